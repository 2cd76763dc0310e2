"""License scans: passages of documents against license templates, by the Dice coefficient of their word bigrams.

Passages are the lines of a text, its paragraphs (between blank lines) and the whole text; on demand also runs of sentences within a
line. Both sides are normalised to lower-case
words of letters and digits. With a passage of n and a template of m distinct bigrams the coefficient is at most 2 min(n, m) / (n + m),
so only templates whose size lies within bounds of the passage's are compared. The same bounds say how many of a template's bigrams a
passage must share at least; a text without certain words of each template cannot, and is passed over. All of this happens
in the row that holds the text: nothing is shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
# Templates are literals of the plan; a longer list would have to become a table.
MOST_TEMPLATES = 500

# Wordings of common license notices, as their publishers state them.
NOTICES: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically "
     "designed to ensure cooperation with the community in the case of network server software."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
     "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
     "conditions are met:"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
     "derived from this software without specific prior written permission."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
     "version 2 as published by the Free Software Foundation."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
     "provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
     "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-2.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public "
     "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
     "License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
     'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
     "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
     "furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# Sentences of a line that are compared together at most: the longest of NOTICES has three, counting the dot in "v. 2.0".
MOST_SENTENCES = 3
_SENTENCE = "\u0001"
# Whole texts, a file each, named by license.
TEXTS: tuple[tuple[str, str], ...] = tuple(
    (file.stem, " ".join(file.read_text(encoding="utf-8").split())) for file in sorted((Path(__file__).parent / "license_texts").glob("*.txt")))
TEMPLATES = NOTICES + TEXTS
# Words that most texts have.
_COMMON = frozenset(
    "1 2 3 a all an and any are as at be been but by can do each for free from has have if in is it its make may means more no not of on one only or "
    "s shall so than that the their there these they this those to under use was we when which will with within without you your".split())
COLUMNS = ("doc_id", "license", "dice", "passage_kind", "passage_no", "matches")


def template_bigrams(text: str) -> list[str]:
    """Distinct bigrams of the normalised words, in order of the text."""
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def telling_words(templates: list[list[str]], threshold: float) -> list[str]:
    """Words of which a text must hold at least one to match any of the templates (lists of bigrams).

    A match shares at least threshold / (2 - threshold) of the template's bigrams. Words are chosen, common ones last and else
    those in most bigrams first, until the bigrams that hold one of them are more than a match may lack: a text without these words lacks
    them all.
    """
    chosen: set[str] = set()
    for bigrams in templates:
        may_lack = len(bigrams) - math.ceil(len(bigrams) * threshold / (2 - threshold) - 1e-9)
        left = [b for b in (set(b.split(" ")) for b in bigrams) if not b & chosen]
        while len(bigrams) - len(left) <= may_lack:
            held = Counter(w for b in left for w in b)
            word = min(held, key=lambda w: (w in _COMMON, -held[w], -len(w), w))
            chosen.add(word)
            left = [b for b in left if word not in b]
    return sorted(chosen)


def normalised(text: Column) -> Column:
    """Lower-case words of letters and digits between single spaces; line ends stay."""
    return F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}\\n]+", " ")


def sentence_runs(text: Column) -> Column:
    """Normalised runs of 1 to MOST_SENTENCES sentences that are less than their line, line by line, the shorter first."""
    marked = F.regexp_replace(F.lower(text), "[.!?][\"')\\]]*[ \\t]+", _SENTENCE)
    lines = F.split(F.regexp_replace(marked, f"[^\\p{{L}}\\p{{N}}\\n{_SENTENCE}]+", " "), "\n")

    def runs(parts: Column) -> Column:
        return F.flatten(F.transform(F.sequence(F.lit(1), F.least(F.size(parts) - 1, F.lit(MOST_SENTENCES))), lambda k: F.transform(
            F.sequence(F.lit(1), F.size(parts) - k + 1), lambda j: F.array_join(F.slice(parts, j, k), " "))))

    parts = F.filter(F.transform(lines, lambda line: F.split(F.btrim(line, F.lit(" " + _SENTENCE)), _SENTENCE)), lambda p: F.size(p) > 1)
    return F.flatten(F.transform(parts, runs))


def _bigrams(passage: Column) -> Column:
    words = F.split(F.btrim(F.regexp_replace(passage, "[ \\n]+", " ")), " ")
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
                       lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(pairs)


def scanned(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD,
            id_col: str = "doc_id", text_col: str = "text", within_lines: bool = False) -> DataFrame:
    """One row per document: doc_id, license, dice, passage_kind, passage_no, matches.

    ``matches`` counts the passages whose best template reaches ``threshold``; the other columns tell of the best of them: the highest
    coefficient, then the longer kind of passage (sentences, line, paragraph, text), then the first. Sentences are compared only
    with ``within_lines``, which :func:`oracle` does not know. Of templates with equal coefficients the one
    that comes first in the list wins. Documents without a match, with null or empty text have nulls and 0
    matches. Passages of fewer than two words match nothing. Repeated rows are judged alike; an empty table gives no rows.
    """
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is above 0 and at most 1")
    known = [(name, template_bigrams(text)) for name, text in templates]
    if any(len(b) < 1 for _, b in known):
        raise ValueError("a template needs two words")
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    least, most = min(len(b) for _, b in known) * low, max(len(b) for _, b in known) * high
    sizes = F.array(*(F.struct(F.lit(i).alias("nth"), F.lit(len(b)).alias("size"), F.lit(name).alias("name"),
                               F.split(F.lit(",".join(b)), ",").alias("bigrams")) for i, (name, b) in enumerate(known)))

    def dice(bigrams: Column, template: Column) -> Column:
        return 2.0 * F.size(F.array_intersect(bigrams, template["bigrams"])) / (F.size(bigrams) + template["size"])

    def best(bigrams: Column) -> Column:
        near = F.filter(sizes, lambda t: (t["size"] >= F.size(bigrams) * low - 1e-9) & (t["size"] <= F.size(bigrams) * high + 1e-9))
        rated = F.transform(near, lambda t: F.struct(dice(bigrams, t).alias("dice"), (-t["nth"]).alias("order"), t["name"].alias("license")))
        return F.array_max(F.filter(rated, lambda r: r["dice"] >= threshold - 1e-9))

    def passages(kind: int, name: str, parts: Column) -> Column:
        rated = F.transform(parts, lambda p, i: F.struct(_bigrams(p).alias("bigrams"), F.lit(kind).alias("kind"), F.lit(name).alias("name"), i.alias("i")))
        return F.filter(rated, lambda r: (F.size(r["bigrams"]) >= least - 1e-9) & (F.size(r["bigrams"]) <= most + 1e-9))

    norm = F.col("__norm")
    words = F.array(*map(F.lit, telling_words([b for _, b in known], threshold)))
    # The templates are in the plan once, for passages of all kinds.
    fitting = F.concat(
        passages(0, "line", F.split(norm, "\n")), passages(1, "paragraph", F.split(norm, "\n *\n[ \n]*")), passages(2, "text", F.array(norm)),
        *([passages(-1, "sentences", sentence_runs(F.col("__raw")))] if within_lines else []))
    matching = F.filter(F.transform(fitting, lambda r: F.struct(best(r["bigrams"]).alias("best"), r["kind"], r["name"], r["i"])),
                        lambda p: p["best"].isNotNull())
    found = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("__norm"), F.col(text_col).alias("__raw")).select(
        "doc_id", F.when(F.arrays_overlap(F.split(norm, "[ \n]"), words), matching).alias("__found"))
    top = F.array_max(F.transform("__found", lambda p: F.struct(
        p["best"]["dice"].alias("dice"), p["kind"].alias("kind"), (-p["i"]).alias("order"), p["best"]["license"].alias("license"), p["name"].alias("name"))))
    return found.select("doc_id", top.alias("__top"), F.coalesce(F.size("__found"), F.lit(0)).alias("matches")).select(
        "doc_id", "__top.license", "__top.dice", F.col("__top.name").alias("passage_kind"),
        (-F.col("__top.order")).cast("int").alias("passage_no"), F.greatest("matches", F.lit(0)).alias("matches"))


def oracle(templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same as SQL, by comparing every passage with every template."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({i}, {quote(name)}, [{', '.join(map(quote, template_bigrams(text)))}])" for i, (name, text) in enumerate(templates))
    return rf"""
WITH templates(nth, license, bigrams) AS (VALUES {rows}),
norm AS (SELECT row_number() OVER () AS id, doc_id, regexp_replace(lower(text), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS t FROM documents),
passages AS (
  SELECT id, 0 AS kind, 'line' AS name, unnest(string_split(t, chr(10))) AS p, generate_subscripts(string_split(t, chr(10)), 1) - 1 AS i FROM norm
  UNION ALL SELECT id, 1, 'paragraph', unnest(string_split_regex(t, '\n *\n[ \n]*')), generate_subscripts(string_split_regex(t, '\n *\n[ \n]*'), 1) - 1 FROM norm
  UNION ALL SELECT id, 2, 'text', t, 0 FROM norm WHERE t IS NOT NULL
), worded AS (
  SELECT id, kind, name, i, string_split(trim(regexp_replace(p, '[ \n]+', ' ', 'g')), ' ') AS w FROM passages
), paired AS (
  SELECT id, kind, name, i, list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS b FROM worded WHERE len(w) > 1
), rated AS (
  SELECT id, kind, p.name, i, license, nth, 2.0::DOUBLE * len(list_intersect(b, t.bigrams)) / (len(b) + len(t.bigrams)) AS dice
  FROM paired p JOIN templates t ON 2.0 * least(len(b), len(t.bigrams)) / (len(b) + len(t.bigrams)) >= {threshold} - 1e-9
), best AS (
  SELECT * FROM rated WHERE dice >= {threshold} - 1e-9
  QUALIFY row_number() OVER (PARTITION BY id, kind, i ORDER BY dice DESC, nth) = 1
), one AS (
  SELECT *, (count(*) OVER (PARTITION BY id))::INTEGER AS matches FROM best
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY dice DESC, kind DESC, i) = 1
)
SELECT doc_id, license, dice, name AS passage_kind, i::INTEGER AS passage_no, coalesce(matches, 0) AS matches FROM norm LEFT JOIN one USING (id)
"""
