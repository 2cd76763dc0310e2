import collections
import os
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from topiclog.llm import language, licenses, mixing, packing, quality, queries, sharding
from topiclog.llm.base import per_process

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0d]+")


# Sharding

def test_shards_match_the_mixture(documents, generated):
    rows = sharding.sharded(documents(generated), 7).collect()
    assert {tuple(r)[:4] for r in rows} == set(generated) and len(rows) == len(generated)
    by_shard = collections.defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r)
    sizes = [len(by_shard[s]) for s in range(7)]
    assert max(sizes) - min(sizes) <= 1
    total = collections.Counter(r[3] for r in generated)
    for shard in by_shard.values():
        assert sorted(r.slot for r in shard) == list(range(len(shard)))
        for source, n in collections.Counter(r.source for r in shard).items():
            assert abs(n - total[source] * len(shard) / len(generated)) <= len(total)


def test_shards_by_brute_force(spark, documents, generated):
    """The order is that of fractional ranks within each source; only the hash is taken from Spark."""
    docs = documents(generated)
    key = F.xxhash64(F.lit(0), F.col("doc_id").cast("string"), F.col("text"))
    slices = sharding._slices(len(generated))
    numbers = {r.doc_id: r.n for r in docs.select("doc_id", key.alias("n")).collect()}
    ranks = []
    for source in {r[3] for r in generated}:
        own = sorted((r[0] for r in generated if r[3] == source), key=lambda i: (((numbers[i] % 2**64) >> 1) % slices, numbers[i]))
        ranks += [((2 * k + 1) / (2 * len(own)), "" if source is None else "=" + source, i) for k, i in enumerate(own)]
    small, larger = divmod(len(ranks), 4)
    expected, place = {}, 0
    order = [i for _, _, i in sorted(ranks)]
    for shard in range(4):
        for slot in range(small + (shard < larger)):
            expected[order[place]] = (shard, slot)
            place += 1
    assert {r.doc_id: (r.shard, r.slot) for r in sharding.sharded(docs, 4).collect()} == expected


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")
def test_the_query_shards_texts(spark, monkeypatch):
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.op3_stratified_sharding(spark, SF_DIR).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {i: (len(t) + 1, zlib.crc32(t)) for i, t in docs.items()}
    real = sharding.sharded
    monkeypatch.setattr(sharding, "sharded", lambda *a, **k: real(*a, **k).withColumn("text", F.lit("out")))
    out = queries.op3_stratified_sharding(spark, SF_DIR).collect()
    assert {(r.size, r.text_crc32) for r in out} == {(4, zlib.crc32(b"out"))}
    assert {(r.doc_id, r.shard, r.slot) for r in out} == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_shards_of_odd_tables(documents, spark, tmp_path):
    assert sharding.sharded(documents([]), 3).count() == 0
    same = sharding.sharded(documents([(None, None)] * 5 + [(1, "a", None, "s")] * 2), 3)
    assert sorted((r.shard, r.slot) for r in same.collect()) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (2, 0), (2, 1)]
    clash = spark.createDataFrame([(1, "t", "s", "x")], "doc_id long, text string, source string, shard string")
    assert sharding.sharded(clash, 2).collect()[0].asDict() == {"doc_id": 1, "text": "t", "source": "s", "shard": 0, "slot": 0}
    sharding.write_shards(same, str(tmp_path / "shards"), 2)
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 7
    with pytest.raises(ValueError):
        sharding.sharded(same, 0)


# Mixing

def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_ = share * sum(sizes.values()), set(names)
    target = {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level >= cap * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 900, None: 50}, {"a": 10, "b": 10, "c": 10, "d": 1000}, {"x": 5}, {"a": 0, "b": 7}, {"é": 3, "z": 1, "Z": 9}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(frame).collect()}
    assert found == pytest.approx(brute_targets(sizes))


def test_copies_reach_their_targets(documents, generated):
    found = mixing.copies(documents(generated)).collect()
    size = lambda t: len(WORD.findall(t or ""))
    assert sorted((r.doc_id, r.size, r.source or "") for r in found) == sorted((r[0], size(r[1]), r[3] or "") for r in generated)
    sums = collections.Counter()
    for r in generated:
        sums[r[3]] += size(r[1])
    target = brute_targets(dict(sums))
    taken = collections.Counter()
    for r in found:
        assert r.source_size == sums[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r.size
    longest = max(size(r[1]) for r in generated)
    for source in sums:
        assert abs(taken[source] - target[source]) <= longest / 2 + 1
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, mixing.copies(documents(generated)).collect()), key=repr)


def test_copies_go_to_the_least_order(documents, generated):
    """Within a source, those with a copy more are the ones with the least uniform number."""
    docs = documents(generated)
    drawn = {r.doc_id: r["__u"] for r in docs.select("doc_id", *mixing._numbers("doc_id", "text", "source", 0)).collect()}
    by_source = collections.defaultdict(list)
    for r in mixing.copies(docs).collect():
        by_source[r.source].append((drawn[r.doc_id], r.copies))
    for own in by_source.values():
        copies = [c for _, c in sorted(own)]
        assert copies == sorted(copies, reverse=True)


def test_mixture_of_odd_tables(documents, spark, generated):
    docs = documents(generated)
    copies = {r.doc_id: r.copies for r in mixing.copies(docs).collect()}
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns
    assert collections.Counter(r.doc_id for r in mixed.collect()) == {i: c for i, c in copies.items() if c}
    assert mixing.copies(documents([])).count() == 0 and mixing.mixture(documents([])).count() == 0
    assert [r.copies for r in mixing.copies(documents([(1, None), (2, " ")])).collect()] == [0, 0]
    assert {r.copies for r in mixing.copies(documents([(None, "a b", None, "s")] * 3)).collect()} <= {1, 2}
    clash = spark.createDataFrame([(1, "a b", "s", 9, 8)], "doc_id long, text string, source string, size int, copies int")
    assert {tuple(r) for r in mixing.mixture(clash).collect()} == {(1, "a b", "s", 9, 8)}


# Packing

def test_remembered_keys_live_for_two_generations():
    made = []
    known = packing.Remembered(lambda k: made.append(k) or k.upper(), 2)
    for keys in ([b"a", b"b", b"c"], [b"a"], [b"b"], [b"d", b"e"], [b"c"], [b"a"]):
        known.age()
        assert [known[k] for k in keys] == [k.upper() for k in keys]
    assert made == [b"a", b"b", b"c", b"d", b"e", b"c"]


def test_first_fit_as_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(50):
        sizes = sorted(rng.integers(1, 50, rng.integers(1, 60)).tolist(), reverse=True)
        room, expected = [], []
        for s in sizes:
            at = next((i for i, r in enumerate(room) if r >= s), len(room))
            if at == len(room):
                room.append(50)
            expected.append((at, 50 - room[at]))
            room[at] -= s
        assert list(zip(*packing.first_fit(sizes, 50))) == expected
    assert packing.first_fit([], 5) == ([], [])
    with pytest.raises(ValueError):
        packing.first_fit([6], 5)


def encoded(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


ODD = ["", " \n", "It's it's. don't!! CAN'T", "<|endoftext|> x<|endoftext|>.", "<|ENDOFTEXT|>", "áb é.", "Straße Σίσυφος ΟΔΥΣΣΕΥΣ. İstanbul",
       "12ab3. x1, 3.14", "漢字かな交じり文。テスト", "a\x1cb\x1d c\x85d e\xa0f", "🙂🙂. ok?!*#", "½ ² Ⅷ ﬁ", "x" * 300 + ". y", "don’t l’eau « »."]


def test_a_word_is_remembered_once():
    """A plain word, what follows it and the strings that hold both are remembered once each, with the library's ids."""
    import public_tokenizers

    encoder = packing.Encoder(public_tokenizers.path(packing.TOKENIZER))
    strings = ["thing", "thing,", "Thing", ",", "zuäbe", "ZUÄBE...", "λόγος", "λόγος", "sλa!", "x1", "!?", "don't.", "ŸŸ", "ÿÿ&"]
    found = encoder.encoded([" ".join(strings).encode()])
    assert found == [np.array(encoder._full.encode(" ".join(strings), add_special_tokens=False).ids, "<u4").tobytes()]
    kept = [key for memory in vars(encoder).values() if isinstance(memory, packing.Remembered) for key in memory]
    assert {"thing", "zuäbe", ","} <= {key.decode() for key in kept}
    assert len(kept) == len(set(kept))


def test_words_of_latin_letters_need_the_model_only(monkeypatch):
    import public_tokenizers

    encoder = packing.Encoder(public_tokenizers.path(packing.TOKENIZER))
    words = ["zu\u00f6", "RE\u00c9LE", "\u00e9\u00ea\u00e7.", "\u017dl\u0165!", "stra\u00dfe", "no\u00f1"]
    # One letter that has no single lower-case letter, one that is not composed, one of another script.
    odd = ["\u0130x", "e\u0301t", "\u03a3\u03c2"]
    expected = [encoder._of_any(w) for w in words + odd]
    asked, real = [], encoder._of_any
    monkeypatch.setattr(encoder, "_of_any", lambda text: asked.append(text) or real(text))
    assert encoder.encoded([w.encode() for w in words + odd]) == expected
    assert not {w.strip(".!").lower() for w in words} & {a.strip(".!").lower() for a in asked} and asked[-3:] == odd


def test_ids_are_those_of_the_tokenizer():
    found = dict(packing.token_ids([t.encode() for t in ODD]))
    assert [np.frombuffer(found[i], "<u4").tolist() for i in range(len(ODD))] == [encoded(t)[:-1] for t in ODD]


def test_long_texts_are_encoded_whole():
    text = "lorem ipsum, dolor. " * 60_000
    (_, ids), = packing.token_ids([text.encode()])
    assert np.frombuffer(ids, "<u4").tolist() == encoded("lorem ipsum, dolor.")[:-1] * 60_000


def test_sequences_hold_every_id_once(documents, generated):
    rows = [r[:2] for r in generated] + [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, None), (5000, "word " * 700), (5000, "word " * 700)]
    pieces = packing.sequences(documents(rows), length=128).collect()
    by_doc = collections.defaultdict(list)
    by_sequence = collections.defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) // 4 <= 128
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for i, text in rows:
        if i == 5000:
            continue
        own = sorted(by_doc[i], key=lambda p: p.start)
        assert np.frombuffer(b"".join(p.ids for p in own), "<u4").tolist() == encoded(text)
        assert all(p.doc_tokens == len(encoded(text)) for p in own)
        assert [p.start for p in own] == list(range(0, len(encoded(text)), 128))
    assert sum(p.length for p in by_doc[5000]) == 2 * len(encoded("word " * 700))
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 128
    tokens = sum(p.length for p in pieces)
    assert len(by_sequence) <= 1.05 * tokens / 128 + 1
    assert packing.sequences(documents([])).count() == 0


def test_groups_follow_pieces(documents, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 8)
    pieces = packing.sequences(documents([(i, f"word{i} " * 900) for i in range(4)]), length=16).collect()
    assert len(pieces) > 200
    assert max(collections.Counter(p.sequence_id >> 32 for p in pieces).values()) <= 32


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")
def test_alike_pieces_without_ids_spread_over_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 500)
    docs = spark.range(20_000).selectExpr("cast(null as long) as doc_id", "'the same few words' as text")
    found = packing.sequences(docs).groupBy(F.shiftright("sequence_id", 32).alias("g")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("length").alias("words"), F.countDistinct("sequence_id").alias("sequences")).collect()
    assert sum(r.n for r in found) == 20_000
    assert len(found) == 40 and max(r.n for r in found) < 1000
    assert all((r.sequences - 1) * 2048 <= r.words + r.sequences * 5 for r in found)


def test_the_query_packs_ids(spark, monkeypatch):
    cut = packing.pieces(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    expected = {(r.doc_id, r.start, r.length, zlib.crc32(r.ids)) for r in cut.collect()}
    real, taken = packing.packed, []
    monkeypatch.setattr(packing, "packed", lambda rows, *a, **k: taken.append(rows.columns) or real(rows, *a, **k))
    rows = queries.op5_packing(spark, SF_DIR).collect()
    assert "ids" in taken[0]
    assert {(r.doc_id, r.start, r.length, r.ids_crc32) for r in rows} == expected


# Quality

@pytest.fixture(scope="module")
def judged(spark, documents):
    import random

    rng = random.Random(9)
    good = lambda: " ".join(rng.choice(["the", "river", "went", "over", "stones", "and", "birds"]) for _ in range(30))
    bad = lambda: " ".join(rng.choice(["XX!!", "$$$", "win", "cash", "0000"]) for _ in range(30))
    rows = [(i, bad() if i % 4 == 0 else good()) for i in range(240)]
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1) for i in range(240)], "doc_id long, quality int")
    return rows, labels


def test_quality_of_held_out_documents(documents, judged):
    rows, labels = judged
    found = quality.quality(documents(rows), labels).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [r for r in found if r.held_out]
    assert len(held) > 20 and all(r.predicted == (r.doc_id % 4 != 0) for r in held)


def test_held_out_labels_teach_nothing(spark, documents, judged):
    rows, labels = judged
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = ({r.doc_id: r.score for r in quality.quality(documents(rows), x).collect()} for x in (labels, flipped))
    assert first == second


def test_scores_as_brute_force(documents, judged):
    rows, labels = judged
    model = quality.learned(documents(rows), labels)
    texts = [r[1] for r in rows[:20]] + ["", None, "win win win", "é ñ"]
    found = {r.doc_id: r.score for r in quality.scored(documents(list(enumerate(texts))), model).collect()}
    weights, bias = model
    for i, text in enumerate(texts):
        buckets = np.concatenate([b for _, b, _ in quality.features([(text or "").encode()])]) if text else np.zeros(0, int)
        logit = (weights[buckets].mean(dtype=float) if len(buckets) else 0.0) + bias
        assert found[i] == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-6)


def test_quality_of_odd_tables(spark, documents, judged):
    rows, labels = judged
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.quality(documents([(1, "a"), (None, None)]), none).collect()} == {0.5}
    assert quality.quality(documents([]), labels).count() == 0
    odd = spark.createDataFrame([(None, 1), (0, None), (0, 7), (1, 1), (1, 0)], "doc_id long, quality int")
    assert quality.quality(documents(rows), odd).count() == len(rows)
    clash = spark.createDataFrame([(1, "the river went over stones", 3.5, "x")], "doc_id long, text string, score double, label string")
    kept = quality.good(clash.union(clash), labels.limit(0), threshold=0.4)
    assert [r.asDict() for r in kept.collect()] == [{"doc_id": 1, "text": "the river went over stones", "score": 3.5, "label": "x"}] * 2


def test_features_of_whole_and_of_long_texts():
    long = ("alpha beta " * 120_000).encode()
    parts = list(quality.features([b"a b", long, b""]))
    counts = collections.Counter()
    for numbers, buckets, docs in parts:
        for j, i in enumerate(numbers):
            counts[i] += int((docs == j).sum())
    assert counts[1] > 240_000 and counts[0] > 0 and counts[2] == 0


# Languages

def test_automaton_holds_exactly_the_substrings():
    text = "abcbcabbacab"
    automaton = language.SuffixAutomaton(text)
    for n in range(1, 6):
        for word in {text[i:i + n] for i in range(len(text) - n + 1)}:
            assert automaton.phrases(word) == 1
    assert automaton.phrases("") == 0 and automaton.phrases("zz") == 2 and automaton.phrases("aza") == 3


def test_greedy_parse_as_brute_force():
    import random

    rng = random.Random(4)
    for _ in range(60):
        text = "".join(rng.choice("abc") for _ in range(30))
        word = "".join(rng.choice("abcd") for _ in range(12))
        at = count = 0
        while at < len(word):
            n = next((n for n in range(len(word) - at, 0, -1) if word[at:at + n] in text), 1)
            at += n
            count += 1
        assert language.SuffixAutomaton(text).phrases(word) == count


def test_a_process_keeps_one_model():
    made = []

    def model(version):
        return per_process("test model", lambda: made.append(version) or object(), version)

    first = model("a")
    assert model("a") is first and model("b") is not first and model("b") is model("b")
    assert made == ["a", "b"]


def test_number_signs_are_no_letters():
    assert language._LETTERS.findall("½ ² ③ 7_") == [] and language._LETTERS.findall("x²y é漢") == ["x", "y", "é漢"]


def test_languages_of_documents(documents, spark):
    import random

    rng = random.Random(2)
    syllables = {"xx": ["ka", "ro", "mi"], "yy": ["sch", "ung", "eit"], "zz": ["çé", "où", "eau"]}
    text = lambda lang, n: " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))
    rows = [(i, text(lang := rng.choice("xyz") * 2, 25), lang) for i in range(150)]
    odd = [(900, None, None), (901, "12 ... !", "xx"), (902, "", None), (903, "sch" * 1_000_000, None), (None, "karo mika", None), (904, "KARO Mika", None)]
    found = language.languages(documents(rows + odd)).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(rows) + len(odd)
    assert all(by_id[i].lang_pred == lang for i, _, lang in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found if r.doc_id is not None)
    assert [by_id[i].lang_pred for i in (900, 901, 902, 903, None, 904)] == ["und", "und", "und", "yy", "xx", "xx"]
    assert all(0 <= r.score <= 1 for r in found)
    assert language.languages(documents([])).count() == 0
    assert {r.lang_pred for r in language.languages(documents([(1, "abc")])).collect()} == {"und"}


# License scans

def test_license_passages(documents, spark):
    mit = dict((n, t) for n, t in licenses.TEMPLATES if len(t) > 200)["MIT"]
    wrapped = "\n".join(re.findall(r".{1,60}(?: |$)", mit))
    rows = [
        (1, "words before\nReleased under the MIT license!\nwords after"), (2, "Some title\n\n" + wrapped + "\n\nmore"), (3, mit.upper()),
        (4, "nothing of the kind here"), (5, None), (6, ""), (7, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0."), (8, "\n" * 50_000 + "x" * 100_000),
        (None, "released under the mit license"), (9, "Released under the old MIT License."), (10, "a b"),
    ]
    found = {r.doc_id: r for r in licenses.scanned(documents(rows)).collect()}
    assert len(found) == len(rows)
    assert (found[1].license, found[1].dice, found[1].passage_kind, found[1].passage_no, found[1].matches) == ("MIT", 1.0, "line", 1, 1)
    assert (found[2].license, found[2].passage_kind, found[2].passage_no) == ("MIT", "paragraph", 1)
    assert (found[3].license, found[3].passage_kind, found[3].matches) == ("MIT", "text", 3)
    for i in (4, 5, 6, 8, 9, 10):
        assert tuple(found[i])[1:] == (None, None, None, None, 0)
    # Both lines, and as one paragraph and text: 6 of 8 bigrams are the template's 6, a coefficient of 12 / 14.
    assert (found[7].license, found[7].dice, found[7].passage_no, found[7].matches) == ("CC-BY-NC-4.0", 1.0, 0, 4)
    assert found[None].license == "MIT"
    assert licenses.scanned(documents([])).count() == 0
    for bad in ({"threshold": 0}, {"templates": (("x", "one"),)}):
        with pytest.raises(ValueError):
            licenses.scanned(documents([]), **bad)


def test_texts_without_telling_words_match_nothing():
    known = [licenses.template_bigrams(t) for _, t in licenses.TEMPLATES]
    words = set(licenses.telling_words(known, 0.8))
    for bigrams in known:
        left = [b for b in bigrams if not words & set(b.split())]
        assert 2 * len(left) / (len(left) + len(bigrams)) < 0.8
    assert len(words) < 150


def test_notices_and_texts_have_their_own_names(documents, spark):
    notice = ("This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by "
              "the Free Software Foundation; either version {} of the License, or (at your option) any later version.")
    redistribution = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following\n"
                      "conditions are met:")
    cases = [
        (notice.format("program", "", "2"), "GPL-2.0"), (notice.format("program", "", "3"), "GPL-3.0"),
        (notice.format("program", "Affero ", "3"), "AGPL-3.0"), (notice.format("library", "Lesser ", "2.1"), "LGPL-2.1"),
        ("Licensed under the MIT License.", "MIT"), ("Copyright Somebody\n\n" + redistribution + "\n\n1. and so on", "BSD"),
    ]
    cases += [(f"Some words before it\n{text}", name) for name, text in licenses.TEXTS]
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MIT", "MPL-2.0"} <= {name for name, _ in licenses.TEXTS}
    found = {r.doc_id: r for r in licenses.scanned(documents([(i, text) for i, (text, _) in enumerate(cases)])).collect()}
    assert [found[i].license for i in range(len(cases))] == [name for _, name in cases]


def test_sentences_within_a_line(documents, spark):
    mpl = dict((n, t) for n, t in licenses.NOTICES)["MPL-2.0"]
    rows = [(1, "A small tool.  Licensed under the MIT License. Have fun with it, and write to us."), (2, f"Some words. {mpl} More words follow here!"),
            (3, "Licensed under the MIT License."), (4, "One. Two. Three."), (5, None), (6, ""), (7, "... . .\n.")]
    plain = {r.doc_id: r for r in licenses.scanned(documents(rows)).collect()}
    found = {r.doc_id: r for r in licenses.scanned(documents(rows), within_lines=True).collect()}
    assert plain[1].license is None and len(found) == len(rows)
    assert tuple(found[1])[1:] == ("MIT", 1.0, "sentences", 1, 1)
    assert (found[2].license, found[2].dice, found[2].passage_kind) == ("MPL-2.0", 1.0, "sentences")
    assert all(found[i] == plain[i] for i in (3, 4, 5, 6, 7))
