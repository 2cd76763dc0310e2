"""Fill-in-the-middle transformation: texts cut at two random places, found by rank queries on a wavelet matrix.

The bytes of many texts together are mapped to eight character classes, and a wavelet matrix over the classes answers how many of a
class stand before a position. Ranks of several classes add up to counts of unit starts (characters: every class but continuation bytes;
words: the two classes of first characters), and bisection on those counts finds the byte where a text's k-th unit ends. Both cuts of all
texts of a chunk are looked for at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topiclog.llm.base import bounded_batches

MARKERS = ("<P>", "<S>", "<M>")
# Percent of the texts that are cut, and percent of those that start with their suffix.
CUT_PERCENT, SUFFIX_FIRST_PERCENT = 90, 20
CHUNK_BYTES = 1 << 20

# Character classes of bytes.
_CONTINUATION, _LINE_FEED, _SPACE, _LETTER, _SIGN, _WIDE, _FIRST, _FIRST_WIDE = range(8)
_LEVELS = 3
# Classes at which a unit starts.
UNITS = {
    "characters": (_LINE_FEED, _SPACE, _LETTER, _SIGN, _WIDE, _FIRST, _FIRST_WIDE),
    "words": (_FIRST, _FIRST_WIDE),
}


def _byte_classes() -> np.ndarray:
    classes = np.full(256, _WIDE, np.uint8)
    classes[:128] = _SIGN
    classes[128:192] = _CONTINUATION
    for first, last in ("az", "AZ", "09"):
        classes[ord(first):ord(last) + 1] = _LETTER
    classes[[9, 11, 12, 13, 32]] = _SPACE
    classes[10] = _LINE_FEED
    return classes


def classes_of(raw: np.ndarray) -> np.ndarray:
    """The class of every byte; the first byte of a word has a class of its own."""
    classes = _byte_classes()[raw]
    space = (classes == _LINE_FEED) | (classes == _SPACE)
    first = ~space
    first[1:] &= space[:-1]
    # A continuation byte starts nothing, whatever stands before it.
    first &= classes != _CONTINUATION
    classes[first] = np.where(classes[first] == _WIDE, _FIRST_WIDE, _FIRST)
    return classes


class WaveletMatrix:
    """Counts of a class before any position of a sequence of classes.

    One bit vector per level, highest bit first; each level is the one before with its zeros moved in front of its ones. A count
    walks a position down the levels; ones before it come from sums per 64-bit word and a population count.
    """

    def __init__(self, classes: np.ndarray):
        self.length = len(classes)
        self._levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        for level in reversed(range(_LEVELS)):
            ones = (classes >> level & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(packed) // 8 + 1, "<u8")
            words.view(np.uint8)[:len(packed)] = packed
            before = np.zeros(len(words) + 1, np.int64)
            np.cumsum(np.bitwise_count(words), out=before[1:])
            zeros = self.length - int(before[-1])
            self._levels.append((words, before, zeros))
            classes = np.concatenate([classes[~ones], classes[ones]])
        self._origin = [self._walk(c, np.zeros(1, np.int64))[0] for c in range(1 << _LEVELS)]

    def _walk(self, one: int, at: np.ndarray) -> np.ndarray:
        for i, (words, before, zeros) in enumerate(self._levels):
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            ones = before[word] + np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            at = zeros + ones if one >> (_LEVELS - 1 - i) & 1 else at - ones
        return at

    def rank(self, one: int, at: np.ndarray) -> np.ndarray:
        """How many of class ``one`` stand before each position."""
        return self._walk(one, at) - self._origin[one]

    def starts_before(self, unit: Sequence[int], at: np.ndarray) -> np.ndarray:
        """How many bytes of the classes ``unit`` stand before each position: their ranks added, or those of all others taken off."""
        others = [c for c in range(1 << _LEVELS) if c not in unit]
        if len(others) < len(unit):
            return at - sum(self.rank(c, at) for c in others)
        return sum(self.rank(c, at) for c in unit)

    def cut_after(self, unit: Sequence[int], count: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Where ``count`` units of each stretch from ``begin`` to ``end`` are over: at the start of the next unit, or at ``end``.

        By bisection for the last position with at most ``count`` starts before it; nothing cut off is at ``begin``.
        """
        wanted = self.starts_before(unit, begin) + count
        low, high = begin.copy(), end.copy()
        while (open_ := low < high).any():
            middle = (low + high + 1) >> 1
            fits = self.starts_before(unit, middle) <= wanted
            low = np.where(open_ & fits, middle, low)
            high = np.where(open_ & ~fits, middle - 1, high)
        return np.where(count == 0, begin, low)


def chunks(sizes: Sequence[int], most: int) -> Iterator[range]:
    """Neighbours that together are at most ``most`` bytes; a longer one comes alone."""
    at = size = 0
    for i, n in enumerate(sizes):
        if i > at and size + n > most:
            yield range(at, i)
            at, size = i, 0
        size += n
    if at < len(sizes):
        yield range(at, len(sizes))


def cuts(texts: list[bytes], first: np.ndarray, second: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(units, units before the lower cut, units before the upper cut, byte of the lower cut, byte of the upper cut) of each text.

    The cuts of a text of n units are ``first`` and ``second`` modulo n + 1.
    """
    raw = np.frombuffer(b"\n".join([b"", *texts]), np.uint8)
    lengths = np.array([len(t) for t in texts], np.int64)
    end = np.cumsum(lengths + 1)
    begin = end - lengths
    matrix, starts = WaveletMatrix(classes_of(raw)), UNITS[unit]
    units = matrix.starts_before(starts, end) - matrix.starts_before(starts, begin)
    one, two = first % (units + 1), second % (units + 1)
    low, high = np.minimum(one, two), np.maximum(one, two)
    at = matrix.cut_after(starts, np.concatenate([low, high]), np.tile(begin, 2), np.tile(end, 2)) - np.tile(begin, 2)
    return units, low, high, at[:len(texts)], at[len(texts):]


def _transformed(unit: str, markers: tuple[str, str, str], cut_percent: int, suffix_first_percent: int, schema: pa.Schema):
    p, s, m = (x.encode() for x in markers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            h1, h2, h3, h4 = (batch.column(f"h{i}").to_numpy() for i in (1, 2, 3, 4))
            for part in chunks([len(t) for t in texts], CHUNK_BYTES):
                here, rows = texts[part.start:part.stop], slice(part.start, part.stop)
                units, low, high, a, b = cuts(here, h1[rows], h2[rows], unit)
                forms, outputs = [], []
                for text, i, j, x, y in zip(here, a.tolist(), b.tolist(), h3[rows].tolist(), h4[rows].tolist()):
                    if not text or x % 100 >= cut_percent or p in text or s in text or m in text:
                        forms.append("plain")
                        outputs.append(text)
                    elif y % 100 < suffix_first_percent:
                        forms.append("spm")
                        outputs.append(b"".join((s, text[j:], p, text[:i], m, text[i:j])))
                    else:
                        forms.append("psm")
                        outputs.append(b"".join((p, text[:i], s, text[j:], m, text[i:j])))
                plain = np.array([f == "plain" for f in forms], bool)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(part.start, len(part)), pa.array(units, pa.int64()), pa.array(forms, pa.string()),
                    pa.array(low, pa.int64(), mask=plain), pa.array(high - low, pa.int64(), mask=plain), pa.array(outputs, pa.binary()),
                ], schema=schema)

    return run


def _may_overlap(x: str, y: str) -> bool:
    """Whether one marker, with text around it, might hold or begin another."""
    return x != y and x in y or any(y.startswith(x[-k:]) for k in range(1, len(x)))


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "characters", seed: str = "1",
    markers: Sequence[str] = MARKERS, cut_percent: int = CUT_PERCENT, suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
) -> DataFrame:
    """One row per document: its id, n, form, prefix_chars, middle_chars, output.

    The sha256 of ``seed``, a colon and the id as text gives four numbers: the first two, modulo n + 1, are the cuts of a text of n
    ``unit`` (``characters``: code points; ``words``: runs without ASCII white space, each with the white space behind it), the third
    says whether it is cut at all, the fourth which part comes first. Forms: ``psm`` prefix, suffix, middle; ``spm`` suffix, prefix,
    middle, each behind its marker; ``plain`` the text, for empty texts, those that hold a marker, and those not cut, with null counts.

    A null text is empty; a null id is no digit in the hash. Repeated rows come out alike, each once. Only the two columns are
    read, so others may have any name. An empty table gives no rows. No shuffle; a task holds a batch and the classes of one text.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    if unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}, not {unit!r}")
    if len(set(markers)) != 3 or len(markers) != 3 or not all(markers) or any(_may_overlap(x, y) for x in markers for y in markers):
        raise ValueError("three different markers are needed, none in another or ending as one begins")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    source = bounded_batches(docs).select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"), digest.alias("digest"),
    ).select("id", "text", *[F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)])
    fields = ["n long", "form string", "prefix_chars long", "middle_chars long", "output binary"]
    schema = source.select("id").sparkSession.createDataFrame([], ", ".join([f"id {source.schema['id'].dataType.simpleString()}", *fields])).schema
    run = _transformed(unit, tuple(markers), cut_percent, suffix_first_percent, to_arrow_schema(schema))
    return source.mapInArrow(run, schema).select(
        F.col("id").alias(id_col), "n", "form", "prefix_chars", "middle_chars", F.col("output").cast("string").alias("output"))


def restored(output: Column, form: Column, markers: Sequence[str] = MARKERS) -> Column:
    """The text that was transformed: what stands behind the markers, in order. Null for a form that is none."""
    pattern = "|".join(f"\\Q{m}\\E" for m in markers)
    parts = F.split(output, pattern)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
    )


ORACLE = """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents
), drawn AS (
  SELECT doc_id, t, length(t)::BIGINT AS n, ('0x' || substr(d, 1, 8))::BIGINT AS h1, ('0x' || substr(d, 9, 8))::BIGINT AS h2,
    ('0x' || substr(d, 17, 8))::BIGINT AS h3, ('0x' || substr(d, 25, 8))::BIGINT AS h4 FROM hashed
), cut AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn
), parts AS (
  SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""
