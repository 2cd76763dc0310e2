"""Packing token sequences: first-fit decreasing over a tournament tree of free room, in randomised groups.

A document's ids are cut at multiples of the sequence length, so only its last piece can be short. A hash deals the pieces to
groups of a few thousand; in each group they are placed by falling length, each into the first sequence with room.
The tree holds the most room below each node, so that sequence is found in a walk from the root to a leaf.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Callable, Iterator
from operator import attrgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topiclog.llm.base import bounded_batches, others, per_process, stored
from topiclog.llm.textbytes import CHUNK_BYTES, cut

LENGTH = 2048
END_ID = 1
# Pieces for each group, on average: large enough that the last sequences of a group hardly count.
GROUP_ROWS = 4096
TOKENIZER = "word_bpe_49k.json"
# Distinct strings whose ids a worker process keeps in each of two generations.
REMEMBERED = 200_000
_TAIL = b".,;:!?*#%$&"
# Letters that are composed already and have one lower-case letter each: A to Z, Latin-1 and Latin Extended-A but for U+0130, U+0149 and U+017F.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e"
_latin_word = re.compile(f"[{_LATIN}]+").fullmatch
# The character that stands for each byte in a byte-level vocabulary: itself if it prints, else one from U+0100 on, in turn.
_PRINTS = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_OTHERS = [b for b in range(0x100) if b not in _PRINTS]
_BYTE_LETTERS = "".join(chr(b if b in _PRINTS else 0x100 + _OTHERS.index(b)) for b in range(0x100))
_id = attrgetter("id")
COLUMNS = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")


class Remembered(dict):
    """Values by key, made when first asked for, in two generations: keys that come again stay, others are forgotten in time."""

    def __init__(self, make: Callable[[bytes], bytes], most: int):
        self._make, self._most = make, most
        self._old: dict[bytes, bytes] = {}

    def __missing__(self, key: bytes) -> bytes:
        value = self._old.get(key)
        if value is None:
            value = self._make(key)
        self[key] = value
        return value

    def age(self) -> None:
        """Begin a new generation if this one is full."""
        if len(self) > self._most:
            self._old = dict(self)
            self.clear()


class Encoder:
    """The ids of whole texts, as little-endian unsigned 32-bit numbers, from the ids of their space-separated strings.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its strings in turn. Punctuation
    after a plain word is a token run of its own, and case does not matter: a string's ids are those of its word in lower case and
    of what follows it, each remembered as a string of its own. Words of ASCII letters need no normalising or splitting, so the
    vocabulary's model alone gives their ids. So it does for words of other Latin letters, written byte by byte, if the vocabulary
    is seen to lower their case and to be of bytes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._full = Tokenizer.from_file(path)
        self._model = self._full.model
        self._strings = Remembered(self._string, REMEMBERED)
        letters = "".join(c for c in map(chr, range(0x180)) if _latin_word(c))
        probes = [letters, *(f"a{c}b" for c in letters)]
        self._latin = all(self._of_latin(w) == self._of_any(w) for w in probes)

    def _of_any(self, text: str) -> bytes:
        return array("I", self._full.encode(text, add_special_tokens=False).ids).tobytes()

    def _of_letters(self, letters: str) -> bytes:
        return array("I", map(_id, self._model.tokenize(letters))).tobytes()

    def _of_latin(self, word: str) -> bytes:
        return self._of_letters(codecs.charmap_decode(word.lower().encode(), "strict", _BYTE_LETTERS)[0])

    def _string(self, s: bytes) -> bytes:
        word = s.rstrip(_TAIL)
        if word.isalpha():
            plain = word.lower()
            if plain == s:
                return self._of_letters(s.decode())
        elif word.isascii():
            return self._of_any(s.decode())
        elif self._latin and _latin_word(text := word.decode()):
            plain = text.lower().encode()
            if plain == s:
                return self._of_latin(text)
        elif len(word) < len(s) and word[-1:].isalpha() and word.decode().isalpha():
            plain = word
        else:
            return self._of_any(s.decode())
        known = self._strings[plain]
        return known + self._strings[s[len(word):]] if len(word) < len(s) else known

    def encoded(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text; ``texts`` together are of the size of a chunk."""
        self._strings.age()
        get = self._strings.__getitem__
        return [b"".join(map(get, t.split())) for t in texts]


def _encoder(path: str | None) -> Encoder:
    def make() -> Encoder:
        if path is not None:
            return Encoder(path)
        import public_tokenizers

        return Encoder(public_tokenizers.path(TOKENIZER))

    return per_process(f"encoder {path}", make)


def token_ids(texts: list[bytes], path: str | None = None) -> Iterator[tuple[int, bytes]]:
    """(number of the text, its ids) in turn; long texts are encoded a piece at a time."""
    encoder = _encoder(path)
    group: list[int] = []
    size = 0

    def ready():
        return zip(group, encoder.encoded([texts[i] for i in group]))

    for i, text in enumerate(texts):
        if group and size + len(text) > CHUNK_BYTES:
            yield from ready()
            group, size = [], 0
        if len(text) > CHUNK_BYTES:
            yield i, b"".join(encoder.encoded([piece])[0] for piece in cut(text))
        else:
            group.append(i)
            size += len(text)
    if group:
        yield from ready()


def _cutter(length: int, path: str | None, schema: pa.Schema):
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            size = 0

            def made():
                at, starts, lengths, ids, tokens = zip(*rows)
                kept = [batch.column(c).take(pa.array(at)) for c in batch.schema.names if c != "__text"]
                new = [pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()), pa.array(tokens, pa.int64())]
                return pa.RecordBatch.from_arrays([*kept, *new], schema=schema)

            for i, ids in token_ids([t or b"" for t in batch.column("__text").to_pylist()], path):
                ids += end
                for start in range(0, len(ids) // 4, length):
                    piece = ids[4 * start:4 * (start + length)]
                    rows.append((i, start, len(piece) // 4, piece, len(ids) // 4))
                    size += len(piece)
                if size > CHUNK_BYTES:
                    yield made()
                    rows, size = [], 0
            if rows:
                yield made()

    return run


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens.

    A document is the ids of its whole text and then the id 1; a null text is empty, so every document has at least one id. Pieces
    have ``length`` ids but for the last of a document. ``tokenizer`` is the path of a vocabulary file on the
    executors; by default that of the public 49k vocabulary. An empty table gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    source = bounded_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("__text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType())])
    return source.mapInArrow(_cutter(length, tokenizer, to_arrow_schema(schema)), schema)


def first_fit(lengths: list[int], room: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of each item, placed in the given order into the first bin with room."""
    width = 1
    while width < max(1, len(lengths)):
        width *= 2
    most = [room] * (2 * width)
    bins, offsets = [], []
    for size in lengths:
        if size > room:
            raise ValueError(f"a piece of {size} does not fit into {room}")
        node = 1
        while node < width:
            node *= 2
            if most[node] < size:
                node += 1
        bins.append(node - width)
        offsets.append(room - most[node])
        most[node] -= size
        while node > 1:
            node //= 2
            most[node] = max(most[2 * node], most[2 * node + 1])
    return bins, offsets


def _placer(length: int):
    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "__key"], ascending=[False, True], kind="stable")
        bins, offsets = first_fit(rows["length"].tolist(), length)
        rows["sequence_id"] = rows["__group"].to_numpy(np.int64) << 32 | np.array(bins, np.int64)
        rows["offset"] = np.array(offsets, np.int64)
        return rows.drop(columns=["__group", "__key"])

    return place


def packed(cut_pieces: DataFrame, rows: int, length: int = LENGTH, seed: int = 0, number_col: str | None = None) -> DataFrame:
    """``cut_pieces`` (doc_id, start, length and any other columns) with sequence_id and offset.

    Sequences hold at most ``length`` ids, offsets in them have no gaps. ``rows`` is about the number of pieces;
    it sets the number of groups. Pieces are dealt by a hash of document, place and length, so a long document spreads over groups
    and a task run again deals the same. Pieces alike in these meet in one group unless ``number_col``, a stored column, tells them
    apart; it is not returned. Columns with the names of the result are replaced.
    """
    groups = max(1, -(-rows // GROUP_ROWS))
    number = [] if number_col is None else [number_col]
    base = cut_pieces.select(*others(cut_pieces, ("sequence_id", "offset", *number)))
    key = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "start", "length", "doc_tokens", *number)
    keyed = cut_pieces.withColumn("__key", key).select(*others(cut_pieces, ("sequence_id", "offset", *number)), "__key").withColumn("__group", F.pmod("__key", F.lit(groups)))
    schema = T.StructType([*base.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return keyed.groupBy("__group").applyInPandas(_placer(length), schema)


def sequences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, tokenizer: str | None = None) -> DataFrame:
    """All ``docs`` packed, with their ids: one row per piece (:func:`pieces` and :func:`packed`).

    The pieces are written once, with numbers, so that they are counted before they are dealt: a group's size does not grow with
    the texts, nor with documents alike or without doc_id.
    """
    numbered = pieces(docs, id_col, text_col, length, tokenizer).withColumn("__number", F.monotonically_increasing_id())
    cut_pieces = stored(numbered, "pieces")
    return packed(cut_pieces, cut_pieces.count(), length, number_col="__number")
