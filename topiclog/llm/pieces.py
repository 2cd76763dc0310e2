"""SentencePiece encoding and decoding: a score-ordered agenda of adjacent symbol pairs, for vocabularies of merge type.

A text starts as its characters. All pairs of neighbours that form a piece wait in an agenda, best score first, leftmost among equals;
the pair taken becomes one symbol, its pairs with its new neighbours join the agenda, and pairs whose symbols are gone are passed
over. Characters without a piece are spelled as byte pieces.

Two characters that follow each other inside no piece of the vocabulary are never merged over, so a text is cut between them, each
stretch has an agenda of its own, and stretches seen before are remembered. Spaces begin pieces and never follow anything else in one, so a
text's ids are those of its words in turn. The library encodes the new words of every Arrow batch as well, as one text, and decodes the ids of
every text; where the two differ the library is right and the document is marked.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topiclog.llm.base import bounded_batches, per_process

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_TEXT = " ⁇ "
CHUNK_BYTES = 1 << 19
# Characters of words, and of stretches, that a worker process remembers in each of two generations.
REMEMBERED = 2_000_000
# Characters of the stretches whose agendas are gone through together; a long one would keep the others waiting.
SHORT = 32


class Memory:
    """What was asked for while the last ``size`` characters of new keys came, and what the generation before held.

    When the young generation is full it becomes the old one; keys found in the old one move to the young one.
    """

    def __init__(self, size: int):
        self._size = size
        self._used = 0
        self.young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def make_room(self, characters: int) -> bool:
        """True if the young generation was put aside to take that many characters more."""
        self._used += characters
        if self._used <= self._size or not self.young:
            return False
        self._old, self.young, self._used = self.young, {}, characters
        return True

    def get(self, key: str) -> bytes | None:
        found = self.young.get(key)
        if found is None and (found := self._old.get(key)) is not None:
            self.young[key] = found
        return found


def _numbers(raw: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol buffer message: integers, or bytes of the other wire types."""
    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (raw[i] & 127) << shift
            shift += 7
            i += 1
            if raw[i - 1] < 128:
                return value, i

    i = 0
    while i < len(raw):
        key, i = varint(i)
        kind = key & 7
        if kind == 0:
            value, i = varint(i)
            yield key >> 3, value
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            size, i = varint(i)
        yield key >> 3, raw[i:i + size]
        i += size


class Agenda:
    """The merge rules of a vocabulary: the score of every piece, higher ones first."""

    def __init__(self, scores: dict[str, float]):
        # Places in the order of scores; equal scores share one.
        places = {score: i for i, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self._place = {piece: places[score] for piece, score in scores.items()}
        pairs = {(ord(a), ord(b)) for piece in scores for a, b in zip(piece, piece[1:])}
        # Sorted, with a last one that no text has.
        self._joined = np.array(sorted(a << 32 | b for a, b in pairs) + [1 << 62], np.int64)
        self._ascii = np.zeros((128, 128), bool)
        for a, b in pairs:
            if a < 128 and b < 128:
                self._ascii[a, b] = True
        self._sizes = max(map(len, scores), default=0) + 1

    def cuts(self, text: str) -> list[int]:
        """Where ``text`` is cut: between all neighbours that follow each other inside no piece."""
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        pairs = codes[:-1] << 32 | codes[1:]
        joined = np.zeros(len(pairs), bool)
        ascii_ = (codes[:-1] < 128) & (codes[1:] < 128)
        joined[ascii_] = self._ascii[codes[:-1][ascii_], codes[1:][ascii_]]
        rest = pairs[~ascii_]
        joined[~ascii_] = self._joined[np.searchsorted(self._joined, rest)] == rest
        return (np.flatnonzero(~joined) + 1).tolist()

    def merged(self, text: str) -> list[str]:
        """The symbols that are left when no two neighbours form a piece.

        A pair waits as one number: its place, then its left symbol, then the size of the piece it forms.
        """
        n = len(text)
        if n < 2:
            return [text]
        place, sizes = self._place.get, self._sizes
        symbols: list[str] = list(text)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [(found * n + i) * sizes + 2 for i, found in enumerate(map(place, map(add, text, text[1:]))) if found is not None]
        heapify(agenda)
        while agenda:
            rest, size = divmod(heappop(agenda), sizes)
            left = rest % n
            right = after[left]
            # A symbol that was merged away is empty, and one that has grown makes the pair longer than it was.
            if right == n or not symbols[left]:
                continue
            pair = symbols[left] + symbols[right]
            if len(pair) != size:
                continue
            symbols[left], symbols[right] = pair, ""
            following = after[left] = after[right]
            if following < n:
                before[following] = left
                joint = pair + symbols[following]
                found = place(joint)
                if found is not None:
                    heappush(agenda, (found * n + left) * sizes + len(joint))
            previous = before[left]
            if previous >= 0:
                joint = symbols[previous] + pair
                found = place(joint)
                if found is not None:
                    heappush(agenda, (found * n + previous) * sizes + len(joint))
        return [s for s in symbols if s]


class Agendas:
    """The agendas of many short stretches at once: in each round every stretch merges its best pair, leftmost among equals.

    Symbols are numbers: those of the pieces, then those of characters that are only parts of pieces; -1 for other characters. All
    stretches lie in one array; the pair that starts at a place waits there as one number, its place in the order of scores before its
    own, so that the least number of a stretch is the next pair of its agenda.
    """

    _NONE = np.int64(1) << 62

    def __init__(self, scores: dict[str, float], ids: dict[str, int]):
        places = {score: i for i, score in enumerate(sorted(set(scores.values()), reverse=True))}
        number = dict(ids)
        for c in sorted({c for piece in scores for c in piece} - number.keys()):
            number[c] = max(number.values()) + 1
        self.pieces = max(ids.values(), default=-1) + 1
        rules = sorted(
            (number[left] << 32 | number[right], places[score], number[piece])
            for piece, score in scores.items() for i in range(1, len(piece))
            for left, right in [(piece[:i], piece[i:])] if left in number and right in number)
        self._rules, self._places, self._results = (np.array([*column, last], np.int64) for column, last in zip(
            zip(*rules) if rules else ((), (), ()), (self._NONE, 0, 0)))
        letters = sorted(c for c in number if len(c) == 1)
        self._codes = np.array([*map(ord, letters), 1 << 31], np.int64)
        self._numbers = np.array([*(number[c] for c in letters), -1], np.int64)

    def _symbols(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        at = np.searchsorted(self._codes, codes)
        return np.where(self._codes[at] == codes, self._numbers[at], -1)

    def _rule(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the rule that joins each pair, whether there is one)."""
        pairs = left << 32 | right
        at = np.searchsorted(self._rules, pairs)
        return at, (self._rules[at] == pairs) & (left >= 0) & (right >= 0)

    def merged(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols left of all stretches in turn, first of each and the end); -1 for characters that are no part of any piece."""
        symbols = self._symbols("".join(stretches))
        sizes = np.array(list(map(len, stretches)), np.int64)
        starts, total = np.cumsum(sizes) - sizes, len(symbols)
        before, after = np.arange(-1, total - 1), np.arange(1, total + 1)
        before[starts] = -1
        after[starts + sizes - 1] = total
        waiting = np.full(total, self._NONE)
        rule = np.zeros(total, np.int64)

        def wait(left: np.ndarray) -> None:
            right = after[left]
            paired = right < total
            waiting[left[~paired]] = self._NONE
            left, right = left[paired], right[paired]
            at, found = self._rule(symbols[left], symbols[right])
            rule[left] = at
            waiting[left] = np.where(found, self._places[at] * total + left, self._NONE)

        wait(np.arange(total))
        gone = np.zeros(total, bool)
        # The part of the array that has stretches with waiting pairs, and where these start in it.
        part, first = np.arange(total), starts
        while len(first):
            best = np.minimum.reduceat(waiting[part], first)
            busy = best < self._NONE
            left = best[busy] % total
            if 2 * len(left) < len(first):
                lengths = np.diff(np.append(first, len(part)))
                part = part[np.repeat(busy, lengths)]
                first = np.cumsum(lengths[busy]) - lengths[busy]
            right = after[left]
            symbols[left] = self._results[rule[left]]
            gone[right] = True
            waiting[right] = self._NONE
            following = after[right]
            after[left] = following
            inner = following < total
            before[following[inner]] = left[inner]
            previous = before[left]
            wait(left)
            wait(previous[previous >= 0])
        kept = np.cumsum(np.append(0, ~gone))
        return symbols[~gone], kept[np.append(starts, total)]


class Pieces:
    """Encoder and decoder of a model file.

    Models that normalise characters, split off user-defined symbols, drop extra white space or have unused pieces are refused: their
    texts need more than merges.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        parts: dict[int, list] = {}
        for number, value in _numbers(library.serialized_model_proto()):
            parts.setdefault(number, []).append(value)
        trainer, normalizer = (dict(_numbers(parts[n][-1])) if n in parts else {} for n in (2, 3))
        kinds = [dict(_numbers(p)).get(3, 1) for p in parts[1]]
        # Normal, unknown, control and byte pieces; not user-defined ones (4) and not unused ones (5).
        known = trainer.get(3) == 2 and trainer.get(24, 0) == 0 and not normalizer.get(2) and normalizer.get(4, 1) == 0 and normalizer.get(5, 1) == 1
        if not known or set(kinds) - {1, 2, 3, 6}:
            raise ValueError(f"{path} is no plain merge vocabulary")
        self._prefix = SPACE if normalizer.get(3, 1) else ""
        names = [library.id_to_piece(i) for i in range(library.vocab_size())]
        self.ids = {names[i]: i for i, kind in enumerate(kinds) if kind == 1}
        scores = {name: library.get_score(i) for name, i in self.ids.items()}
        self.agenda, self._agendas = Agenda(scores), Agendas(scores, self.ids)
        self._bytes = {int(names[i][3:5], 16): i for i, kind in enumerate(kinds) if kind == 6}
        self._unknown = library.unk_id()
        self._words, self._known_stretches = Memory(REMEMBERED), Memory(REMEMBERED)
        # What each piece decodes to; control pieces to nothing.
        self._decoded = [
            {1: name.replace(SPACE, " ").encode(), 2: UNKNOWN_TEXT.encode(), 3: b""}.get(kind) or (bytes([int(name[3:5], 16)]) if kind == 6 else b"")
            for name, kind in zip(names, kinds)]
        self._is_byte = np.array([kind == 6 for kind in kinds])
        self._is_control = np.array([kind == 3 for kind in kinds])
        self._differing: set[str] = set()
        # Words may be looked up one by one where a space joins nothing before it.
        self._by_word = all(SPACE not in name.lstrip(SPACE) for name in self.ids)

    def _spelled(self, symbols: list[str]) -> bytes:
        ids: list[int] = []
        gap = False
        for symbol in symbols:
            found = self.ids.get(symbol)
            if found is not None:
                ids.append(found)
            elif self._bytes:
                ids.extend(self._bytes[b] for b in symbol.encode())
            elif not gap:
                # Without byte pieces, unknown neighbours are one unknown piece.
                ids.append(self._unknown)
            gap = found is None
        return np.array(ids, "<i4").tobytes()

    def _merge(self, stretches: list[str]) -> dict[str, bytes]:
        """The ids of each stretch: short ones together, long ones by an agenda of their own."""
        found = {s: self._spelled(self.agenda.merged(s)) for s in stretches if len(s) > SHORT}
        short = [s for s in stretches if len(s) <= SHORT]
        if short:
            symbols, first = self._agendas.merged(short)
            raw = symbols.astype("<i4").tobytes()
            spelled = np.maximum.reduceat((symbols < 0) | (symbols >= self._agendas.pieces), first[:-1]).tolist()
            ends = (first * 4).tolist()
            for s, a, b, other in zip(short, ends, ends[1:], spelled):
                found[s] = self._spelled(self.agenda.merged(s)) if other else raw[a:b]
        return found

    def _stretches(self, text: str, cuts: list[int]) -> list[bytes]:
        """The ids of each stretch of ``text``."""
        memory = self._known_stretches
        memory.make_room(len(text))
        parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        new = [s for s in set(parts) if memory.get(s) is None]
        if new:
            memory.young.update(self._merge(new))
        return list(map(memory.young.__getitem__, parts))

    def _merged(self, marked: str) -> list[bytes]:
        return self._stretches(marked, self.agenda.cuts(marked)) if marked else []

    def _checked(self, text: str) -> tuple[bytes, bool]:
        """The ids of a text that is not looked up by words, and whether the library says the same."""
        marked = self._prefix + text.replace(" ", SPACE)
        # Without byte pieces, unknown characters may meet at a cut.
        ids = b"".join(self._merged(marked)) if self._bytes else self._spelled(self.agenda.merged(marked))
        right = np.array(self.library.encode(text), "<i4").tobytes()
        return right, right == ids

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of words with a space mark before each."""
        marked = SPACE + SPACE.join(words)
        cuts = self.agenda.cuts(marked)
        ids = self._stretches(marked, cuts)
        first = np.searchsorted([0, *cuts], np.cumsum([0, *(len(w) + 1 for w in words)])).tolist()
        found = [b"".join(ids[a:b]) for a, b in zip(first, first[1:])]
        if np.array(self.library.encode(" ".join(words)), "<i4").tobytes() != b"".join(found):
            right = [np.array(x, "<i4").tobytes() for x in self.library.encode(words, num_threads=1)]
            self._differing.update(w for w, x, y in zip(words, right, found) if x != y)
            found = right
        self._words.young.update(zip(words, found))

    def encoded(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        """(ids of each text as little-endian 32-bit numbers, whether the library says the same of all its words)."""
        if not (self._bytes and self._by_word and self._prefix):
            found = [self._checked(t) if t else (b"", True) for t in texts]
            return [ids for ids, _ in found], [same for _, same in found]
        split = [t.replace(SPACE, " ").split(" ") for t in texts]
        memory = self._words
        distinct = set().union(*split)
        distinct.discard("")
        new = distinct - memory.young.keys()
        if memory.make_room(sum(map(len, new))):
            new = distinct
        new = [word for word in new if memory.get(word) is None]
        if new:
            self._learn(new)
        get = memory.young.__getitem__
        found, agreed = [], []
        for text, words in zip(texts, split):
            # Empty words are further spaces before the next one.
            ids, same = (b"".join(map(get, words)), True) if "" not in words else self._checked(text) if text else (b"", True)
            found.append(ids)
            agreed.append(same and (not self._differing or self._differing.isdisjoint(words)))
        return found, agreed

    def decoded(self, ids: list[int]) -> str:
        """The text of ``ids``: spaces for space marks, none at the very start, bytes put together."""
        pieces = list(map(self._decoded.__getitem__, ids))
        first = next((i for i, number in enumerate(ids) if not self._is_control[number]), None)
        if self._prefix and first is not None and not self._is_byte[ids[first]] and ids[first] != self._unknown:
            pieces[first] = pieces[first].removeprefix(b" ")
        try:
            return b"".join(pieces).decode()
        except UnicodeDecodeError:
            return self._repaired(pieces, self._is_byte[ids].tolist())

    @staticmethod
    def _repaired(pieces: list[bytes], is_byte: list[bool]) -> str:
        """Bytes that are no characters become one replacement character each."""
        out, i = [], 0
        while i < len(pieces):
            if not is_byte[i]:
                out.append(pieces[i].decode())
                i += 1
                continue
            end = i
            while end < len(pieces) and is_byte[end]:
                end += 1
            run = b"".join(pieces[i:end])
            while run:
                for size in (1, 2, 3, 4):
                    try:
                        out.append(run[:size].decode())
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    size = 1
                    out.append("�")
                run = run[size:]
            i = end
        return "".join(out)


def pieces_of(model: str | None) -> Pieces:
    """The encoder of this process; by default that of the public 32k vocabulary."""
    def make() -> Pieces:
        if model is not None:
            return Pieces(model)
        import public_tokenizers

        return Pieces(public_tokenizers.path(MODEL))

    return per_process(f"pieces {model}", make)


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    at = size = 0
    for i, text in enumerate(texts):
        if i > at and size + len(text) > CHUNK_BYTES:
            yield at, i
            at, size = i, 0
        size += len(text)
    if at < len(texts):
        yield at, len(texts)


def _tokenizer(model: str | None, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            texts = [t.decode("utf-8", "replace") for t in batch.column("text").to_pylist()]
            for a, b in _chunks(texts):
                raw, same = pieces.encoded(texts[a:b])
                ids = [np.frombuffer(r, "<i4").tolist() for r in raw]
                decoded = pieces.library.decode(ids, num_threads=1)
                agreed = [x and pieces.decoded(i) == text for x, i, text in zip(same, ids, decoded)]
                offsets = np.cumsum([0, *map(len, ids)])
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(a, b - a),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(raw), "<i4"))).cast(schema.field("ids").type),
                    pa.array(decoded, pa.string()), pa.array(agreed, pa.bool_()),
                ], schema=schema)

    return run


def tokenized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """One row per document: its id, ids (array of int), decoded (their text), agreed (whether the library said the same).

    ``model`` is the path of a model file on the executors. Whole texts are encoded, without begin and end ids; an empty or null text has
    no ids and decodes to an empty text. Control pieces written out in a text are ordinary characters. Bytes that are no UTF-8 count as
    replacement characters. Repeated rows come out alike, each once; a null id stays null. Only the two columns are read, so
    others may have any name. An empty table gives no rows. No shuffle; a task holds a batch and two generations of remembered words.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    source = bounded_batches(docs).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    schema = T.StructType([
        source.schema["id"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType()),
        T.StructField("agreed", T.BooleanType())])
    run = _tokenizer(model, to_arrow_schema(schema))
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def detokenized(rows: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str | None = None) -> DataFrame:
    """One row per row of ``rows``: its id and text, what its ids decode to; no text for null ids, and null members are left out."""
    from pyspark.sql.pandas.types import to_arrow_schema

    source = bounded_batches(rows).select(F.col(id_col).alias("id"), F.filter(F.col(ids_col).cast("array<int>"), lambda i: i.isNotNull()).alias("ids"))
    schema = T.StructType([source.schema["id"], T.StructField("text", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            texts = [None if ids is None else pieces.decoded(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], schema=arrow)

    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)
