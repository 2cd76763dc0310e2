"""Words and n-grams of UTF-8 text as 64-bit hashes, computed for many documents at once with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from topiclog.llm.base import per_process

CHUNK_BYTES = 1 << 18
_BASE = 0x9E3779B97F4A7C15


def _tables() -> dict:
    rng = np.random.default_rng(20240229)
    space = np.zeros(256, dtype=bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return {
        "space": space, "lower": lower,
        "byte": rng.integers(0, 2**64, 256, dtype=np.uint64),
        "power": np.ones(0, dtype=np.uint64), "inverse": np.ones(0, dtype=np.uint64),
    }


def _known() -> dict:
    return per_process("tables", _tables)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    known = _known()
    if len(known["power"]) < n:
        size = max(n, CHUNK_BYTES + (CHUNK_BYTES >> 2))
        for name, base in (("power", _BASE), ("inverse", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            known[name] = np.cumprod(steps, dtype=np.uint64)
    return known["power"][:n], known["inverse"][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers, so that every bit depends on every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Prefix:
    """Hashes of any stretch of bytes from one running sum: sum(code[byte i] * base^i), shifted back to the start."""

    def __init__(self, raw: np.ndarray):
        power, self._inverse = _powers(len(raw))
        self._sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(_known()["byte"][raw] * power, out=self._sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self._sums[ends] - self._sums[starts]) * self._inverse[starts])

    def grams(self, n: int) -> np.ndarray:
        """Hashes of all stretches of ``n`` bytes, by their start."""
        m = len(self._sums) - n
        return mixed((self._sums[n:] - self._sums[:-n]) * self._inverse[:m])


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; ``raw`` begins and ends with white space."""
    edge = np.diff(_known()["space"][raw].view(np.int8))
    return np.flatnonzero(edge == -1) + 1, np.flatnonzero(edge == 1) + 1


def lowered(raw: np.ndarray) -> np.ndarray:
    return _known()["lower"][raw]


def cut(text: bytes) -> Iterator[bytes]:
    """A long text in pieces of about a chunk, cut at white space; longer only within one word."""
    at = 0
    while len(text) - at > CHUNK_BYTES:
        end = at + CHUNK_BYTES
        window = np.frombuffer(text, np.uint8, count=CHUNK_BYTES, offset=at)
        spaces = np.flatnonzero(_known()["space"][window[-4096:]])
        if len(spaces):
            end = at + CHUNK_BYTES - min(4096, CHUNK_BYTES) + int(spaces[-1]) + 1
        else:
            while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
                end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def chunks(texts: list[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """Documents in groups of about a chunk of bytes: (their numbers, bytes, first byte of each, end of each).

    A document longer than a chunk comes alone, several times, a piece at a time. White space stands before
    and after each document.
    """
    group: list[int] = []
    size = 0

    def packed(numbers: list[int], parts: list[bytes]):
        raw = np.frombuffer(b"\n" + b"\n".join(parts) + b"\n", np.uint8)
        lengths = np.array([len(p) for p in parts])
        ends = np.cumsum(lengths + 1)
        return numbers, raw, ends - lengths, ends

    for i, text in enumerate(texts):
        if len(text) > CHUNK_BYTES:
            for piece in cut(text):
                yield packed([i], [piece])
            continue
        if group and size + len(text) > CHUNK_BYTES:
            yield packed(group, [texts[j] for j in group])
            group, size = [], 0
        group.append(i)
        size += len(text) + 1
    if group:
        yield packed(group, [texts[j] for j in group])


def word_hashes(texts: list[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(numbers of the documents, hashes of their words lower-cased in A-Z, first word of each and the count).

    Every document comes once; its words are those of the whole text.
    """
    long: list[np.ndarray] = []
    alone = -1
    for numbers, raw, first, _ in chunks(texts):
        raw = lowered(raw)
        starts, ends = word_spans(raw)
        hashes = Prefix(raw).of(starts, ends) if len(starts) else np.zeros(0, np.uint64)
        if alone >= 0 and numbers != [alone]:
            yield [alone], (h := np.concatenate(long)), np.array([0, len(h)])
            long, alone = [], -1
        if len(numbers) == 1 and len(texts[numbers[0]]) > CHUNK_BYTES:
            alone = numbers[0]
            long.append(hashes)
            continue
        yield numbers, hashes, np.append(np.searchsorted(starts, first), len(starts))
    if alone >= 0:
        yield [alone], (h := np.concatenate(long)), np.array([0, len(h)])
