"""Language identification by cross-parsing: how few phrases of a language's text are needed to write a document.

For each language a suffix automaton holds every substring of its labelled words. A document is parsed greedily: each phrase is the
longest match from where the last one ended, or one character where nothing matches. Few, long phrases mean that the text
is like the language's; the number of phrases over the number that the language needs for its own
held-back words, both per character, is the estimate compared. The least wins.

Phrases do not run across white space, so the phrases of a word are the same wherever it stands: they are counted once for each
distinct word and remembered, and a document only adds up counts, one for each of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topiclog.llm.base import bounded_batches, crc32_of_id, per_process
from topiclog.llm.textbytes import CHUNK_BYTES

# The bounded sample that the languages are learned from: documents for each language, languages, and distinct words
# of at most WORD_CHARS characters for each language, the most frequent ones.
TRAIN_ROWS, LANGUAGES, TRAIN_WORDS, WORD_CHARS = 1000, 200, 6000, 64
# Of the words, one in HELD_BACK measures how many phrases the language needs for its own text.
HELD_BACK = 10
REMEMBERED = 250_000
UNKNOWN = "und"
_BITS = 40
_LETTERS = regex.compile(r"\p{L}+")
COLUMNS = ("doc_id", "held_out", "lang_pred", "score")


class SuffixAutomaton:
    """All substrings of a text: the text is read once, one state or two for each character."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        link, length = [-1], [0]
        last = 0
        for c in text:
            new = len(self.next)
            self.next.append({})
            link.append(0)
            length.append(length[last] + 1)
            at = last
            while at >= 0 and c not in self.next[at]:
                self.next[at][c] = new
                at = link[at]
            if at >= 0:
                to = self.next[at][c]
                if length[to] == length[at] + 1:
                    link[new] = to
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[to]))
                    link.append(link[to])
                    length.append(length[at] + 1)
                    while at >= 0 and self.next[at].get(c) == to:
                        self.next[at][c] = copy
                        at = link[at]
                    link[to] = link[new] = copy
            last = new

    def phrases(self, text: str) -> int:
        """Phrases of the greedy parse: longest matches in turn, or single characters that do not occur."""
        steps = self.next
        count, state = 0, 0
        for c in text:
            to = steps[state].get(c)
            if to is None:
                # The phrase ends before c; c begins the next one, or is one by itself.
                count += state != 0
                to = steps[0].get(c)
                if to is None:
                    count += 1
                    to = 0
            state = to
        return count + (state != 0)


class Languages:
    """Phrase counts of words in every language; ``words`` maps a language to its training words."""

    def __init__(self, words: dict[str, list[str]]):
        self.names = sorted(words)
        self.automata, self.rates = [], []
        for name in self.names:
            own = sorted(words[name])
            held = own[::HELD_BACK] if len(own) > HELD_BACK else own
            taught = [w for i, w in enumerate(own) if i % HELD_BACK] or own
            automaton = SuffixAutomaton(" " + " ".join(taught) + " ")
            self.automata.append(automaton)
            counts = sum(automaton.phrases(f" {w} ") for w in held)
            self.rates.append(counts / max(1, sum(len(w) + 2 for w in held)))
        self._known: dict[str, int] = {}

    def _counted(self, chunk: str) -> int:
        """Phrases of the letter runs in a string without white space, a field of _BITS bits for each language; then the characters."""
        total = 0
        for word in _LETTERS.findall(chunk):
            text = f" {word} "
            for i, automaton in enumerate(self.automata):
                total += automaton.phrases(text) << (_BITS * i)
            total += len(text) << (_BITS * len(self.automata))
        return total

    def _sum(self, words: list[str]) -> int:
        known = self._known
        if len(known) > REMEMBERED:
            known.clear()
        long = 0
        for w in set(words).difference(known):
            if len(w) <= WORD_CHARS:
                known[w] = self._counted(w)
            else:
                known[w] = None
                long += 1
        if not long:
            return sum(map(known.__getitem__, words))
        total = sum(self._counted(w) if known[w] is None else known[w] for w in words)
        for w in [w for w in set(words) if known[w] is None]:
            del known[w]
        return total

    def judged(self, text: str | None) -> tuple[str, float]:
        """(language, score): the score is how far the best is below the second best, as a share of that."""
        total = 0
        text = (text or "").lower()
        at = 0
        while at < len(text):
            # Long texts in pieces that end at white space.
            end = len(text) if len(text) - at <= CHUNK_BYTES else self._end(text, at + CHUNK_BYTES)
            total += self._sum(text[at:end].split())
            at = end
        field = (1 << _BITS) - 1
        chars = total >> (_BITS * len(self.names))
        if not chars or not self.names:
            return UNKNOWN, 0.0
        cost = [((total >> (_BITS * i)) & field) / chars / self.rates[i] for i in range(len(self.names))]
        best = min(range(len(cost)), key=cost.__getitem__)
        others = [c for i, c in enumerate(cost) if i != best]
        return self.names[best], (1 - cost[best] / min(others) if others else 1.0)

    @staticmethod
    def _end(text: str, at: int) -> int:
        while at < len(text) and not text[at].isspace():
            at += 1
        return at


def training_words(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> dict[str, list[str]]:
    """language -> its words, from a bounded sample of ``docs``; rows without language, id or text teach nothing.

    At most TRAIN_ROWS documents of each language, those with the least hash of their id, from at most LANGUAGES languages;
    then at most TRAIN_WORDS words of each.
    """
    few = Window.partitionBy("lang").orderBy("key", "id")
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    chosen = (
        labelled.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.xxhash64(F.col(id_col).cast("string")).alias("key"))
        .withColumn("nth", F.row_number().over(few)).where(F.col("nth") <= TRAIN_ROWS)
        .orderBy("nth", "lang").limit(TRAIN_ROWS * LANGUAGES).select("lang", "id")
    )
    words = (
        labelled.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(F.broadcast(chosen.distinct()), ["lang", "id"])
        .select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("(\\p{L}+)"))).alias("word"))
        .where(F.length("word") <= WORD_CHARS).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    )
    most = Window.partitionBy("lang").orderBy(F.col("n").desc(), "word")
    rows = words.withColumn("nth", F.row_number().over(most)).where(F.col("nth") <= TRAIN_WORDS).select("lang", "word").collect()
    found: dict[str, list[str]] = {}
    for lang, word in rows:
        found.setdefault(lang, []).append(word)
    return found


def _judge(words, key: str):
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = per_process("languages", lambda: Languages(words.value), key)
        for batch in batches:
            answers = [languages.judged(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([a for a, _ in answers], pa.string()), pa.array([s for _, s in answers], pa.float64())], schema=schema)

    return run, "doc_id long, lang_pred string, score double"


def identified(docs: DataFrame, words: dict[str, list[str]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row of ``docs``, from the whole text and ``words`` (language -> words) alone.

    lang_pred is ``und`` (score 0) for a null text, a text without letters, or if no language was learned. Ties go to the
    name that sorts first. Repeated rows are judged alike; an empty table gives no rows.
    """
    import uuid

    shared = docs.sparkSession.sparkContext.broadcast(words)
    run, schema = _judge(shared, uuid.uuid4().hex)
    return bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def languages(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score. Learns from rows whose crc32(id as text) mod 3 is not 1."""
    held_out = F.pmod(crc32_of_id(id_col), F.lit(3)) == 1
    words = training_words(docs.where(~held_out), lang_col, id_col, text_col)
    found = identified(docs, words, id_col, text_col)
    return found.select("doc_id", (F.pmod(crc32_of_id("doc_id"), F.lit(3)) == 1).alias("held_out"), "lang_pred", "score")
