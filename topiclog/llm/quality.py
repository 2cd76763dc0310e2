"""A supervised text classifier: hashed word and n-gram vectors, averaged per document, then softmax.

Features of a text, hashed into one table of vectors: its words; its pairs of neighbouring words; and the stretches of 3 to 5
characters of each word with the white space at its ends (characters are UTF-8 bytes). A word that repeats the one before gives
one feature instead, the same for all words. Vectors and output layer are learned by stochastic
gradient descent in numpy, with the step of each weight scaled by its past gradients.

The score of a document is linear in the average up to the softmax, so after training each feature needs one number, and scoring
is one look-up per feature and a sum per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclog.llm.base import bounded_batches, crc32_of_id, others
from topiclog.llm.textbytes import Prefix, chunks, mixed, word_spans

BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
DIMENSIONS = 4
EPOCHS = 6
STEP = 0.5
# The bounded sample that the classifier is fitted on: this many labelled documents, chosen by a hash of their id.
TRAIN_ROWS = 2000
THRESHOLD = 0.7
COLUMNS = ("doc_id", "held_out", "score", "predicted")


def features(texts: list[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(numbers of documents, buckets of their features, which document each feature is of), in chunks."""
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    for numbers, raw, first, _ in chunks(texts):
        blank = space[raw]
        raw = np.where(blank, np.uint8(32), raw)
        prefix = Prefix(raw)
        starts, ends = word_spans(raw)
        found, at = [], []
        repeated = np.zeros(len(raw) + 1, np.int8)
        if len(starts):
            words = prefix.of(starts, ends)
            doc = np.searchsorted(first, starts, "right")
            follows = np.append(False, doc[1:] == doc[:-1])
            before = np.append(np.uint64(0), words[:-1])
            repeats = follows & (words == before)
            found.append(mixed(words + np.uint64(1))[~repeats])
            at.append(starts[~repeats])
            pairs = np.where(repeats, np.uint64(2), mixed(words * np.uint64(3) + before))
            found.append(pairs[follows])
            at.append(starts[follows])
            edge = np.zeros(len(raw) + 1, np.int8)
            edge[starts[repeats]] = 1
            edge[ends[repeats]] -= 1
            repeated = np.cumsum(edge, dtype=np.int8)
        blanks = np.concatenate(([0], np.cumsum(blank)))
        for n in GRAMS:
            if len(raw) < n:
                continue
            whole = np.flatnonzero((blanks[n - 1:-1] == blanks[1:-n + 1]) & (repeated[1:len(raw) - n + 2] == 0))
            found.append(prefix.grams(n)[whole] + np.uint64(n))
            at.append(whole + 1)
        where = np.concatenate(at) if at else np.zeros(0, np.int64)
        hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
        docs = np.searchsorted(first, where, "right") - 1
        yield numbers, (hashes % np.uint64(BUCKETS)).astype(np.int64), np.clip(docs, 0, len(numbers) - 1)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, buckets, shares) of each document: distinct features and their part of all features."""
    schema = pa.schema([("label", pa.int32()), ("buckets", pa.binary()), ("shares", pa.binary())])
    for batch in batches:
        labels = batch.column("label").to_pylist()
        texts = [t or b"" for t in batch.column("text").to_pylist()]
        counts: dict[int, dict[str, np.ndarray]] = {}
        for numbers, buckets, docs in features(texts):
            for j, i in enumerate(numbers):
                ids, n = np.unique(buckets[docs == j], return_counts=True)
                if i in counts:
                    ids, back = np.unique(np.concatenate((counts[i]["ids"], ids)), return_inverse=True)
                    n = np.bincount(back, np.concatenate((counts[i]["n"], n)))
                counts[i] = {"ids": ids, "n": n}
        for i, found in counts.items():
            if len(found["ids"]):
                share = (found["n"] / found["n"].sum()).astype(np.float32)
                yield pa.RecordBatch.from_arrays([
                    pa.array([labels[i]], pa.int32()), pa.array([found["ids"].astype(np.int32).tobytes()]),
                    pa.array([share.tobytes()])], schema=schema)


def fitted(examples: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 1) -> tuple[np.ndarray, float]:
    """(weight of each bucket, bias): the log odds of label 1 are the average weight plus the bias.

    Vectors start at zero and the output layer at random, so features that never occurred weigh nothing. Without examples
    everything is zero.
    """
    rng = np.random.default_rng(seed)
    vectors = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    layer = rng.normal(0, 1, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    past_vectors, past_layer, past_bias = np.full(BUCKETS, 1e-12, np.float32), np.full((DIMENSIONS, 2), 1e-4), np.full(2, 1e-4)
    for epoch in range(EPOCHS):
        step = STEP * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(examples)):
            label, ids, shares = examples[i]
            average = shares @ vectors[ids]
            logits = average @ layer + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[label] -= 1
            back = layer @ error
            past_vectors[ids] += shares ** 2 * (back @ back)
            vectors[ids] -= step * np.outer(shares / np.sqrt(past_vectors[ids]), back)
            slope = np.outer(average, error)
            past_layer += slope ** 2
            layer -= (step * slope / np.sqrt(past_layer)).astype(np.float32)
            past_bias += error ** 2
            bias -= (step * error / np.sqrt(past_bias)).astype(np.float32)
    if not examples:
        return np.zeros(BUCKETS, np.float32), 0.0
    return vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0])


def learned(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
            rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Fit on at most ``rows`` documents with label 0 or 1, those with the least hash of their id.

    Only counts of hashed features of that sample come to the driver. Rows without id, label or words teach nothing.
    """
    chosen = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("__id"), "__id").limit(rows)
    )
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("binary").alias("text"))
    sample = texts.join(F.broadcast(chosen), "__id").select("label", "text")
    found = sample.mapInArrow(_counted, "label int, buckets binary, shares binary")
    examples = [(r.label, np.frombuffer(r.buckets, np.int32), np.frombuffer(r.shares, np.float32))
                for r in found.orderBy(F.xxhash64("buckets", "shares")).limit(2 * rows).collect()]
    return fitted(examples)


def _scorer(weights, bias: float, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = weights.value
        for batch in batches:
            texts = [t or b"" for t in batch.column("__text").to_pylist()]
            total, count = np.zeros(len(texts)), np.zeros(len(texts))
            for numbers, buckets, docs in features(texts):
                total[numbers] += np.bincount(docs, table[buckets], len(numbers))
                count[numbers] += np.bincount(docs, minlength=len(numbers))
            logit = np.clip(total / np.maximum(count, 1) + bias, -700, 700)
            kept = [batch.column(c) for c in batch.schema.names if c != "__text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(1 / (1 + np.exp(-logit)))], schema=schema)

    return run


def scored(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) and ``score``: the probability of label 1, from the whole text.

    A null or empty text has no features; its score is that of the bias. A column named score is replaced. An empty table gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    weights, bias = model
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() != "score"]
    source = bounded_batches(docs).select(*(F.col(f"`{c}`") for c in names), F.col(text_col).cast("binary").alias("__text"))
    result = docs.select(*(F.col(f"`{c}`") for c in names), F.lit(0.0).alias("score")).schema
    table = docs.sparkSession.sparkContext.broadcast(weights)
    return source.mapInArrow(_scorer(table, bias, to_arrow_schema(result)), result)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 if score >= ``threshold``).

    Learns from documents whose crc32(id as text) mod 4 is not 2; the rest is held out.
    """
    held_out = F.pmod(crc32_of_id(id_col), F.lit(4)) == 2
    model = learned(docs, labels.where(~held_out), id_col=id_col, text_col=text_col)
    result = scored(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model, "text", ["doc_id"])
    return result.select(
        "doc_id", (F.pmod(crc32_of_id("doc_id"), F.lit(4)) == 2).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns."""
    held_out = F.pmod(crc32_of_id(id_col), F.lit(4)) == 2
    model = learned(docs, labels.where(~held_out), id_col=id_col, text_col=text_col)
    rows = docs.withColumnRenamed("score", "__score") if "score" in docs.columns else docs
    kept = scored(rows, model, text_col).where(F.col("score") >= threshold).drop("score")
    return kept.withColumnRenamed("__score", "score").select(*others(docs, ()))
