"""Near-duplicate documents: MinHash bands propose groups and pairs, odd sketches sift them, full shingle sets confirm them.

An odd sketch folds the MinHash samples of a document into a bitmap of parities; the number of bits in which two
bitmaps differ estimates how many samples differ, and so the similarity, best where that is high. A pair that agrees
in a whole band is a candidate; the sketches drop candidates far below the threshold before any text is fetched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topiclog.llm import bloom
from topiclog.llm.base import bounded_batches, others, per_process, stored, unused
from topiclog.llm.graph import components
from topiclog.llm.textbytes import mixed, word_hashes

BANDS, ROWS = 24, 4
# The sketch folds more samples than the bands use; with them an estimate strays by 0.015 (one standard deviation) at 0.8.
SAMPLES = 720
SKETCH_LONGS = 32
# A pair is kept unless its estimate is this far below the threshold.
MARGIN = 0.08
# Documents and shingles that a worker signs at once.
SIGNED_DOCS, SIGNED_SHINGLES = 1024, 1 << 17
# Members of the main component that the strays of a bucket are compared with before all of them are.
GUIDES = 4
COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(77)
    k = SAMPLES
    return rng.integers(0, 2**32, k, dtype=np.uint32) | np.uint32(1), rng.integers(0, 2**32, k, dtype=np.uint32)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all stretches of n words; of the whole sequence if it is shorter."""
    n = min(n, len(words))
    if not n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        total = mixed(total + words[i:len(words) - n + 1 + i] + np.uint64(i))
    return total


def shingle_sets(texts: list[bytes], n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(number of the document, sorted distinct shingle hashes) for each document, in no fixed order."""
    for numbers, words, first in word_hashes(texts):
        for j, i in enumerate(numbers):
            yield i, np.unique(shingle_hashes(words[first[j]:first[j + 1]], n))


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(band hashes, odd sketches) of some non-empty sets, both as rows of 64-bit integers."""
    a, b = per_process("permutations", _permutations)
    k, bits = SAMPLES, 64 * SKETCH_LONGS
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    least = np.empty((len(sets), k), np.uint32)
    for i in range(k):
        least[:, i] = np.minimum.reduceat(flat * a[i] + b[i], starts)
    bands = np.full((len(sets), BANDS), 1, np.uint64) * np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        bands = mixed(bands * np.uint64(31) + least[:, i:BANDS * ROWS:ROWS])
    spot = mixed((np.arange(k, dtype=np.uint64) << np.uint64(32)) + least) % np.uint64(bits)
    flips = np.bincount((spot.astype(np.int64) + np.arange(len(sets))[:, None] * bits).ravel(), minlength=len(sets) * bits)
    return bands.view(np.int64), np.packbits((flips & 1).astype(np.uint8).reshape(-1, bits), axis=1).view(np.int64)


def max_differing_bits(similarity: float) -> int:
    """Bits in which two sketches may differ if the estimated similarity reaches ``similarity``."""
    bits = 64 * SKETCH_LONGS
    samples = 2 * SAMPLES * (1 - similarity)
    return math.ceil(bits / 2 * (1 - math.exp(-2 * samples / bits)))


_SKETCH = [f"s{i}" for i in range(SKETCH_LONGS)]
_BAND = [f"b{i}" for i in range(BANDS)]


def _signed(n: int):
    names = ["doc_id", "n_shingles", "set_hi", "set_lo", *_SKETCH, *_BAND]
    schema = pa.schema([(c, pa.int64()) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), [t or b"" for t in batch.column(1).to_pylist()]
            pending: list[tuple[int, np.ndarray]] = []
            size = 0

            def rows(found):
                full = [(i, s) for i, s in found if len(s)]
                head = np.zeros((len(found), len(names) - 1), np.int64)
                where = {i: j for j, (i, _) in enumerate(found)}
                if full:
                    bands, sketch = signatures([s for _, s in full])
                    digests = [xxhash.xxh3_128_digest(s.tobytes()) for _, s in full]
                    at = [where[i] for i, _ in full]
                    head[at, 0] = [len(s) for _, s in full]
                    head[at, 1:3] = np.frombuffer(b"".join(digests), ">i8").reshape(-1, 2)
                    head[at, 3:3 + SKETCH_LONGS] = sketch
                    head[at, 3 + SKETCH_LONGS:] = bands
                columns = [ids.take(pa.array([i for i, _ in found])), *map(pa.array, head.T)]
                return pa.RecordBatch.from_arrays(columns, schema=schema)

            for i, s in shingle_sets(texts, n):
                pending.append((i, s))
                size += len(s)
                if size > SIGNED_SHINGLES or len(pending) >= SIGNED_DOCS:
                    yield rows(pending)
                    pending, size = [], 0
            if pending:
                yield rows(pending)

    return run, ", ".join(f"{c} long" for c in names)


def _setted(n: int):
    schema = pa.schema([("set_hi", pa.int64()), ("set_lo", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, s in shingle_sets([t or b"" for t in batch.column(0).to_pylist()], n):
                if len(s):
                    hi, lo = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), ">i8").tolist()
                    yield pa.RecordBatch.from_arrays([pa.array([hi]), pa.array([lo]), pa.array([s.tobytes()])], schema=schema)

    return run, "set_hi long, set_lo long, shingles binary"


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each shingle of each set."""
    for batch in batches:
        sets = [np.frombuffer(s.as_buffer(), np.int64) for s in batch.column("shingles")]
        sizes = [len(s) for s in sets]
        nodes = np.repeat(batch.column("node").to_numpy(), sizes)
        if sets:
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(np.repeat(np.array(sizes, np.int64), sizes)), pa.array(np.concatenate(sets))],
                names=["node", "n_shingles", "shingle"])


def _confirmed(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (batch.column(c) for c in ("a", "b", "x", "y"))
            linked = []
            for left, right in zip(x, y):
                u, v = (np.frombuffer(s.as_buffer(), np.uint64) for s in (left, right))
                common = len(np.intersect1d(u, v, assume_unique=True))
                linked.append(100 * common >= percent * (len(u) + len(v) - common))
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], schema=schema)

    return run, "a long, b long"


def _differing(left: str, right: str) -> Column:
    total = F.lit(0)
    for s in _SKETCH:
        total = total + F.bit_count(F.col(f"{left}.{s}").bitwiseXOR(F.col(f"{right}.{s}")))
    return total


def _alike(left: str, right: str, percent: int) -> Column:
    """Sizes and sketches allow the threshold: the smaller set has at least that share of the larger."""
    small, large = (f(F.col(f"{left}.n_shingles"), F.col(f"{right}.n_shingles")) for f in (F.least, F.greatest))
    bits = max_differing_bits(max(0.0, percent / 100 - MARGIN))
    return (100 * small >= percent * large) & (_differing(left, right) <= bits)


class _Linker:
    """The steps of one run: the stored nodes (one for each distinct shingle set, named by its least doc_id)."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, n: int, percent: int):
        self.docs, self.nodes, self.n, self.percent = docs, nodes, n, percent
        self.rows = nodes.select("node", F.explode(F.array(*_BAND)).alias("bucket"))
        self.buckets = stored(
            self.rows.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("members"))
            .where("members > 1"), "buckets")

    def _alike(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sizes and sketches allow the threshold."""
        pairs = stored(pairs.distinct(), "pairs")
        sketches = self.nodes.select("node", "n_shingles", *_SKETCH)
        return (
            pairs.alias("p").join(sketches.alias("x"), F.col("p.a") == F.col("x.node"))
            .join(sketches.alias("y"), F.col("p.b") == F.col("y.node"))
            .where(_alike("x", "y", self.percent)).select("p.a", "p.b")
        )

    def to_leaders(self) -> DataFrame:
        """Candidates (a, b): every member of a bucket with the least member."""
        pairs = self.rows.join(self.buckets, "bucket").where("node <> leader")
        return self._alike(pairs.select(F.col("leader").alias("a"), F.col("node").alias("b")))

    def _mixed(self, labels: DataFrame) -> DataFrame:
        """Members (bucket, node, label, main) of buckets that still hold several components; main is the component with
        most members there. Leaders were compared with all others before and are left out."""
        members = (
            self.rows.join(self.buckets.where("members > 2"), "bucket").where("node <> leader").select("bucket", "node")
            .join(labels, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))
        )
        members = stored(members, "members")
        mains = stored(
            members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("size"))
            .groupBy("bucket").agg(F.max_by("label", F.struct("size", "label")).alias("main"), F.count(F.lit(1)).alias("parts"))
            .where("parts > 1").select("bucket", "main"), "mains")
        return members.join(mains, "bucket")

    def to_guides(self, labels: DataFrame) -> DataFrame:
        """Candidates between each stray and a few members of the main component of its bucket, chosen by hash.

        In a large group of copies nearly every stray is linked to one of these and needs no further comparison.
        """
        members = self._mixed(labels)
        chosen = [F.min(F.struct(F.xxhash64("node", "bucket", F.lit(i)), "node"))["node"] for i in range(GUIDES)]
        guides = stored(members.where("label = main").groupBy("bucket").agg(F.array(*chosen).alias("guides")), "guides")
        pairs = members.where("label <> main").join(guides, "bucket").select("node", F.explode("guides").alias("guide"))
        return self._alike(pairs.select(F.least("node", "guide").alias("a"), F.greatest("node", "guide").alias("b")))

    def across(self, labels: DataFrame) -> DataFrame:
        """Links (a, b) between members of buckets that still hold several components.

        Shingles of these members are put in one order, those that fewest members hold first. If x and y reach the threshold, they have at
        least percent / (100 + percent) of their two sizes in common, so their first common shingle has at least as many places from it to
        the end of either set: from its place in x follows the largest y that it may link, and the other way round. A text whose own
        changes fill its first places meets nobody, so a group of copies that are linked to none of the others costs its size and not its
        pairs. Shingles that only one member holds take places and are never joined. Strays look for members by (shingle, size); members of
        the main component of all their buckets are only found. What meets is sifted by sketches and confirmed on the full sets.
        """
        members = self._mixed(labels)
        involved = stored(members.groupBy("node", "label").agg(F.max(F.col("label") != F.col("main")).alias("stray")), "involved")
        sets = self._sets(involved)
        held = sets.mapInArrow(_held, "node long, n_shingles long, shingle long")
        shared = stored(held.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1"), "shared")
        own = Window.partitionBy("node")
        places = (
            held.join(shared, "shingle")
            .withColumn("place", F.row_number().over(own.orderBy("holders", "shingle")))
            .withColumn("place", F.col("n_shingles") - F.count(F.lit(1)).over(own) + F.col("place"))
        )
        p = self.percent
        firsts = places.withColumn("most", F.expr(f"({100 + p} * (n_shingles - place + 1) - {p} * n_shingles) div {p}"))
        firsts = firsts.where(f"100 * most >= {p} * n_shingles").select("shingle", "node", "n_shingles", "most")
        firsts = stored(firsts.join(involved, "node"), "firsts")
        sizes = firsts.groupBy("shingle", F.col("n_shingles").alias("size")).agg(F.max("most").alias("reach"))
        asked = stored(
            firsts.where("stray").join(sizes, "shingle")
            .where(f"100 * size >= {p} * n_shingles and size <= most and reach >= n_shingles"), "asked")
        pairs = asked.alias("x").join(firsts.alias("y"), F.expr(
            "x.shingle = y.shingle and x.size = y.n_shingles and y.most >= x.n_shingles and x.label <> y.label"
            " and (not y.stray or x.node < y.node)"))
        return self.confirmed(self._alike(pairs.select(
            F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))), sets)

    def _sets(self, wanted: DataFrame) -> DataFrame:
        """Stored (node, shingles) of the nodes in ``wanted``; only their texts are fetched."""
        wanted = stored(wanted.join(self.nodes.select("node", "set_hi", "set_lo"), "node").select("node", "set_hi", "set_lo"), "wanted")
        blocks = bloom.blocks_for(wanted.count())
        texts = bloom.possible(self.docs, "id", bloom.built(wanted, "node", blocks), blocks)
        # An inner join: a semi-join would be moved below the filter.
        texts = texts.join(wanted.select(F.col("node").alias("id")).distinct(), "id").select("text")
        run, schema = _setted(self.n)
        sets = texts.mapInArrow(run, schema).join(wanted, ["set_hi", "set_lo"]).select("node", "shingles")
        # A row that occurs twice has its set once.
        return stored(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")

    def confirmed(self, candidates: DataFrame, sets: DataFrame | None = None) -> DataFrame:
        """The candidates whose full sets reach the threshold. Without ``sets``, texts of candidates are fetched."""
        candidates = stored(candidates, "candidates")
        if sets is None:
            sets = self._sets(candidates.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        pairs = (
            candidates.alias("c").join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
        )
        run, schema = _confirmed(self.percent)
        return stored(pairs.mapInArrow(run, schema), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    A document's set holds its distinct shingles of ``words`` words (A-Z lower-cased); with fewer words, the whole sequence. Two
    documents are linked if 100 * common >= ``percent`` * united, confirmed on the full sets; component_id is the least
    doc_id reachable over links, and the document that has it is kept.

    Nulls and repeats: a null text is empty; an empty text has no shingles and no links. Rows without doc_id are in no
    component (null) and are kept. Texts with the same set are one node of the graph, so groups of copies cost no pairs; a
    doc_id that occurs with several texts is one document with all their links. ``percent`` is 1 at least. An empty table gives no rows.

    The chance that no band of a pair agrees is (1 - s^4)^24 at similarity s: 3e-6 at 0.8 and less above.
    """
    source = bounded_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    run, schema = _signed(words)
    signed = stored(source.mapInArrow(run, schema), "signed")
    nodes = stored(
        signed.where("doc_id is not null and n_shingles > 0").groupBy("set_hi", "set_lo")
        .agg(F.min("doc_id").alias("node"), *(F.max(c).alias(c) for c in ["n_shingles", *_SKETCH, *_BAND])), "nodes")
    linker = _Linker(source.where("id is not null"), nodes, words, percent)
    links = linker.confirmed(linker.to_leaders())
    labels = components(links)
    for step in (lambda known: linker.confirmed(linker.to_guides(known)), linker.across):
        more = step(labels)
        if not more.isEmpty():
            links = links.union(more)
            labels = components(links)
    groups = stored(
        nodes.select("set_hi", "set_lo", "node").join(labels, "node", "left")
        .select("set_hi", "set_lo", F.coalesce("label", "node").alias("component_id")), "groups")
    joined = signed.select("doc_id", "n_shingles", "set_hi", "set_lo").join(groups, ["set_hi", "set_lo"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        (component.isNull() | (F.col("doc_id") == component)).alias("kept"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that :func:`near_duplicates` keeps, with all their columns.

    Copies of one doc_id stand or fall together; remove exact duplicates before if they should not.
    """
    judged = near_duplicates(docs, id_col, text_col, words, percent)
    gone = unused(docs, "__dropped")
    dropped = stored(judged.where("not kept").select(F.col("doc_id").alias(gone)).distinct(), "dropped")
    return docs.join(dropped, F.col(id_col).cast("long") == F.col(gone), "left_anti").select(*others(docs, ()))
