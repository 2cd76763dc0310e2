"""Exact top-k search by inner product over candidates grouped by length.

Candidates are grouped by length into buckets, and each bucket is dealt to units of a few thousand vectors. A first pass over the
unit of longest vectors gives each query a score its k-th best can only exceed. With that score each query visits only units long enough
to reach it, and there needs a cosine of at least score / (query length * longest length in the unit). Where that local threshold is high,
the coordinates in which the query is largest confine a candidate's coordinates (coordinate pruning); else candidates too short for the
score are cut off the sorted unit (length pruning). The products of all that remain are computed exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topiclog.llm.base import bounded_batches, stored

UNIT_ROWS = 4096
MOST_BUCKETS = 256
# Local cosine threshold from which coordinates are worth looking at, and how many of them.
COORDINATE_FROM, FOCUS = 0.85, 4
SCALE = 256.0
_SLACK = 1e-9
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1
COLUMNS = ("query_id", "rank", "vec_id", "score")


def _scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, length, vector) of usable rows: floor(256 x) of every component, as doubles."""
    schema = pa.schema([("id", pa.int64()), ("length", pa.float64()), ("vector", pa.binary())])
    for batch in batches:
        ids, lengths, vectors = [], [], []
        for key, values in zip(batch.column(0).to_pylist(), batch.column(1)):
            if key is None or not values.is_valid or values.values.null_count:
                continue
            x = values.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if not np.isfinite(x).all():
                continue
            with np.errstate(over="ignore"):
                x = np.floor(SCALE * x)
            if not np.isfinite(x).all():
                continue
            ids.append(key)
            lengths.append(float(np.hypot.reduce(x)) if len(x) else 0.0)
            vectors.append(x.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lengths, pa.float64()), pa.array(vectors, pa.binary())], schema=schema)


def _matrix(vectors: list[bytes], width: int) -> np.ndarray:
    """Rows of ``width`` numbers; shorter vectors end in zeros."""
    rows = np.zeros((len(vectors), width))
    for row, v in zip(rows, vectors):
        row[:len(v) // 8] = np.frombuffer(v)
    return rows


class Unit:
    """Some candidates, longest first."""

    def __init__(self, ids: list[int], lengths: list[float], vectors: list[bytes]):
        order = np.argsort(-np.array(lengths), kind="stable")
        self.ids = np.array(ids, np.int64)[order]
        self.lengths = np.array(lengths)[order]
        self.width = max((len(v) // 8 for v in vectors), default=0)
        self.rows = _matrix([vectors[i] for i in order], self.width)
        with np.errstate(invalid="ignore", divide="ignore"):
            self.directions = np.nan_to_num(self.rows / self.lengths[:, None])

    def _within(self, query: np.ndarray, length: float, score: float) -> np.ndarray:
        """Positions of the candidates that can reach ``score``."""
        if length == 0 or not np.isfinite(score):
            return np.arange(len(self.ids)) if score <= 0 else np.arange(0)
        longest = self.lengths[0] if len(self.lengths) else 0.0
        local = (score - abs(score) * _SLACK) / (length * longest) if longest else -np.inf
        if local > 1 + _SLACK:
            return np.arange(0)
        if local < COORDINATE_FROM:
            shortest = score / length * (1 - _SLACK)
            return np.arange(len(self.ids) if shortest <= 0 else int(np.searchsorted(-self.lengths, -shortest, "right")))
        keep = self.lengths >= score / length * (1 - _SLACK)
        # A candidate lies within the angle of the threshold from the query, which confines its angle to each axis.
        direction = query[:self.width] / length
        reach = np.arccos(min(1.0, local))
        for f in np.argsort(-np.abs(direction))[:FOCUS]:
            angle = np.arccos(np.clip(direction[f], -1, 1))
            high, low = np.cos(max(0.0, angle - reach)), np.cos(min(np.pi, angle + reach))
            keep &= (self.directions[:, f] >= low - 1e-7) & (self.directions[:, f] <= high + 1e-7)
        return np.flatnonzero(keep)

    def best(self, ids: list[int], lengths: list[float], vectors: list[bytes], scores: list[float], k: int) -> Iterator[tuple[int, np.ndarray, list[int]]]:
        """For each query its k best candidates here that reach its score: (position of the query, candidate ids, products)."""
        width = max([self.width, *(len(v) // 8 for v in vectors)])
        rows = self.rows if width == self.width else np.pad(self.rows, ((0, 0), (0, width - self.width)))
        queries = _matrix(vectors, width)
        for i, (own, length, score) in enumerate(zip(ids, lengths, scores)):
            at = self._within(queries[i], length, score)
            at = at[self.ids[at] != own]
            if not len(at):
                continue
            if length * (self.lengths[0] if len(self.lengths) else 0.0) < _EXACT:
                products = (rows[at] if len(at) < len(rows) else rows) @ queries[i]
                reach = products >= score
                at, products = at[reach], products[reach]
                if len(at) > k:
                    worst = np.partition(products, len(products) - k)[len(products) - k]
                    at, products = at[products >= worst], products[products >= worst]
                order = np.lexsort((self.ids[at], -products))[:k]
                yield i, self.ids[at[order]], products[order].astype(np.int64).tolist()
            else:
                numbers = [int(v) for v in queries[i]]
                exact = [sum(int(a) * b for a, b in zip(rows[j], numbers)) for j in at]
                order = sorted(range(len(at)), key=lambda j: (-exact[j], self.ids[at[j]]))[:k]
                yield i, self.ids[at[order]], [max(-_LONG - 1, min(_LONG, exact[j])) for j in order]


def _least_scores(seed, k: int):
    """Adds to each query the k-th best score among the seed unit; minus infinity if there are fewer."""
    schema = pa.schema([("id", pa.int64()), ("length", pa.float64()), ("vector", pa.binary()), ("least", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = Unit(*seed.value)
        for batch in batches:
            ids, lengths, vectors = (batch.column(c).to_pylist() for c in ("id", "length", "vector"))
            least = [-np.inf] * len(ids)
            for i, _, products in unit.best(ids, lengths, vectors, least, k):
                if len(products) == k:
                    least[i] = float(products[-1]) - abs(float(products[-1])) * 1e-15
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("length"), batch.column("vector"), pa.array(least, pa.float64())], schema=schema)

    return run, "id long, length double, vector binary, least double"


def _searched(k: int):
    """Rows come sorted by unit, candidates before queries: gather the unit, then answer the queries as they come."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, unit = None, None
        gathered: tuple[list, list, list] = ([], [], [])
        for batch in batches:
            units = batch.column("unit").to_numpy()
            asks = batch.column("least").is_valid().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(units) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(units)]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                rows = [part.column(c).to_pylist() for c in ("id", "length", "vector")]
                if units[a] != number:
                    number, unit, gathered = units[a], None, ([], [], [])
                if not asks[a]:
                    for into, values in zip(gathered, rows):
                        into.extend(values)
                    continue
                unit = unit or Unit(*gathered)
                out: tuple[list, list, list] = ([], [], [])
                for i, ids, products in unit.best(*rows, part.column("least").to_pylist(), k):
                    out[0].extend([rows[0][i]] * len(products))
                    out[1].extend(ids.tolist())
                    out[2].extend(products)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], schema=schema)

    return run, "query_id long, vec_id long, score long"


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` best of ``vectors`` for each row of ``queries``: query_id, rank (from 1), vec_id, score.

    Components are floor(256 x); the score is the integer inner product, exact, ties to the smaller vec_id; rows with the id of the query
    are not its candidates. Rows without id, with a null vector, or with a null or non-finite component take no part.
    Vectors of unequal dimension are compared as if the shorter ended in zeros. Of query rows with one id the
    least vector asks; repeated candidates all count. Scores beyond 64 bits are cut to the largest or smallest long. With fewer
    candidates than ``k`` all are returned; without queries or candidates there are no rows.

    Every query visits every unit it can reach, in blocks: queries * units rows are shuffled, units * UNIT_ROWS being all
    candidates, and a task holds one unit and a batch of queries at a time.
    """
    def scaled(frame: DataFrame) -> DataFrame:
        own = bounded_batches(frame).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
        return own.mapInArrow(_scaled, "id long, length double, vector binary")

    spark = vectors.sparkSession
    candidates = stored(scaled(vectors), "vectors")
    asked = stored(scaled(queries).groupBy("id").agg(F.min(F.struct("vector", "length")).alias("row"))
                   .select("id", "row.length", "row.vector"), "queries")
    total = candidates.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not total:
        return empty
    # Buckets by length: at most MOST_BUCKETS edges come to the driver, and the size of each bucket.
    parts = max(1, min(MOST_BUCKETS, -(-total // UNIT_ROWS)))
    edges = sorted(set(candidates.agg(F.percentile_approx("length", [i / parts for i in range(parts)], 10_000)).first()[0]), reverse=True)
    bucket = F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e > F.col("length")))
    sizes = {r.bucket: (r.n, r.longest) for r in candidates.groupBy(bucket.alias("bucket"))
             .agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("longest")).collect()}
    order = sorted(sizes)
    units = {b: max(1, -(-sizes[b][0] // UNIT_ROWS)) for b in order}
    first, reached = {}, [0]
    for b in order:
        first[b] = reached[-1]
        reached.append(reached[-1] + units[b])

    def chosen(values: dict[int, int]):
        return F.element_at(F.create_map(*(F.lit(x) for b in order for x in (b, values[b]))), F.col("bucket"))

    dealt = candidates.withColumn("bucket", bucket).select(
        (chosen(first) + F.pmod(F.xxhash64("id", "vector"), chosen(units))).alias("unit"), "id", "length", "vector",
        F.lit(None).cast("double").alias("least"))
    seed = dealt.where("unit = 0").limit(2 * UNIT_ROWS).collect()
    known = spark.sparkContext.broadcast(([r.id for r in seed], [r.length for r in seed], [bytes(r.vector) for r in seed]))
    run, schema = _least_scores(known, k)
    ready = stored(asked.repartition("id").mapInArrow(run, schema), "asked")
    # Buckets come in falling length: a query visits those whose longest vector can reach its score.
    longest = F.array(*(F.lit(sizes[b][1]) for b in order))
    visits = F.size(F.filter(longest, lambda m: m * F.col("length") * (1 + _SLACK) >= F.col("least")))
    last = F.element_at(F.array(*map(F.lit, reached)), visits + 1)
    asking = ready.withColumn("last", last).where("last > 0").select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("last").cast("long") - 1)).alias("unit"), "id", "length", "vector", "least")
    run, schema = _searched(k)
    found = (
        dealt.unionByName(asking).repartition("unit").sortWithinPartitions("unit", F.col("least").isNotNull())
        .mapInArrow(run, schema)
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
