"""Compression of vectors to codes: a codebook per part, nearest entries found with fixed pivots (LAESA).

Vectors are cut into parts, and every part has a codebook. A few pivots per part are chosen among its first entries; the distances of all
parts to them are computed once and stored. In each round the distances of pivots to entries give, by the triangle inequality, a lower
bound of every distance of part and entry: the greatest difference of their distances to a pivot. Entries are tried in the order of
these bounds, exactly and in integers, until the next bound is above the best distance found. A codebook and its sums have a fixed size
whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topiclog.llm.base import bounded_batches, stored
from topiclog.session import broadcast_if_small

SCALE = 256.0
PARTS, ENTRIES, ROUNDS, PIVOTS = 16, 64, 2, 4
# Rows of a part looked at together.
ROWS = 4096
# Parts of the rows of a label that are joined with its sum side by side.
SALTS = 16
# Groups of entries of a part whose sums are added up side by side.
MERGED_IN = 4
# Relative error that stored distances may have.
_SLACK = 1e-5
_LONG = (1 << 63) - 1
COLUMNS = ("vec_id", "code", "error", "label_error", "codebooks_sha256")


class Codebook(NamedTuple):
    """``entries[part][entry]`` are the integers of an entry, ``pivots[part]`` those of its pivots."""

    entries: list[list[list[int]]]
    pivots: list[list[list[int]]]


def whole(x: np.ndarray, limit: int) -> np.ndarray:
    """floor(256 x) of doubles, as 64-bit integers, or as Python's where one is beyond ``limit``."""
    with np.errstate(over="ignore"):
        floors = np.floor(SCALE * x)
    if len(floors) == 0 or np.abs(floors).max() <= limit:
        return floors.astype(np.int64)
    return np.array([math.floor(256 * int(v)) if abs(v) > 2.0**60 else int(f) for v, f in zip(x.tolist(), floors.tolist())], object)


def safe(width: int) -> int:
    """The greatest component for which squared distances of parts of ``width`` components stay within 64 bits."""
    return math.isqrt((1 << 62) // max(1, width)) // 2


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of every row to every point, exact."""
    gaps = rows[:, None, :] - points[None, :, :]
    return (gaps * gaps).sum(axis=2)


def as_doubles(numbers: np.ndarray) -> np.ndarray:
    """Integers that are not negative as doubles; infinite beyond their range."""
    if numbers.dtype != object:
        return numbers.astype(np.float64)
    return np.array([float(n) if n < 1 << 1000 else math.inf for n in numbers.ravel()], np.float64).reshape(numbers.shape)


def roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(as_doubles(squares))


def points(rows: list[list[int]], width: int) -> np.ndarray:
    """Entries or pivots of ``width`` components, in 64 bits where squared distances stay within them."""
    wide = max((abs(c) for row in rows for c in row), default=0) > safe(width)
    return np.array(rows, object if wide else np.int64).reshape(len(rows), width)


def chosen_pivots(entries: list[list[int]], count: int) -> list[list[int]]:
    """Entries far from each other: the first, then again and again the one farthest from those chosen."""
    points = np.array(entries, object)
    chosen = [0] if len(points) and points.shape[1] else []
    while chosen and len(chosen) < min(count, len(points)):
        nearest = distances(points, points[chosen]).min(axis=1)
        chosen.append(int(np.argmax(nearest)))
    return [entries[i] for i in chosen]


def nearest(rows: np.ndarray, entries: np.ndarray, to_pivots: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index of the nearest entry of each row, ties to the lower; its squared distance; exact distances computed).

    Rows are tried together: each has its own order of entries, and the n-th step computes the n-th entry of all rows still looking.
    """
    bounds = np.zeros((len(rows), len(entries)))
    for p in range(len(pivots)):
        apart = roots(distances(pivots[p:p + 1], entries))[0]
        ours = to_pivots[:, p:p + 1].astype(np.float64)
        np.maximum(bounds, np.abs(ours - apart) - _SLACK * (ours + apart), out=bounds)
    bounds = np.maximum(bounds, 0.0) ** 2 * (1 - _SLACK)
    order = np.argsort(bounds, axis=1, kind="stable")
    best = np.zeros(len(rows), np.int64)
    least = np.full(len(rows), -1, rows.dtype)
    looking, computed = np.arange(len(rows)), 0
    for step in range(len(entries)):
        at = order[looking, step]
        if step:
            # An entry at the very distance of the best one may have the lower index.
            open_ = bounds[looking, at] <= as_doubles(least[looking])
            looking, at = looking[open_], at[open_]
            if not len(looking):
                break
        gaps = rows[looking] - entries[at]
        found = (gaps * gaps).sum(axis=1)
        computed += len(looking)
        now, kept = least[looking], best[looking]
        better = (now < 0) | (found < now) | ((found == now) & (at < kept))
        best[looking] = np.where(better, at, kept)
        least[looking] = np.where(better, found, now)
    return best, least, computed


def _usable(width: int, parts: int):
    """Rows whose vectors can take part: floor(256 x) of their components as doubles or decimal text, and the distances to pivots later."""
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("vector", pa.binary())])
    limit = safe(max(1, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, vectors = [], []
            for i, values in enumerate(batch.column("vector")):
                if not values.is_valid or values.values.null_count:
                    continue
                x = values.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(x).all():
                    at.append(i)
                    vectors.append(packed(whole(np.pad(x, (0, parts * width - len(x))), limit)))
            kept = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(kept), batch.column("label").take(kept), pa.array(vectors, pa.binary())], schema=schema)

    return run, "vec_id long, label string, vector binary"


def packed(numbers: np.ndarray) -> bytes:
    """Integers in the smallest of 16, 32 and 64 bits that holds all; as JSON where 64 do not. The last byte says which."""
    if numbers.dtype == object:
        return json.dumps([int(n) for n in numbers]).encode() + b"j"
    most = int(np.abs(numbers).max()) if len(numbers) else 0
    kind, name = ("<i2", b"2") if most < 1 << 15 else ("<i4", b"4") if most < 1 << 31 else ("<i8", b"8")
    return numbers.astype(kind).tobytes() + name


def unpacked(raw: bytes) -> np.ndarray:
    if raw[-1:] == b"j":
        return np.array(json.loads(raw[:-1]), object)
    return np.frombuffer(raw[:-1], f"<i{raw[-1:].decode()}").astype(np.int64)


def _stacked(raws: list[bytes], parts: int, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, rows x parts x width) of vectors in 64-bit integers, then of those in Python's."""
    big = np.array([r[-1:] == b"j" for r in raws], bool)
    for wide in (False, True):
        at = np.flatnonzero(big == wide)
        if len(at):
            rows = np.stack([unpacked(raws[i]) for i in at])
            yield at, rows.reshape(len(at), parts, width)


def _with_pivots(book: Codebook, parts: int, width: int):
    """Adds to each vector the distances of its parts to the pivots, as 32-bit floats."""
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("vector", pa.binary()), ("to_pivots", pa.binary())])
    count = max(map(len, book.pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = batch.column("vector").to_pylist()
            out = np.zeros((len(raws), parts, count), "<f4")
            for at, rows in _stacked(raws, parts, width):
                for p in range(parts):
                    if book.pivots[p]:
                        # Beyond the range of a 32-bit float there is no bound to be had.
                        found = roots(distances(rows[:, p], points(book.pivots[p], width)))
                        out[at, p] = np.where(found < 1e38, found, np.nan)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([row.tobytes() for row in out], pa.binary())], schema=schema)

    return run, "vec_id long, label string, vector binary, to_pivots binary"


def _assigned(book: Codebook, batch: pa.RecordBatch, parts: int, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(part, places in the batch, their rows, nearest entries, squared distances), block by block."""
    raws, near = batch.column("vector").to_pylist(), batch.column("to_pivots").to_pylist()
    entries = [points(part, width) for part in book.entries]
    pivots = [points(part, width) for part in book.pivots]
    for start in range(0, len(raws), ROWS):
        block = raws[start:start + ROWS]
        known = np.stack([np.frombuffer(r, "<f4") for r in near[start:start + ROWS]]).reshape(len(block), parts, -1)
        for at, rows in _stacked(block, parts, width):
            for p in range(parts):
                mine, to = rows[:, p], known[at, p]
                # Distances beyond a 32-bit float bound nothing: all entries are tried.
                usable = pivots[p] if not np.isnan(to).any() and rows.dtype == entries[p].dtype == pivots[p].dtype == np.int64 else pivots[p][:0]
                best, least, _ = nearest(mine.astype(np.result_type(mine, entries[p])), entries[p], to, usable)
                yield p, start + at, mine, best, least


def _sums(book: Codebook, parts: int, width: int):
    """Of each task, per part and entry: how many parts chose it, and their componentwise sums as decimal text."""
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, len(book.entries[0])), np.int64)
        sums = np.zeros((*counts.shape, width), object)
        for batch in batches:
            for p, _, rows, best, _ in _assigned(book, batch, parts, width):
                counts[p] += np.bincount(best, minlength=counts.shape[1])
                added = np.zeros((counts.shape[1], width), rows.dtype)
                # ROWS components below the limit of ``safe`` stay within 64 bits.
                np.add.at(added, best, rows)
                sums[p] += added
        used = np.argwhere(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array(used[:, 0], pa.int32()), pa.array(used[:, 1], pa.int32()), pa.array(counts[tuple(used.T)], pa.int64()),
            pa.array([[str(int(c)) for c in sums[p, e]] for p, e in used], pa.list_(pa.string()))], schema=schema)

    return run, "part int, entry int, n long, sums array<string>"


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    """The sums of all tasks, for some entries of a part."""
    totals: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for part, entry, n, sums in zip(rows["part"], rows["entry"], rows["n"], rows["sums"]):
        count, so_far = totals.get((part, entry), (0, [0] * len(sums)))
        totals[part, entry] = count + n, [a + int(b) for a, b in zip(so_far, sums)]
    return pd.DataFrame({
        "part": [p for p, _ in totals], "entry": [e for _, e in totals], "n": [n for n, _ in totals.values()],
        "sums": [list(map(str, s)) for _, s in totals.values()]})


def _coded(book: Codebook, parts: int, width: int):
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("code", pa.string()), ("error", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = np.zeros((len(batch), parts), np.int64)
            error = np.zeros(len(batch), object)
            for p, at, _, best, least in _assigned(book, batch, parts, width):
                code[at, p] = best
                error[at] += least
            digits = max(2, len(f"{len(book.entries[0]) - 1:x}"))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("label"), pa.array(["".join(f"{c:0{digits}x}" for c in row) for row in code.tolist()], pa.string()),
                pa.array([min(_LONG, int(e)) for e in error], pa.int64())], schema=schema)

    return run, "vec_id long, label string, code string, error long"


def book_text(book: Codebook) -> str:
    """All integers of the codebook, by part, entry and position, with commas between."""
    return ",".join(str(c) for part in book.entries for entry in part for c in entry)


def trained(rows: DataFrame, width: int, parts: int, entries: int, rounds: int, pivots: int) -> tuple[DataFrame, Codebook]:
    """(stored vectors with their distances to the pivots, codebook after ``rounds``). ``rows`` are stored usable vectors.

    To the driver come ``entries`` vectors, and in each round one row per part and entry.
    """
    ids = [r.vec_id for r in rows.select("vec_id").where(F.col("vec_id").isNotNull()).distinct().orderBy("vec_id").limit(entries).collect()]
    if ids:
        first = rows.where(F.col("vec_id") <= ids[-1]).groupBy("vec_id").agg(F.min("vector").alias("vector")).orderBy("vec_id").collect()
    else:
        first = rows.select("vector").distinct().orderBy("vector").limit(entries).collect()
    cut = [unpacked(bytes(r.vector)).reshape(parts, width) for r in first]
    start = [[[int(c) for c in v[p]] for v in cut] for p in range(parts)]
    book = Codebook(start, [chosen_pivots(part, pivots) for part in start])
    run, schema = _with_pivots(book, parts, width)
    ready = stored(rows.mapInArrow(run, schema), "codes")
    for _ in range(rounds):
        run, schema = _sums(book, parts, width)
        moved = [[list(e) for e in part] for part in book.entries]
        for r in ready.mapInArrow(run, schema).groupBy("part", F.col("entry") % MERGED_IN).applyInPandas(_added, schema).collect():
            moved[r.part][r.entry] = [int(s) // r.n for s in r.sums]
        book = Codebook(moved, book.pivots)
    return ready, book


def compressed(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS,
) -> DataFrame:
    """One row per usable row of ``vectors``: vec_id, code, error, label_error, codebooks_sha256.

    Every component becomes floor(256 x). ``code`` has two hex digits or more for the entry of each part, ``error`` is the squared distance
    of the vector to what its code stands for, ``label_error`` its sum over equal labels, nulls together, and ``codebooks_sha256`` the
    digest of all entries. The codebook starts as the vectors of the ``entries`` smallest ids, which may be fewer; entries that
    nothing chose stay. Ties go to the lower entry.

    Rows with a null vector or a null or non-finite component are left out; repeated rows each have their row and weight, but an id
    starts one entry, with the least of its vectors. Rows without id are coded too; if no row has one, the least vectors start. Vectors
    shorter than the longest, or whose size is no multiple of ``parts``, end in zeros. Components beyond 64 bits are computed exactly; errors
    beyond are cut to the greatest long. An empty table gives no rows. Only the three columns are read, so others may have any name.
    """
    if not 1 <= entries or not 1 <= parts:
        raise ValueError("at least one part and one entry are needed")
    spark = vectors.sparkSession
    source = bounded_batches(vectors).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    longest = source.agg(F.max(F.size("vector"))).first()[0]
    width = -(-max(0, longest or 0) // parts)
    run, schema = _usable(width, parts)
    rows = stored(source.mapInArrow(run, schema), "vectors")
    if rows.isEmpty():
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    ready, book = trained(rows, width, parts, entries, rounds, pivots)
    run, schema = _coded(book, parts, width)
    coded = stored(ready.mapInArrow(run, schema), "coded")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG).cast("decimal(38,0)")).cast("long")
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    sums = stored(coded.groupBy("label").agg(total.alias("label_error")), "label-errors").withColumnRenamed("label", "of")
    small = broadcast_if_small(sums)
    if small is sums:
        salted = sums.withColumn("salt", salt)
        joined = coded.withColumn("slice", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int")).join(
            salted, F.col("label").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("salt")))
    else:
        joined = coded.join(small, F.col("label").eqNullSafe(F.col("of")))
    digest = hashlib.sha256(book_text(book).encode()).hexdigest()
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle(rounds: int = ROUNDS) -> str:
    """SQL for the table ``embeddings``: every part with every entry of its codebook, round by round."""
    def assigned(name: str, book: str) -> str:
        square = "list_dot_product(a.x, a.x) - 2 * list_dot_product(a.x, b.x) + list_dot_product(b.x, b.x)"
        return f"""{name} AS MATERIALIZED (
  SELECT a.rid, a.p, min(struct_pack(d := ({square})::BIGINT, e := b.e)) AS best
  FROM parts a JOIN {book} b USING (p) GROUP BY a.rid, a.p
)"""

    steps = []
    for k in range(rounds):
        steps.append(assigned(f"near{k}", f"book{k}"))
        steps.append(f"""book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN (
    SELECT p, e, list(floor((s - ((s % n) + n) % n) / n) ORDER BY i) AS x FROM (
      SELECT p, e, i, sum(c::HUGEINT) AS s, count(*) AS n FROM (
        SELECT p, best.e AS e, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM near{k} JOIN parts USING (rid, p)
      ) GROUP BY p, e, i
    ) GROUP BY p, e
  ) m USING (p, e)
)""")
    steps.append(assigned("final", f"book{rounds}"))
    return f"""
WITH usable AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT rid, vec_id, p, list_slice(v, p * (len(v) // {PARTS}) + 1, (p + 1) * (len(v) // {PARTS})) AS x FROM usable, range({PARTS}) AS r(p)
), book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM parts QUALIFY e < {ENTRIES}
), {", ".join(steps)}, coded AS (
  SELECT rid, string_agg(format('{{:02x}}', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM final GROUP BY rid
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) FROM (
     SELECT p, e, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM book{rounds})) AS codebooks_sha256
FROM coded JOIN usable USING (rid)
"""
