import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from topiclog.operators import numbering
from topiclog.operators.numbering import dense_index, store_in_order


@pytest.fixture(scope="module")
def skewed(spark):
    """One topic holds most rows, and its rows come in one burst; the order key is composite, with text in it."""
    n = F.col("id")
    return spark.range(0, 20_000, numPartitions=6).select(
        F.when(n.between(5_000, 14_000), "hot").otherwise(F.concat(F.lit("t"), (n % 40).cast("string"))).alias("topic"),
        F.md5((n % 701).cast("string")).alias("name"), F.timestamp_micros(n * 7919 % 20_011 * 1000).alias("at"), n.alias("id"))


def plain(rows, order_by, within):
    window = Window.partitionBy(*within).orderBy(*order_by)
    return rows.withColumn("index", (F.row_number().over(window) - 1).cast("bigint"))


@pytest.mark.parametrize("within", [["topic"], []])
@pytest.mark.parametrize("order_by", [["id"], ["at", "id"], ["name", "at", "id"]])
@pytest.mark.parametrize("rows_per_piece", [97, 3_000])
def test_pieces_give_the_same_numbers_as_one_window(skewed, within, order_by, rows_per_piece):
    split = dense_index(skewed, order_by, within, "index", rows_per_piece)
    whole = plain(skewed, order_by, within)
    assert split.columns == whole.columns
    assert split.count() == 20_000
    assert split.exceptAll(whole).isEmpty()


def test_parts_are_even_and_follow_each_other(spark, skewed, path):
    store_in_order(skewed, ["at", "id"], ["topic"], path("parts"), 1_000)
    parts = spark.read.parquet(path("parts")).groupBy(F.shiftright("_place", 33).alias("part")).agg(
        F.count("*").alias("rows"), F.min(F.struct("topic", "at", "id")).alias("first"), F.max(F.struct("topic", "at", "id")).alias("last"),
        F.countDistinct("topic").alias("topics")).orderBy("part").collect()
    # The hot topic has 9,001 rows: no part is much larger than the others, so it lies in many.
    assert 18 <= len(parts) <= 20 and max(p["rows"] for p in parts) < 2_000
    assert sum(p["first"].topic <= "hot" <= p["last"].topic for p in parts) >= 7
    assert all(a["last"] < b["first"] for a, b in zip(parts, parts[1:]))


def test_one_plan_whatever_the_size(skewed, monkeypatch):
    plans = []
    for rows_per_piece in (1_000, 20_000):
        plan = dense_index(skewed, ["id"], ["topic"], "index", rows_per_piece)._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "Join" in plan
        plans.append(plan.count("Join"))
    assert plans == [1, 1]
    monkeypatch.setattr(numbering, "broadcast_if_small", lambda df: df)
    assert dense_index(skewed, ["id"], ["topic"], "index", 100).exceptAll(plain(skewed, ["id"], ["topic"])).isEmpty()


def test_ties_and_nulls_in_the_order(spark):
    rows = spark.range(1000).select(F.lit("t").alias("topic"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("k"))
    found = dense_index(rows, ["k"], ["topic"], "index", 50).orderBy("index").collect()
    assert [r["index"] for r in found] == list(range(1000))
    keys = [-1 if r["k"] is None else r["k"] for r in found]
    assert keys == sorted(keys)


def test_no_rows(spark):
    assert dense_index(spark.range(0), ["id"], [], "index", 10).count() == 0


def test_what_only_gives_the_order_is_neither_shuffled_nor_stored(spark, skewed, path):
    tie = F.xxhash64("id")
    store_in_order(skewed, ["name"], ["topic"], path("kept"), 1_000, tie=tie, keep=["topic", "id"])
    stored = spark.read.parquet(path("kept"))
    assert stored.columns == ["topic", "id", "_place"]
    found = numbering.indexed(skewed.select("topic", "id"), ["topic"], "index", path("kept"))
    assert found.exceptAll(plain(skewed.withColumn("tie", tie), ["name", "tie"], ["topic"]).select("topic", "id", "index")).isEmpty()
    assert found.count() == 20_000
