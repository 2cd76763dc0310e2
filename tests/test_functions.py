import hashlib

import pytest
from pyspark.sql import functions as F

from topiclog.errors import InvalidStorageError
from topiclog.functions import clusters, measures, names, patterns, positions


def values(spark, column, **columns):
    schema = ", ".join(f"{n} {t}" for n, (t, _) in columns.items())
    data = list(zip(*[v for _, v in columns.values()]))
    return [r[0] for r in spark.createDataFrame(data, schema).select(column).collect()]


def test_make_topic(spark):
    found = values(spark, names.make_topic(F.col("d"), F.col("s")), d=("string", ["ams-3"]), s=("string", ["page_views"]))
    assert found == ["scribe.ams-3.page_views"]


def test_parse_topic(spark):
    topics = ["scribe.ams-3.orders", "scribe.lhr.nginx.access.json"]
    topic = F.col("t")
    assert values(spark, names.topic_datacenter(topic), t=("string", topics)) == ["ams-3", "lhr"]
    assert values(spark, names.topic_stream(topic), t=("string", topics)) == ["orders", "nginx.access.json"]


def test_malformed_topics(spark):
    topics = ["orders", "scribe.orders", "other.ams-3.orders", "", "scribe.."]
    topic = F.col("t")
    assert values(spark, names.is_well_formed(topic), t=("string", topics)) == [False, False, False, False, True]
    assert values(spark, names.topic_stream(topic), t=("string", topics)) == [None, None, None, None, ""]


def test_parsing_that_raises(spark, rows):
    from topiclog.errors import TopicNameError
    from topiclog.operators.discovery import parsed_topics
    topics = lambda *names: spark.createDataFrame([(n,) for n in names], "topic string")
    assert rows(parsed_topics(topics("scribe.lhr.a.b"))) == [("scribe.lhr.a.b", "lhr", "a.b")]
    assert names.split_topic("scribe.lhr.a.b") == ("lhr", "a.b")
    for wrong in ("scribe.lhr", "other.lhr.a"):
        with pytest.raises(ValueError, match="not a well-formed"):
            names.split_topic(wrong)
    # Also where nobody reads the parts, as in a count.
    for wrong in ("scribe.lhr", "other.lhr.a", "", None):
        with pytest.raises(TopicNameError, match="not a well-formed"):
            parsed_topics(topics("scribe.lhr.a", wrong)).count()
    assert parsed_topics(topics()).count() == 0
    with pytest.raises(TopicNameError):
        names.split_topic("")


def test_units_are_cut_at_the_last_dash(spark):
    units = ["orders-4", "orders-12", "page-views-3"]
    assert values(spark, names.unit_topic(F.col("u")), u=("string", units)) == ["orders", "orders", "page-views"]
    assert values(spark, names.unit_partition(F.col("u")), u=("string", units)) == [4, 12, 3]
    assert values(spark, names.unit_name(F.col("t"), F.col("p")), t=("string", ["page-views"]), p=("int", [3])) == ["page-views-3"]


def test_group_path(spark):
    topics = ["views", "orders"]
    digest = hashlib.sha1(repr(sorted(topics)).encode()).hexdigest()
    frame = dict(g=("string", ["billing"]), t=("array<string>", [topics]))
    assert values(spark, names.group_path(F.col("g"), F.col("t"), "/base"), **frame) == [f"/base/billing/{digest}"]
    assert values(spark, names.group_path(F.col("g"), F.col("t"), "/base", by_topics=False), **frame) == ["/base/billing"]


def test_text_and_bytes(spark):
    assert values(spark, names.as_text(names.as_bytes(F.col("v"))), v=("string", ["größe", ""])) == ["größe", ""]


def test_patterns(spark):
    topics = ["topic1", "mytopic", "log.topic"]
    topic = F.col("t")
    assert values(spark, patterns.starts_matching(topic, "topic|x"), t=("string", topics)) == [True, False, False]
    assert values(spark, patterns.contains_matching(topic, "topic"), t=("string", topics)) == [True, True, True]
    assert values(spark, patterns.ends_with_stream(topic, ".topic"), t=("string", topics)) == [False, False, True]


def identity(spark, brokers, zookeeper):
    frame = spark.createDataFrame([("t", "n", brokers, zookeeper)], "type string, name string, b array<string>, z string")
    return frame.select(clusters.cluster_identity(F.col("type"), F.col("name"), F.col("b"), F.col("z"))).first()[0]


def test_cluster_identity_ignores_order_and_empty_hosts(spark):
    one = identity(spark, ["b1:1", "b2:1"], "z1,z2")
    assert one == identity(spark, ["b2:1", "", "b1:1"], "z2,z1,")
    assert one != identity(spark, ["b1:1", "b3:1"], "z1,z2")
    assert one != identity(spark, ["b1:1", "b2:1"], "z1,z3")


def test_positions(spark):
    assert values(spark, positions.known_or_zero(F.col("o")), o=("bigint", [-1, None, 7])) == [0, 0, 7]
    found = values(spark, positions.mark_or_failed(F.col("o"), F.col("e")), o=("bigint", [30, 30, 30]), e=("int", [0, 3, None]))
    assert found == [30, -1, 30]
    assert values(spark, positions.distance(F.col("h"), F.col("c")), h=("bigint", [30, 5]), c=("bigint", [10, 9])) == [20, -4]


@pytest.mark.parametrize("reset, expected", [("smallest", [7, 5, 5, 5, 5, 9]), ("largest", [7, 9, 9, 9, 5, 9])])
def test_start_offset(spark, reset, expected):
    commits = [7, None, 4, 10, 5, 9]
    start = positions.start_offset(F.col("c"), F.lit(5), F.lit(9), reset)
    assert values(spark, start, c=("bigint", commits)) == expected


def test_unknown_reset():
    with pytest.raises(ValueError):
        positions.start_offset(None, None, None, "middle")


def test_storages():
    assert positions.read_storage(None) == "zookeeper"
    assert positions.write_storages(None) == ["zookeeper"]
    assert positions.write_storages("dual") == ["zookeeper", "kafka"]
    for function in (positions.read_storage, positions.write_storages):
        with pytest.raises(InvalidStorageError):
            function("random_string")
    with pytest.raises(InvalidStorageError):
        positions.read_storage("dual")


def test_dimensions(spark):
    fixed = measures.fixed_dimensions(group_id="g", cluster_name="c", cluster_type="t")
    found = values(spark, measures.merged_dimensions(F.col("own"), fixed),
                   own=("map<string,string>", [{"extra": "1", "group_id": "mine"}, {}, None]))
    always = {"group_id": "g", "cluster_name": "c", "cluster_type": "t"}
    assert found == [{"extra": "1", **always}, always, always]


def test_milliseconds(spark):
    assert values(spark, measures.to_milliseconds(F.col("s")), s=("double", [10.0])) == [10000.0]
    assert values(spark, measures.to_seconds(F.col("s")), s=("int", [100])) == [0.1]
