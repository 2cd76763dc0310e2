import collections
import os

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from topiclog.llm.base import stored, table
from topiclog.llm.queries import ORACLE, QUERIES
from topiclog.llm.quality import learned, scored
from tests.llm.test_dedup import brute_groups, brute_near
from tests.llm.test_documents import encoded

SF_DIR = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def stages(spark):
    """The result of each stage."""
    docs = table(spark, SF_DIR, "documents")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(stored(stage(spark, found[-1], SF_DIR), "stage"))
    return found


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_names_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact dedup", "near dedup", "mixing", "packing"]
    for kept in stages[1:-1]:
        assert kept.columns == stages[0].columns
    assert entry.queries()["pipeline"] is corpus_pipeline.run and set(QUERIES) <= set(entry.queries())


def test_quality_stage(spark, stages):
    held = "pmod(crc32(cast(cast(doc_id as string) as binary)), 4) <> 2"
    model = learned(stages[0], table(spark, SF_DIR, "labels").where(held))
    expected = {r.doc_id for r in scored(stages[0], model).collect() if r.score >= 0.7}
    assert collections.Counter(r["doc_id"] for r in rows(stages[1])) == collections.Counter(expected)


def test_dedup_stages(stages):
    before = [(r["doc_id"], r["text"]) for r in rows(stages[1])]
    assert {r["doc_id"] for r in rows(stages[2])} == {g[0] for g in brute_groups(before) if g[3]}
    left = [(r["doc_id"], r["text"]) for r in rows(stages[2])]
    assert {r["doc_id"] for r in rows(stages[3])} == {g[0] for g in brute_near(left, 5, 80) if g[3]}


def test_mixing_stage(spark, stages):
    from topiclog.llm.mixing import copies

    wanted = {r.doc_id: r.copies for r in copies(stages[3]).collect() if r.copies}
    assert collections.Counter(r["doc_id"] for r in rows(stages[4])) == wanted


def test_packing_stage(stages):
    docs = collections.Counter(r["doc_id"] for r in rows(stages[4]))
    texts = {r["doc_id"]: r["text"] for r in rows(stages[4])}
    pieces = collections.defaultdict(collections.Counter)
    fill = collections.Counter()
    for p in rows(stages[5]):
        pieces[p["doc_id"]][(p["start"], bytes(p["ids"]))] += 1
        fill[p["sequence_id"]] += p["length"]
    assert max(fill.values()) <= 2048
    assert set(pieces) == set(docs)
    for i, own in pieces.items():
        ids = np.array(encoded(texts[i]), "<u4")
        assert own == {(a, ids[a:a + 2048].tobytes()): docs[i] for a in range(0, len(ids), 2048)}


def test_run_applies_the_stages(spark, stages):
    key = lambda df: sorted((r["doc_id"], r["start"], r["length"], bytes(r["ids"])) for r in rows(df))
    assert key(corpus_pipeline.run(spark, SF_DIR)) == key(stages[-1])


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_against_sql(spark, name):
    db = duckdb.connect()
    for file in os.listdir(SF_DIR):
        db.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{SF_DIR}/{file}'")
    cursor = db.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    frame = QUERIES[name](spark, SF_DIR).select(*columns)
    assert sorted(map(tuple, frame.collect()), key=repr) == sorted(cursor.fetchall(), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"op9_minhash_near_dedup"}))
def test_queries_return_every_document(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    docs = {r.doc_id for r in table(spark, SF_DIR, "documents").select("doc_id").collect()}
    assert {r.doc_id for r in found.select("doc_id").collect()} == docs


def test_near_duplicates_of_the_table(spark):
    texts = [tuple(r) for r in table(spark, SF_DIR, "documents").select("doc_id", "text").collect()]
    found = {tuple(r) for r in QUERIES["op9_minhash_near_dedup"](spark, SF_DIR).collect()}
    assert found == brute_near(texts, 4, 80)
