import hashlib
import random
import re

import pytest

from topiclog.llm.exactdup import exact_groups, without_exact_duplicates
from topiclog.llm.graph import components
from topiclog.llm.neardup import max_differing_bits, near_duplicates, shingle_sets, signatures, without_near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_groups(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(hashlib.sha256(re.sub(r"[\x20\x09-\x0d]+", " ", text or "").encode()).hexdigest(), []).append(i)
    return {(i, min(g), len(g), i == min(g), h) for h, g in groups.items() for i in g}


def shingles(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[k:k + n]) for k in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute_near(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for j, t in sets.items():
            if j < i and s and t and 100 * len(s & t) >= percent * len(s | t):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {(i, len(s), root(i), root(i) == i) for i, s in sets.items()}


@pytest.mark.parametrize("least", [2, 1000])
def test_exact_groups_as_brute_force(documents, generated, least):
    rows = [r[:2] for r in generated]
    found = exact_groups(documents(rows), least=least).collect()
    assert {tuple(r) for r in found} == brute_groups(rows)
    assert len(found) == len(rows)


def test_groups_that_no_sketch_found_need_no_window(documents, generated):
    rows = [(7, "seen often")] * 30 + [(None, "without id")] * 30 + [r[:2] for r in generated if r[0] > 7]
    found = exact_groups(documents(rows), least=1000)
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
    counts = {}
    for r in found.collect():
        counts.setdefault((r.doc_id, r.keep_id, r.group_size), []).append(r.kept)
    assert sorted(counts[7, 7, 30]) == sorted(counts[None, None, 30]) == [False] * 29 + [True]


@pytest.mark.parametrize("least", [2, 1000])
def test_exact_duplicates_go(documents, generated, least):
    kept = without_exact_duplicates(documents(generated), least=least)
    assert kept.columns == ["doc_id", "text", "lang", "source"]
    assert {r.doc_id for r in kept.collect()} == {g[0] for g in brute_groups([r[:2] for r in generated]) if g[3]}


@pytest.mark.parametrize("least", [2, 1000])
def test_exact_groups_nulls_repeats_and_clashes(documents, spark, least):
    rows = [(3, "a  b"), (3, "a b"), (None, "a b"), (None, None), (None, ""), (7, None)]
    found = sorted(map(tuple, exact_groups(documents(rows), least=least).collect()), key=repr)
    by_text = {}
    for r in found:
        by_text.setdefault(r[4], []).append(r[:4])
    assert sorted(len(g) for g in by_text.values()) == [3, 3]
    for group in by_text.values():
        assert sum(r[3] for r in group) == 1
        assert {r[1] for r in group} in ({3}, {7}) and {r[2] for r in group} == {3}
    assert exact_groups(documents([]), least=least).count() == 0
    clash = spark.createDataFrame([(1, "x", "y", 5)], "doc_id long, text string, keep_id string, kept int")
    assert without_exact_duplicates(clash, least=least).collect()[0].asDict() == {"doc_id": 1, "text": "x", "keep_id": "y", "kept": 5}


def test_group_without_any_id_has_no_keep_id(documents):
    assert [tuple(r)[:4] for r in exact_groups(documents([(None, "t")])).collect()] == [(None, None, 1, True)]


@pytest.mark.parametrize("n, percent", [(4, 80), (5, 80)])
def test_near_duplicates_as_brute_force(documents, generated, n, percent):
    rows = [r[:2] for r in generated]
    found = near_duplicates(documents(rows), words=n, percent=percent).collect()
    assert {tuple(r) for r in found} == brute_near(rows, n, percent)


def test_chains_and_groups_around_no_common_leader(documents):
    """Copies drift from one to the next: neighbours are linked, the ends are not, and stars around the least id
    alone would not connect them."""
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(24):
        rows.append((100 - i if i % 2 else i, " ".join(words)))
        for _ in range(2):
            words[rng.randrange(200)] = f"w{rng.randrange(10**6)}"
    expected = brute_near(rows, 4, 80)
    assert len({r[2] for r in expected}) < len(rows) / 2
    assert {tuple(r) for r in near_duplicates(documents(rows)).collect()} == expected


def drifted(rng, base, share):
    """Runs of the base replaced by words that no other text has."""
    words = list(base)
    for at in rng.sample(range(0, len(words) - 4, 5), int(share * len(words) / 5)):
        words[at] = f"own{rng.randrange(10**9)}"
    return " ".join(words)


def test_group_of_unlinked_copies_costs_its_size(documents, monkeypatch):
    """Copies whose own changes fill more than a ninth of their shingles meet nobody; those that are linked are found among them."""
    from topiclog.llm import neardup

    rng = random.Random(8)
    base = [f"b{i}" for i in range(160)]
    rows = [(i, drifted(rng, base, 0.22 if i % 4 else rng.choice([0.03, 0.06, 0.1]))) for i in range(10, 410)]
    rows += [(1000 + i, rows[i * 7][1] + f" tail{i}") for i in range(40)]
    sifted = []
    known = neardup._Linker._alike
    monkeypatch.setattr(neardup._Linker, "_alike", lambda self, pairs: sifted.append(pairs.distinct().count()) or known(self, pairs))
    assert {tuple(r) for r in near_duplicates(documents(rows)).collect()} == brute_near(rows, 4, 80)
    assert sifted[-1] < 4 * len(rows)


def test_near_duplicates_odd_rows(documents, spark):
    long = " ".join(f"x{i}" for i in range(300_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO"), (6, "two"), (None, "one two"), (8, long), (9, long + " end"), (4, "one two")]
    found = sorted(map(tuple, near_duplicates(documents(rows)).collect()), key=repr)
    assert found == sorted([
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True),
        (None, 1, None, True), (8, 299_997, 8, True), (9, 299_998, 8, False)], key=repr)
    assert near_duplicates(documents([])).count() == 0
    clash = spark.createDataFrame([(1, "a b c d", 7), (2, "a b c d", 8)], "doc_id long, text string, kept int")
    assert [r.asDict() for r in without_near_duplicates(clash).collect()] == [{"doc_id": 1, "text": "a b c d", "kept": 7}]


def test_sketches_estimate_high_similarities():
    base = [f"w{i}" for i in range(400)]
    other = base[:380] + [f"v{i}" for i in range(20)]
    sets = dict(shingle_sets([" ".join(base).encode(), " ".join(other).encode(), b"quite another text with a few words"], 4))
    _, sketches = signatures([sets[i] for i in range(3)])
    differ = lambda a, b: sum(bin(int(x) & (2**64 - 1)).count("1") for x in (sketches[a] ^ sketches[b]))
    assert differ(0, 1) <= max_differing_bits(0.8) < differ(0, 2)


def test_components(spark):
    edges = [(i, i + 1) for i in range(20, 60)] + [(100, i) for i in range(200, 260)] + [(5, 5), (None, 3), (7, 300), (300, 8), (7, 8)]
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = {i: 20 for i in range(20, 61)} | {i: 100 for i in [100, *range(200, 260)]} | {5: 5} | {i: 7 for i in (7, 8, 300)}
    assert found == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("change", [str.lower, str.upper])
def test_columns_named_like_internal_ones_stay(spark, change):
    from topiclog.llm.mixing import mixture

    names = [change(c) for c in ("__digest", "__keep_id", "__nth", "__dropped", "__source", "__size", "__u", "__order", "__copies", "row", "id")]
    rows = [(i, f"text {'same' if i < 3 else i} of words", "s", *range(i * 100, i * 100 + len(names))) for i in range(1, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{c}` int" for c in names))
    for found in (without_exact_duplicates(docs), without_near_duplicates(docs), mixture(docs)):
        assert found.columns == docs.columns
        assert {tuple(r) for r in found.collect()} <= set(rows)
    assert sorted(r.doc_id for r in without_exact_duplicates(docs).collect()) == [1, 3, 4, 5]
