import math
import random

import pytest

from topiclog.llm import topk, urls


# URL filters

def brute_verdicts(rows, rules=urls.RULES):
    """(host, path, rule, verdict) of each url; canonical URLs that repeat are listed."""
    def parts(url):
        if url is None or "://" not in url:
            return "", "", ""
        rest = url.split("://", 1)[1]
        end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
        tail = rest[end:]
        cut = next((i for i, c in enumerate(tail) if c in "?#"), len(tail))
        return host, tail[:cut], tail[cut:]

    def canonical(url):
        host, path, tail = parts(url)
        name = host.removeprefix("www.")
        if not name:
            return None
        query = tail[1:].split("#")[0] if tail.startswith("?") else ""
        asked = sorted(p for p in query.split("&") if p and not (
            p.split("=")[0] in ("ref", "fbclid", "gclid") or p.split("=")[0].startswith("utm_")))
        return name + path.rstrip("/") + ("?" + "&".join(asked) if asked else "")

    keys = [canonical(u) for u in rows]
    out = []
    for url, key in zip(rows, keys):
        host, path, _ = parts(url)
        fits = [(n + p, v) for v, n, p in rules if (host == n or host.endswith("." + n)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda f: len(f[0])) if fits else (None, None)
        out.append((host, path, rule, verdict or ("block" if key is not None and keys.count(key) > 1 else "allow")))
    return out


URLS = [
    "http://a.Example.ORG/es/1", "https://example.org/en/12?x=1", "https://example.org/en/2", "https://badexample.org/es/1", "http://org", "http://org/",
    "http://x.com/fr/1", "http://x.com/de/1#f", "http://x.com/DE/1", "http://x.com", "http://www.x.com/?utm_source=a", "https://X.com/#top",
    "http://y.net/a?b=2&a=1&ref=z", "ftp://y.net/a/?a=1&b=2", "http://y.net/a?b=2", "no scheme", "", None, None, "://", "http:///path", "x://é.NET/ä",
    "http://z.net/1", "http://z.net/1", "http://z.net/1/", "http://q.net?p=/a#b", "http://q.net#b?p",
]


def test_verdicts_as_brute_force(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judged(pages, urls.shared_urls(pages)).collect()}
    assert [found[i] for i in range(len(URLS))] == brute_verdicts(URLS)
    assert {v for _, _, r, v in found.values() if r is None} == {"allow", "block"}


def test_the_filter_changes_nothing_but_the_work(spark):
    rows = [f"http://h{i % 7}.net/{i}" for i in range(400)]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    listed = spark.createDataFrame([(f"h{i % 7}.net/{i}",) for i in range(0, 400, 3)] + [(None,), ("h0.net/0",)], "canonical string")
    found = {r.page_id: r.verdict for r in urls.judged(pages, listed).collect()}
    assert found == {i: "block" if i % 3 == 0 else "allow" for i in range(400)}


def test_urls_of_odd_tables(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    none = spark.createDataFrame([], "canonical string")
    assert urls.judged(empty, none).count() == 0
    clash = spark.createDataFrame([(1, "http://a.b/c", 5, "v"), (1, "http://a.b/c", 5, "v")], "page_id long, url string, host int, verdict string")
    found = urls.judged(clash, none)
    assert [tuple(r) for r in found.collect()] == [(1, "http://a.b/c", "a.b", "/c", None, "allow")] * 2


# Top-k search

def brute_top(vectors, queries, k):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for q, x in {i: x for i, x in usable if i in queries}.items():
        scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in usable if i != q)
        out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return {q: v for q, v in out.items() if v}


def searched(spark, vectors, queries, k, kind="double"):
    frame = spark.createDataFrame(vectors, f"vec_id long, embedding array<{kind}>")
    rows = topk.nearest(frame, frame.where(frame.vec_id.isin(list(queries))), k).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return found


def test_search_as_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "UNIT_ROWS", 40)
    rng = random.Random(1)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    vectors = []
    for i in range(400):
        scale = rng.choice([0.01, 1, 1, 5, 30])
        vectors.append((i, [scale * (c + rng.gauss(0, 0.05)) for c in rng.choice(centres)]))
    vectors += [(1000 + i, vectors[7][1]) for i in range(90)] + [(2000, [0.0] * 8), (2001, [-x for x in vectors[3][1]])]
    queries = {0, 7, 50, 333, 1000, 2000, 2001}
    assert searched(spark, vectors, queries, 5) == brute_top(vectors, queries, 5)


def test_coordinate_pruning_loses_nothing():
    rng = random.Random(3)
    vectors = [(i, [float(math.floor(256 * rng.gauss(0, 1))) for _ in range(6)]) for i in range(300)]
    import numpy as np

    lengths = [math.hypot(*v) for _, v in vectors]
    unit = topk.Unit([i for i, _ in vectors], lengths, [np.array(v).tobytes() for _, v in vectors])
    for q, (own, x) in enumerate(vectors[:60]):
        products = {i: sum(a * b for a, b in zip(x, y)) for i, y in vectors}
        best = max(p for i, p in products.items() if i != own)
        for score in (best, 0.9 * best, 0.5 * best, -1.0):
            kept = {int(unit.ids[j]) for j in unit._within(np.array(x), lengths[q], score)}
            assert {i for i, p in products.items() if p >= score} <= kept


def test_search_of_odd_vectors(spark):
    vectors = [(1, [0.5, -0.001]), (2, [1.0, 2.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 0.0]), (None, [9.0, 9.0]),
               (7, [1.0]), (8, []), (9, [1e30, -1e30]), (10, [2.0, 1.0]), (11, [2.0, 1.0])]
    expected = brute_top([(i, v) for i, v in vectors if v is None or len(v) == 2], {1, 2}, 3)
    found = searched(spark, vectors, {1, 2, 4, 5, 8}, 3)
    largest = 2**63 - 1
    assert found[1][0][:2] == (1, 9) and found[1][0][2] == largest
    assert [r[1] for r in found[1][1:]] == [10, 11] and expected
    assert 4 not in found and 5 not in found
    assert [r[1:] for r in found[8]] == [(1, 0), (2, 0), (7, 0)]
    assert searched(spark, [], {1}, 3) == {} and searched(spark, [(1, [1.0])], {1}, 3) == {}
    repeated = [(1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0])]
    assert searched(spark, repeated, {1}, 5) == {1: [(1, 2, 65536), (2, 2, 65536)]}
