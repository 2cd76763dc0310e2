"""SentencePiece pieces, vector codes and fill-in-the-middle, each against a plain version."""
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from topiclog.llm import codes, infill, pieces

ODD_TEXTS = [
    None, "", " ", "  ", "a", " a", "a  b   c ", "\n\n", "x\ty\r\n z", "▁", "a▁b ▁", "<s> </s> <unk> <0x41>", "é漢字😀ß", "\x00", "‍", "1234567890",
    "The thing and the other thing, of the 12 things.", "word " * 3000, "x" * 5000, "漢字仮名" * 2000, "ab" * 40 + "  " + "cd" * 40,
]


# SentencePiece

@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))


def test_ids_and_texts_are_those_of_the_library(spark, library, generated):
    texts = ODD_TEXTS + [t for _, t, _, _ in generated]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, IDS string")
    found = {r.doc_id: r for r in pieces.tokenized(docs).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        ids = library.encode(text or "")
        assert (found[i].ids, found[i].decoded, found[i].agreed) == (ids, library.decode(ids), True), text
    back = pieces.detokenized(pieces.tokenized(docs)).collect()
    assert {r.doc_id: r.text for r in back} == {i: r.decoded for i, r in found.items()}


def test_random_texts_and_random_ids(library):
    encoder, rng = pieces.pieces_of(None), random.Random(7)
    parts = ["a", "b", "the ", " the", "ing", " ", "  ", "é", "漢", "😀", "\x00", "▁", "<s>", "1", ".", ",", "\n", "ß", "Th", "and"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    ids, agreed = encoder.encoded(texts)
    assert all(agreed)
    assert [np.frombuffer(i, "<i4").tolist() for i in ids] == library.encode(texts)
    for _ in range(4000):
        # Bytes that are no characters, control and unknown pieces among others.
        some = [rng.choice([rng.randrange(library.vocab_size()), rng.randrange(262), 29871]) for _ in range(rng.randint(0, 8))]
        assert encoder.decoded(some) == library.decode(some), some


def test_an_agenda_takes_the_best_pair_and_the_leftmost_of_equals():
    scores = {"a": 0.0, "b": 0.0, "c": 0.0, "ab": -1.0, "bc": -1.0, "abc": -9.0, "aa": -2.0, "aaaa": -3.0}
    agenda = pieces.Agenda(scores)
    assert agenda.merged("abc") == ["abc"]
    assert agenda.merged("aaa") == ["aa", "a"]
    assert agenda.merged("aaaaab") == ["aaaa", "ab"]
    assert agenda.cuts("abcab") == [3]
    assert agenda.merged("bcd") == ["bc", "d"]
    many = pieces.Agendas(scores, {p: i for i, p in enumerate(scores)})
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 12))) for _ in range(500)]
    symbols, first = many.merged(texts)
    names = list(scores)
    for text, a, b in zip(texts, first, first[1:]):
        assert [names[s] if s >= 0 else "d" for s in symbols[a:b]] == agenda.merged(text), text


def test_a_small_memory_changes_nothing(library, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(pieces, "REMEMBERED", 40)
    encoder, rng = pieces.Pieces(public_tokenizers.path(pieces.MODEL)), random.Random(1)
    for _ in range(60):
        texts = [" ".join(rng.choice(["alpha", "beta,", "gamma.", "delta!", "x" * 50]) + str(rng.randrange(9)) for _ in range(20)) for _ in range(3)]
        assert [np.frombuffer(i, "<i4").tolist() for i in encoder.encoded(texts)[0]] == library.encode(texts)


def test_where_the_library_differs_it_is_right_and_the_document_marked(library):
    import public_tokenizers

    encoder = pieces.Pieces(public_tokenizers.path(pieces.MODEL))
    encoder._known_stretches.young["▁wrong"] = np.array([5, 6], "<i4").tobytes()
    ids, agreed = encoder.encoded(["all right", "wrong here", "right here"])
    assert agreed == [True, False, True]
    assert [np.frombuffer(i, "<i4").tolist() for i in ids] == library.encode(["all right", "wrong here", "right here"])


def test_no_documents_no_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.tokenized(empty).collect() == []
    repeated = spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string")
    assert len({tuple(r.ids) for r in pieces.tokenized(repeated).collect()}) == 1
    given = spark.createDataFrame([(1, None), (2, []), (3, [None, 263])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in pieces.detokenized(given).collect()} == {1: None, 2: "", 3: "er"}


# Vector codes

def brute_codes(rows, parts, entries, rounds):
    """Sorted (vec_id, code, error, label_error) and the digest, in Python's integers."""
    kept = [(i, [math.floor(256 * x) if abs(x) < 1e300 else 256 * int(x) for x in v], label)
            for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], None
    width = -(-max(len(v) for _, v, _ in kept) // parts)
    kept = [(i, v + [0] * (parts * width - len(v)), label) for i, v, label in kept]
    starts = {}
    for i, v, _ in kept:
        if i is not None:
            starts[i] = [*starts.get(i, []), v]
    first = [starts[i] for i in sorted(starts)[:entries]]
    assert all(len({tuple(v) for v in vs}) == 1 for vs in first)
    cut = lambda v, p: v[p * width:(p + 1) * width]
    book = [[cut(vs[0], p) for vs in first] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book[p]))

    for _ in range(rounds):
        moved = []
        for p in range(parts):
            members = {}
            for _, v, _ in kept:
                members.setdefault(near(p, cut(v, p))[1], []).append(cut(v, p))
            moved.append([[sum(c) // len(members[k]) for c in zip(*members[k])] if k in members else e for k, e in enumerate(book[p])])
        book = moved
    out, by_label = [], {}
    for i, v, label in kept:
        found = [near(p, cut(v, p)) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    long = (1 << 63) - 1
    digest = hashlib.sha256(",".join(str(c) for part in book for e in part for c in e).encode()).hexdigest()
    return sorted(((i, c, min(long, e), min(long, by_label[label])) for i, c, e, label in out), key=repr), digest


VECTORS = "vec_id long, embedding array<double>, label int"


def check_codes(spark, rows, parts=4, entries=8, rounds=2, **kwargs):
    found = codes.compressed(spark.createDataFrame(rows, VECTORS), parts=parts, entries=entries, rounds=rounds, **kwargs).collect()
    expected, digest = brute_codes(rows, parts, entries, rounds)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in found), key=repr) == expected
    assert {r.codebooks_sha256 for r in found} == ({digest} if expected else set())


def test_codes_as_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) if rng.random() < 0.8 else rng.choice([0.0, -0.001, 2.0]) for _ in range(12)], rng.choice([1, 2, None])) for i in range(300)]
    rows += [(1000 + i, rows[i % 5][1], 1) for i in range(40)]
    rows += [(2000, None, 1), (2001, [1.0, None] * 6, 1), (2002, [float("nan")] * 12, 1), (2003, [float("inf")] + [0.0] * 11, 2), (-5, [0.5] * 12, None)]
    check_codes(spark, rows)
    check_codes(spark, rows, parts=5, entries=16, rounds=1, pivots=2)


def test_codes_of_odd_vectors(spark):
    check_codes(spark, [])
    check_codes(spark, [(1, None, 1)])
    check_codes(spark, [(1, [], None), (2, [], None)])
    check_codes(spark, [(3, [1.0, 2.0], 1), (3, [1.0, 2.0], 1), (None, [4.0, 4.0, 4.0], 2), (9, [-1.5], 2)])
    check_codes(spark, [(i, [float(i % 3)] * 4, 0) for i in range(30)], entries=3)
    # Beyond 64 bits, some and all of them.
    check_codes(spark, [(i, [1e9 * i, -3e30 * (i % 4), 0.25, 7.0], i % 2) for i in range(20)], entries=3)
    check_codes(spark, [(i, [1.7e308, -1e200 * (i % 4), float(i), 1e17 * i], i % 2) for i in range(12)], entries=2)


def test_rows_without_id_are_coded(spark):
    rows = [(None, [float(i), 1.0], 1) for i in range(5)]
    found = codes.compressed(spark.createDataFrame(rows, VECTORS), parts=2, entries=4).collect()
    assert len(found) == 5 and {r.vec_id for r in found} == {None}


def test_pivots_spare_distances_and_change_nothing():
    rng = np.random.default_rng(3)
    centres = rng.integers(-500, 500, (64, 4))
    rows = centres[rng.integers(0, 64, 2000)] + rng.integers(-20, 20, (2000, 4))
    plain = codes.distances(rows, centres)
    pivots = np.array(codes.chosen_pivots(centres.tolist(), 4))
    known = codes.roots(codes.distances(rows, pivots)).astype("<f4")
    best, least, computed = codes.nearest(rows, centres, known, pivots)
    assert (best == plain.argmin(axis=1)).all() and (least == plain.min(axis=1)).all()
    assert computed < 0.2 * plain.size


def test_labels_joined_in_slices_when_they_are_many(spark, monkeypatch):
    rows = [(i, [float(i % 7), 1.0], i % 5 if i % 4 else None) for i in range(60)]
    monkeypatch.setattr(codes, "broadcast_if_small", lambda df: df)
    check_codes(spark, rows, parts=2, entries=4)


# Fill-in-the-middle

def brute_infill(doc_id, text, unit):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    starts = list(range(len(text))) if unit == "characters" else [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    n = len(starts)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in infill.MARKERS) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    at = lambda k: 0 if k == 0 else starts[k] if k < n else len(text)
    p, m, s = text[:at(a)], text[at(a):at(b)], text[at(b):]
    if h[3] % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", list(infill.UNITS))
def test_outputs_as_brute_force_and_restored(spark, rows, generated, unit):
    texts = ODD_TEXTS + ["has <P> inside", "<S>", "a<M", "<", "> <P", "   lead", "x" * 300_000 + "é" * 1000] + [t for _, t, _, _ in generated]
    docs = spark.createDataFrame([(i if i != 30 else None, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, FORM string, output string")
    made = infill.fill_in_middle(docs, unit=unit)
    expected = [brute_infill(i if i != 30 else None, t, unit) for i, t in enumerate(texts)]
    assert rows(made.drop("none")) == sorted(expected, key=repr)
    assert {f for _, _, f, *_ in expected} == {"plain", "psm", "spm"}
    back = made.select("doc_id", infill.restored(F.col("output"), F.col("form")).alias("text"))
    assert rows(back) == sorted(((i if i != 30 else None, t or "") for i, t in enumerate(texts)), key=repr)


def test_wavelet_matrix_counts_and_finds():
    rng = np.random.default_rng(1)
    classes = rng.integers(0, 8, 1000).astype(np.uint8)
    matrix = infill.WaveletMatrix(classes)
    at = np.arange(1001)
    for c in range(8):
        assert (matrix.rank(c, at) == np.append(0, np.cumsum(classes == c))).all()
    starts = np.flatnonzero((classes == 2) | (classes == 5))
    found = matrix.cut_after((2, 5), np.arange(len(starts) + 1), np.zeros(len(starts) + 1, np.int64), np.full(len(starts) + 1, 1000))
    assert found.tolist() == [0, *starts[1:].tolist(), 1000]


def test_markers_and_units_that_cannot_be_are_refused(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert infill.fill_in_middle(docs).collect() == []
    for markers in (("<P>", "<P>", "<M>"), ("<P", "P<", "M"), ("a", "b", ""), ("a", "b"), ("<P>", "[<P>]", "x")):
        with pytest.raises(ValueError):
            infill.fill_in_middle(docs, markers=markers)
    with pytest.raises(ValueError):
        infill.fill_in_middle(docs, unit="lines")
    other = spark.createDataFrame([(7, "some text here")], "doc_id long, text string")
    made = infill.fill_in_middle(other, markers=("(pre)", "[suf]", "{mid}"), cut_percent=100, suffix_first_percent=100)
    assert made.first().output.startswith("[suf]")
    assert made.select(infill.restored(F.col("output"), F.col("form"), ("(pre)", "[suf]", "{mid}"))).first()[0] == "some text here"
