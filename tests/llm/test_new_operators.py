"""Lexical search, decontamination and vector codes: against plain Python, on odd rows, and under other plans."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from voxmill.llm import decontamination, lexical_search, vector_codes
from voxmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = [
    (1, "The cat sat on the mat, the CAT!"), (2, None), (3, ""), (4, " \n.,;"), (5, "cat"), (5, "cat"), (6, "Ünï cödé 漢字 cat\x00sat"), (None, "the cat sat on the mat"),
    (7, "dog " * 3000 + "cat sat on a mat"), (8, "the cat sat on the mat and then it slept all day long in the sun"), (9, "x" * 9000 + " the cat"), (10, "catsat mat-on"), (11, "KKelvin İ é"),
]
ITEMS = [(1, "cat sat"), (1, "mat"), (2, None), (3, " .. "), (None, "the cat sat on"), (4, "the"), (5, "it slept all day long in the sun the end of it"), (6, "漢字 cat sat"), (7, "unknown words only"), (8, "cat cat cat")]


def frames(spark, docs=DOCS, items=ITEMS):
    """With columns whose names clash, in another case too, or hold dots."""
    docs = spark.createDataFrame([(*r, "x", "y", "z", 1) for r in docs], "doc_id long, text string, TEXT string, item_id string, `a.b` string, n int").repartition(3)
    items = spark.createDataFrame([(*r, "x", "y", "z") for r in items], "item_id long, text string, Item_ID string, doc_id string, `c.d` string")
    return docs, items


def test_search_as_in_plain_python(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = [(r.item_id, r["rank"], r.doc_id, r.score) for r in QUERIES["op11_lexical_search"](spark, SF).collect()]
    assert sorted(got) == sorted(plain.ranked(docs, items, 50))


@pytest.mark.parametrize("plan", [{}, {"k": 2}, {"group_bytes": 8}])
def test_search_of_odd_rows(spark, plan):
    got = [(r.item_id, r["rank"], r.doc_id, r.score) for r in lexical_search.search(*frames(spark), **plan).collect()]
    assert sorted(got, key=str) == sorted(plain.ranked(DOCS, ITEMS, plan.get("k", 50)), key=str)


def test_search_in_pieces(monkeypatch):
    scanner = lexical_search.Terms(["cat", "sat", "the"])
    texts = [(t or "").encode() for _, t in DOCS]
    whole = scanner.counts(texts)
    monkeypatch.setattr(lexical_search, "SCAN", 7)
    for a, b in zip(whole, scanner.counts(texts), strict=True):
        assert a.tolist() == b.tolist()
    assert whole[0].tolist() == [len(plain.pieces(t)) for _, t in DOCS]


def test_search_in_empty_tables(spark):
    docs, items = frames(spark)
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0))):
        found = lexical_search.search(d, i)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.collect() == []


def test_many_equal_scores(spark):
    docs = [(i, "same words") for i in range(3000, 0, -1)]
    got = lexical_search.search(*frames(spark, docs, [(1, "words"), (2, "other")]), k=50).collect()
    assert [(r.item_id, r["rank"], r.doc_id) for r in sorted(got, key=lambda r: r["rank"])] == []  # held by all: weight of ln(1.0) is 0
    got = lexical_search.search(*frames(spark, [*docs, *((i, "else") for i in range(5000, 9000))], [(1, "words")]), k=50).collect()
    assert sorted((r["rank"], r.doc_id) for r in got) == [(i, i) for i in range(1, 51)]


def found_passages(df):
    return sorted(((r.doc_id, r.n_words, [(s["first"], s.end) for s in r.spans], set(r["items"])) for r in df.collect()), key=str)


def test_passages_as_in_plain_python(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = defaultdict(set)
    for i, t in items:
        ws = plain.pieces(t)
        for o in range(max(1, len(ws) - 9)):
            windows[tuple(ws[o : o + 10])].add(i)
    want = {}
    for d, t in docs:
        ws, hit, held = plain.pieces(t), set(), set()
        for size in {len(w) for w in windows if w}:
            for o in range(len(ws) - size + 1):
                if (some := windows.get(tuple(ws[o : o + size]))) is not None:
                    hit.update(range(o, o + size))
                    held |= some
        ids = ",".join(sorted(map(str, held)))
        want[d] = (len(ws), len(hit), len(held), hashlib.sha256(ids.encode()).hexdigest(), bool(hit))
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in QUERIES["op12_decontamination"](spark, SF).collect()}
    assert got == want and any(w[1] for w in want.values())


@pytest.mark.parametrize("plan", [{}, {"window": 4}, {"window": 4, "shingle": 1}, {"window": 6, "shingle": 2, "least": 60}, {"window": 4, "group_bytes": 20}, {"window": 5, "shingle": 2, "least": 50, "group_bytes": 20}])
def test_passages_of_odd_rows(spark, plan):
    options = {k: v for k, v in plan.items() if k != "group_bytes"}
    got = found_passages(decontamination.find_passages(*frames(spark), **plan))
    assert got == sorted(plain.passages(DOCS, ITEMS, **options), key=str)


def test_passages_in_empty_tables(spark):
    docs, items = frames(spark)
    assert decontamination.find_passages(docs.limit(0), items).collect() == []
    for r in decontamination.contamination(decontamination.find_passages(docs, items.limit(0))).collect():
        assert (r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (0, 0, hashlib.sha256(b"").hexdigest(), False)


def test_only_rare_shingles_are_joined():
    windows = decontamination.cut_windows([(0, "of the dog and of the cat".split())], 7, 2)
    keys = np.unique(windows.shingles(2)[2])
    times = np.full(len(keys), 100)
    rare = decontamination.grams(windows.word, 2)[2]  # "dog and"
    times[np.searchsorted(keys, rare)] = 1
    key, window, place = decontamination.prefixes(windows, 2, {2: (keys, times)}, 100)
    assert (key.tolist(), window.tolist(), place.tolist()) == ([rare], [0], [2])
    assert len(decontamination.prefixes(windows, 2, {2: (keys, times)}, 50)[0]) == 4  # 6 shingles, 3 needed


def test_codes_as_in_plain_python(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, books = plain.coded([(i, v) for i, v, _ in rows], 4, 256, 4)
    by_label = defaultdict(int)
    for i, _, label in rows:
        by_label[label] += want[i][1]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    got = {r.vec_id: (r.code, r.error, r.label_error, r.codebooks_sha256) for r in QUERIES["op13_vector_codes"](spark, SF).collect()}
    assert got == {i: (*want[i], by_label[label], digest) for i, _, label in rows}


@pytest.mark.parametrize("seed", range(6))
def test_trees_find_the_nearest(seed):
    rng = np.random.default_rng(seed)
    kinds = [rng.integers(-5, 5, (700, 3)), rng.integers(-900, 900, (37, 8)), np.repeat(rng.integers(-9, 9, (9, 4)), 50, axis=0) * 100 + rng.integers(0, 3, (450, 4)), rng.integers(-(2**24) + 1, 2**24, (300, 16)), np.zeros((65, 2), int), rng.integers(0, 2, (1, 1))]
    points = kinds[seed].astype(np.int64)
    book = points[rng.integers(0, len(points), int(rng.integers(1, 60)))]
    data, entries = vector_codes.unpack(vector_codes.pack(vector_codes.grow(points, vector_codes.LEAF)), len(points)), vector_codes.grow(book, 1)
    want = ((points[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)  # first of equals
    got = np.zeros(len(points), int)
    got[data.order] = vector_codes.owners(data, entries)
    assert got.tolist() == want.tolist()
    count, total = vector_codes.sums(data, entries)
    assert count.tolist() == np.bincount(want, minlength=len(book)).tolist()
    assert total.tolist() == [points[want == e].sum(axis=0).tolist() for e in range(len(book))]


def test_whole_nodes_are_assigned_by_their_sums():
    rng = np.random.default_rng(1)
    centres = rng.integers(-90_000, 90_000, (16, 8))
    points = np.repeat(centres, 256, axis=0) + rng.integers(-9, 9, (4096, 8))
    whole, left, _ = vector_codes.assign(vector_codes.grow(points, 32), vector_codes.grow(centres, 1))
    assert not len(left) and sum(len(n) for _, n, _ in whole) <= 64


def test_codes_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [i * 0.25, -i * 0.1, float(i % 3), 0.001 * i], i % 2) for i in range(1, 300)] + [(3, [9.0, 9.0, 9.0, 9.0], None), (None, [0.5, 0.5, -0.0, 0.0], None), (500, [1.0, 1.0, 1.0, 1.0], None), (500, [1.0, 1.0, 1.0, 1.0], None)]
    odd = [(600, None, 1), (601, [], 1), (602, [1.0, None, 1.0, 1.0], 1), (603, [nan, 1.0, 1.0, 1.0], 1), (604, [inf, 1.0, 1.0, 1.0], 0), (0, [1.0], 0), (-1, [1.0] * 8, 0), (605, [1e30, 0.0, 0.0, 0.0], 1)]
    vectors = spark.createDataFrame([(*r, "x", "y") for r in good + odd], "vec_id long, embedding array<double>, label int, code string, Label string").repartition(3)
    # Repeated and null ids: the first entries go by id, then components, null last.
    order = sorted(range(len(good)), key=lambda k: (good[k][0] is None, good[k][0] or 0, good[k][1]))
    want, books = plain.coded([(n, good[k][1]) for n, k in enumerate(order)], 4, 256, 4)
    coded, got_books = vector_codes.compress(vectors)
    assert got_books.tolist() == books
    got = vector_codes.with_label_errors(coded).collect()
    assert sorted((str(r.vec_id), r.code, r.error) for r in got) == sorted((str(good[k][0]), *want[n]) for n, k in enumerate(order))
    by_label = defaultdict(int)
    for n, k in enumerate(order):
        by_label[good[k][2]] += want[n][1]
    assert {(r.label, r.label_error) for r in got} == set(by_label.items())


def test_codes_of_few_and_no_vectors(spark):
    vectors = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [-3.5, 0.25], 1)], "vec_id long, embedding array<float>, label long")
    coded, books = vector_codes.compress(vectors, parts=2)
    assert sorted(coded.select("vec_id", "code", "error").collect()) == [(1, "0000", 0), (2, "0101", 0)] and books.shape == (2, 2, 1)
    coded, books = vector_codes.compress(vectors.limit(0))
    assert vector_codes.with_label_errors(coded).collect() == [] and vector_codes.codebooks_digest(books) == hashlib.sha256(b"").hexdigest()


def test_labels_beyond_the_broadcast(spark):
    coded = spark.range(9000).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("label"), F.lit("00").alias("code"), F.col("id").alias("error"))
    got = vector_codes.with_label_errors(coded).collect()
    assert len(got) == 9000 and all(r.label_error == (r.label if r.label is not None else sum(range(0, 9000, 3))) for r in got)
