"""Exact searches against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from test_documents import AWKWARD, documents, prose

from gustline.llm import exact_search, ranked_search
from gustline.llm.text import WordHashes


def brute_top(rows, most, is_query=lambda i: i % 20 == 0):
    """(query row, rank) -> (id, score) over all other rows; nulls last among equals."""
    used = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    lists = []
    for at, (i, q) in enumerate(used):
        if i is not None and is_query(i):
            scored = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0, k) for k, (j, v) in enumerate(used) if k != at]
            lists += [(i, rank, None if missing else j, -score) for rank, (score, missing, j, _) in enumerate(sorted(scored)[:most], 1)]
    return sorted(lists, key=str)


def vectors(spark, rows, inner="float"):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], f"vec_id long, embedding array<{inner}>, row long, v int, score int")


def listed(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.mark.parametrize("most", [1, 3, 20])
def test_top_products_agree_with_brute_force(spark, most, monkeypatch):
    rnd = random.Random(most)
    rows = [(i, [rnd.choice([-0.5, -0.25, 0.0, 0.3, 0.9]) for _ in range(6)]) for i in range(150)]
    rows += [(i, [0.5] * 6) for i in range(150, 220)]  # a group of copies, so a group of ties
    monkeypatch.setattr(exact_search, "CELL", 200)
    monkeypatch.setattr(exact_search, "QUERY_CELL", 30)
    monkeypatch.setattr(exact_search, "TILE", 1024)
    assert listed(exact_search.top_products(vectors(spark, rows), most=most)) == brute_top(rows, most)


def test_top_products_of_awkward_rows(spark):
    rows = [
        (0, [0.1, 0.2]), (0, [0.1, 0.2]), (0, [0.9]), (20, []), (40, None), (60, [float("nan"), 1.0]), (80, [float("inf")]), (100, [None, 1.0]),
        (None, [0.5, 0.5]), (None, [0.5, 0.5]), (-20, [-0.3, 0.4, 0.5]), (7, [0.5, 0.5]), (9, [1000.0, -1000.0]),
    ]
    for most in (1, 4, 20):
        assert listed(exact_search.top_products(vectors(spark, rows), most=most)) == brute_top(rows, most)
    assert listed(exact_search.top_products(vectors(spark, rows), is_query=exact_search.F.col("id") == 7, most=2)) == brute_top(rows, 2, lambda i: i == 7)


def test_top_products_of_few_and_of_large(spark):
    assert listed(exact_search.top_products(vectors(spark, []))) == []
    assert listed(exact_search.top_products(vectors(spark, [(20, [1.0])]))) == []
    rows = [(i, [2.0**22 + i, -(2.0**18) * i, 1.0]) for i in range(0, 60, 5)]
    assert listed(exact_search.top_products(vectors(spark, rows, "double"))) == brute_top(rows, 20)
    with pytest.raises(ValueError):
        exact_search.top_products(vectors(spark, [(20, [1e12]), (1, [1e12])], "double"))


TERM = re.compile("[^\\x00-\\x2f\\x3a-\\x40\\x5b-\\x60\\x7b-\\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_ranks(docs, items, most):
    docs = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in docs:
            m = 100 - 50 + (50 * c.total() * n_docs) // n_terms if docs else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank, None if missing else i, -score) for rank, (score, missing, i) in enumerate(sorted(scored)[:most], 1)]
    return sorted(out, key=str)


ITEMS = [(1, prose(12, 1)), (2, prose(30, 5).upper()), (3, None), (4, "--"), (5, "Zü 中文 nowhere"), (None, prose(3, 8)), (1, prose(12, 1)), (6, " ".join({prose(1, k) for k in range(900)}))]


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, doc_id long, n long")


@pytest.mark.parametrize("most, item_bytes, items_at_once", [(50, 10**6, 256), (3, 10**6, 2), (5, 40, 1)])
def test_ranks_agree_with_brute_force(spark, most, item_bytes, items_at_once, monkeypatch):
    monkeypatch.setattr(ranked_search, "BATCH_ITEMS", items_at_once)
    monkeypatch.setattr(ranked_search, "TILE", 2000)
    docs = [(k, prose(random.Random(k).choice([1, 5, 40, 300]), k)) for k in range(300)] + [(1000 + k, prose(40, 3)) for k in range(80)]
    found = ranked_search.search(documents(spark, [(i, t, "a") for i, t in docs]), benchmark(spark, ITEMS), most, item_bytes=item_bytes)
    assert listed(found) == brute_ranks(docs, ITEMS, most)


def test_ranks_of_awkward_rows(spark):
    awkward, nothing = documents(spark, AWKWARD), documents(spark, [])
    found = ranked_search.search(awkward, benchmark(spark, ITEMS), 4)
    assert listed(found) == brute_ranks([(i, t) for i, t, _ in AWKWARD], ITEMS, 4)
    assert listed(ranked_search.search(nothing, benchmark(spark, ITEMS))) == []
    assert listed(ranked_search.search(awkward, benchmark(spark, []))) == []


def test_bounds_hold_and_spare_exact_scores():
    known, rows = WordHashes(), []
    for k in range(600):
        tally = Counter(prose(30, k).split())
        hashes = sorted((known[w.encode()], c) for w, c in tally.items())
        rows.append((k, tally.total(), np.array([h for h, _ in hashes], np.uint64).tobytes(), np.array([c for _, c in hashes], np.int32).tobytes()))
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["id", "n", "terms", "counts"])
    block = ranked_search.Block(batch, 600, 18000)
    hashes = np.unique(np.array([known[w.encode()] for w in prose(8, 77).split()], np.uint64))
    item = (0, hashes, np.arange(1000, 1000 + len(hashes)))
    for docs, bounds in block.tiles(ranked_search.Lookup([item])):
        assert (bounds[0] >= block.exact(docs, *item[1:])).all()
    best = {}
    rescored = ranked_search.rescore(block, ranked_search.Lookup([item]), best, 5)
    exact = block.exact(np.arange(600), *item[1:])
    assert best[0].rows[0].tolist() == sorted(exact.tolist(), reverse=True)[:5] and rescored < 300
