import math
import random

import numpy as np
import pytest

from bankspark.llm import topk


def brute(rows, queries, k=10):
    clean = {}
    for i, (vid, x) in enumerate(rows):
        if vid is None or x is None or any(e is None or not math.isfinite(e) for e in x):
            continue
        clean[i] = (vid, [math.floor(1024 * np.float64(np.float32(e))) for e in x])
    out = []
    for q in sorted(set(queries)):
        own = [x for v, x in clean.values() if v == q]
        if not own:
            continue
        scored = sorted((-sum(a * b for a, b in zip(own[0], x)), v) for v, x in clean.values() if v != q)[:k]
        out += [(q, r, v, -s) for r, (s, v) in enumerate(scored, 1)]
    return out


def rows_of(n, dim=8, seed=1):
    rnd = random.Random(seed)
    rows = [(i, [rnd.gauss(i % 4, 1) for _ in range(dim)]) for i in range(n)]
    rows += [(n + i, [0.5] * dim) for i in range(n // 3)]  # one hot vector, many ties
    return rows + [(900001, None), (900002, [None] + [0.0] * (dim - 1)), (900003, [float("nan")] * dim), (900100, [float("inf")] + [0.0] * (dim - 1)),
                   (None, [1.0] * dim), (900200, []), (900300, [1.0]), (900301, [0.0] * dim)]


def search(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string")
    out = topk.top_k(df, df.filter("vec_id % 100 = 0"), **kw)
    return sorted(tuple(r) for r in out.select("query_id", "rank", "id", "score").collect())


@pytest.mark.parametrize("n, block", [(700, 2048), (700, 40), (3, 2048)])
def test_equals_brute_force(spark, monkeypatch, n, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk.build_index, "__defaults__", (topk.PIVOTS, topk.ANNULI, block))
    rows = rows_of(n)
    got = search(spark, [(*r, 1, "s") for r in rows])
    assert got == sorted(brute(rows, [v for v, _ in rows if v is not None and v % 100 == 0]))


def test_numbers_beyond_doubles_stay_exact(spark):
    rows = [(0, [2.0**19, 1.0]), (1, [2.0**20, 1.0]), (2, [2.0**20, 2.0]), (3, [2.0**20, 3.0])]
    got = search(spark, [(*r, 1, "s") for r in rows])
    assert got == sorted(brute(rows, [0]))


def test_empty_and_repeated(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (5, [1.0, 1.0]), (5, [1.0, 1.0])]
    assert search(spark, [(*r, 1, "s") for r in rows]) == [(0, 1, 5, 2**20), (0, 2, 5, 2**20)]
    assert search(spark, []) == []


def test_queries_that_are_not_indexed_are_answered(spark):
    rows = [(i, [float(i % 7), float(i % 5), 1.0]) for i in range(1, 60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = [(1, rows[0][1]), (1000, [0.5, -2.0, 1.0]), (2000, [1.0, 1.0, 1.0, 9.0]), (3000, [1.0])]
    got = topk.top_k(df, spark.createDataFrame(asked, "vec_id long, embedding array<float>"), k=4)
    found = sorted(tuple(r) for r in got.select("query_id", "rank", "id", "score").collect())
    want = []
    for q, x in asked:
        scored = sorted((-sum(math.floor(1024 * a) * math.floor(1024 * b) for a, b in zip(x, v)), i) for i, v in rows if i != q)[:4]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    assert found == want


def test_large_finite_components_take_part(spark):
    rows = [(0, [1e17, 1.0]), (1, [1.0, 1.0]), (2, [-1e17, 1.0]), (3, [1e300, 0.0]), (4, [0.0, 2.0]), (5, [float("inf"), 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, df.filter("vec_id in (0, 4, 5)"))
    found = {(r.query_id, r.rank): (r.id, r.score) for r in got.collect()}
    assert found[0, 1] == (1, 2**63 - 1) and found[0, 2] == (3, 2**63 - 1)
    assert {found[0, r][0] for r in (1, 2, 3, 4)} == {1, 2, 3, 4} and found[0, 4] == (2, 1 - 2**63)
    assert found[4, 1] == (0, 2048 * 1024) and found[4, 4] == (3, 0) and len(found) == 8
