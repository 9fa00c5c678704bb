"""Exact top-k against all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import topk
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<double>, label int"
EVERY = lambda: F.col("vec_id") % 3 == 0


def brute(rows, is_query, k) -> dict[int, list[tuple[int, int]]]:
    """{query: [(vec_id, score)]}; the least vector of an id and length counts."""
    whole = {}
    for vec_id, v in rows:
        if vec_id is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(1024 * x) for x in v]
        key = vec_id, len(v)
        whole[key] = min(v, whole.get(key, v))
    out = {}
    for (q, n), v in whole.items():
        if is_query(q):
            found = [(c, sum(a * b for a, b in zip(v, w))) for (c, m), w in whole.items() if c != q and m == n]
            out.setdefault(q, []).extend((c, max(-topk.MOST, min(topk.MOST, s))) for c, s in found)
    return {q: sorted(f, key=lambda x: (-x[1], x[0]))[:k] for q, f in out.items() if f}


def result(df) -> dict[int, list[tuple[int, int]]]:
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    df = QUERIES["op12_topk"](spark, SMALL)
    assert dict(df.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    assert result(df) == brute(rows, lambda i: i % 100 == 0, 10)


@pytest.mark.parametrize("seed", range(3))
def test_many_blocks_and_ties(spark, seed, monkeypatch):
    """Small blocks; few values, so that many scores are equal; many equal vectors."""
    monkeypatch.setattr(topk, "BLOCK", 16)
    r = random.Random(seed)
    same = [r.choice([-1.0, 0.5, 1.0]) for _ in range(6)]
    rows = [
        (i, same if r.random() < 0.3 else [r.choice([-1.0, 0.0, 0.001, 0.5, 1.0]) for _ in range(6)])
        for i in r.sample(range(-500, 500), 150)
    ]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert result(topk.top_k(df, EVERY(), 5)) == brute(rows, lambda i: i % 3 == 0, 5)


@pytest.mark.parametrize("scale", [2.0**14, 2.0**19, 2.0**40, 2.0**200])
def test_large_components(spark, scale):
    """Sums beyond 2**53, and beyond a long."""
    r = random.Random(7)
    rows = [(i, [r.uniform(-scale, scale) for _ in range(5)]) for i in range(60)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert result(topk.top_k(df, EVERY(), 7)) == brute(rows, lambda i: i % 3 == 0, 7)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [0.5, 9.0]), (3, None), (6, [1.0, None]), (9, [nan, 1.0]),
        (12, [inf, 1.0]), (None, [1.0, 1.0]), (15, []), (18, []), (21, [1.0]), (24, [0.0, 0.0]),
        (25, [0.9999, -0.0001]), (26, [3.0, 3.0]), (26, [1.0, 5.0]), (27, [1.0, 2.0, 3.0]),
    ]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).selectExpr("*", "1 AS score", "2 AS query_id")
    got = result(topk.top_k(df, EVERY(), 10))
    assert got == brute(rows, lambda i: i % 3 == 0, 10)
    assert got[15] == [(18, 0)] and 21 not in got and len(got[0]) == 3
    assert topk.top_k(df.limit(0), EVERY(), 10).count() == 0
    assert topk.top_k(df, F.lit(False), 10).count() == 0


def test_threshold_keeps_what_it_must():
    """Phases two and three on one block: nothing that reaches the cutoff goes."""
    r = np.random.default_rng(1)
    for _ in range(50):
        vectors = np.floor(r.normal(0, 300, (80, 9)))
        block = topk.Block(np.arange(80), vectors)
        query = vectors[:3]
        scores = query @ vectors.T
        for i, (own, at, total) in enumerate(
            topk._other_phases(block, query, np.arange(3), np.array([int(np.sort(s)[-12]) for s in scores], object), 10)
        ):
            order = [j for j in np.lexsort((np.arange(80), -scores[i])) if j != i and scores[i][j] >= np.sort(scores[i])[-12]]
            assert at.tolist() == order[:10] and (total[at] == scores[i][at]).all()
