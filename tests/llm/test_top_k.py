"""Top-k search against all inner products."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferryline.llm import top_k
from ferryline.llm.ball_tree import BallTree

SCHEMA = "vec_id long, embedding array<float>, uid string, shard int, score string"


def plain(rows, k):
    """All (query_id, rank, vec_id, score) by trying every pair."""
    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(1024 * float(np.float32(x))) for x in v]

    vectors = [(i, whole(v)) for i, v in rows if i is not None]
    vectors = [(i, v) for i, v in vectors if v is not None]
    out = []
    for n, (query, q) in enumerate(vectors):
        if query % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), i) for m, (i, v) in enumerate(vectors)
                            if m != n and len(v) == len(q))
            out += [(query, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def searched(spark, rows, k=10, **settings_):
    df = spark.createDataFrame([(i, v, "u", 1, "s") for i, v in rows], SCHEMA)
    got = top_k.top_k(df, F.col("vec_id") % 100 == 0, k, **settings_)
    return sorted(tuple(r) for r in got.collect())


def made(n, dim, seed):
    draw = random.Random(seed)
    centers = [[draw.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    return [(i, [c + draw.gauss(0, 0.2) for c in draw.choice(centers)]) for i in range(n)]


@pytest.mark.parametrize("shard_rows", [40, 5_000])
def test_search(spark, shard_rows):
    rows = made(700, 6, 1)
    same = [0.5, 0.25, -1.0, 0.0, 2.0, 1.5]
    rows += [(i, same) for i in range(1_000, 1_300)]  # a third are one vector: ties go to smaller ids
    rows += [(100, same), (100, [0.0] * 6), (200, rows[200][1])]
    assert searched(spark, rows, shard_rows=shard_rows) == plain(rows, 10)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (None, [9.0, 9.0]),
            (5, [1.0, 2.0]), (6, [1.0]), (7, []), (100, []), (200, [3.0]), (300, None), (400, [1.0, 2.0, 3.0]),
            (-100, [-1.0, 0.0001])]
    assert searched(spark, rows) == plain(rows, 10)
    assert [r for r in searched(spark, rows) if r[0] == 400] == []
    assert searched(spark, []) == [] and searched(spark, [(1, [1.0]), (3, [2.0])]) == []


def test_scores_beyond_floating_point(spark):
    rows = [(i, [300_000.0 + i, -2.0 * i, 123_457.0]) for i in range(60)] + [(100, [299_999.0, 1.0, 70_001.0])]
    assert searched(spark, rows, k=7, shard_rows=8) == plain(rows, 7)
    with pytest.raises(Exception, match="64 bits"):
        searched(spark, [(0, [3e38, 1.0]), (1, [1.0, 1.0])])


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 300), st.integers(1, 5), st.integers(1, 12))
def test_tree(seed, n, dim, k):
    draw = np.random.default_rng(seed)
    vectors = draw.integers(-5, 6, (n, dim))
    ids, rows = draw.integers(0, 50, n), np.arange(n)
    queries = draw.integers(-5, 6, (4, dim))
    least = np.full(4, -(2**63)), np.full(4, 2**63 - 1)
    tree = BallTree(vectors, ids, rows, leaf=3)
    asked, score, found = tree.search(queries, np.array([0, 1, -1, -1]), k, *least)
    for q in range(4):
        all_ = sorted((-int(queries[q] @ vectors[i]), int(ids[i])) for i in range(n) if not (q < 2 and i == q))
        assert [(-int(s), int(i)) for s, i in zip(score[asked == q], found[asked == q])] == all_[:k]
        if len(all_) > 3:  # a kth score from elsewhere leaves out what comes after it
            kth, kth_id = np.full(4, -all_[2][0]), np.full(4, all_[2][1])
            a, s, f = tree.search(queries, np.array([0, 1, -1, -1]), k, kth, kth_id)
            assert [(-int(x), int(i)) for x, i in zip(s[a == q], f[a == q])] == [
                x for x in all_ if x < all_[2]][:k]
