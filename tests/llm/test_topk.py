"""Exact top-k search against all scores."""

import numpy as np
import pytest

from covisit_spark.llm import topk
from covisit_spark.session import get_spark


@pytest.fixture(scope="module")
def spark():
    return get_spark(master="local[4]", shuffle_partitions=4)


def brute(rows, k=10, every=100):
    least = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        w = [int(np.floor(1024.0 * x)) for x in v]
        least[i] = min(least.get(i, w), w)
    out = []
    for q, a in least.items():
        if q % every:
            continue
        scores = ((min(max(sum(x * y for x, y in zip(a, b)), -(2**63)), 2**63 - 1), i) for i, b in least.items() if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted((-s, i) for s, i in scores)[:k])]
    return sorted(out)


def check(spark, rows, **settings):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df, **settings).collect())
    assert got == brute(rows, settings.get("k", 10), settings.get("every", 100))
    return got


def test_random_clustered_and_repeated_vectors(spark):
    r = np.random.default_rng(0)
    centres = r.normal(size=(8, 24))
    rows = [(i, (centres[i % 8] + 0.2 * r.normal(size=24)).tolist()) for i in range(1500)]
    rows += [(3000 + i, rows[5][1]) for i in range(30)] + rows[:20]
    assert len(check(spark, rows)) == 150 + 10


def test_nulls_odd_lengths_and_few_candidates(spark):
    rows = [(0, [1.0, 2.0]), (100, [0.5]), (1, None), (2, [float("nan"), 1.0]), (3, [None, 1.0]), (None, [1.0, 1.0]), (200, []), (4, [-1.0, -0.5, 3.0]),
            (4, [-2.0, 0.1]), (5, [float("inf")]), (-100, [0.25, 0.25])]
    assert len(check(spark, rows)) == 4 * 4


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 1.0] if i % 2 else [0.0, 0.0]) for i in range(400)]
    got = check(spark, rows)
    assert [x[2] for x in got if x[0] == 0] == list(range(1, 11))


def test_values_beyond_exact_doubles(spark):
    check(spark, [(0, [1e9, -3e8]), (1, [2e9 + 0.5, 1.0]), (2, [-2e9, 5e8]), (3, [1e15, 1e15]), (100, [1e14, 1e15])])


def test_empty(spark):
    assert check(spark, []) == []


def test_reading_stops_before_the_lists_end():
    r = np.random.default_rng(1)
    vectors = r.integers(-10, 10, (4096, 16))
    vectors[:40] = 1000
    block = topk.Block(np.arange(4096), vectors)
    read = []
    bincount = np.bincount

    def counted(x, *rest):
        read.append(len(x))
        return bincount(x, *rest)

    topk.np.bincount = counted
    try:
        best = topk.search(block, vectors[0], 0, [], 10)
    finally:
        topk.np.bincount = bincount
    assert best == [(-16 * 10**6, i) for i in range(1, 11)]
    assert max(read) < 4096 * 16 / 8
