from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tripmart.llm.top_k import CHUNK, LEAST, LISTS, Lists, top_k

SCHEMA = "vec_id long, embedding array<float>, score string, rank string"


def brute(rows, k, every):
    valid = [
        (i, r[0], [math.floor(1024 * x) for x in r[1]])
        for i, r in enumerate(rows)
        if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])
    ]
    out = []
    for i, q, a in valid:
        if q is None or q % every:
            continue
        scores = [(-sum(x * y for x, y in zip(a, b, strict=False)), c is None, c) for j, c, b in valid if j != i]
        best = sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        out += [(q, n, c, -s) for n, (s, _, c) in enumerate(best, 1)]
    return sorted(out, key=repr)


def single(x: float) -> float:
    return float(np.float32(x))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    draw = random.Random(seed)
    rows = [(i, [single(draw.gauss(0, 0.3)) for _ in range(7)], "", "") for i in range(300)]
    rows += [(i, [0.5] * 7, "", "") for i in (3, 100, 100, 400)]  # ties, repeated rows and queries
    rows += [(None, [0.9] * 7, "", ""), (None, [0.9] * 7, "", ""), (500, [0.25] * 3, "", ""), (600, [], "", "")]
    rows += [(700, None, "", ""), (701, [0.1, None], "", ""), (800, [float("nan")] * 7, "", ""), (5, [float("inf")], "", "")]
    got = [tuple(r) for r in top_k(spark.createDataFrame(rows, SCHEMA), every=20).collect()]
    assert sorted(got, key=repr) == brute(rows, 10, 20)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0], "", ""), (1, [-1.0, 0.5], "", "")]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert [tuple(r) for r in top_k(frame).collect()] == brute(rows, 10, 100)
    assert top_k(frame.limit(0)).count() == 0
    assert top_k(frame.limit(1)).count() == 0


def test_large_numbers_stay_whole(spark):
    rows = [(0, [1e30, 3.0], "", ""), (1, [-1e30, 2.0], "", ""), (2, [5e5, 3e6], "", "")]
    got = {r.vec_id: r.score for r in top_k(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1] == -(1 << 63) and got[2] == (1 << 63) - 1


def test_lists_are_opened_as_far_as_the_threshold_asks():
    draw = np.random.default_rng(5)
    length = np.where(np.arange(2000) % 50 == 0, 400, 20)[:, None]
    vectors = (draw.normal(size=(2000, 32)) * length).astype(np.int64)
    queries, k = vectors[::40], 10
    usable = np.ones((len(queries), len(vectors)), bool)
    scores = queries @ vectors.T
    lists = Lists(vectors)
    cutoffs = [int(whole.min()) for _, whole in lists.heads(queries, usable, k)]
    kth = np.sort(scores, axis=1)[:, -k]
    assert (cutoffs <= kth).all()
    assert lists.opened == LISTS * CHUNK * len(queries)
    for i, (some, whole) in enumerate(lists.reaching(queries, usable, cutoffs)):
        assert some.tolist() == np.flatnonzero(scores[i] >= cutoffs[i]).tolist()
        assert whole.tolist() == scores[i, some].tolist()
    computed = lists.opened + LISTS * lists.resolved
    assert computed < 0.6 * LISTS * scores.size  # brute force computes every part of every score


def test_without_a_cutoff_every_vector_is_resolved():
    vectors = np.array([[1, 2, 3, 4], [-9, 0, 0, 0], [0, 0, 0, 0]], np.int64)
    (some, whole), = Lists(vectors).reaching(vectors[:1], np.array([[False, True, True]]), [LEAST])
    assert some.tolist() == [1, 2] and whole.tolist() == [-9, 0]


def test_blocks_are_dealt_over_many_tasks(spark, conf):
    conf("spark.sql.shuffle.partitions", 16)
    draw = random.Random(3)
    rows = [(i, [draw.gauss(0, 1) for _ in range(4)], "", "") for i in range(9000)]
    frame = top_k(spark.createDataFrame(rows, SCHEMA).repartition(8), every=1000)
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert text.count("REPARTITION_BY_NUM") >= 2
    assert frame.count() == 90
