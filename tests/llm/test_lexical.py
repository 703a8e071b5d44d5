from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import AWKWARD, documents, invented
from tripmart.llm import lexical as lx


def terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(rows, items, k=20):
    docs = [(r[0], Counter(terms(r[1]))) for r in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n, total = len(docs), sum(d[2] for d in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, length in docs:
            m = 75 + 25 * length * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in terms(text) if c[t]
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("segment", [4096, 7])
def test_ranks_equal_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(lx, "SEGMENT", segment)
    monkeypatch.setattr(lx, "QUERIES_AT_ONCE", 5)
    rows = invented(120, 6)
    draw = random.Random(7)
    items = [(i, " ".join(draw.choice(rows)[1].split()[:12])) for i in range(12)] + [(12, None), (13, "zzzz"), (14, "A a a")]
    frame = spark.createDataFrame([(*i, "x") for i in items], "item_id int, text string, query string")
    got = sorted((tuple(r) for r in lx.search(documents(spark, rows), frame.unionAll(frame.limit(3)), k=9).collect()), key=repr)
    assert got == brute(rows, items, 9)


def test_awkward_rows(spark):
    docs = documents(spark)
    items = [(1, "the MIT license of nobody"), (2, "one two w5 word"), (3, "")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert sorted((tuple(r) for r in lx.search(docs, frame).collect()), key=repr) == brute(AWKWARD, items)
    assert lx.search(docs.limit(0), frame).count() == 0
    assert lx.search(docs, frame.limit(0)).count() == 0
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert {r.doc_id for r in lx.search(named, frame).collect()} >= {"d4", "d7", None}


def test_bounds_of_pairs_skip_more_than_those_of_terms():
    draw = np.random.default_rng(5)
    size, n_terms = 400, 12
    postings = [np.flatnonzero(draw.random(size) < p) for p in np.linspace(0.02, 0.3, n_terms)]
    df = np.array([len(p) for p in postings])
    lists = (
        draw.integers(20, 400, size), np.arange(n_terms), df, np.concatenate([[0], np.cumsum(df)[:-1]]),
        np.concatenate(postings), draw.integers(1, 6, df.sum()),
    )
    weight = np.sort(draw.integers(100, 5000, n_terms))
    segment = lx.Segment(*lists, n=size, total=int(lists[0].sum()), weight=weight)
    pairs = [(i, i + 1) for i in range(0, n_terms, 2)]
    joint = {}
    for i, (a, b) in enumerate(pairs):
        both, most = segment.joint(a, b)
        joint[i] = (most, both if len(both) <= 5 else None)
    query = lx.Query(tuple(range(n_terms)), (1,) * 10 + (2, 1), tuple((i, 2 * i, 2 * i + 1) for i in range(len(pairs))))
    scores = np.zeros(size, np.int64)
    for t, c in zip(query.terms, query.times, strict=True):
        at, impact = segment.lists[t]
        scores[at] += c * impact
    cutoff = int(np.sort(scores)[-5])
    work = {}
    for name, given in (("pairs", joint), ("terms", None)):
        work[name] = Counter()
        docs, found = segment.best(query, cutoff, 5, given, work[name])
        assert dict(zip(docs.tolist(), found.tolist(), strict=True)) == {
            int(i): int(scores[i]) for i in np.flatnonzero(scores >= cutoff)
        }
    assert sum(work["pairs"].values()) < sum(work["terms"].values())
    assert work["pairs"]["scored"] < (scores > 0).sum()
    assert all(b >= scores.max() for b in [sum(g[0] for g in segment.bounds(query, joint))])
