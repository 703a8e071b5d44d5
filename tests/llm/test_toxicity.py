from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import AWKWARD, documents
from tripmart.llm import toxicity as tx
from tripmart.llm.lexical import terms_of


def test_index_equals_all_cosines():
    draw = np.random.default_rng(1)
    for n in (1, 63, 64, 65, 300):
        vectors = draw.random((n, 12)) * (draw.random((n, 12)) < [0.3] * 6 + [0.04] * 6)
        vectors[: n // 2] = np.round(vectors[: n // 2])  # ties
        index = tx.BlockMaxIndex.of(*np.nonzero(vectors), vectors[np.nonzero(vectors)], n, 12)
        for without in (-1, 0):
            for _ in range(20):
                words = np.sort(draw.choice(12, 4, replace=False))
                weights = draw.random(4)
                cosines = vectors[:, words] @ weights
                want = sorted(((-c, i) for i, c in enumerate(cosines) if c > 0 and i != without))[:10]
                ids, near = index.nearest(words, weights, 10, without)
                assert np.allclose(near, [-c for c, _ in want], atol=1e-6)
                assert np.allclose(cosines[ids], near, atol=1e-6) and without not in ids


def test_blocks_stay_shut_where_they_cannot_reach():
    draw = np.random.default_rng(2)
    vectors = np.zeros((640, 200))
    for i in range(640):  # every block has words of its own
        vectors[i, i // 64 * 20 + draw.choice(20, 5, replace=False)] = draw.random(5)
    index = tx.BlockMaxIndex.of(*np.nonzero(vectors), vectors[np.nonzero(vectors)], 640, 200)
    opened: list[int] = []
    index.nearest(np.array([3, 4, 5]), np.array([0.5, 0.5, 0.5]), 10, opened=opened)
    assert opened == [2]


@pytest.fixture(scope="module")
def model(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, tx.fit(docs, labels)


def test_held_out_rows(spark, model):
    docs, labels, fitted = model
    got = tx.scored(docs, fitted).select("row.doc_id", "held_out", "score", "predicted").join(labels, "doc_id").toPandas()
    mine = got[got.held_out]
    wrong = mine[(mine.predicted == 1) & (mine.toxic == 0)]
    assert len(wrong) <= 0.03 * len(mine)
    found = mine[mine.toxic == 1].predicted.mean()
    assert found >= 0.5  # a hundred words of four languages, forty examples
    assert got.score.between(0, 1).all()


def plain(docs, labels, fitted):
    """Scores of all rows by plain dictionaries, from the examples that the model names."""
    import math
    import re

    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    def terms(text):
        found = Counter()
        for w in word.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")):
            found[w] += 1
            found.update({f"{w[:n]}~" for n in (4, 5, 6) if len(w) > n and w[:n] in fitted.beginnings})
        return found

    texts = {r.doc_id: r.text for r in docs.collect()}
    known = {r.doc_id: r.toxic for r in labels.collect()}
    examples = {i: terms(texts[i]) for i in fitted.example_id}
    names = {w for e in examples.values() for w in e if not w.endswith("~")} | {f"{b}~" for b in fitted.beginnings}
    counts = {i: terms(t) for i, t in texts.items()}
    df = Counter(t for c in counts.values() for t in c.keys() & names)
    y = {i: known[i] for i in examples}
    n, n1 = len(y), sum(y.values())
    weight = {}
    for t in names:
        both, a = sum(t in e for e in examples.values()), sum(y[i] for i, e in examples.items() if t in e)
        odds = math.log((a + 0.5) / (n1 + 1)) - math.log((both - a + 0.5) / (n - n1 + 1))
        chi = n * (a * (n - n1) - (both - a) * n1) ** 2 / (n1 * (n - n1) * both * (n - both + 1)) if odds >= 1 else 0
        weight[t] = (math.log((1 + len(texts)) / (1 + df[t])) + 1) * (0.1 + 0.9 * min(1, chi / 20))

    def vector(c):
        own = {t: (1 + math.log(m)) * weight[t] for t, m in c.items() if t in weight}
        length = math.sqrt(sum(x * x for x in own.values()))
        return {t: x / length for t, x in own.items()}

    held = {i: vector(e) for i, e in examples.items()}
    out = {}
    for i, c in counts.items():
        v = vector(c)
        near = sorted((sum(x * e.get(t, 0) for t, x in v.items()) for e in held.values()), reverse=True)[:15]
        cosines = {j: sum(x * e.get(t, 0) for t, x in v.items()) for j, e in held.items()}
        best = [j for j in cosines if cosines[j] >= max(near[-1], 1e-12)]
        votes = sum(cosines[j] ** 3 for j in best) + 0.01
        share = (sum(cosines[j] ** 3 * y[j] for j in best) + 0.01 * fitted.rate) / votes
        share = min(max(share, 1e-6), 1 - 1e-6)
        out[i] = 1 / (1 + math.exp(-(fitted.slope * math.log(share / (1 - share)) + fitted.offset))) if v else fitted.rate
    return out


def test_scores_equal_plain_python(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    fitted = tx.fit(docs, labels)
    want = plain(docs, labels, fitted)
    got = {r.doc_id: r.score for r in tx.scored(docs, fitted).select("row.doc_id", "score").collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[i] - want[i]) for i in got) < 1e-4


def test_scores_are_calibrated(spark, model):
    docs, labels, fitted = model
    got = tx.scored(docs, fitted).select("row.doc_id", "held_out", "score").join(labels, "doc_id").toPandas()
    mine = got[got.held_out]
    assert abs(mine.score.mean() - mine.toxic.mean()) < 0.06
    low, high = mine[mine.score < 0.2], mine[mine.score > 0.8]
    assert low.toxic.mean() < 0.1 and (high.toxic.mean() > 0.75 or len(high) < 5)


def test_string_ids(spark, model):
    docs, labels, _ = model
    named = [t.limit(200).withColumn("doc_id", F.concat(F.lit("d"), "doc_id")) for t in (docs, labels)]
    fitted = tx.fit(*named)
    assert {type(e.doc_id) for r in tx.scored(named[0].limit(20), fitted, evidence=True).collect() for e in r.evidence} == {str}


def test_labels_of_held_out_rows_are_not_learnt(spark, model):
    docs, labels, fitted = model
    turned = labels.withColumn("toxic", F.when(tx.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = tx.fit(docs, turned)
    assert again.words == fitted.words and again.rate == fitted.rate
    assert (again.label == fitted.label).all() and again.slope == fitted.slope  # reruns agree, too


def test_awkward_rows_and_labels(spark, model):
    _, labels, fitted = model
    docs = documents(spark)
    got = tx.scored(docs, fitted, evidence=True).collect()
    assert len(got) == len(AWKWARD)
    assert all(r.score == fitted.rate and not r.evidence for r in got if r.row.doc_id in (1, 2, 3))
    assert tx.scored(docs.limit(0), fitted).count() == 0
    none = tx.fit(docs, labels.limit(0))
    assert {r.score for r in tx.scored(docs, none).collect()} == {0.0}
    kept = tx.without_toxic(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == len(AWKWARD)


def test_queries_together_equal_each_alone(monkeypatch):
    draw = np.random.default_rng(3)
    vectors = draw.random((200, 40)) * (draw.random((200, 40)) < [0.5] * 5 + [0.05] * 35)
    vectors[100:] = vectors[:100]  # every vector twice: the lower number comes first
    index = tx.BlockMaxIndex.of(*np.nonzero(vectors), vectors[np.nonzero(vectors)], 200, 40)
    asked = [np.sort(draw.choice(40, draw.integers(0, 12), replace=False)) for _ in range(70)]
    terms, edges = np.concatenate(asked), np.cumsum([0, *map(len, asked)])
    weights, without = draw.random(len(terms)), np.where(draw.random(70) < 0.3, draw.integers(0, 200, 70), -1)
    alone = [
        index.nearest(terms[a:b], weights[a:b], 15, w)
        for a, b, w in zip(edges[:-1], edges[1:], without.tolist(), strict=True)
    ]
    for queries, postings in ((256, 400_000), (7, 400_000), (256, 20)):
        monkeypatch.setattr(tx, "QUERIES", queries)
        monkeypatch.setattr(tx, "POSTINGS", postings)
        together = index.nearest_each(terms, weights, edges, 15, without)
        assert all((a[0] == b[0]).all() and (a[1] == b[1]).all() for a, b in zip(alone, together, strict=True))
    for (ids, near), a, b, w in zip(alone, edges[:-1], edges[1:], without.tolist(), strict=True):
        cosines = vectors[:, terms[a:b]] @ weights[a:b]
        want = sorted(((-round(c, 6), i) for i, c in enumerate(cosines) if c > 0 and i != w))[:15]
        assert np.allclose(near, [-c for c, _ in want], atol=1e-5) and w not in ids
        assert all(i < j for i, j, x, y in zip(ids[:-1], ids[1:], near[:-1], near[1:], strict=True) if x == y)


def test_terms_equal_plain_dictionaries(monkeypatch):
    monkeypatch.setattr(tx, "PIECE", 50)
    words = [b"a", b"ab", b"ba", "straße".encode(), "\U0001f469‍\U0001f469x".encode(), b"idiots", b"x" * 300]
    beginnings = ["idio", "straß", "\U0001f469‍\U0001f469x", "xxxxxx"]
    texts = ["", "a", "A ab,BA--a", "Straßen Straße straß Idiots IDIO idioten", " \t", "x" * 300 + " " + "X" * 301,
             "\U0001f469‍\U0001f469x \U0001f469‍\U0001f469xy Ä ä", "ab " * 400 + "idiots", "\x00a\x7fb"]
    number = {w: i for i, w in enumerate(words)}
    starts = {b: len(words) + i for i, b in enumerate(beginnings)}
    found = tx.Terms(words, beginnings)
    terms, times, edges = found.counts([t.encode() for t in texts])
    for i, text in enumerate(texts):
        want = Counter()
        for w in terms_of(text):
            want.update([number[w]] if w in number else [])
            want.update(t for b, t in starts.items() if w.decode().startswith(b) and len(w.decode()) > len(b))
        own = slice(edges[i], edges[i + 1])
        assert list(zip(terms[own].tolist(), times[own].tolist(), strict=True)) == sorted(want.items())
    assert found.counts([])[2].tolist() == [0] and len(tx.Terms([], []).counts([b"a b"])[0]) == 0


def test_carried_texts_travel_once(spark, model):
    docs, _, fitted = model
    for carry, times in ((docs.columns, 0), (["doc_id"], 1)):
        plan = tx.scored(docs, fitted, carry=carry)._jdf.queryExecution().analyzed().toString()
        assert plan.count(" AS text#") == times
    some = docs.where("doc_id % 10 = 0")
    rows = [{tuple(r) for r in tx.scored(some, fitted, carry=c).select("row.doc_id", "score").collect()} for c in (docs.columns, ["doc_id"])]
    assert rows[0] == rows[1] and len(rows[0]) == some.count()
