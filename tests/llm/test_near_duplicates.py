from __future__ import annotations

import random
from collections import Counter

import pytest

from tests.llm.cases import AWKWARD, documents, invented
from tripmart.llm import near_duplicates as nd
from tripmart.llm import components as stars
from tripmart.llm import workers
from tripmart.llm.components import components


def root_of(parent, i):
    while parent[i] != i:
        i = parent[i]
    return i


def brute(texts: list[str], idf) -> list[int]:
    """The class of each text by comparing every pair."""
    bags = []
    for t in texts:
        found, times = nd.shingles(t)
        bags.append(dict(zip(found.tolist(), (times * idf[nd._cells(found)].astype(float)).tolist(), strict=True)))
    parent = list(range(len(texts)))
    for i, a in enumerate(bags):
        for j in range(i):
            b = bags[j]
            common = sum(min(w, b[x]) for x, w in a.items() if x in b)
            both = len(a.keys() & b.keys())
            total, n = sum(a.values()) + sum(b.values()) - common, len(a) + len(b) - both
            if texts[i] == texts[j] or total and common >= 0.8 * total - 1e-9 or n and both >= 0.8 * n - 1e-9:
                parent[root_of(parent, i)] = root_of(parent, j)
    return [root_of(parent, i) for i in range(len(texts))]


def partition(labels) -> set[frozenset]:
    groups: dict = {}
    for i, label in enumerate(labels):
        groups.setdefault(label, set()).add(i)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("block", [800, 4])
def test_classes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    rows = invented(40, 5, copies=8, words=150)
    docs = documents(spark, rows)
    idf = nd.idf_table(docs.select("text"))
    found = {r.doc_id: r["class"] for r in nd.near_duplicates(docs).collect()}
    mine = partition([found[r[0]] for r in rows])
    assert mine == partition(brute([r[1] for r in rows], idf))
    assert len(mine) < len(rows)


def test_awkward_rows(spark):
    docs = documents(spark)
    found = nd.near_duplicates(docs).collect()
    assert len(found) == len(AWKWARD)
    by_id = Counter(r.class_id for r in found)
    assert by_id[1] == 2  # null and empty
    assert {r.class_id for r in found if r.doc_id == 9} == {8}
    kept = nd.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [-3, 0, 1, 3, 4, 4, 5, 6, 7, 8]
    assert nd.near_duplicates(docs.limit(0)).count() == 0
    assert nd.deduplicated(docs.limit(0)).count() == 0


def test_signatures_agree_as_often_as_texts_are_alike():
    import numpy as np

    draw = np.random.default_rng(1)
    same = []
    for _ in range(200):
        pool = np.unique(draw.integers(0, 1 << 63, 300).astype(np.uint64))
        a, b = pool[:250], pool[50:]
        weigh = lambda x: (1 + (x % np.uint64(3))).astype(float)
        same.append((nd.signature(a, weigh(a)) == nd.signature(b, weigh(b))).mean())
    assert abs(np.mean(same) - 200 / 300) < 0.03


def test_components_equal_union_find(spark):
    draw = random.Random(4)
    for n, m in [(1, 0), (30, 20), (60, 90), (40, 39)]:
        links = [(f"n{draw.randrange(n):03}", f"n{draw.randrange(n):03}") for _ in range(m)]
        if m == 39:
            links = [(f"n{i:03}", f"n{i + 1:03}") for i in range(39)]  # a long chain
        parent = {x: x for pair in links for x in pair}
        for a, b in links:
            parent[max(root_of(parent, a), root_of(parent, b))] = min(root_of(parent, a), root_of(parent, b))
        frame = spark.createDataFrame(links, "a string, b string")
        got = {r.node: r.label for r in components(frame).collect()}
        joined = {x for a, b in links if a != b for x in (a, b)}
        assert got == {x: root_of(parent, x) for x in joined}


@pytest.mark.parametrize(("links", "most"), [
    ([("a", x) for x in "bcdefg"], 1),  # one star
    ([(x, "z") for x in "abcdef"], 2),  # below the largest
    ([("a", "b"), ("c", "d"), ("c", "e"), ("x", "x"), ("d", None)], 1),
    ([], 1),
])
def test_components_end_with_the_round_that_leaves_stars(spark, monkeypatch, links, most):
    rounds = []
    monkeypatch.setattr(stars, "free", lambda _: rounds.append(1))
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    joined = {x for a, b in links if b and a != b for x in (a, b)}
    assert got.keys() == joined and all(got[a] == got[b] for a, b in links if b and a != b)
    assert all(got[x] == x or got[got[x]] == got[x] < x for x in got)
    assert len(rounds) <= most


def test_what_the_driver_s_python_has_freed_goes_back(spark):
    def held_mb() -> float:
        with open("/proc/self/smaps_rollup") as lines:
            return next(int(x.split()[1]) for x in lines if x.startswith("Pss_Anon")) / 1024

    held = [bytes(2000) for _ in range(50_000)]
    before = held_mb()
    held = held[::100]  # what stays lies among what goes
    workers.free(spark)
    assert len(held) == 500 and held_mb() < before - 50


def test_sets_alike_are_linked_however_often_a_line_repeats(spark):
    line = " ".join(f"r{i}" for i in range(10))

    def text(doc: int, times: int, words: int = 100) -> str:
        return " ".join([f"d{doc}w{i}" for i in range(words)] + [line] * times)

    def more(doc: int) -> str:
        return text(doc, 1).replace(line, line + " " + line)

    texts = [t for k in range(20) for t in (text(k, 30), text(k, 3))]
    texts += [more(k) for k in range(20)] + [text(50, 4, 12), text(50, 400, 12), text(51, 4, 12)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    idf = nd.idf_table(documents(spark, rows).select("text"))
    found = {r.doc_id: r["class"] for r in nd.near_duplicates(documents(spark, rows)).collect()}
    mine = partition([found[r[0]] for r in rows])
    assert mine == partition(brute(texts, idf))
    assert all(found[2 * k] == found[2 * k + 1] for k in range(20))
    assert nd.linked(texts[:2], [0, 0], False, idf) == [(1, 0)]
