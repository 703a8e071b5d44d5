from __future__ import annotations

import pytest

from tests.llm.cases import documents
from tripmart.llm.mixing import mixed, mixing_plan


def filled(sizes: dict[str, int], weights=(1, 2, 3), cap=3) -> dict[str, float]:
    """Targets by giving out the excess again and again."""
    names = sorted(sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        share = left / sum(w[s] for s in free)
        over = {s for s in free if share * w[s] >= cap * sizes[s]}
        for s in over or free:
            target[s] = cap * sizes[s] if over else share * w[s]
        left -= sum(cap * sizes[s] for s in over)
        free -= over or free
    return target


def test_targets_and_words_taken(spark):
    rows = [(i, "w " * (i % 37 + 1), "en", f"s{i % 5}", 0) for i in range(3000)]
    rows += [(9000 + i, "w w", "en", "tiny", 0) for i in range(10)]
    plan = mixing_plan(documents(spark, rows)).toPandas()
    expected = filled(plan.groupby(plan.doc_id.map({r[0]: r[3] for r in rows}))["size"].sum().to_dict())
    for source, part in plan.groupby(plan.doc_id.map({r[0]: r[3] for r in rows})):
        assert part.target.iloc[0] == pytest.approx(expected[source])
        assert abs(part.taken.sum() - part.target.iloc[0]) <= max(part["size"].max() * 3, 0.02 * part.taken.sum())
    assert plan.copies.between(0, 3).all()
    assert set(plan.copies[plan.doc_id >= 9000]) == {3}


def test_a_rerun_and_another_partitioning_agree(spark):
    docs = documents(spark)
    once = sorted(map(str, mixing_plan(docs).collect()))
    assert once == sorted(map(str, mixing_plan(docs.repartition(7)).collect()))


def test_awkward_rows(spark):
    docs = documents(spark)
    assert mixing_plan(docs).count() == docs.count()
    taken = mixed(docs)
    assert taken.columns == docs.columns
    assert taken.count() == mixing_plan(docs).groupBy().sum("copies").first()[0]
    assert mixing_plan(docs.limit(0)).count() == 0
    assert mixed(docs.limit(0)).columns == docs.columns


def test_one_size_and_one_source_is_taken_evenly(spark):
    plan = mixing_plan(documents(spark, [(i, "same text", "en", None, 0) for i in range(1000)]))
    assert {r.copies for r in plan.collect()} == {1}
