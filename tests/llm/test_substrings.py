from __future__ import annotations

import hashlib

import pytest

from tests.llm.cases import AWKWARD, documents, invented
from tripmart.llm.substrings import LAST, WINDOW, cut_repeats, without_repeats


def brute(rows) -> list[tuple]:
    split = [((r[0] if r[0] is not None else LAST), (r[1] or "").encode().split()) for r in rows]
    least: dict[tuple, int] = {}
    for doc, words in split:
        for i in range(len(words) - WINDOW + 1):
            gram = tuple(words[i : i + WINDOW])
            least[gram] = min(doc, least.get(gram, doc))
    out = []
    for (doc, words), row in zip(split, rows, strict=True):
        gone = set()
        for i in range(len(words) - WINDOW + 1):
            if least[tuple(words[i : i + WINDOW])] < doc:
                gone |= set(range(i, i + WINDOW))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((row[0], len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("rows", [AWKWARD, invented(60, 1), invented(150, 2, copies=6)], ids=str.__class__)
def test_removed_words(spark, rows):
    cut = cut_repeats(documents(spark, rows), results=("n_words", "n_removed", "kept_sha256"))
    got = [tuple(r) for r in cut.select("row.doc_id", "n_words", "n_removed", "kept_sha256").collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_spans_stand_in_their_source(spark):
    rows = invented(80, 3, copies=5)
    words = {r[0]: r[1].split() for r in rows}
    found = 0
    for r in cut_repeats(documents(spark, rows)).collect():
        removed = set()
        for s in r.spans:
            own = words[r.row.doc_id][s.start : s.start + s.n_words]
            assert own == words[s.source_id][s.source_start : s.source_start + s.n_words]
            assert s.source_id < r.row.doc_id and s.n_words >= WINDOW
            removed |= set(range(s.start, s.start + s.n_words))
            found += 1
        assert len(removed) == r.n_removed
    assert found


def test_all_columns_and_rows_stay(spark):
    docs = documents(spark)
    kept = without_repeats(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert all(r.n_chars == len(r.text) for r in kept.collect())
    assert without_repeats(docs.limit(0)).count() == 0
