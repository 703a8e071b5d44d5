from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest

from tests.llm.cases import AWKWARD, documents, invented
from tripmart.llm import fingerprints as fp


def brute_set(text, common=frozenset(fp.COMMON)):
    """The signatures of a text as tuples of words."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = ["", *re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)]
    found = set()
    for i, w in enumerate(words):
        if i == 0 or w in common:
            chain = [x for x in words[i + 1 :] if x not in common][: fp.CHAIN]
            if chain:
                found.add((w, *chain))
    return found or ({tuple(words)} if len(words) > 1 else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


TEXTS = ["", " . ", "Von.", "the of and", "The cat of the house", "Cat, house", "a b c a b c a", "é der Zug der Zug und"]


def test_sets_equal_plain_python():
    texts = TEXTS + [r[1] or "" for r in AWKWARD] + [r[1] for r in invented(30, 2)]
    sets = fp.signature_sets(texts, fp._Words(tuple(fp.COMMON)))
    plain = [brute_set(t) for t in texts]
    assert [len(s) for s in sets] == [len(p) for p in plain]
    for a, x in zip(sets, plain, strict=True):
        for b, y in zip(sets, plain, strict=True):
            assert fp.likeness(a, b) == pytest.approx(jaccard(x, y))


def test_pruned_likeness_equals_the_whole_one():
    draw = np.random.default_rng(3)
    pool = np.unique(draw.integers(0, 1 << 63, 2000).astype(np.uint64))
    for _ in range(200):
        a = np.sort(draw.choice(pool, draw.integers(0, 900), replace=False))
        b = np.union1d(a[: draw.integers(0, len(a) + 1)], draw.choice(pool, draw.integers(0, 300), replace=False))
        whole = jaccard({*a.tolist()}, {*b.tolist()})
        for least in (0.0, 0.3, 0.8):
            assert fp.likeness(a, b, least) == pytest.approx(whole if whole >= least else 0.0)


def brute(rows):
    """Ties of ids have the texts' order left open, so give none."""
    rows = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, (doc, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        own = brute_set(text)
        out.append((
            doc, len(text), hashlib.sha256(edited.encode()).hexdigest(),
            round(jaccard(own, brute_set(edited)), 9), round(jaccard(own, brute_set(following)), 9),
        ))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted(
        ((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in frame.collect()), key=repr
    )


@pytest.mark.parametrize("chunk", [1 << 21, 300])
def test_documents_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(fp, "CHUNK", chunk)
    rows = [(i * 7 - 40, *r[1:]) for i, r in enumerate(invented(70, 8))]
    rows += [(5000 + i, t, "en", "s", 0) for i, t in enumerate([*TEXTS, "word " * 20_000, "dog \U0001f469‍\U0001f469 of the end"])]
    rows += [(None, "an empty id of a row", "en", "s", 0)]
    assert rows_of(fp.compared(documents(spark, rows))) == brute(rows)


def test_awkward_rows(spark):
    docs = documents(spark)
    got = fp.compared(docs).collect()
    assert len(got) == len(AWKWARD)
    one = {r.doc_id: r.fingerprint for r in got}
    assert one[1] == one[2] == one[3] and one[8] != one[9]
    assert fp.compared(docs.limit(0)).count() == 0
    alone = fp.compared(documents(spark, [(1, "The only cat of the town", "en", "s", 0)])).first()
    assert alone.near_next == 1.0 and alone.n_chars == 24
    same = [(7, f"text number {i} of the id", "en", "s", 0) for i in range(300)] + [(7, "text of the id", "en", "s", 0)] * 50
    again = rows_of(fp.compared(documents(spark, same)))
    assert len(again) == 350 and again == rows_of(fp.compared(documents(spark, same[::-1])))


def test_fingerprints_of_equal_texts_are_equal(spark):
    got = fp.fingerprinted(documents(spark)).collect()
    assert len(got) == len(AWKWARD)
    four = [r.fingerprint for r in got if r.doc_id == 4]
    assert four[0] == four[1] != four[2]
    assert all(list(r.signatures) == sorted(r.signatures, key=lambda x: x % (1 << 64)) for r in got)
