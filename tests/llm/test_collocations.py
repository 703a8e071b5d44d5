from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.cases import AWKWARD, documents
from tripmart.llm import collocations as co


def brute(rows, least=2, subsumed=80, top=None):
    f: dict[str, Counter] = {}
    for _, text, lang, *_ in rows:
        own = f.setdefault("und" if lang is None else lang, Counter())
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            w = [x for x in re.split("[ \t]+", piece) if x]
            for n in range(1, 5):
                own.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside: dict[tuple, int] = {}
        for p, a in found.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    part = p[i : i + size]
                    inside[part] = max(inside.get(part, 0), a)
        best = []
        for p, a in found.items():
            if 100 * inside.get(p, 0) >= subsumed * a:
                continue
            score, _, left, right = min(
                (2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))
            )
            best.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def phrases(n, seed):
    draw = random.Random(seed)
    words = ["The", "of", "é", "Zug", "a", "b", "x1", "|"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " ! "]
    return [
        (i, "".join(draw.choice(words) + draw.choice(marks) for _ in range(draw.randint(0, 60))),
         draw.choice(["en", "de", None]), "s", 0)
        for i in range(n)
    ]


@pytest.mark.parametrize("hot", [8, 0.01])
def test_phrases_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(co, "HOT", hot)  # at 0.01 every stripe is split
    rows = phrases(60, 3)
    rows += rows[:5]
    got = sorted(tuple(r) for r in co.collocations(documents(spark, rows), least=3, top=40).collect())
    assert got == brute(rows, 3, top=40) and len(got) > 60


def test_what_is_held_does_not_matter(monkeypatch):
    import pyarrow as pa

    rows = phrases(80, 4)
    batch = pa.RecordBatch.from_pydict({"lang": [r[2] or "und" for r in rows], "text": [r[1] for r in rows]})
    level = co.Level((1,), None, np.empty(0, np.uint64), 5)

    def merged():
        parts: dict[int, list] = {}
        for sent in co._counted(iter([batch.slice(0, 30), batch.slice(30)]), level):
            for i in range(sent.num_rows):
                parts.setdefault(sent.column("shard")[i].as_py(), []).append(sent.slice(i, 1).select(
                    ["lang", "prefixes", "lengths", "nexts", "counts"]))
        out = Counter()
        for own in parts.values():
            for b in co._merged(iter(own), 1):
                for r in b.to_pylist():
                    out[r["lang"], r["phrase"]] += r["f"]
        return out

    whole = merged()
    monkeypatch.setattr(co, "CHUNK", 50)
    monkeypatch.setattr(co, "HELD_WORDS", 3)
    assert merged() == whole and whole["en", None] == sum(c for (lang, p), c in whole.items() if lang == "en" and p)


def test_awkward_rows(spark):
    docs = documents(spark)
    got = sorted(tuple(r) for r in co.collocations(docs).collect())
    assert got == brute(AWKWARD, 30, top=2000)
    assert {r[0] for r in got} <= {"en", "und"} and any(r[2] == "word word word word" for r in got)
    assert co.collocations(docs.limit(0)).count() == 0
