"""What stays in a worker after its task, and how much it takes at once."""

from __future__ import annotations

import gc
import tracemalloc
import weakref
from functools import partial

import pyarrow as pa
import public_tokenizers

from tripmart.llm import bpe, hashing, near_duplicates, substrings, workers


def test_batches_are_worked_on_in_slices(spark):
    docs = spark.createDataFrame([(i, "x" * 2**20) for i in range(12)], "doc_id long, text string").coalesce(1)

    def sizes(batch):
        return workers.columns(rows=pa.array([batch.num_rows]), size=pa.array([batch.nbytes]))

    found = workers.map_batches(docs, sizes, "rows long, size long").collect()
    assert sum(r["rows"] for r in found) == 12 and max(r["size"] for r in found) <= workers.PART


def test_slices_keep_all_rows_in_order():
    batch = pa.RecordBatch.from_pydict({"n": list(range(5)), "t": ["x" * 2**23, None, "", "y" * 2**23, "z"]})
    found = list(workers.slices(iter([batch, batch.slice(0, 0)])))
    assert len(found) > 1 and [n for b in found for n in b["n"].to_pylist()] == list(range(5))
    assert [t for b in found for t in b["t"].to_pylist()] == batch["t"].to_pylist()


def test_groups_reach_over_slices(monkeypatch):
    monkeypatch.setattr(workers, "PART", 1)
    batch = pa.RecordBatch.from_pydict({"k": [1, 1, 1, 2, 3, 3], "v": list("abcdef")})
    found = [(g["k"][0], "".join(g["v"])) for g in near_duplicates._groups(iter([batch]), ["k"])]
    assert found == [(1, "abc"), (2, "d"), (3, "ef")]


def test_memory_is_given_back_after_the_last_batch(monkeypatch):
    log = []
    monkeypatch.setattr(workers, "give_back", lambda: log.append("given"))
    run = workers.lean(lambda batches: (log.append(b) or b for b in batches))
    assert list(run(iter([1, 2]))) == [1, 2] and log == [1, 2, "given"]


def test_the_encoder_stays_for_its_kind_of_task_only(monkeypatch):
    made = []

    class Watched(bpe.WordBpe):
        def __init__(self, path):
            super().__init__(path)
            made.append(weakref.ref(self))

    monkeypatch.setattr(bpe, "WordBpe", Watched)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words", None]})
    path, results = public_tokenizers.path("word_bpe_49k.json"), ("n_tokens", "ids")
    encode = workers.lean(partial(bpe._encoded, vocabulary=path, results=results), keeps=True)
    found = [pa.Table.from_batches(encode(iter([batch]))) for _ in range(2)]
    assert len(made) == 1 and made[0]() is not None and found[0] == found[1]
    assert found[0]["n_tokens"].to_pylist() == [len(i) for i in found[0]["ids"].to_pylist()]
    assert list(workers.lean(lambda batches: batches)(iter([1]))) == [1]
    gc.collect()
    assert made[0]() is None


def test_cutting_does_not_hold_the_words_of_a_batch():
    """As objects, the 300,000 words of six letters take 48 bytes each beside 136 of arrays."""
    text = " ".join(f"w{i % 5000:05d}" for i in range(3000))
    table = pa.table({
        "id": pa.array(range(100), pa.int64()), "text": [f"d{i} {text}" for i in range(100)],
        "row": pa.array([{"doc_id": i} for i in range(100)]), "batch": pa.array([0] * 100, pa.int64()),
    })
    none = pa.table({n: pa.array([], pa.binary()) for n in ("one", "two", "doc", "pos")})
    hashing.word_hashes(hashing.split(text))
    tracemalloc.start()
    found = substrings._cut(table, none, ("kept", "n_removed"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 160 * 300_000
    # all but the first keep their own first word only
    assert found["n_removed"].to_pylist() == [0] + [3000] * 99
    assert found["kept"].to_pylist()[0] == f"d0 {text}" and found["kept"].to_pylist()[7] == "d7"
