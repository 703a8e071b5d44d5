from __future__ import annotations

import hashlib

import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import DATA
from tests.llm.cases import SCHEMA, invented
from tests.llm.test_near_duplicates import brute as classes
from tripmart.llm import near_duplicates as nd
from tripmart.llm import toxicity as tx
from tripmart.llm.mixing import OP1_SQL
from tripmart.llm.substrings import WINDOW


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    sizes = [len(before)]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, DATA)
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
        docs = kept.checkpoint()
        sizes.append(docs.count())
        assert {r.doc_id for r in docs.collect()} <= before.keys()
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert last.count() == sizes[4]
    assert {r.doc_id for r in corpus_pipeline.run(spark, DATA).collect()} == {r.doc_id for r in docs.collect()}


class AllCosines:
    """The nearest vectors by the cosines of all."""

    def __init__(self, index: tx.BlockMaxIndex) -> None:
        edges = index.at[index.first]
        self.vectors = np.zeros((index.size, len(edges) - 1))
        for w, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            self.vectors[index.ids[low:high], w] = index.weights[low:high]

    def nearest(self, words, weights, k, without=-1):
        assert without == -1  # no example is scored here
        cosines = self.vectors[:, words] @ weights
        ids = [i for i in np.lexsort((np.arange(len(cosines)), -cosines)) if cosines[i] > 0][:k]
        return np.array(ids, np.int64), cosines[ids]


def cut(rows: dict[int, str]) -> dict[int, str]:
    """Texts without the words of windows that a smaller id has."""
    split = {d: t.split() for d, t in rows.items()}
    grams = {d: [tuple(w[i : i + WINDOW]) for i in range(len(w) - WINDOW + 1)] for d, w in split.items()}
    least: dict[tuple, int] = {}
    for d in sorted(grams):
        for g in grams[d]:
            least.setdefault(g, d)
    gone = {
        d: {j for i, g in enumerate(grams[d]) if least[g] < d for j in range(i, i + WINDOW)} for d in grams
    }
    return {d: " ".join(w for i, w in enumerate(split[d]) if i not in gone[d]) for d in split}


def test_run_equals_a_chain_of_brute_force(spark, tmp_path):
    rows = invented(50, 9, copies=5, words=120)
    rows = [(i, t + " idiot moron scum" * (i % 5 == 0), lang, source, 0) for i, t, lang, source, _ in rows]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(r[0], int(r[0] % 5 == 0)) for r in rows], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")

    model = tx.fit(docs, labels)
    model.index = AllCosines(model.index)
    vectors = model.vectors([r[1].encode() for r in rows])
    clean = {r[0]: r[1] for r, v in zip(rows, vectors, strict=True) if model.score(*v)[0] < tx.THRESHOLD}
    ids = sorted(clean)
    idf = nd.idf_table(docs.where(docs.doc_id.isin(ids)).select("text"))
    heads: dict[int, int] = {}
    for d, label in zip(ids, classes([clean[d] for d in ids], idf), strict=True):
        heads.setdefault(label, d)
    passages = cut({d: clean[d] for d in heads.values()})
    assert len(rows) > len(clean) > len(passages) and any(passages[d] != clean[d] for d in passages)

    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    db.executemany(
        "INSERT INTO documents VALUES (?, ?, ?, ?, ?)",
        [(d, passages[d], "en", f"s{d % 3}", len(passages[d])) for d in passages],
    )
    copied = OP1_SQL.replace("::BIGINT * size)::BIGINT AS taken", "::BIGINT) AS copies")
    taken = db.execute(f"SELECT doc_id, copies FROM ({copied})").fetchall()
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    want = []
    for d, copies in taken:
        found = library.encode(passages[d], add_special_tokens=False).ids
        texts = " ".join(map(str, found)), library.decode(found, skip_special_tokens=False)
        want += [(d, found, *(hashlib.sha256(t.encode()).hexdigest() for t in texts))] * copies
    got = [(r.doc_id, r.ids, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)
