"""Hybrid search over all documents against brute force."""

import math
from collections import Counter

import duckdb
import numpy as np
import pytest

from quire.operators.embed import HashedWords
from quire.plans import catalog


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Eighty documents, of which only ten have a vector, and some questions."""
    d = str(tmp_path_factory.mktemp("few"))
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{int(k)}" for k in rng.zipf(1.4, 12 + i % 9) % 60) for i in range(80)]
    texts[50] = texts[49]
    spark.createDataFrame([*enumerate(texts), (80, None)], "doc_id long, text string").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, [float(i), 1.0]) for i in range(10)], "vec_id long, embedding array<float>").write.parquet(f"{d}/embeddings.parquet")
    questions = [(20 * i, " ".join(texts[i * 9 + 11].split()[-10:])) for i in range(6)]
    spark.createDataFrame(questions, "pair_id long, question string").write.parquet(f"{d}/qa_pairs.parquet")
    return d, texts, questions


def bm25(texts, asked):
    words = [t.split() for t in texts]
    n, mean = len(words), sum(map(len, words)) / len(words)
    df = Counter(w for ws in words for w in set(ws))
    raw = {w: math.log(n - c + 0.5) - math.log(c + 0.5) for w, c in df.items()}
    average = sum(raw.values()) / len(raw)
    idf = {w: 0.25 * average if r < 0 else r for w, r in raw.items()}
    out = {}
    for i, ws in enumerate(words):
        tf = Counter(ws)
        hit = [w for w in asked.split() if w in tf]
        if hit:
            out[i] = sum(idf[w] * tf[w] * 2.5 / (tf[w] + 1.5 * (0.25 + 0.75 * len(ws) / mean)) for w in hit)
    return out


def hybrid(texts, asked, vector):
    u = HashedWords().embed(texts).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    sims = np.round(u @ (vector / np.linalg.norm(vector)), 6)
    dense = {int(i): sims[i] for i in sorted(range(len(texts)), key=lambda j: (-sims[j], j))[:40]}
    scores = bm25(texts, asked)
    best = sorted(scores, key=lambda j: (-round(scores[j], 6), j))[:40]
    norm = math.sqrt(sum(scores[j] ** 2 for j in best)) + 1e-6
    both = {j: 0.5 * dense.get(j, 0.0) + 0.5 * (scores[j] / norm if j in best else 0.0) for j in {*dense, *best}}
    return {j: both[j] for j in sorted(both, key=lambda j: (-round(both[j], 6), j))[:40]}


def queries_of(questions):
    """(query_id, text, vector) of the questions; each has ten words, all of which count."""
    return [(i, text, HashedWords().embed([text])[0].astype(float)) for i, text in questions]


def test_documents_without_a_stored_vector_are_found(spark, folder):
    d, texts, questions = folder
    got = {}
    for r in catalog.QUERIES["hybrid_all"](spark, d).collect():
        got.setdefault(r.query_id, {})[r.chunk_id] = r.hybrid
    assert max(c for g in got.values() for c in g) > 9
    for qid, asked, vector in queries_of(questions):
        want = hybrid(texts, asked, vector)
        assert set(got.pop(qid)) == set(want)
    assert not got


def test_final_ranks(spark, folder):
    d, texts, questions = folder
    got = {}
    for r in catalog.QUERIES["dedupe_final_all"](spark, d).orderBy("query_id", "final_rank").collect():
        got.setdefault(r.query_id, []).append(r.chunk_id)
    for qid, asked, vector in queries_of(questions):
        final = {j: s + 0.2 * len(set(asked.split()) & set(texts[j].split())) for j, s in hybrid(texts, asked, vector).items()}
        order, seen = [], set()
        for j in sorted(final, key=lambda j: (-round(final[j], 6), j)):
            if texts[j] not in seen:
                seen.add(texts[j])
                order.append(j)
        assert got[qid] == order[:10]


def test_texts_are_not_shuffled_to_meet_their_vectors(spark, folder):
    d, texts, _ = folder
    docs, asked, vectors, asking = catalog._texts(spark, d)
    assert not any("Join" in f._jdf.queryExecution().optimizedPlan().toString() for f in (docs, asked))
    assert sorted(r.chunk_id for r in docs.collect()) == list(range(80)) and sorted(r.query_id for r in asked.collect()) == [0, 20, 40, 60]
    assert sorted(r.id for r in vectors.collect()) == list(range(10)) and [r.query_id for r in asking.collect()] == [0]


def unnamed(spark, folder, path, count):
    """The tables of ``folder`` with ``count`` more documents that have the text of document 20 and no id."""
    d, texts, _ = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    docs.unionByName(spark.createDataFrame([(None, texts[20])] * count, docs.schema)).write.parquet(f"{path}/documents.parquet")
    for t in ("embeddings", "qa_pairs"):
        spark.read.parquet(f"{d}/{t}.parquet").write.parquet(f"{path}/{t}.parquet")
    return str(path)


@pytest.mark.parametrize("count", [1, 3])
def test_documents_without_an_id_end_keyword_rerank_as_its_sql(spark, folder, tmp_path, count):
    d = unnamed(spark, folder, tmp_path, count)
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet/*.parquet')")
    got = sorted(map(tuple, catalog.QUERIES["keyword_rerank"](spark, d).collect()))
    assert got == sorted(con.execute(catalog.ORACLES["keyword_rerank"]).fetchall()) and {r[0] for r in got} == {0, 20, 40, 60}


def test_documents_without_an_id_take_no_place_of_keyword_rerank_all(spark, folder, tmp_path, monkeypatch):
    _, texts, questions = folder
    d, every = unnamed(spark, folder, tmp_path, 1), bm25
    # The document counts for the weights of words.
    monkeypatch.setitem(globals(), "bm25", lambda texts, asked: {i: s for i, s in every([*texts, texts[20]], asked).items() if i < 80})
    got = {}
    for r in catalog.QUERIES["keyword_rerank_all"](spark, d).collect():
        got.setdefault(r.query_id, {})[r.chunk_id] = (r.keyword_score, r.final)
    for qid, asked, vector in queries_of(questions):
        shared = {j: len(set(asked.split()) & set(texts[j].split())) for j in range(80)}
        want = {j: (shared[j], pytest.approx(s + 0.2 * shared[j], abs=2e-5)) for j, s in hybrid(texts, asked, vector).items()}
        assert got.pop(qid) == want
    assert not got
