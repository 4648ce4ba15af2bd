"""Queries meet chunks as a stream: nothing grows with the product of both, and the best are those of brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.functions.text import keyword_score
from quire.operators import retrieval as R
from quire.operators.embed import HashedWords
from quire.plans import catalog


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def sides(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{int(k)}" for k in rng.zipf(1.3, 5 + i % 40) % 500) for i in range(1500)]
    texts[700:760] = [texts[3]] * 60
    chunks = spark.createDataFrame(list(enumerate(texts)), "chunk_id long, text string")
    asked = [(i, texts[i * 7]) for i in range(200)]
    return texts, chunks, asked, spark.createDataFrame(asked, "query_id long, text string")


def test_chunks_and_queries_meet_without_a_join(spark, sides):
    _, chunks, _, queries = sides
    assert "Join" not in plan(R.bm25_topk(chunks, queries, 5))
    vectors = spark.createDataFrame([(1, [1.0, 2.0])], "id long, embedding array<float>")
    assert "Join" not in plan(R.dense_topk(vectors.withColumnRenamed("id", "query_id"), vectors, 5))


@pytest.mark.parametrize("parts", [1, 3])
def test_bm25_of_many_chunks(spark, sides, parts, monkeypatch):
    texts, chunks, asked, queries = sides
    meet = R._streams
    monkeypatch.setattr(R, "_streams", lambda q, i, a, b, n: meet(q, i, a, b, parts))
    monkeypatch.setattr(R, "_rows_of", lambda n: 16)
    got = {}
    for r in R.bm25_topk(chunks, queries, 20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.chunk_id)
    words = [t.split() for t in texts]
    vocabulary = {w: j for j, w in enumerate(sorted({w for ws in words for w in ws}))}
    f = np.zeros((len(texts), len(vocabulary)))
    for i, ws in enumerate(words):
        np.add.at(f[i], [vocabulary[w] for w in ws], 1)
    df, size = (f > 0).sum(axis=0), f.sum(axis=1)
    raw = np.log(len(texts) - df + 0.5) - np.log(df + 0.5)
    idf = np.where(raw < 0, 0.25 * raw.mean(), raw)
    saturated = f * 2.5 / (f + 1.5 * (0.25 + 0.75 * size / size.mean())[:, None])
    for qid, text in asked:
        q = f[qid * 7]
        score = np.round(saturated @ (q * idf), 6)
        near = np.flatnonzero((f > 0) @ q > 0)
        assert got[qid] == sorted(near, key=lambda i: (-score[i], i))[:20], text


def test_best_of_blocks_with_ties():
    rng = np.random.default_rng(1)
    scores = np.round(rng.random((4000, 30)), 2)
    scores[rng.random(scores.shape) < 0.3] = -np.inf
    scores[:, 4] = -np.inf
    best = R._Best(30, 7)
    for a in range(0, 4000, 50):
        best.add(scores[a : a + 50].copy(), a)
    query, item, score = best.best()
    for q in range(30):
        want = sorted((i for i in range(4000) if scores[i, q] > -math.inf), key=lambda i: (-scores[i, q], i))[:7]
        assert sorted(item[query == q], key=lambda i: (-scores[i, q], i))[:7] == want


def test_few_more_than_the_best_are_held():
    # Every block is better than the one before.
    best = R._Best(1000, 50)
    for a in range(0, 1500, 60):
        best.add(np.arange(a, a + 60)[:, None] + np.zeros(1000), a)
        assert best.held <= 1.25 * 50 * 1000 + (1 << 18) + 60 * 1000
    query, item, _ = best.best()
    assert (query.dtype, item.dtype) == (np.int32, np.int32)
    assert set(item[query == 7]) == set(range(1450, 1500))


@pytest.mark.parametrize("weights", [[1.0, 2.0, 3.0], [1.0, -2.0, 3.0]])
def test_what_shares_no_term_stays_under_the_least_score(weights):
    post = R._Postings(np.array([2, 1]), np.array([5, 7, 9]), np.array(weights))
    [(_, scores)] = post.scores(np.array([2, 1, 1]), np.array([5, 7, 9, 4]), lambda f, size: f)
    assert (scores >= post.least).tolist() == [[True, False], [False, True], [False, False]]
    best = R._Best(2, 3, post.least)
    best.add(scores, 0)
    query, item, score = best.best()
    assert (query.tolist(), item.tolist(), score.tolist()) == ([0, 1], [0, 1], [weights[0] + weights[1], weights[2]])


def test_chunks_are_read_three_times(spark, sides):
    _, chunks, _, queries = sides
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    R.bm25_topk(chunks.mapInArrow(count, chunks.schema), queries, 5).collect()
    assert read.value <= 3 * 1500


def test_words_of_a_text_are_made_once_a_pass(spark, sides, monkeypatch):
    texts, chunks, _, queries = sides
    chunks = spark.createDataFrame([*enumerate(texts), (5000, " "), (5001, ""), (5002, None)], chunks.schema)
    cuts, meets, cut, meet = [], [], R.cut, R._streams
    monkeypatch.setattr(R, "cut", lambda df: cuts.append(plan(df)) or cut(df))
    monkeypatch.setattr(R, "_streams", lambda q, i, *a: meets.append(plan(i)) or meet(q, i, *a))
    assert {r.chunk_id for r in R.bm25_topk(chunks, queries, 5).collect()} <= set(range(1500))
    assert cuts[0].count("split(") == meets[0].count("split(") == 1


def test_routed_search_is_two_stage_with_lexical_clusters(spark):
    rng = np.random.default_rng(11)
    vector = lambda: [float(x) for x in rng.standard_normal(6)]
    words = [f"{a}{b}" for a in ("frei", "humid", "cut", "plat") for b in ("ght", "ity", "ting", "ework")]
    chunks = spark.createDataFrame([(f"c{i}", vector()) for i in range(120)] + [("zero", [0.0] * 6), ("none", None)], "id string, embedding array<float>")
    groups = [(f"0.{i}", " ".join(rng.choice(words, 2)), vector(), [f"c{j}" for j in rng.integers(0, 125, 6)] + ["zero"]) for i in range(60)]
    clusters = spark.createDataFrame([*groups, ("0.60", None, None, ["c1", "c1"]), ("0.61", "cutting", vector(), None)], "id string, text string, embedding array<float>, chunks array<string>")
    asked = [(i, vector(), [str(t) for t in rng.choice(words, i % 3)]) for i in range(40)] + [(40, [0.0] * 6, ["freight"]), (41, vector(), None)]
    queries = spark.createDataFrame(asked, "query_id long, embedding array<float>, terms array<string>")
    want = R.two_stage(queries, clusters, chunks, 3, 7, R.lexical_clusters(queries, clusters))
    got = R.routed_topk(queries, clusters, chunks, 3, 7)
    rows = lambda df: sorted((r.query_id, r.id, r.similarity, r["rank"]) for r in df.collect())
    assert rows(got) == rows(want) and len(rows(got)) > 40


@pytest.mark.parametrize("parts", [1, 3])
def test_keyword_scores_are_counted_without_a_join(spark, parts, monkeypatch):
    rng = np.random.default_rng(9)
    odd = ["A\u00a0b  B", "a\x1cb", "", "  \n", "\u0130stanbul \u03a3\u03a3", "\u3000x\x85Y"]
    texts = odd + [" ".join(f"W{int(k)}" if k % 3 else f"w{int(k)}" for k in rng.zipf(1.3, 3 + i % 30) % 90) for i in range(90)]
    chunks = spark.createDataFrame(list(enumerate(texts)), "chunk_id long, text string")
    queries = chunks.withColumnRenamed("chunk_id", "query_id").where("query_id % 2 = 0")
    # Text 7 is found by every query, 95 by one; what has no text or is no query is left out.
    pairs = [(q, c, q / 100 + c) for q in range(0, 96, 2) for c in {7, *range(q % 6, 95, 11)}] + [(2, 95, 0.5), (1, 7, 0.5), (2, 500, 0.5)]
    ranked = spark.createDataFrame(pairs, "query_id long, chunk_id long, hybrid double")
    meet = R._streams
    monkeypatch.setattr(R, "_streams", lambda q, i, a, b, n, pairs: meet(q, i, a, b, parts, pairs=pairs))
    got = R.rerank_keywords(ranked, queries, chunks)
    assert "Join" not in plan(got)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "9")
    try:
        rows = sorted((r.query_id, r.chunk_id, r.keyword_score, r.final) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    joined = ranked.join(queries.withColumnRenamed("text", "asked"), "query_id").join(chunks, "chunk_id").withColumn("n", keyword_score(F.col("asked"), F.col("text")))
    assert rows == sorted((r.query_id, r.chunk_id, r.n, r.hybrid + 0.2 * r.n) for r in joined.collect())
    assert len(rows) == len(pairs) - 2


def test_pairs_of_null_ids_have_no_keyword_score(spark):
    chunks = spark.createDataFrame([(None, "a b"), (None, "a"), (1, "a b c"), (2, "c")], "chunk_id long, text string")
    queries = spark.createDataFrame([(None, "c"), (5, "a c")], "query_id long, text string")
    ranked = spark.createDataFrame([(q, c, 0.5) for q in (None, 5) for c in (None, 1, 2)], "query_id long, chunk_id long, hybrid double")
    assert sorted((r.query_id, r.chunk_id, r.keyword_score) for r in R.rerank_keywords(ranked, queries, chunks).collect()) == [(5, 1, 2), (5, 2, 1)]


def test_embedding_is_a_signed_count_of_words():
    import zlib

    def one(text):
        out = np.zeros(64)
        for w in text.lower().split():
            h = zlib.crc32(w.encode())
            out[h % 64] += 1 if h >> 16 & 1 else -1
        return out / (np.linalg.norm(out) or 1)

    texts = ["A a b", "", None, "x y z x", "ü   ü"]
    assert np.allclose(HashedWords().embed(texts), [one(t or "") for t in texts])
    assert HashedWords().embed([]).shape == (0, 64)


def test_terms_and_clusters_meet_without_a_join(spark):
    clusters = spark.createDataFrame([("0.1", "freight table"), ("0.2", "humidity"), ("0.1", "humidity too"), ("0.3", None)], "id string, text string")
    terms = spark.createDataFrame([(1, ["freigth", "humidity"]), (2, ["table"]), (3, [])], "query_id int, terms array<string>")
    df = R.lexical_clusters(terms, clusters)
    assert "Join" not in plan(df)
    assert sorted((r.query_id, r.id) for r in df.collect()) == [(1, "0.1"), (1, "0.2"), (2, "0.1")]


def test_long_terms_and_texts_are_compared_like_short_ones():
    rng = np.random.default_rng(2)
    base = "".join(rng.choice(list("abcdefgh "), 400))
    texts = [base[i : i + n] for i, n in ((0, 90), (40, 150), (200, 200), (0, 400), (90, 64))]
    terms = []
    for i in range(60):
        a, n = int(rng.integers(0, 300)), int(rng.integers(3, 140))
        t = list(base[a : a + n])
        for _ in range(int(n * rng.random() * 0.35)):
            t[int(rng.integers(0, len(t)))] = str(rng.choice(list("abcdefgh")))
        terms.append("".join(t))
    want = [sorted(t for t in terms if R.partial_ratio(t, x, 80.0)) for x in texts]
    assert [sorted(x) for x in R.matching_terms(texts, terms, 80.0)] == want and any(want)
