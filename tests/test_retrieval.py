import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import retrieval as R


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            row[j + 1], before = (before + 1 if x == y else max(row[j + 1], row[j])), row[j + 1]
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abcd", min_size=1, max_size=7), st.text("abcd", min_size=1, max_size=14))
def test_partial_ratio_is_the_best_window(term, text):
    a, b = sorted((term, text), key=len)
    windows = [b[max(0, i) : i + len(a)] for i in range(1 - len(a), len(b))]
    assert math.isclose(R.partial_ratio(term, text), max(200 * lcs(a, w) / (len(a) + len(w)) for w in windows))


def test_dense_topk_against_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((300, 8)).astype("float32")
    x[7] = 0
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)] + [(300, None), (301, [])], "id long, embedding array<float>")
    q = v.where("id % 20 = 7").select(F.col("id").alias("query_id"), "embedding")
    got = {(r.query_id, r.rank): r.id for r in R.dense_topk(q, v, 5).collect()}
    u = x.astype(float) / np.where((n := np.linalg.norm(x, axis=1, keepdims=True)) > 0, n, 1)
    for i in range(27, 300, 20):
        s = np.round(u @ u[i], 6)
        s[7] = -9
        best = sorted(range(300), key=lambda j: (-s[j], j))[:5]
        assert [got[i, k + 1] for k in range(5)] == best
    assert not any(k[0] == 7 for k in got)


def test_rerank_budget_rules(spark):
    rows = [(1, "a", 0.9, 1000), (1, "b", 0.9, 1000), (1, "c", 0.88, 600), (1, "d", 0.2, 10), (2, "e", 0.1, 5), (2, "f", 0.1, 5), (3, "g", 0.3, None)]
    got = {(r.query_id, r.chunk_id) for r in R.rerank_budget(spark.createDataFrame(rows, "query_id int, chunk_id string, score double, token_count int")).collect()}
    assert got == {(1, "a"), (1, "b"), (2, "e"), (3, "g")}  # c would pass the budget; all below the floor: the best stays


def test_merge_and_terms(spark):
    sem = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "query_id int, id string, rank int")
    lex = spark.createDataFrame([(1, "y", 1), (1, "z", 2)], "query_id int, id string, rank int")
    assert [r.id for r in R.merge_clusters(sem, lex).orderBy("position").collect()] == ["x", "y", "z"]
    t = spark.createDataFrame([("Wie ist die Kostenstelle_42?",), ("",), (None,)], "t string").select(T.query_terms(F.col("t")).alias("x")).collect()
    assert t[0].x == ["kosten", "kostenstelle", "kostenstelle42", "stelle"] and t[1].x == [] and t[2].x is None


def test_lexical_clusters(spark):
    c = spark.createDataFrame([("0.1", "Freight table of the plant"), ("0.2", "Humidity"), ("0.3", None)], "id string, text string")
    q = spark.createDataFrame([(1, ["freigth"]), (2, ["humidity", "plant"])], "query_id int, terms array<string>")
    assert {(r.query_id, r.id) for r in R.lexical_clusters(q, c).collect()} == {(1, "0.1"), (2, "0.1"), (2, "0.2")}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abcde", min_size=1, max_size=9), min_size=1, max_size=4, unique=True), st.lists(st.one_of(st.none(), st.text("abcde ", max_size=30)), max_size=6))
def test_matching_terms_are_those_of_partial_ratio(terms, texts):
    want = [sorted(t for t in terms if x and R.partial_ratio(t, x, 80.0)) for x in texts]
    assert [sorted(x) for x in R.matching_terms(texts, terms, 80.0)] == want
