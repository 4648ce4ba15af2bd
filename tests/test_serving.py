from pyspark.sql import functions as F

from quire.operators.embed import embed
from quire.operators.models import TRANSLATE, MockClient
from quire.plans import catalog, serving


class Translator(MockClient):
    def complete(self, prompt):
        return "Feuchtigkeit in Halle sieben messen" if prompt.startswith(TRANSLATE) else super().complete(prompt)


def clusters(spark, rows):
    return spark.createDataFrame(rows, "id string, text string, chunks array<string>").withColumn("embedding", embed(F.col("text")))


def context(spark, question, groups, client=MockClient):
    texts = [("a", "Freight is weighed at the gate", 6), ("b", "Feuchtigkeit in Halle sieben messen", 5), ("c", "Nothing", 1)]
    chunks = spark.createDataFrame(texts, "chunk_id string, text string, token_count int").withColumn("embedding", embed(F.col("text")))
    asked = spark.createDataFrame([(1, question)], "request_id long, text string")
    return serving.answer(asked, clusters(spark, groups), chunks, client, top_clusters=1).collect()[0].context or ""


def test_cluster_found_by_a_word_only(spark):
    # The first cluster is the nearest by vector; the word with a slip is in the second.
    groups = [("0.1", "gate at the freigth weighed is", ["c"]), ("0.2", "Freight and twelve other matters of the plant and the yard that stand here", ["a"])]
    assert "Freight is weighed" in context(spark, "freigth is weighed at the gate", groups)


def test_question_is_translated_for_retrieval(spark):
    groups = [("0.1", "Feuchtigkeit Halle sieben messen", ["b"]), ("0.2", "damp", ["c"])]
    assert "Feuchtigkeit" in context(spark, "how is the damp of the hall measured", groups, Translator)


def test_inner_clusters_and_retrieved_chunks_take_part(spark):
    got = {r.cluster_id: set(r.chunks) for r in catalog.chunks_of_nodes(spark, "/root/testdata/sf0.001").collect()}
    last = {}
    for r in spark.read.parquet("/root/testdata/sf0.001/cluster_records.parquet").orderBy("record_no").collect():
        last[r.cluster_id] = set(r.cluster_chunks or []) | set(r.leaf_chunks or [])
    assert got == last and any(not r for r in last.values()) is any(not g for g in got.values())


def test_every_question_is_answered(spark):
    folder = "/root/testdata/sf0.001"
    want = {r.pair_id for r in spark.read.parquet(f"{folder}/qa_pairs.parquet").where("question is not null").collect()}
    assert {r.query_id for r in catalog._all_questions(spark, folder).collect()} == want
    got = catalog.QUERIES["answered_questions"](spark, folder).select("request_id").collect()
    assert sorted(r.request_id for r in got) == sorted(want)


def test_no_frame_of_queries_and_clusters(spark, monkeypatch):
    """Every query finds every cluster by a word; what is shuffled has no row for each pair."""
    monkeypatch.setattr(serving.retrieval, "two_stage", None)
    asked = spark.createDataFrame([(i, f"freight number {i % 5} at the gate") for i in range(40)], "request_id long, text string")
    chunks = spark.createDataFrame([("a", "Freight is weighed at the gate", 6)], "chunk_id string, text string, token_count int").withColumn("embedding", embed(F.col("text")))
    terms = []
    lexical = serving.retrieval.lexical_clusters
    monkeypatch.setattr(serving.retrieval, "lexical_clusters", lambda t, *more: terms.append(t.count()) or lexical(t, *more))
    got = serving.answer(asked, clusters(spark, [(f"0.{i}", "freight", ["a"]) for i in range(30)]), chunks).collect()
    assert len(got) == 40 and all("Freight" in r.context for r in got)
    # Different terms only: 40 questions in three ways are 120 queries.
    assert len(terms) == 1 and terms[0] < 100
