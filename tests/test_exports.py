from pyspark.sql import functions as F

from quire.operators import documents as D
from quire.operators import drift
from quire.operators import hierarchy as H
from quire.operators import models as M


def test_nested_tree_and_summary(spark):
    leaf = spark.createDataFrame([("0.0", "a"), ("0.10", "b"), ("0.2", "c"), ("0.2", "d")], "cluster_id string, chunk_id string")
    tree = D.nested_tree(H.nodes_of(leaf), leaf)
    assert tree["total_clusters"] == 4 and [c["cluster_id"] for c in tree["clusters"][0]["children"]["clusters"]] == ["0.0", "0.2", "0.10"]
    assert tree["clusters"][0]["children"]["clusters"][1]["chunk_ids"] == ["c", "d"]
    text = D.build_summary({"cutoff": 0.5}, H.lossless_check(leaf.select("chunk_id"), leaf), H.level_summary(H.nodes_of(leaf), leaf))
    assert "missing: 0" in text and "1: 3 clusters, 4 leaf chunks" in text


def test_stubs_views_and_merging(spark):
    one = spark.range(1)
    c = F.lit("0.1")
    r = one.select(M.relationship_stub(c, F.lit(2), F.lit("A"), F.lit("B"), F.lit(None).cast("string")).alias("x"), M.process_stub(c, F.lit(3), F.lit("P")).alias("y")).first()
    assert r.x.id == "0.1::rel::2" and r.x.type == "related_to" and r.y.id == "0.1::proc::3" and r.y.steps == []
    assert [x[0] for x in spark.createDataFrame([("Part of",), ("likes",)], "k string").select(M.valid_relationship(F.col("k"))).collect()] == [True, False]
    lab = spark.createDataFrame([("0", {"EN": ("s", "l", ["k"])}), ("1", {"DE": ("s", "l", None)})], f"cluster_id string, multilang {M.BLOCK}")
    assert [x.cluster_id for x in M.language_view(lab, "EN").collect()] == ["0"]
    bo = spark.createDataFrame([("0.0", "Order", ["a"]), ("0.1", "Order", ["b", "a"]), ("0.1", "Roll", None)], "cluster_id string, bo_name string, bo_transitions array<string>")
    assert {(x.cluster_id, x.bo_name): x.bo_transitions for x in M.merged_objects(bo).collect()} == {("0", "Order"): ["a", "b"], ("0", "Roll"): []}


def test_extraction_inputs(spark):
    nodes = spark.createDataFrame([("0",), ("0.0",), ("0.1",)], "cluster_id string")
    texts = spark.createDataFrame([("0.0", "t0"), ("0.1", "t1")], "cluster_id string, text string")
    done = spark.createDataFrame([("0.0", "concept", "{}"), ("0.1", "concept", "broken{"), ("0.1", "questions", '{"q": 1}')], "cluster_id string, info_type string, payload string")
    assert [r.cluster_id for r in M.extraction_inputs(nodes, texts, done, "concept").collect()] == ["0.1"]
    near = spark.createDataFrame([("0.1", 1, "n1"), ("0.1", 2, "n2")], "cluster_id string, rank int, text string")
    got = M.extraction_inputs(nodes, texts, done, "WHY", "questions", near, 1).collect()
    assert [(r.cluster_id, r.input) for r in got] == [("0.1", '{"q": 1}\n\nt1\n\nn1')]


def test_drift_edges(spark):
    nodes = spark.createDataFrame([("0",), ("0.0",), ("0.1",)], "cluster_id string")
    own = spark.createDataFrame([("0.0", "a"), ("0.0", "b"), ("0.1", "c")], "cluster_id string, chunk_id string")
    got = {r.cluster_id: r.overlap_distance for r in drift.overlap_distance(own, spark.createDataFrame([("0.0", "a")], own.schema), nodes).collect()}
    assert got == {"0": None, "0.0": 0.5, "0.1": 1.0}
    v = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 0.0]), ("c", [0.0, 0.0])], "chunk_id string, embedding array<double>")
    shift = {r.cluster_id: r.semantic_shift for r in drift.semantic_shift(own, own, v, nodes).collect()}
    assert shift == {"0": None, "0.0": 0.0, "0.1": None}
