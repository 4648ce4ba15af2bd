import json

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import documents as D
from quire.operators import models as M
from quire.operators import store as S
from quire.sources import readers as R
from quire.streaming import ingest as I


def test_upsert(spark):
    old = spark.createDataFrame([("a", "d1", 1), ("b", "d1", 1), ("c", "d2", 1)], "id string, document_name string, v int")
    new = spark.createDataFrame([("a", "d1", 2), ("c", "d3", 2)], "id string, document_name string, v int")
    got = {r.id: r.v for r in S.upsert(old, new, F.col("document_name") == "d1").collect()}
    assert got == {"a": 2, "c": 2}
    with pytest.raises(ValueError):
        S.upsert(old, new.unionAll(new))


def test_collection(spark, tmp_path):
    c = S.Collection(spark, str(tmp_path / "c"))
    with pytest.raises(FileNotFoundError):
        c.all()
    rows = spark.createDataFrame([("a", "x", [1.0]), ("b", "y", [2.0])], "id string, document_name string, embedding array<double>")
    c.add(rows)
    c.upsert(spark.createDataFrame([("b", "z", [3.0])], rows.schema))
    assert c.count() == 2 and c.delete(F.col("document_name") == "z") == 1 and c.count() == 1
    assert c.lookup(spark.createDataFrame([("a",), ("q",)], "id string")).where("document_name is null").count() == 1
    assert c.for_clustering("document_name", "missing").columns == ["id", "embedding", "document_name", "missing"]
    c.drop()
    assert not c.versions()


def test_collection_rewrites_only_what_it_must(spark, tmp_path):
    c = S.Collection(spark, str(tmp_path / "c"))
    schema = "id string, document_name string, v int"
    for i, name in enumerate("abc"):
        c.add(spark.createDataFrame([(f"{name}{k}", name, i) for k in range(3)], schema))
    first = c.parts()
    c.upsert(spark.createDataFrame([("b1", "b", 9), ("n", "new", 9)], schema))
    second = c.parts()
    assert [p for p in first if p in second] == [first[0], first[2]] and len(second) == 3
    assert {r.id: r.v for r in c.all().where("document_name IN ('b', 'new')").collect()} == {"b0": 1, "b1": 9, "b2": 1, "n": 9}
    c.upsert(spark.createDataFrame([("z", "c", 5)], schema), F.col("document_name") == "c")
    assert first[0] in c.parts() and {r.id for r in c.all().where("document_name = 'c'").collect()} == {"z"}
    assert c.delete(F.col("v") == 100) == 0 and c.delete(F.col("id") == "z") == 1
    c.add(spark.createDataFrame([("w", 7)], "id string, extra int"))
    assert c.count() == 8 and c.all().where("extra = 7").count() == 1
    c.compact()
    assert len(c.parts()) == 1 and c.count() == 8 and c.versions() == list(range(1, 9))
    fs, path = c._path("versions", "9.json")
    fs.create(path, False).close()
    with pytest.raises(Exception, match="exists|Exists"):
        fs.create(path, False)


def test_json_salvage(spark):
    cases = {'```json\n{"a": "}"}\n```': {"a": "}"}, 'text {"a": {"b": "\\"}"}} more': {"a": {"b": '"}'}}, "{'a': None,}": {"a": None}, '{"a": 1,} // end\n': {"a": 1}, "nothing": None, "": None, None: None, '{"a": "True"}': {"a": "True"}}
    for text, want in cases.items():
        assert M.salvage(text) == want
    df = spark.createDataFrame([(k,) for k in cases], "t string").select(M.salvaged_json("t").alias("j")).collect()
    assert [None if r.j is None else json.loads(r.j) for r in df] == list(cases.values())


class Failing:
    def complete(self, prompt):
        if "bad" in prompt:
            raise OSError("down")
        return "no object" if "none" in prompt else '{"ok": 1}'


def test_completion_status(spark):
    df = spark.createDataFrame([("good",), ("bad",), ("none",)], "prompt string")
    assert {r.prompt: r.status for r in M.complete(df, Failing).collect()} == {"good": "done", "bad": "error", "none": "incomplete"}


def test_labels_bottom_up(spark):
    nodes = spark.createDataFrame([("0",), ("0.0",), ("0.1",)], "cluster_id string")
    texts = spark.createDataFrame([("0.0", "alpha letters here"), ("0.1", None)], "cluster_id string, text string")
    got = {r.cluster_id: r for r in M.label_tree(nodes, texts).collect()}
    assert set(got) == {"0", "0.0", "0.1"} and all(r.label.strip() for r in got.values()) and got["0"].status == "done"


def test_readers(spark, tmp_path):
    rows = [{"document_name": "m", "chunk_id": 1, "text": "a b", "token_count": None}, {"document_name": "m", "chunk_id": 2, "text": "", "image_paths": ["p.jpg"]}, {"document_name": "m", "chunk_id": 3, "text": " "}]
    (tmp_path / "m_chunks.json").write_text(json.dumps(rows))
    paths = R.resolve(spark, str(tmp_path), "re:m_.*json")
    assert paths == R.resolve(spark, str(tmp_path), "*_chunks.json") == R.resolve(spark, str(tmp_path), "m_chunks.json")
    with pytest.raises(FileNotFoundError):
        R.resolve(spark, str(tmp_path), "x")
    got = R.structural_chunks(spark, paths).orderBy("chunk_id").collect()
    assert [(r.chunk_id, r.token_count) for r in got] == [(1, 2), (2, 0)]
    tree = {"clusters": [{"cluster_id": "0", "size": 2, "children": {"clusters": [{"cluster_id": "0.0", "size": 1, "children": None, "chunk_ids": ["x"]}, {"cluster_id": "0.1", "size": 1, "children": None, "ids": ["y"]}]}}]}
    (tmp_path / "tree.json").write_text(json.dumps(tree))
    nodes, leaves = R.hierarchy(spark, str(tmp_path / "tree.json"))
    assert nodes.count() == 3 and {(r.cluster_id, r.chunk_id) for r in leaves.collect()} == {("0.0", "x"), ("0.1", "y")}


def test_streaming_ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(json.dumps({"document_name": "m", "chunk_id": i, "text": f"text {i % 2}"}) for i in range(4)))
    c = S.Collection(spark, str(tmp_path / "c"))
    I.ingest(spark, str(tmp_path / "in"), c, str(tmp_path / "ck")).awaitTermination()
    assert c.count() == 2
    (tmp_path / "in" / "b.json").write_text(json.dumps({"document_name": "m", "chunk_id": 9, "text": "text 9"}))
    I.ingest(spark, str(tmp_path / "in"), c, str(tmp_path / "ck")).awaitTermination()
    assert c.count() == 3


def test_stream_windows(spark, tmp_path):
    src = spark.createDataFrame([("2024-01-01 00:10:00", "a", 1.0), ("2024-01-01 00:50:00", "a", 2.0), ("2024-01-01 01:10:00", "b", 3.0)], "ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    src.write.parquet(str(tmp_path / "e"))
    q = I.windowed_counts(spark.readStream.schema(src.schema).parquet(str(tmp_path / "e"))).writeStream.outputMode("complete").format("memory").queryName("w").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.event_type, r.n, r.total) for r in spark.table("w").collect()} == {("a", 2, 3.0), ("b", 1, 3.0)}


def test_text_rules(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(T.xml_safe(F.lit("a­ & <b>–„q“\x01"))) == 'a &amp; &lt;b&gt;-"q"'
    assert one(T.repaired_json(F.lit("x {'a': None,} /* c */ y"))) == '{"a": null}'
    assert one(T.repaired_json(F.lit("}{"))) == "" and one(T.repaired_json(F.lit("none"))) == "none"
    assert one(T.safe_id(F.lit("a::b c/d\\e>f<g"))) == "a__b_c_d_e_f_g"
    assert one(T.merged_lines(F.lit(" 12 ; a\n\n b"))) == "a\nb"
    assert one(T.ancestors(F.lit("0.1.12"))) == ["0", "0.1", "0.1.12"] and one(T.parent_id(F.lit("0"))) is None
    assert one(T.content_id(F.lit(""), F.array(F.lit("p"), F.lit("q")))) == one(F.md5(F.lit("p q")))


def test_exports(spark, tmp_path):
    leaf = spark.createDataFrame([("0.0", "x"), ("0.1", "y"), ("0.1", "gone")], "cluster_id string, chunk_id string")
    chunks = spark.createDataFrame([("x", "text", "m", [1, 2], ["H"], None, 3, "a"), ("y", "text", "m", [1], None, ["p"], 4, None)], "chunk_id string, chunk_type string, document_name string, pages array<int>, heading_path array<string>, image_paths array<string>, token_count int, chunk_text_class string")
    D.write_csv(D.chunk_rows(leaf, chunks), str(tmp_path / "csv"))
    assert spark.read.option("sep", ";").option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "csv")).count() == 2
    assert D.printed_tree(D.tree_rows(leaf, chunks)).split("\n")[0] == "0 (3 chunks)"
    assert "total: 3" in D.results_markdown(leaf)
