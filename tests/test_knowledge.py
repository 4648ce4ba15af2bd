"""Operators on fixtures: text classes, metadata, label cache, extraction tasks, baselines, ontology steps, documents as files, searches in groups."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import docx, enrich, extraction, models, ontology, retrieval


class Names:
    def complete(self, prompt):
        return {"a": "1. letter.", "b": "EMAIL", "c": "poem"}[prompt.partition("<<<")[2][0]]


def test_text_classes(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None), (5, " ")], "id int, text string")
    assert {r.id: r.chunk_text_class for r in enrich.classify_texts(df, factory=Names).collect()} == {1: "Letter", 2: "Email", 3: "Other", 4: None, 5: None}


def test_clean_metadata_and_blocks(spark):
    df = spark.createDataFrame([(1, [], ["x"], [("heading", "T", 1, 2, "s")])], "id int, pages array<int>, images array<string>, blocks array<struct<kind:string,text:string,page_num:int,heading_level:int,spans:string>>")
    got = enrich.clean_metadata(df).first()
    assert got.asDict() == {"id": 1, "pages": None, "images": ["x"]}
    assert df.select(enrich.simplified_blocks(F.col("blocks"))).first()[0] == '[{"kind":"heading","text":"T","page_num":1,"heading_level":2}]'


class Counting:
    def complete(self, prompt):
        return '{"EN": {"summary": "new", "label": "New", "keywords": ["k"]}}'


def test_label_cache_and_repair(spark):
    nodes = spark.createDataFrame([("0",), ("0.0",), ("0.1",)], "cluster_id string")
    texts = spark.createDataFrame([("0.0", "t"), ("0.1", "t")], "cluster_id string, text string")
    cache = spark.createDataFrame([("0.0", None, "DE", "old", "Old"), ("0.1", None, "DE", "", "Blank")], f"cluster_id string, multilang {models.BLOCK}, source_language string, summary string, label string")
    got = {r.cluster_id: (r.label, r.status) for r in models.label_tree(nodes, texts, Counting, cache).collect()}
    assert got == {"0": ("New", "done"), "0.0": ("Old", "cached"), "0.1": ("New", "done")}
    shown = spark.createDataFrame([("0", "L", "S", ["k"]), ("0.0", " ", "S", ["k"]), ("0.1", "L", None, ["k"]), ("0.2", "L", "S", []), ("0.3", "L", "S", None)], "cluster_id string, label string, summary string, keywords array<string>")
    assert sorted(r.cluster_id for r in models.missing_labels(shown).collect()) == ["0.0", "0.1", "0.2", "0.3"]


def test_language_choice(spark):
    n = spark.createDataFrame([("0", None), ("0.10", ["FR"]), ("0.2", ["DE", "EN"]), ("0.3", [])], "cluster_id string, languages array<string>")
    assert models.language_pick(n).first().language == "DE" and models.language_pick(n, "IT").first().language == "IT"
    assert models.language_pick(n.where("cluster_id = '0'")).count() == 0
    codes = spark.createDataFrame([(" de ",), ("German",), (None,), ("e1",)], "a string").select(models.language_code(F.col("a")).alias("c"))
    assert [r.c for r in codes.collect()] == ["DE", "EN", "EN", "EN"]


def test_due_tasks_and_baselines(spark):
    nodes = spark.createDataFrame([("0", False, "root"), ("0.0", True, "leaf")], "cluster_id string, is_leaf boolean, label string")
    done = spark.createDataFrame([("0.0", "questions"), ("0.0", "WHY"), ("0", "concept")], "cluster_id string, info_type string")
    got = {(r.cluster_id, r.info_type) for r in extraction.due_tasks(nodes, done, extraction.spec_table(spark)).collect()}
    assert got == {("0", "process_b"), ("0", "BO"), ("0", "B_Context"), *(("0.0", k) for k in ("concept", "process_b", "BO", "keywords", "WHAT", "WHEN", "HOW"))}
    matching = spark.createDataFrame([("0.0", 2, "b"), ("0.0", 1, "a"), ("0.0", 3, "x")], "cluster_id string, rank int, chunk_id string")
    chunks = spark.createDataFrame([("a", "A"), ("b", "B"), ("x", None)], "chunk_id string, text string")
    inputs = {r.cluster_id: (r.chunks, r.input) for r in extraction.baseline_inputs(nodes, matching, chunks, done.where("false")).collect()}
    assert inputs == {"0": (0, None), "0.0": (2, "A\n\nB")}


class Failing:
    def complete(self, prompt):
        raise RuntimeError("down")


def test_failed_baselines_are_records(spark):
    rows = extraction.baselines(spark.createDataFrame([("0", "l", 0, "t")], "cluster_id string, label string, chunks long, input string"), Failing).collect()
    assert '"label":"ERROR"' in rows[0].payload and rows[0].status == "error"
    raw = extraction.chunk_prompts(spark.createDataFrame([(1, "a")], "chunk_id int, text string"), {"x": "X.", "y": "Y."}, Failing).first()
    assert raw.x.startswith("[ERROR") and raw.y.startswith("[ERROR")


def test_ontology_steps(spark):
    schema = "cluster_id string, label string, entities array<string>, processes array<string>, relationships array<struct<source:string,target:string,type:string>>"
    base = spark.createDataFrame([("0", "l", ["pump", "tank"], ["fill"], [("pump", "tank", None)])], schema)
    nodes = spark.createDataFrame([("0",), ("0.1",)], "cluster_id string")
    b = ontology.loaded_baselines(nodes, base)
    assert {r.cluster_id: len(r.entities) for r in b.collect()} == {"0": 2, "0.1": 0}
    out = ontology.run_part(b, "entities", Failing)
    assert out.count() == 6 and all('"name":"' in r.payload and r.status == "error" for r in out.collect())
    done = spark.createDataFrame([("Entities_Step_1", "0", 0, '{"name": "kept"}'), ("Entities_Step_1", "0", 1, "{broken")], "step string, cluster_id string, idx int, payload string")
    again = {(r.step[-1], r.idx): (r.payload, r.status) for r in ontology.run_part(b, "entities", Failing, done).collect()}
    assert again["1", 0] == ('{"name": "kept"}', "kept") and again["3", 0][0] == '{"name": "kept"}' and '"tank"' in again["1", 1][0]
    assert ontology.run_part(b, "attributes").count() == 0
    states = {r.step: r.state for r in ontology.step_states(out.where("step <> 'Entities_Step_3' and (step = 'Entities_Step_1' or idx = 0)"), models.ontology_tasks(b, "entities"), "entities").collect()}
    assert states == {"Entities_Step_1": "completed", "Entities_Step_2": "running", "Entities_Step_3": "pending"}


class Upper:
    def complete(self, prompt):
        return "" if "keep" in prompt else prompt.split("\n\n", 1)[1].upper()


def test_documents_round_trip(spark):
    nodes = spark.createDataFrame([("0", "Root & <all>", "Sum"), ("0.10", "Ten", None), ("0.2", None, "Two\nlines")], "cluster_id string, label string, summary string")
    qa = spark.createDataFrame([("0.2", "WHY", 2, "Q2?", None), ("0.2", "WHY", 1, "Q1?", "A1"), ("9", "WHY", 1, "lost", "x"), ("0.2", "HOW", 1, None, "x")], "cluster_id string, info_type string, item_no int, question string, answer string")
    files = docx.render(docx.document_rows(nodes, qa).withColumn("doc", F.lit("d")))
    p = docx.read_paragraphs(files).orderBy("idx").collect()
    assert [(r.style, r.text) for r in p] == [("Heading1", "Root & <all>"), ("Normal", "Sum"), ("Heading2", ""), ("Normal", "Two\nlines"), ("Heading3", "Q1?"), ("Normal", "A1"), ("Heading3", "Q2?"), ("Normal", ""), ("Heading2", "Ten")]
    assert docx.read_paragraphs(spark.createDataFrame([("x", b"no zip"), ("y", None)], "doc string, content binary")).count() == 0
    rows = spark.createDataFrame([("d", 0, "Normal", "abc", False, False), ("d", 1, "TOC1", "contents", False, True), ("d", 2, "Normal", "12", False, False), ("d", 3, "Normal", "keep", False, False)], "doc string, idx int, style string, text string, has_break boolean, in_toc boolean")
    assert {r.idx: (r.text, r.changed) for r in docx.rewritten(rows, "Shout.", Upper).collect()} == {0: ("ABC", True), 1: ("contents", False), 2: ("12", False), 3: ("keep", False)}


def test_bm25_against_brute_force(spark):
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(["the", "a", *[f"w{i}" for i in range(40)]], int(rng.integers(0, 30)), p=[0.3, 0.1, *[0.6 / 40] * 40])) or None for _ in range(300)]
    asked = ["the w1 w1 w3", "w5", "nothing here", "a", None]
    chunks = spark.createDataFrame(list(enumerate(texts)), "chunk_id int, text string")
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id int, text string")
    docs = [Counter((t or "").split()) for t in texts]
    df = Counter(w for d in docs for w in d)
    raw = {w: math.log(len(docs) - n + 0.5) - math.log(n + 0.5) for w, n in df.items()}
    mean = sum(raw.values()) / len(raw)
    idf = {w: v if v >= 0 else 0.25 * mean for w, v in raw.items()}
    size = [sum(d.values()) for d in docs]
    want = {}
    for q, text in enumerate(asked):
        words = Counter((text or "").split())
        scores = [(round(sum(n * idf[w] * d[w] * 2.5 / (d[w] + 1.5 * (0.25 + 0.75 * size[i] / (sum(size) / len(size)))) for w, n in words.items() if w in d), 6), i) for i, d in enumerate(docs) if set(words) & set(d)]
        for rank, (s, i) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:7]):
            want[q, rank + 1] = (i, s)
    got = {(r.query_id, r["rank"]): (r.chunk_id, round(r.score, 6)) for r in retrieval.bm25_topk(chunks, queries, 7, block=16).collect()}
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 2e-6 for k in want)
    assert retrieval.bm25_topk(chunks.limit(0), queries, 7).count() == 0


def test_search_within_groups(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((200, 6))
    v = spark.createDataFrame([(i, r.tolist(), None if i % 10 == 9 else i % 3) for i, r in enumerate(x)], "id long, embedding array<double>, label int")
    q = v.where("id % 20 = 0").select(F.col("id").alias("query_id"), "embedding", "label")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = {}
    for r in retrieval.dense_topk(q, v, 4, within="label").collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.id
    for i in range(0, 200, 20):
        mine = [j for j in range(200) if j % 10 != 9 and j % 3 == i % 3]
        assert [got[i][k] for k in (1, 2, 3, 4)] == sorted(mine, key=lambda j: (-round(float(u[i] @ u[j]), 6), j))[:4]
    clusters = spark.createDataFrame([(c, x[c].tolist(), [int(j) for j in range(200) if j % 5 in (c, c + 1)]) for c in range(4)], "id long, embedding array<double>, chunks array<long>")
    routed = {}
    for r in retrieval.two_stage(q.select("query_id", "embedding"), clusters, v.select("id", "embedding"), 2, 5).collect():
        routed.setdefault(r.query_id, []).append((r["rank"], r.id))
    for i in range(0, 200, 20):
        best = sorted(range(4), key=lambda c: (-round(float(u[i] @ u[c]), 6), c))[:2]
        mine = {j for c in best for j in range(200) if j % 5 in (c, c + 1)}
        assert [j for _, j in sorted(routed[i])] == sorted(mine, key=lambda j: (-round(float(u[i] @ u[j]), 6), j))[:5]


def test_checkpoint_folder_is_asked_for_on_clusters():
    from quire.functions.cut import ensure_checkpoint_dir

    class Missing:
        def isDefined(self):
            return False

    class Fake:
        def __getattr__(self, name):
            return self

        def __call__(self, *a):
            return self

        def getCheckpointDir(self):
            return Missing()

        master = "yarn"

        def get(self, key, default=None):
            return default

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Fake())


def test_patterns_are_valid():
    assert all(re.compile(p) for p in enrich._RULES.values()) and len(enrich.TEXT_CLASSES) == 12
