"""Extraction tasks per cluster: which are due, their inputs, baselines of clusters, and several prompts per chunk."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.models import Client, MockClient, complete


@dataclass(frozen=True)
class TaskSpec:
    """One kind of information: for leaves, inner clusters or both; made from chunks or from another kind; with so many neighbouring texts."""

    info_type: str
    on_leaves: bool
    on_inner: bool
    source: str | None = None
    neighbours: int = 0
    from_children: bool = False


# The kinds of information, where they are made and from what.
SPECS = (
    TaskSpec("concept", True, True), TaskSpec("process_b", True, True), TaskSpec("BO", True, True), TaskSpec("keywords", True, False), TaskSpec("questions", True, False),
    TaskSpec("steps", True, False, "process_b"), TaskSpec("steps", False, True, "process_b", 10),
    TaskSpec("WHY", True, False, "questions", 10), TaskSpec("WHAT", True, False, "questions", 10), TaskSpec("WHEN", True, False, "questions", 10), TaskSpec("HOW", True, False, "questions", 10),
    TaskSpec("B_Context", True, False, "process_b"), TaskSpec("B_Context", False, True, None, 0, True),
)


def spec_table(spark: SparkSession, specs: tuple[TaskSpec, ...] = SPECS) -> DataFrame:
    return spark.createDataFrame([(s.info_type, s.on_leaves, s.on_inner, s.source, s.neighbours, s.from_children) for s in specs], "info_type string, on_leaves boolean, on_inner boolean, source string, neighbours int, from_children boolean")


def due_tasks(nodes: DataFrame, done: DataFrame, specs: DataFrame) -> DataFrame:
    """Tasks to do next: cluster_id, info_type, source, neighbours, from_children.

    A task is due for each cluster (cluster_id, is_leaf) and spec of its kind that has no
    output in ``done`` (cluster_id, info_type) yet, and whose source has one.  The specs
    are a handful of rows and are broadcast.
    """
    wanted = nodes.select("cluster_id", F.coalesce("is_leaf", F.lit(False)).alias("is_leaf")).join(F.broadcast(specs), F.when(F.col("is_leaf"), F.col("on_leaves")).otherwise(F.col("on_inner")))
    have = done.select("cluster_id", "info_type").distinct()
    due = wanted.join(have, ["cluster_id", "info_type"], "left_anti")
    ready = due.join(have.withColumnRenamed("info_type", "source"), ["cluster_id", "source"], "left_semi").select(*due.columns)
    return due.where("source is null").unionByName(ready).select("cluster_id", "info_type", "source", "neighbours", "from_children")


def child_outputs(outputs: DataFrame) -> DataFrame:
    """What inner clusters are made of where a spec says ``from_children``: the payloads of the children in path order."""
    from quire.functions.text import parent_id, path_of

    up = outputs.select(parent_id(F.col("cluster_id")).alias("parent"), "info_type", path_of(F.col("cluster_id")).alias("path"), "payload").where("parent is not null and payload is not null")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("path", "payload"))), lambda x: x["payload"])
    return up.groupBy(F.col("parent").alias("cluster_id"), "info_type").agg(F.array_join(listed, "\n\n").alias("input"))


def baseline_inputs(nodes: DataFrame, matching: DataFrame, chunks: DataFrame, done: DataFrame, top: int = 10) -> DataFrame:
    """Clusters without a baseline: cluster_id, label, chunks (how many), input (the texts of the best ``top`` matches that exist, in rank order).

    ``matching``: cluster_id, rank, chunk_id.
    """
    first = matching.where(F.col("rank") <= top).join(chunks.select("chunk_id", "text").where("text is not null"), "chunk_id")
    texts = first.groupBy("cluster_id").agg(F.count("*").alias("chunks"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda x: x["text"]), "\n\n").alias("input"))
    todo = nodes.select("cluster_id", "label").join(done.select("cluster_id").distinct(), "cluster_id", "left_anti")
    return todo.join(texts, "cluster_id", "left").select("cluster_id", "label", F.coalesce("chunks", F.lit(0)).cast("long").alias("chunks"), "input")


def baselines(inputs: DataFrame, factory: Callable[[], Client] = MockClient, tries: int = 3) -> DataFrame:
    """Baseline records: cluster_id, payload (label, summary, keywords, entities, processes, relationships as JSON), status.

    After ``tries`` answers without an object the record is an error record with empty
    lists, so that a cluster is never lost.
    """
    prompt = F.concat(F.lit("Describe the texts as one JSON object with label, summary, keywords, entities, processes and relationships (source, target, type).\n\n"), F.coalesce("input", F.lit("")))
    done = complete(inputs.withColumn("prompt", prompt), factory, tries)
    none = F.array().cast("array<string>")
    failed = F.to_json(F.struct(F.lit("ERROR").alias("label"), F.lit("").alias("summary"), *[none.alias(c) for c in ("keywords", "entities", "processes", "relationships")]))
    return done.select("cluster_id", F.coalesce("payload", failed).alias("payload"), "status")


def baseline_status(nodes: DataFrame, done: DataFrame) -> DataFrame:
    """One row per level: clusters expected, done and missing."""
    from quire.functions.text import level_of

    have = done.select("cluster_id").distinct().withColumn("d", F.lit(1))
    n = nodes.select("cluster_id", level_of(F.col("cluster_id")).alias("level")).join(have, "cluster_id", "left")
    return n.groupBy("level").agg(F.count("*").alias("expected"), F.count("d").alias("done"), (F.count("*") - F.count("d")).alias("missing"))


def chunk_prompts(chunks: DataFrame, prompts: dict[str, str], factory: Callable[[], Client] = MockClient) -> DataFrame:
    """Several prompts for every chunk: chunk_id and a column per prompt with its JSON, or the raw answer where it holds none."""
    named = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.lit(v).alias("head")) for k, v in prompts.items()]))
    asked = complete(chunks.select("chunk_id", "text", named.alias("p")).select("chunk_id", F.col("p.name").alias("name"), F.concat("p.head", F.lit("\n\n"), F.coalesce("text", F.lit(""))).alias("prompt")), factory, tries=1)
    return asked.groupBy("chunk_id").pivot("name", list(prompts)).agg(F.first(F.coalesce("payload", "answer")))
