"""Drift between the chunks of a cluster and the chunks that retrieval returns for it, and cluster records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.text import ancestors, level_of
from quire.operators.retrieval import cosine


def subtree_chunks(leaf_chunks: DataFrame) -> DataFrame:
    """(cluster_id, chunk_id) of every node's subtree, duplicates kept."""
    return leaf_chunks.select(F.explode(ancestors(F.col("cluster_id"))).alias("cluster_id"), "chunk_id")


def overlap_distance(original: DataFrame, matched: DataFrame, nodes: DataFrame) -> DataFrame:
    """1 - common / all different chunks of a node's own and retrieved ones; null where both are empty."""
    a = original.select("cluster_id", "chunk_id", F.lit(1).alias("o"), F.lit(0).alias("m"))
    b = matched.select("cluster_id", "chunk_id", F.lit(0).alias("o"), F.lit(1).alias("m"))
    per = a.unionByName(b).groupBy("cluster_id", "chunk_id").agg(F.max("o").alias("o"), F.max("m").alias("m"))
    counts = per.groupBy("cluster_id").agg(F.sum(F.col("o") * F.col("m")).alias("common"), F.count("*").alias("every"))
    return nodes.select("cluster_id").join(counts, "cluster_id", "left").select("cluster_id", F.round(1 - F.col("common") / F.col("every"), 6).alias("overlap_distance"))


def mean_vectors(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """(cluster_id, center): mean of the vectors of a node's chunks; duplicates weigh."""
    values = pairs.join(vectors.select("chunk_id", "embedding"), "chunk_id").select("cluster_id", F.posexplode("embedding").alias("pos", "x"))
    mean = values.groupBy("cluster_id", "pos").agg(F.avg(F.col("x").cast("double")).alias("value"))
    return mean.groupBy("cluster_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"]).alias("center"))


def semantic_shift(original: DataFrame, matched: DataFrame, vectors: DataFrame, nodes: DataFrame) -> DataFrame:
    """1 - cosine of the mean vectors of a node's own and retrieved chunks; null where one side has none or is zero."""
    a = mean_vectors(original, vectors).withColumnRenamed("center", "a")
    b = mean_vectors(matched, vectors).withColumnRenamed("center", "b")
    both = nodes.select("cluster_id").join(a, "cluster_id", "left").join(b, "cluster_id", "left")
    return both.select("cluster_id", F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), F.round(1 - cosine(F.col("a"), F.col("b")), 6)).alias("semantic_shift"))


def drift_global(drift: DataFrame) -> DataFrame:
    """One row of statistics over nodes with chunks: ``drift`` has size, overlap_distance, semantic_shift."""
    cols = []
    for c in ("overlap_distance", "semantic_shift"):
        cols += [F.round(F.avg(c), 6).alias(f"{c}_mean"), F.round(F.max(c), 6).alias(f"{c}_max"), F.round(F.sum(F.col(c) * F.col("size")) / F.sum("size"), 6).alias(f"{c}_weighted")]
        cols += [F.round(F.percentile(c, F.lit(p / 100)), 6).alias(f"{c}_p{p}") for p in (25, 50, 75, 95)]
    return drift.where("size > 0").agg(*cols)


def drift_by_depth(drift: DataFrame) -> DataFrame:
    """Per depth (root 0): mean overlap and shift, and the larger count of the two."""
    return drift.groupBy(level_of(F.col("cluster_id")).alias("depth")).agg(F.round(F.avg("overlap_distance"), 6).alias("overlap_mean"), F.round(F.avg("semantic_shift"), 6).alias("shift_mean"), F.greatest(F.count("overlap_distance"), F.count("semantic_shift")).alias("cluster_count"))


def lineage(nodes: DataFrame, skip: int = 3) -> DataFrame:
    """(cluster_id, lineage): labels from the root to the node, missing ones left out, without the first ``skip``."""
    up = nodes.select("cluster_id", F.posexplode(ancestors(F.col("cluster_id"))).alias("pos", "id"))
    named = up.join(nodes.select(F.col("cluster_id").alias("id"), "label").where("label is not null and label <> ''"), "id")
    path = F.transform(F.array_sort(F.collect_list(F.struct("pos", "label"))), lambda x: x["label"])
    found = named.groupBy("cluster_id").agg(path.alias("labels"))
    empty = F.array().cast("array<string>")
    return nodes.select("cluster_id").join(found, "cluster_id", "left").select("cluster_id", F.when(F.size("labels") > skip, F.slice("labels", skip + 1, 1000)).otherwise(empty).alias("lineage"))


def heading_top(retrieved: DataFrame, n: int = 5) -> DataFrame:
    """Per cluster the ``n`` most frequent heading paths of its chunks (cluster_id, heading_path array), ties by text."""
    key = F.array_join("heading_path", " > ")
    counted = retrieved.where(F.size("heading_path") > 0).groupBy("cluster_id", key.alias("heading")).agg(F.count("*").alias("n"))
    return counted.withColumn("rank", F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.desc("n"), "heading"))).where(F.col("rank") <= n)


def embedding_text(label: Column, summary: Column, keywords: Column, lineage_: Column, headings: Column) -> Column:
    """The text that a cluster record is embedded by: its non-empty parts, one per line."""
    empty = F.lit("")
    parts = F.array(F.coalesce(label, empty), F.coalesce(summary, empty), F.coalesce(F.array_join(keywords, ", "), empty), F.coalesce(F.array_join(lineage_, " | "), empty), F.coalesce(F.array_join(headings, " | "), empty))
    return F.array_join(F.filter(parts, lambda x: x != ""), "\n")


def cluster_records(nodes: DataFrame, drift: DataFrame, lineages: DataFrame, headings: DataFrame, matched: DataFrame, leaf_chunks: DataFrame) -> DataFrame:
    """Assembled records: label parts, depth, drift, lineage, headings, retrieved and leaf chunks as typed columns."""
    top = headings.groupBy("cluster_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "heading"))), lambda x: x["heading"]).alias("semantic_heading_path"))
    found = matched.groupBy("cluster_id").agg(F.array_sort(F.collect_set("chunk_id")).alias("cluster_chunks"))
    own = leaf_chunks.groupBy("cluster_id").agg(F.array_sort(F.collect_set("chunk_id")).alias("leaf_chunks"))
    r = nodes.join(drift, "cluster_id", "left").join(lineages, "cluster_id", "left").join(top, "cluster_id", "left").join(found, "cluster_id", "left").join(own, "cluster_id", "left")
    return r.select("cluster_id", "label", "summary", "keywords", F.struct("is_leaf", level_of(F.col("cluster_id")).alias("depth"), F.struct("overlap_distance", "semantic_shift").alias("drift"), F.col("lineage").alias("semantic_lineage_path"), "semantic_heading_path").alias("metadata"), "cluster_chunks", "leaf_chunks",
                    embedding_text(F.col("label"), F.col("summary"), F.col("keywords"), F.col("lineage"), F.col("semantic_heading_path")).alias("embedding_text"))
