"""Outlines, tree printing and exports of the knowledge base."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.text import ancestors, level_of, parent_id, path_of
from quire.operators.hierarchy import token_rollup, with_gaps_filled


def tree_rows(leaf_chunks: DataFrame, chunks: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Rows of a printed tree in order of their path: cluster_id, level, chunks, tokens, synthetic, path."""
    rows = with_gaps_filled(leaf_chunks.select("cluster_id").distinct()).join(token_rollup(leaf_chunks, chunks), "cluster_id", "left")
    out = rows.select("cluster_id", level_of(F.col("cluster_id")).alias("level"), F.coalesce("chunks", F.lit(0).cast("long")).alias("chunks"), F.coalesce("tokens", F.lit(0).cast("long")).alias("tokens"), "synthetic", path_of(F.col("cluster_id")).alias("path"))
    return out if max_depth is None else out.where(F.col("level") <= max_depth)


def printed_tree(rows: DataFrame) -> str:
    """The tree as text, for a tree that a person reads (sorted by path)."""
    return "\n".join(f"{'  ' * r['level']}{r['cluster_id']} ({r['chunks']} chunks)" for r in rows.orderBy("path").toLocalIterator())


def root_of(ids: DataFrame) -> DataFrame:
    """One row: the smallest id by path that is nobody's parent, and its first segment."""
    parents = ids.select(parent_id(F.col("cluster_id")).alias("cluster_id")).where("cluster_id is not null").distinct()
    leaf = ids.join(parents, "cluster_id", "left_anti").orderBy(path_of(F.col("cluster_id")), "cluster_id").limit(1)
    return leaf.select("cluster_id", F.substring_index("cluster_id", ".", 1).alias("root"))


def document_depth(nodes: DataFrame) -> DataFrame:
    """(cluster_id, depth, allowed, valid): depth of the deepest leaf below each inner node.

    Two levels are allowed, three where a child has children that are no leaves.
    """
    leaves = nodes.where("is_leaf").select(F.explode(ancestors(F.col("cluster_id"), with_self=False)).alias("cluster_id"), level_of(F.col("cluster_id")).alias("leaf_level"))
    deep = leaves.groupBy("cluster_id").agg(F.max("leaf_level").alias("deepest"))
    inner_grand = nodes.where("not is_leaf").select(parent_id(parent_id(F.col("cluster_id"))).alias("cluster_id")).where("cluster_id is not null").distinct().withColumn("mixed", F.lit(True))
    d = nodes.where("not is_leaf").select("cluster_id").join(deep, "cluster_id", "left").join(inner_grand, "cluster_id", "left")
    depth = F.coalesce(F.col("deepest") - level_of(F.col("cluster_id")), F.lit(0))
    allowed = F.when(F.coalesce("mixed", F.lit(False)), 3).otherwise(2)
    return d.select("cluster_id", depth.alias("depth"), allowed.alias("allowed"), (depth <= allowed).alias("valid"))


def outline(nodes: DataFrame, qa: DataFrame) -> DataFrame:
    """Document outlines: per cluster a header and its questions with answers by kind, in order.

    ``qa``: cluster_id, info_type, item_no, question, answer.
    """
    items = qa.where("question is not null").groupBy("cluster_id", "info_type").agg(F.transform(F.array_sort(F.collect_list(F.struct("item_no", "question", "answer"))), lambda x: F.struct(x["question"].alias("question"), x["answer"].alias("answer"))).alias("elements"))
    by_kind = items.groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct("info_type", "elements"))).alias("qa"))
    return nodes.select("cluster_id", F.struct("label", "summary", "keywords").alias("header")).join(by_kind, "cluster_id", "left")


def rewritable_paragraphs(paragraphs: DataFrame) -> DataFrame:
    """Paragraphs (doc, idx, text, style, has_break, in_toc) to rewrite, with their page and kind of text."""
    w = Window.partitionBy("doc").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    p = paragraphs.withColumn("page", 1 + F.sum(F.col("has_break").cast("int")).over(w)).withColumn("text_type", F.when(F.lower("style").startswith("heading"), "heading").otherwise("body"))
    return p.where(~F.col("in_toc") & F.col("text").rlike(r"\p{L}"))


def chunk_rows(leaf_chunks: DataFrame, chunks: DataFrame) -> DataFrame:
    """The rows of chunks.csv; entries whose chunk is missing are left out, lists are one line per element."""
    line = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), "\n")
    return leaf_chunks.join(chunks, "chunk_id").select("cluster_id", "chunk_id", "chunk_type", "document_name", line(F.col("pages")).alias("pages"), line(F.col("heading_path")).alias("heading_path"), line(F.col("image_paths")).alias("image_paths"), "token_count", "chunk_text_class")


def write_csv(df: DataFrame, folder: str) -> None:
    """Semicolon-separated text with a header, as many files as partitions."""
    df.write.mode("overwrite").option("sep", ";").option("header", True).option("quoteAll", True).option("escape", '"').csv(folder)


def write_json(df: DataFrame, folder: str, *partition: str) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition) if partition else w).json(folder)


def name_collisions(names: DataFrame) -> DataFrame:
    """Names (name) that become the same id once made safe: safe, names."""
    from quire.functions.text import safe_id

    return names.select(safe_id(F.col("name")).alias("safe"), "name").distinct().groupBy("safe").agg(F.count("*").alias("names")).where("names > 1")


def results_markdown(results: DataFrame) -> str:
    """Query results (a list that a person reads) as Markdown with a summary per document."""
    rows = [r.asDict(recursive=True) for r in results.toLocalIterator()]
    per: dict[str, int] = {}
    for r in rows:
        name = r.get("document_name") or "Unknown Document"
        per[name] = per.get(name, 0) + 1
    out = ["# Results", "", *(f"- {k}: {v}" for k, v in sorted(per.items())), f"- total: {len(rows)}", ""]
    return "\n".join(out + [f"## {i + 1}\n\n```json\n{json.dumps(r, ensure_ascii=False, default=str)}\n```\n" for i, r in enumerate(rows)])


def cluster_rows(nodes: DataFrame, leaf_chunks: DataFrame, chunks: DataFrame) -> DataFrame:
    """The rows of clusters.csv: size, children, texts, tokens, flags, parent, level, shares of documents and text classes."""
    from quire.functions.text import padded_id
    from quire.operators.hierarchy import node_flags, share_list, shares

    roll = token_rollup(leaf_chunks, chunks)
    kids = nodes.select(parent_id(F.col("cluster_id")).alias("cluster_id")).where("cluster_id is not null").groupBy("cluster_id").agg(F.count("*").alias("children"))
    docs = share_list(shares(leaf_chunks, chunks, "document_name")).withColumnRenamed("shares", "source_documents")
    classes = share_list(shares(leaf_chunks, chunks, "chunk_text_class")).withColumnRenamed("shares", "text_class")
    n = nodes.select("cluster_id", "label", "summary").join(node_flags(nodes.select("cluster_id", "is_leaf")), "cluster_id")
    for part in (roll.select("cluster_id", F.col("chunks").alias("size"), F.col("tokens").alias("token_count")), kids, docs, classes):
        n = n.join(part, "cluster_id", "left")
    zero = F.lit(0).cast("long")
    return n.select(F.col("padded").alias("cluster_id"), F.coalesce("size", zero).alias("size"), F.coalesce("children", zero).alias("children"), "summary", "label", F.coalesce("token_count", zero).alias("token_count"), "document_cluster", "is_leaf", "all_child_leaf", "all_child_internal", "has_leaf_sibling", "has_internal_sibling", padded_id(parent_id(F.col("cluster_id"))).alias("parent"), "level", "source_documents", "text_class")


def category_records(nodes: DataFrame, leaf_chunks: DataFrame, chunks: DataFrame) -> DataFrame:
    """One record per cluster for the category files: texts, document flag, shares of documents and of text classes."""
    from quire.operators.hierarchy import node_flags, shares

    def listed(column: str, name: str, label: str) -> DataFrame:
        s = shares(leaf_chunks, chunks, column)
        return s.groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct(F.col("name").alias(label), F.col("share").alias("tokens_percentage")))).alias(name))

    flags = node_flags(nodes.select("cluster_id", "is_leaf")).select("cluster_id", F.col("document_cluster").alias("is_document_cluster"))
    return nodes.select("cluster_id", "label", "summary", "keywords").join(flags, "cluster_id").join(listed("document_name", "source_documents", "document_name"), "cluster_id", "left").join(listed("chunk_text_class", "text_class", "class"), "cluster_id", "left")


def nested_tree(nodes: DataFrame, leaf_chunks: DataFrame) -> dict:
    """The minimal nested tree (cluster_id, size, children, chunk_ids) for a tree file; a file holds one tree, read in path order."""
    chunks: dict[str, list] = {}
    for r in leaf_chunks.orderBy("cluster_id", "chunk_id").toLocalIterator():
        chunks.setdefault(r["cluster_id"], []).append(r["chunk_id"])
    made: dict[str, dict] = {}
    roots: list[dict] = []
    for r in nodes.orderBy(path_of(F.col("cluster_id"))).toLocalIterator():
        cid = r["cluster_id"]
        node = made[cid] = {"cluster_id": cid, "size": r["size"], "children": None}
        if cid in chunks:
            node["chunk_ids"] = chunks[cid]
        parent = made.get(cid.rpartition(".")[0])
        if parent is None:
            roots.append(node)
        else:
            parent["children"] = parent["children"] or {"clusters": []}
            parent["children"]["clusters"].append(node)
            parent["children"]["children_count"] = len(parent["children"]["clusters"])
    return {"clusters": roots, "children_count": len(roots), "total_clusters": len(made)}


def build_summary(parameters: dict, lossless: DataFrame, levels: DataFrame) -> str:
    """The text of a build's summary file: parameters, the lossless check, and counts per level."""
    out = ["parameters"] + [f"  {k} = {v}" for k, v in parameters.items()] + ["lossless check"]
    out += [f"  {r['what']}: {r['v']}" for r in lossless.collect()] + ["levels"]  # five rows
    return "\n".join(out + [f"  {r['level']}: {r['clusters']} clusters, {r['leaf_chunks']} leaf chunks" for r in levels.orderBy("level").toLocalIterator()])
