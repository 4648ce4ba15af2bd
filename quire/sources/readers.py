"""Readers of the JSON, PDF and collection inputs, with fixed schemas."""

from __future__ import annotations

import fnmatch
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import content_id, merged_lines, token_count

CHUNK_SCHEMA = "document_name string, chunk_id int, pages array<int>, heading_path array<string>, text string, token_count int, chunk_type string, image_paths array<string>, mixed_combo string"
TOKEN_CHUNK_SCHEMA = "token_chunk_id int, document_name string, heading_path array<string>, pages array<int>, chunk_type string, image_paths array<string>, merged_from array<int>, merged_original_texts map<int,string>, token_start int, token_end int, chunk_text string"
SPAN_SCHEMA = "text string, font_size double, bold boolean, bbox array<double>, block_no int, line_no int, page_num int, is_image boolean, image_path string"


def resolve(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Files of ``folder`` by ``re:<expression>`` (from the start of the name), glob, or exact name; none raises FileNotFoundError."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []
    if pattern.startswith("re:"):
        found = [n for n in names if re.match(pattern[3:], n)]
    elif any(c in pattern for c in "*?["):
        found = fnmatch.filter(names, pattern)
    else:
        found = [n for n in names if n == pattern]
    if not found:
        raise FileNotFoundError(f"{folder}/{pattern}")
    return [f"{folder.rstrip('/')}/{n}" for n in found]


def structural_chunks(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Chunk files; rows without text and without images are left out; adds id and fills token_count."""
    df = spark.read.schema(CHUNK_SCHEMA).option("multiLine", True).json(paths)
    images = F.coalesce(F.size("image_paths"), F.lit(0)) > 0
    kept = df.where((F.coalesce(F.trim("text"), F.lit("")) != "") | images)
    return kept.select(content_id(F.col("text"), F.col("image_paths")).alias("id"), *[c for c in df.columns if c != "token_count"], F.coalesce("token_count", token_count(F.col("text"))).alias("token_count"))


def token_chunks(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Token-chunk files with their text cleaned: parts joined by line, line numbers in front and blank lines removed."""
    df = spark.read.schema(TOKEN_CHUNK_SCHEMA).option("multiLine", True).json(paths)
    text = merged_lines(F.coalesce("chunk_text", F.array_join(F.map_values("merged_original_texts"), "\n")))
    return df.withColumn("text", text).where("text <> ''").withColumn("id", F.md5("text"))


def spans(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Span files as layout input; the document is the file name."""
    df = spark.read.schema(SPAN_SCHEMA).option("multiLine", True).json(paths).withColumn("file", F.input_file_name())
    return df.select(F.regexp_extract("file", r"([^/]+?)(?:_spans)?\.json$", 1).alias("doc"), "page_num", "block_no", "line_no", F.monotonically_increasing_id().alias("span_no"), "text", "font_size", F.coalesce("bold", F.lit(False)).alias("bold"),
                     *[F.get("bbox", F.lit(i)).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))], F.coalesce("is_image", F.lit(False)).alias("is_image"), "image_path").where("is_image or trim(text) <> ''")


def pdf_files(spark: SparkSession, folder: str) -> DataFrame:
    """PDF bytes (path, content); decoding to spans is a plug-in, since no PDF library is part of this package."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder).select("path", "content")


def cluster_metadata(records: DataFrame, schema: str) -> DataFrame:
    """Cluster records stored as JSON text (record_json) with a fixed schema; rows without one are left out."""
    return records.withColumn("record", F.from_json("record_json", schema)).where("record_json is not null and record is not null")


def hierarchy(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A nested hierarchy file as (nodes, leaf_chunks).  A tree file holds one tree and is read on the driver."""
    import json

    root = json.loads(spark.read.text(path, wholetext=True).first()[0])
    nodes, leaves = [], []
    stack = [(c, None) for c in root.get("clusters", [])]
    while stack:
        c, parent = stack.pop()
        kids = (c.get("children") or {}).get("clusters")
        nodes.append((c["cluster_id"], parent, int(c.get("size") or 0), kids is None, c.get("label"), c.get("summary")))
        if kids is None:
            leaves += [(c["cluster_id"], i, x) for i, x in enumerate(c.get("chunk_ids") or c.get("ids") or [])]
        else:
            stack += [(k, c["cluster_id"]) for k in kids]
    return spark.createDataFrame(nodes, "cluster_id string, parent string, size int, is_leaf boolean, label string, summary string"), spark.createDataFrame(leaves, "cluster_id string, pos int, chunk_id string")
