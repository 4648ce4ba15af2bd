"""Token windows over merged chunks, and what they came from."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.text import words

RUNS = 64  # so many runs under one heading are folded in one Python group


def merge_small(chunks: DataFrame, least: int = 80) -> DataFrame:
    """Join consecutive chunks of a document under the same first heading while together they have fewer than ``least`` tokens.

    ``chunks``: document_name, chunk_id, heading_path, text.  Returns document_name,
    merged_id, merged_from, text.  A chunk without heading path has the key null.

    A document is cut where the first heading changes, and some such runs go to one
    Python group, so that the largest document is no single group.
    """

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        out: list[list] = []
        for r in pdf.sort_values("chunk_id", kind="stable").itertuples():
            top = r.heading_path[0] if r.heading_path is not None and len(r.heading_path) else None
            n = len((r.text or "").split())
            if out and out[-1][4] == top and out[-1][3] + n < least:
                out[-1][1].append(r.chunk_id)
                out[-1][2] += "\n" + (r.text or "")
                out[-1][3] += n
            else:
                out.append([r.document_name, [r.chunk_id], r.text or "", n, top])
        return pd.DataFrame([(x[0], pdf["part"].iloc[0], i, x[1], x[2]) for i, x in enumerate(out)], columns=["document_name", "part", "n", "merged_from", "text"])

    src = chunks.select("document_name", "chunk_id", "heading_path", "text").where("document_name is not null")
    order = Window.partitionBy("document_name").orderBy("chunk_id")
    top = F.get("heading_path", F.lit(0))
    fresh = src.withColumn("fresh", (~top.eqNullSafe(F.lag(top).over(order))).cast("int"))
    parts = fresh.withColumn("part", F.floor(F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) / RUNS)).drop("fresh")
    folded = parts.groupBy("document_name", "part").applyInPandas(one, "document_name string, part long, n int, merged_from array<int>, text string")
    number = F.row_number().over(Window.partitionBy("document_name").orderBy("part", "n"))
    return folded.select("document_name", number.alias("merged_id"), "merged_from", "text")


def token_windows(chunks: DataFrame, key: str = "chunk_id", size: int = 384, overlap: int = 64) -> DataFrame:
    """Windows of ``size`` tokens every ``size - overlap``: key, window_no, token_start, token_end, chunk_text.

    A window starts at every step within the text, so the last may lie inside the one
    before.  Inside the JVM, without a shuffle; a blank text has no window.
    """
    w = chunks.select(key, words(F.col("text")).alias("w")).withColumn("n", F.size("w")).where("n > 0")
    starts = F.posexplode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(size - overlap)))
    return w.select(key, "w", "n", starts.alias("window_no", "token_start")).select(
        key, "window_no", "token_start", F.least(F.col("n"), F.col("token_start") + size).alias("token_end"), F.array_join(F.slice("w", F.col("token_start") + 1, F.lit(size)), " ").alias("chunk_text")
    )


def traced_windows(merged: DataFrame, chunks: DataFrame, size: int = 384, overlap: int = 64) -> DataFrame:
    """Token windows with where they come from: merged_from, original texts by chunk, pages, heading and images."""
    parts = merged.select("document_name", "merged_id", F.posexplode("merged_from").alias("pos", "chunk_id")).join(chunks, ["document_name", "chunk_id"])
    origin = parts.groupBy("document_name", "merged_id").agg(
        F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("pos", "chunk_id", "text"))), lambda x: F.struct(x["chunk_id"], x["text"]))).alias("merged_original_texts"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("pages", F.array().cast("array<int>")))))).alias("pages"),
        F.min_by("heading_path", "pos").alias("heading_path"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("image_paths", F.array().cast("array<string>")).alias("p")))), lambda x: x["p"])).alias("image_paths"),
    )
    windows = token_windows(merged.withColumn("key", F.struct("document_name", "merged_id")), "key", size, overlap).select("key.*", "window_no", "token_start", "token_end", "chunk_text")
    return windows.join(origin, ["document_name", "merged_id"]).join(merged.select("document_name", "merged_id", "merged_from"), ["document_name", "merged_id"])
