"""Continuous ingest: chunk files that arrive in a folder are merged into a collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.functions.text import content_id, token_count
from quire.operators.store import Collection, latest
from quire.sources.readers import CHUNK_SCHEMA


def ingest(spark: SparkSession, folder: str, collection: Collection, checkpoint: str) -> StreamingQuery:
    """Upsert every new chunk file of ``folder``; the newest row of an id wins.  Ends when all present files are in."""
    rows = spark.readStream.schema(CHUNK_SCHEMA).json(folder)

    def batch(df: DataFrame, epoch: int) -> None:
        new = df.where("trim(text) <> ''").select(content_id(F.col("text")).alias("id"), "document_name", "text", F.coalesce("token_count", token_count(F.col("text"))).alias("token_count"), "chunk_id")
        collection.upsert(latest(new, "id", "chunk_id", "document_name"))

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_rows(rows: DataFrame, key: str, at: str, loaded: str, lateness: str = "7 days") -> DataFrame:
    """Per day of ``at``: rows, and those loaded more than ``lateness`` after it (works on streams with a watermark, too)."""
    late = F.col(loaded) > F.col(at) + F.expr(f"INTERVAL {lateness}")
    return rows.groupBy(F.to_date(at).alias("day")).agg(F.count(key).alias("rows"), F.sum(F.coalesce(late, F.lit(False)).cast("long")).alias("late"))


def windowed_counts(events: DataFrame, watermark: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Tumbling counts and sums per event type; on a stream late events within the watermark still count."""
    return events.withWatermark("ts", watermark).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")
