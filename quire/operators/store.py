"""The chunk collection: a keyed Parquet table with add, delete, scoped upsert and lookups."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def merge_duplicates(chunks: DataFrame, order: str) -> DataFrame:
    """One row per text: the first by ``order``, with the image paths of all its copies."""
    images = chunks.groupBy("text").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("image_paths", F.array().cast("array<string>")))))).alias("image_paths"))
    # Partial aggregation keeps one candidate per task and text, so a text copied many times is no hot group.
    first = chunks.groupBy("text").agg(F.min(order).alias(order))
    return chunks.drop("image_paths").join(first, ["text", order], "left_semi").dropDuplicates(["text"]).join(images, "text")


def upsert(existing: DataFrame, new: DataFrame, scope: Column | None = None, key: str = "id") -> DataFrame:
    """The collection after an upsert: rows of ``scope`` are replaced, colliding keys take the new row.

    Raises ValueError when ``new`` has a key twice.
    """
    if not new.groupBy(key).count().where("count > 1").isEmpty():
        raise ValueError("duplicate keys in one batch")
    kept = existing.join(new.select(key), key, "left_anti")
    if scope is not None:
        kept = kept.where(~F.coalesce(scope, F.lit(False)))
    return kept.unionByName(new, allowMissingColumns=True)


class Collection:
    """A collection in a folder: immutable parts, and versions that list the parts they consist of.

    A write adds parts and then a version, so readers keep a whole one.  Adding rows
    writes those rows only; an upsert or a deletion rewrites the parts that hold rows
    concerned, and no other.  A version's file is created only if it does not exist: of
    two writers at the same time one gets an error and can try again.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, *names: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *names]))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def versions(self) -> list[int]:
        fs, path = self._path("versions")
        return sorted(int(s.getPath().getName().split(".")[0]) for s in fs.listStatus(path)) if fs.exists(path) else []

    def parts(self) -> list[str]:
        """The parts of the newest version."""
        have = self.versions()
        if not have:
            return []
        fs, path = self._path("versions", f"{have[-1]}.json")
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _read(self, parts: list[str]) -> DataFrame:
        return self.spark.read.option("mergeSchema", True).parquet(*[f"{self.folder}/parts/{p}" for p in parts])

    def all(self) -> DataFrame:
        """Every row (a full scan; columns are pruned by the plan)."""
        parts = self.parts()
        if not parts:
            raise FileNotFoundError(self.folder)
        return self._read(parts)

    def _write(self, df: DataFrame) -> str:
        part = uuid.uuid4().hex
        df.write.parquet(f"{self.folder}/parts/{part}")
        return part

    def _commit(self, parts: list[str]) -> None:
        fs, path = self._path("versions", f"{([0] + self.versions())[-1] + 1}.json")
        stream = fs.create(path, False)  # fails if another writer was first
        try:
            stream.write(bytearray(json.dumps(parts).encode()))
        finally:
            stream.close()

    def _touched(self, rows: DataFrame) -> list[str]:
        """The parts that the rows (a selection of ``all``) come from: at most as many as there are parts."""
        name = F.regexp_extract(F.input_file_name(), r"/parts/([0-9a-f]+)/", 1)
        return [r[0] for r in rows.select(name.alias("part")).distinct().collect()]

    def add(self, rows: DataFrame) -> None:
        self._commit([*self.parts(), self._write(rows)])

    def upsert(self, rows: DataFrame, scope: Column | None = None, key: str = "id") -> None:
        """Replace the rows of ``scope``, and those with a key of ``rows``, by ``rows``."""
        parts = self.parts()
        if not parts:
            self._commit([self._write(upsert(rows.limit(0), rows, key=key))])
            return
        name = F.regexp_extract(F.input_file_name(), r"/parts/([0-9a-f]+)/", 1)
        marked = self.all().withColumn("its part", name).withColumn("in scope", F.coalesce(scope, F.lit(False)) if scope is not None else F.lit(False))
        hit = marked.where("`in scope`").select("its part").union(marked.join(rows.select(key), key, "left_semi").select("its part"))
        touched = {r[0] for r in hit.distinct().collect()}  # at most as many as there are parts
        old = self._read([p for p in parts if p in touched]) if touched else self.all().limit(0)
        self._commit([*(p for p in parts if p not in touched), self._write(upsert(old, rows, scope, key))])

    def compact(self) -> None:
        """One part of all rows, after many small writes."""
        self._commit([self._write(self.all())])

    def delete(self, where: Column) -> int:
        """Remove rows for which ``where`` holds; returns how many."""
        hit = F.coalesce(where, F.lit(False))
        parts = self.parts()
        touched = set(self._touched(self.all().where(hit)))
        if not touched:
            return 0
        old = self._read([p for p in parts if p in touched])
        n = old.where(hit).count()
        self._commit([*(p for p in parts if p not in touched), self._write(old.where(~hit))])
        return n

    def count(self) -> int:
        return self.all().count()

    def get(self, limit: int | None = None) -> DataFrame:
        return self.all() if limit is None else self.all().limit(limit)

    def lookup(self, ids: DataFrame) -> DataFrame:
        """Rows of ``ids`` (id); ids the collection lacks have nulls."""
        return ids.join(self.all(), "id", "left")

    def for_clustering(self, *keys: str) -> DataFrame:
        """Embeddings, ids and the metadata asked for; a key the table lacks is null.  The text is not read."""
        have = self.all()
        return have.select("id", "embedding", *[F.col(k) if k in have.columns else F.lit(None).cast("string").alias(k) for k in keys])

    def drop(self) -> None:
        fs, path = self._path()
        fs.delete(path, True)


def latest(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The newest row of each key by ``order`` (compared descending)."""
    w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return rows.withColumn("newest", F.row_number().over(w)).where("newest = 1").drop("newest")
