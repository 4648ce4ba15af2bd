"""Dense, sparse, hybrid and routed retrieval for batches of queries, and re-ranking.

Frames: chunks (chunk_id, text, ...), vectors (id, embedding), queries (query_id, ...).
Scores order by their value rounded to six digits and then by id, so that ranks do not
depend on the last bits of a sum.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.cut import cut
from quire.functions.text import normalize_space, words

BLOCK = 2048
LEAST = -1e300  # under every score but -inf


def _norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors in double precision; null where one is all zero."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    return F.try_divide(dot, _norm(a) * _norm(b))


def _blocks(df: DataFrame, kind: str, group: str | None = None) -> DataFrame:
    """Rows (id, embedding, group) packed without a shuffle into rows of up to BLOCK vectors: b, ids, dim, data, group.

    With ``group``, all vectors of a block have the same value in the third column.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(2).to_numpy(zero_copy_only=False) if group else None
            order = np.argsort(values, kind="stable") if group else np.arange(batch.num_rows)
            cuts = np.flatnonzero(values[order][1:] != values[order][:-1]) + 1 if group else []
            for rows in np.split(order, cuts) if len(order) else []:
                for a in range(0, len(rows), BLOCK):
                    part = batch.take(pa.array(rows[a : a + BLOCK])) if group else batch.slice(a, BLOCK)
                    flat = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                    ids = part.column(0).to_pylist()
                    out = [pa.array([zlib.crc32(str(ids[0]).encode())]), pa.array([ids], pa.list_(part.column(0).type)), pa.array([len(flat) // part.num_rows], pa.int32()), pa.array([flat.tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays([*out, *([part.column(2).slice(0, 1)] if group else [])], names=["b", "ids", "dim", "data", *(["grp"] if group else [])])

    return df.mapInArrow(pack, f"b long, ids array<{kind}>, dim int, data binary" + (f", grp {group}" if group else ""))


class _Best:
    """The ``k`` best items of every query of a stream of blocks of scores, and all that may tie with the last of them.

    Only scores that reach a query's ``k``-th best so far are kept, so what is held
    grows with the queries and not with the items.  Scores under ``least`` do not count.
    """

    def __init__(self, queries: int, k: int, least: float = LEAST) -> None:
        self.k, self.n, self.held, self.least = k, queries, 0, least
        self.low = np.full(queries, least)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, scores: np.ndarray, first: int) -> None:
        """A block of scores (items by queries, under ``least`` where an item is none of the query's); ``first`` is its first item's number."""
        if not self.parts and len(scores) >= self.k:
            self.low = np.maximum(self.least, np.round(np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k], 6) - 1e-6)
        item, query = np.divmod(np.flatnonzero(scores >= self.low), self.n)
        if item.size:
            self.parts.append((query.astype(np.int32), (item + first).astype(np.int32), scores[item, query]))
            self.held += len(item)
        # Sorting needs several times what is held.
        if self.held > self.k * self.n * 5 // 4 + (1 << 18):
            self.parts = [self.best()]
            self.held = len(self.parts[0][0])

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Queries, items and scores that are held."""
        if not self.parts:
            return np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0)
        query, item, score = (np.concatenate([p[i] for p in self.parts]) for i in range(3))
        order = np.lexsort((-score, query))
        query, item, score = query[order], item[order], score[order]
        starts = np.searchsorted(query, np.arange(self.n))
        last = starts + self.k - 1
        full = (last < len(query)) & (query[np.minimum(last, len(query) - 1)] == np.arange(self.n))
        self.low[full] = np.maximum(self.low[full], np.round(score[last[full]], 6) - 1e-6)
        keep = score >= self.low[query]
        return query[keep], item[keep], score[keep]


def _rows_of(queries: int) -> int:
    """How many items are scored at once against so many queries."""
    return min(1024, max(16, (1 << 22) // max(1, queries)))


def _found(best: _Best, query_ids: pa.Array, item_ids: pa.Array, names: list[str], size: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    query, item, score = best.best()
    for a in range(0, len(query), size):
        yield pa.RecordBatch.from_arrays([query_ids.take(pa.array(query[a : a + size])), item_ids.take(pa.array(item[a : a + size])), pa.array(score[a : a + size])], names=names)


def _streams(queries: DataFrame, items: DataFrame, query: str, item: str, parts: int = 1, *order: str, pairs: DataFrame | None = None) -> DataFrame:
    """Rows for tasks of which each reads its part of the queries first (kind 0) and then, as a stream, its share of the items (kind 1).

    There is no join of both sides: what is shuffled is the items once for each of the
    ``parts`` of the queries, and the queries once for each share of the items.  With
    ``pairs`` of both, each is read (kind 2) by the task that has its query, after its item.
    """
    spark = items.sparkSession
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(4, spark.sparkContext.defaultParallelism))
    shares = max(1, -(-tasks // parts))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    part, share = F.pmod(F.xxhash64(query), F.lit(parts)), F.pmod(F.xxhash64(item), F.lit(shares)) * parts
    asks = queries.withColumn("share", every(shares)).withColumn("task", (F.col("share") * parts + part).cast("int")).withColumn("kind", F.lit(0))
    read = items.withColumn("part", every(parts)).withColumn("task", (share + F.col("part")).cast("int")).withColumn("kind", F.lit(1))
    both = asks.drop("share").unionByName(read.drop("part"), allowMissingColumns=True)
    if pairs is None:
        return both.repartitionById(shares * parts, "task").sortWithinPartitions("kind", *order).drop("task")
    both = both.unionByName(pairs.withColumn("task", (share + part).cast("int")).withColumn("kind", F.lit(2)), allowMissingColumns=True)
    return both.repartitionById(shares * parts, "task").sortWithinPartitions(F.col("kind") > 0, item, "kind").drop("task")


def dense_topk(queries: DataFrame, vectors: DataFrame, k: int, exclude_same: bool = False, max_distance: float | None = None, within: str | None = None, several: bool = False) -> DataFrame:
    """The ``k`` vectors most similar to each query by cosine: query_id, id, similarity, distance, rank.

    ``queries`` (query_id, embedding) and ``vectors`` (id, embedding) meet in tasks that
    hold queries and read their share of the vectors as a stream; a task hands on the
    ``k`` best only, so nothing held or shuffled grows with the product of the sides.  Null, empty
    and all-zero vectors are never found and find nothing.  With ``max_distance`` the
    limit applies after the ``k`` best are taken.  With ``within``, a column of both
    sides, a query is compared only with vectors that have its value there (not null):
    blocks are then of one value each, and only such of the same value meet.  With
    ``several``, a query or a vector may have rows of several values; what is found
    more than once counts once.
    """
    vkind, qkind = (df.schema[c].dataType.simpleString() for df, c in ((vectors, "id"), (queries, "query_id")))
    usable = lambda c: (F.size(c) > 0) & F.forall(c, lambda x: x.isNotNull()) & F.exists(c, lambda x: x != 0)
    take = k + 1 if exclude_same else k
    if within is None:
        found = _dense_streams(queries.where(usable("embedding")).select("query_id", "embedding"), vectors.where(usable("embedding")).select("id", "embedding"), qkind, vkind, take)
    else:
        found = _dense_blocks(queries.where(usable("embedding") & F.col(within).isNotNull()), vectors.where(usable("embedding") & F.col(within).isNotNull()), qkind, vkind, k, within)
    if exclude_same:
        found = found.where("query_id <> id")
    found = found.withColumn("similarity", F.round("similarity", 6))
    if several:
        found = found.groupBy("query_id", "id").agg(F.max("similarity").alias("similarity"))
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    out = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).withColumn("distance", F.round(1 - F.col("similarity"), 6))
    if max_distance is not None:
        out = out.where(F.col("distance") <= max_distance)
    return out.select("query_id", "id", "similarity", "distance", "rank")


def _dense_streams(queries: DataFrame, vectors: DataFrame, qkind: str, vkind: str, k: int) -> DataFrame:
    """The ``k`` most similar vectors of every query, and those that may tie, of each task: query_id, id, similarity."""
    parts = max(1, -(-queries.count() // 50_000))
    rows = _streams(queries, vectors, "query_id", "id", parts).select("kind", "query_id", "id", F.col("embedding").cast("array<double>").alias("embedding"))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: dict[int, list] = {}
        ready: dict[int, tuple] = {}
        for batch in batches:
            kind, vectors = batch.column("kind").to_numpy(), batch.column("embedding")
            dims = np.diff(vectors.offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                for side, name in ((0, "query_id"), (1, "id")):
                    at = np.flatnonzero((dims == dim) & (kind == side))
                    if not at.size:
                        continue
                    ids, x = batch.column(name).take(pa.array(at)), vectors.take(pa.array(at)).flatten().to_numpy().reshape(-1, dim)
                    x = x / np.linalg.norm(x, axis=1)[:, None]
                    if side == 0:
                        asked.setdefault(dim, []).append((ids, x))
                        continue
                    if dim not in asked:
                        continue
                    if dim not in ready:
                        y = np.concatenate([v for _, v in asked[dim]])
                        ready[dim] = (pa.concat_arrays([i for i, _ in asked[dim]]), np.ascontiguousarray(y.T), _Best(len(y), k), [], [0])
                    _, y, best, seen, n = ready[dim]
                    seen.append(ids)
                    for a in range(0, len(x), step := _rows_of(y.shape[1])):
                        best.add(x[a : a + step] @ y, n[0] + a)
                    n[0] += len(x)
        for qids, _, best, seen, _ in ready.values():
            yield from _found(best, qids, pa.concat_arrays(seen), ["query_id", "id", "similarity"])

    return rows.mapInArrow(multiply, f"query_id {qkind}, id {vkind}, similarity double").withColumn("similarity", F.round("similarity", 12))


def _dense_blocks(queries: DataFrame, vectors: DataFrame, qkind: str, vkind: str, k: int, within: str) -> DataFrame:
    """The ``k`` most similar vectors of the same value of ``within``, of each pair of blocks: query_id, id, similarity."""
    group, on = vectors.schema[within].dataType.simpleString(), ["dim", "task", "grp"]
    v = _blocks(vectors.select("id", "embedding", within), vkind, group)
    q = _blocks(queries.select("query_id", "embedding", within), qkind, group).withColumnsRenamed({"b": "qb", "ids": "qids", "data": "qdata"})
    # Vectors are spread over the tasks once; the blocks of the queries go to every task.
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tasks - 1).cast("long")))
    pairs = v.withColumn("task", F.pmod("b", F.lit(tasks))).join(q.withColumn("task", spread), on)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                x, y = (np.frombuffer(r[c]).reshape(-1, r["dim"]) for c in ("qdata", "data"))
                sims = np.round((x @ y.T) / (np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1)[None]), 12)
                ids = r["ids"]
                out = ([], [], [])
                for i, qid in enumerate(r["qids"]):
                    s = sims[i]
                    near = np.argpartition(-s, k)[: k + 1] if len(s) > k + 1 else np.arange(len(s))
                    low = np.round(s[near].min(), 6) - 1e-6  # everything that may tie with the last one
                    near = np.flatnonzero(s >= low) if len(s) > k + 1 else near
                    out[0].extend([qid] * len(near))
                    out[1].extend(ids[j] for j in near)
                    out[2].extend(s[near].tolist())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (batch.schema.field("qids").type.value_type, batch.schema.field("ids").type.value_type, pa.float64()))], names=["query_id", "id", "similarity"])

    return pairs.mapInArrow(multiply, f"query_id {qkind}, id {vkind}, similarity double")


def filtered_topk(queries: DataFrame, vectors: DataFrame, allowed: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of the vectors that are allowed to a query (query_id, id): scored after the join, missing ids drop out."""
    pairs = allowed.select("query_id", "id").distinct().join(vectors.select("id", "embedding"), "id").join(queries.select("query_id", F.col("embedding").alias("q")), "query_id")
    scored = pairs.select("query_id", "id", F.round(cosine(F.col("embedding"), F.col("q")), 6).alias("similarity")).where(F.col("similarity").isNotNull())
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id"))).where(F.col("rank") <= k)


def result_summary(results: DataFrame) -> DataFrame:
    """Results per document and in total (document_name null, total true)."""
    named = results.withColumn("document_name", F.coalesce("document_name", F.lit("Unknown Document")))
    return named.rollup("document_name").agg(F.count("*").alias("results"), F.grouping("document_name").cast("boolean").alias("total"))


def _hashed(texts: DataFrame) -> DataFrame:
    """Texts with terms: the words as hashes of 64 bits."""
    return texts.withColumn("terms", F.transform(words(F.col("text")), lambda w: F.xxhash64(w))).drop("text")


def term_weights(chunks: DataFrame, queries: DataFrame, n: int, epsilon: float = 0.25) -> DataFrame:
    """Okapi weights of the words of each query: query_id, term (a hash of the word), weight (times in the query * idf).

    Both sides have their words as ``terms``; there are ``n`` chunks, with words or
    without.  Words that no chunk has are left out.  A word in more than half of the
    chunks gets ``epsilon`` times the mean idf of all words.  Terms are counted once,
    combined before they are shuffled.  Chunks without an id count as one chunk.
    """
    # For an inner explode Spark would make the words of every text once more, to filter empty ones.
    words_of = chunks.select(F.col("chunk_id").isNotNull().cast("long").alias("named"), F.explode_outer(F.array_distinct("terms")).alias("term"))
    df = cut(words_of.where("term is not null").groupBy("term").agg((F.sum("named") + 1 - F.min("named")).alias("df")))
    raw = df.select("term", (F.log(F.lit(n) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)).alias("raw"))
    mean = raw.agg(F.avg("raw").alias("mean"))  # one row
    idf = raw.join(F.broadcast(mean)).select("term", F.when(F.col("raw") < 0, epsilon * F.col("mean")).otherwise(F.col("raw")).alias("idf"))
    asked = queries.select("query_id", F.explode("terms").alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("times"))
    return asked.join(idf, "term").select("query_id", "term", (F.col("times") * F.col("idf")).alias("weight"))


def bm25_topk(chunks: DataFrame, queries: DataFrame, k: int, k1: float = 1.5, b: float = 0.75, epsilon: float = 0.25) -> DataFrame:
    """The ``k`` best chunks of each query by Okapi BM25: query_id, chunk_id, score, rank.

    Words are white-space tokens as written; repeated words of a query count each
    time.  Chunks that share no word with a query are not found, nor are those without
    an id, which only count for the weights of words.  A task holds queries
    and reads its share of the chunks as a stream, and hands on the ``k`` best of each
    query only: no join is on words, so one that stands in every chunk is not a hot
    key, and nothing held or shuffled grows with the product of the sides.
    """
    ckind, qkind = chunks.schema["chunk_id"].dataType.simpleString(), queries.schema["query_id"].dataType.simpleString()
    # No filter is on the words, which would make them twice; empty texts share none with a query.
    tokens = _hashed(chunks.select("chunk_id", "text").where("text is not null"))
    n, mean = chunks.agg(F.count("*"), F.avg(F.greatest(F.coalesce(F.size(words(F.col("text"))), F.lit(0)), F.lit(0)))).first()
    mean = mean or 1.0
    weights = term_weights(tokens, _hashed(queries.select("query_id", "text")), n, epsilon).groupBy("query_id").agg(F.collect_list(F.struct("term", "weight")).alias("asks"))
    asks = cut(weights.select("query_id", F.col("asks.term").alias("terms"), F.col("asks.weight").alias("weights")))
    size = asks.agg(F.count("*"), F.sum(F.size("terms"))).first()
    parts = max(1, -(-size[0] // 50_000), -(-(size[1] or 0) // 4_000_000))
    rows = _streams(asks, tokens.where("chunk_id is not null"), "query_id", "chunk_id", parts).select("kind", "query_id", "chunk_id", "terms", "weights")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, seen, n, best = [], [], 0, None
        for batch in batches:
            first = int(np.searchsorted(batch.column("kind").to_numpy(), 1))
            if first:
                part = batch.slice(0, first)
                terms = part.column("terms")
                asked.append((part.column("query_id"), np.diff(terms.offsets.to_numpy()), terms.flatten().to_numpy(), part.column("weights").flatten().to_numpy()))
            if first == batch.num_rows or not asked:
                continue
            if best is None:
                qids = pa.concat_arrays([x[0] for x in asked])
                post = _Postings(*(np.concatenate([x[i] for x in asked]) for i in (1, 2, 3)))
                best = _Best(len(qids), k, post.least)
            part = batch.slice(first)
            terms = part.column("terms")
            seen.append(part.column("chunk_id"))
            for a, scores in post.scores(np.diff(terms.offsets.to_numpy()), terms.flatten().to_numpy(), lambda f, size: f * (k1 + 1) / (f + k1 * (1 - b + b * size / mean))):
                best.add(scores, n + a)
            n += part.num_rows
        if best is not None:
            yield from _found(best, qids, pa.concat_arrays(seen), ["query_id", "chunk_id", "score"])

    return topk(rows.mapInArrow(score, f"query_id {qkind}, chunk_id {ckind}, score double"), k)


class _Postings:
    """The weighted terms of queries by term, to be multiplied with blocks of chunks.

    Terms that many pairs of a chunk and a query share are columns of a dense product;
    of the others the queries that have a chunk's terms are added up chunk by chunk.
    """

    def __init__(self, sizes: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> None:
        self.queries = len(sizes)
        self.terms, of = np.unique(terms, return_inverse=True)
        order = np.argsort(of, kind="stable")
        self.query, self.weight = np.repeat(np.arange(len(sizes)), sizes)[order], weights[order]
        self.at = np.searchsorted(of[order], np.arange(len(self.terms) + 1))
        self.positive = bool((weights > 0).all())
        self.least = np.nextafter(0, 1) if self.positive else LEAST  # what shares a term has this score at least

    def scores(self, sizes: np.ndarray, terms: np.ndarray, saturated) -> Iterator[tuple[int, np.ndarray]]:
        """Blocks of scores of chunks by queries, under ``least`` where they share no term, each with the number of its first chunk."""
        if not len(self.terms):
            return
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        both = self.terms[at] == terms
        key, times = np.unique((np.repeat(np.arange(len(sizes)), sizes) * len(self.terms) + at)[both], return_counts=True)
        row, term = key // len(self.terms), key % len(self.terms)
        value = saturated(times.astype(float), sizes[row])
        degree = np.diff(self.at)
        share = np.bincount(term, minlength=len(self.terms)) / max(1, len(sizes)) * (degree / self.queries)
        # A dense column costs about a hundredth of what the same pairs cost one by one.
        dense = np.argsort(-share)[: max(8, (1 << 23) // self.queries)]
        dense = dense[share[dense] > 0.01]
        column = np.full(len(self.terms), -1)
        column[dense] = np.arange(len(dense))
        matrix = np.zeros((len(dense), self.queries))
        for c, t in enumerate(dense):
            matrix[c, self.query[self.at[t] : self.at[t + 1]]] = self.weight[self.at[t] : self.at[t + 1]]
        if not self.positive:  # a score of 0 or less may come from shared terms
            held = np.zeros(matrix.shape)
            for c, t in enumerate(dense):
                held[c, self.query[self.at[t] : self.at[t + 1]]] = 1
        starts = np.searchsorted(row, np.arange(len(sizes) + 1))
        step = _rows_of(self.queries)
        for a in range(0, len(sizes), step):
            z = min(len(sizes), a + step)
            span = slice(starts[a], starts[z])
            out = self._product(row[span] - a, term[span], value[span], column, matrix, self.weight, z - a)
            if not self.positive:
                shared = self._product(row[span] - a, term[span], np.ones(span.stop - span.start), column, held, np.ones(len(self.weight)), z - a)
                out[shared == 0] = -np.inf
            yield a, out

    def _product(self, row, term, value, column, matrix, weight, rows: int) -> np.ndarray:
        wide = column[term] >= 0
        left = np.zeros((rows, len(matrix)))
        left[row[wide], column[term[wide]]] = value[wide]
        out = left @ matrix
        row, term, value = row[~wide], term[~wide], value[~wide]
        starts = np.searchsorted(row, np.arange(rows + 1))
        first, last = self.at[term], self.at[term + 1]
        for r in range(rows):
            i, j = starts[r], starts[r + 1]
            if i == j:
                continue
            spans = [slice(x, y) for x, y in zip(first[i:j].tolist(), last[i:j].tolist())]
            add = np.concatenate([weight[x] for x in spans]) * np.repeat(value[i:j], last[i:j] - first[i:j])
            out[r] += np.bincount(np.concatenate([self.query[x] for x in spans]), add, self.queries)
        return out


def topk(scored: DataFrame, k: int, score: str = "score", key: str = "chunk_id", digits: int = 6) -> DataFrame:
    """The ``k`` best per query by rounded score and id, with rank."""
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round(score, digits)), key)
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hybrid(dense: DataFrame, sparse: DataFrame, k: int = 40, alpha: float = 0.5) -> DataFrame:
    """Dense and sparse candidates as one ranking: query_id, chunk_id, dense, sparse, hybrid, rank.

    Sparse scores are divided by the length of the vector of the query's selected
    scores; a candidate that one side lacks has 0 there.  Without any sparse row of a
    query the dense score counts alone.
    """
    norm = sparse.withColumn("sparse", F.col("score") / (F.sqrt(F.sum(F.col("score") * F.col("score")).over(Window.partitionBy("query_id"))) + 1e-6)).select("query_id", "chunk_id", "sparse")
    both = dense.select("query_id", F.col("id").alias("chunk_id"), F.col("similarity").alias("dense")).join(norm, ["query_id", "chunk_id"], "full_outer")
    both = both.withColumn("has_sparse", F.max(F.col("sparse").isNotNull()).over(Window.partitionBy("query_id"))).na.fill(0.0, ["dense", "sparse"])
    score = F.when(F.col("has_sparse"), alpha * F.col("dense") + (1 - alpha) * F.col("sparse")).otherwise(F.col("dense"))
    return topk(both.withColumn("hybrid", score).drop("has_sparse"), k, "hybrid")


def cluster_query(label: Column, summary: Column, keywords: Column) -> Column:
    """The query text that stands for a cluster."""
    empty = F.lit("")
    return F.concat(F.lit("Topic label: "), F.coalesce(label, empty), F.lit("\nSummary: "), F.coalesce(summary, empty), F.lit("\nKeywords: "), F.coalesce(F.array_join(keywords, ", "), empty), F.lit("\nRetrieve text relevant to this topic."))


def rerank_keywords(ranked: DataFrame, queries: DataFrame, chunks: DataFrame, weight: float = 0.2) -> DataFrame:
    """Hybrid score plus a weight per different query word in the chunk: query_id, chunk_id, hybrid, copy_of, keyword_score, final.

    A task holds the words of queries and reads its share of the chunks, each before its
    pairs, as a stream: a text is cut into words once and not for every pair, and no text
    is shuffled once for every query that found it.  ``copy_of`` is the same for chunks
    with the same text.  Pairs whose query or chunk is null or unknown are left out.
    """
    ckind, qkind = chunks.schema["chunk_id"].dataType.simpleString(), queries.schema["query_id"].dataType.simpleString()
    text = F.lower(F.coalesce("text", F.lit(""))).alias("words")
    same = F.unhex(F.md5(F.regexp_replace("text", r"(?U)^\s+|\s+$", ""))).alias("copy_of")
    asks, items = queries.select("query_id", text), chunks.select("chunk_id", text, same)
    size = asks.agg(F.count("*"), F.sum(F.length("words"))).first()
    parts = max(1, -(-size[0] // 50_000), -(-(size[1] or 0) // 32_000_000))
    pairs = ranked.select(F.col("query_id").cast(qkind), F.col("chunk_id").cast(ckind), "hybrid")
    rows = _streams(asks, items, "query_id", "chunk_id", parts, pairs=pairs).select("kind", "query_id", "chunk_id", "words", "copy_of", "hybrid")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, held, qids = _SharedWords(), None, []
        for batch in batches:
            first = int(np.searchsorted(batch.column("kind").to_numpy() > 0, True))
            if first:
                qids.append(batch.column("query_id").slice(0, first))
                shared.ask(batch.column("words").slice(0, first).to_pylist())
            if first == batch.num_rows or not qids:
                continue
            if held is None and len(qids) > 1:
                qids = [pa.concat_arrays(qids)]
            part = batch.slice(first)
            if held is not None:  # the pairs of the last chunk may go on in the next batch
                part = pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
            kind = part.column("kind").to_numpy()
            chunk, pair = np.flatnonzero(kind == 1), np.flatnonzero(kind == 2)
            if chunk.size:
                held = part.slice(int(chunk[-1]), 1)
            of = np.searchsorted(chunk, pair) - 1
            pair, of = pair[of >= 0], of[of >= 0]
            ids, own = part.column("chunk_id").take(pa.array(pair)), part.column("chunk_id").take(pa.array(chunk[of]))
            asking = pc.index_in(part.column("query_id").take(pa.array(pair)), value_set=qids[0], skip_nulls=True)
            good = pc.and_(pc.equal(ids, own).fill_null(False), asking.is_valid()).to_numpy(zero_copy_only=False)
            pair, of, asking = pair[good], of[good], asking.filter(pa.array(good)).to_numpy()
            if not pair.size:
                continue
            some, at = np.unique(of, return_index=True)
            n = shared.counts(part.column("words").take(pa.array(chunk[some])).to_pylist(), asking, [*at.tolist(), len(pair)])
            at = pa.array(pair)
            yield pa.RecordBatch.from_arrays([*(part.column(c).take(at) for c in ("query_id", "chunk_id", "hybrid")), part.column("copy_of").take(pa.array(chunk[of])), pa.array(n, pa.int32())], names=["query_id", "chunk_id", "hybrid", "copy_of", "keyword_score"])

    scored = rows.mapInArrow(count, f"query_id {qkind}, chunk_id {ckind}, hybrid double, copy_of binary, keyword_score int")
    return scored.withColumn("final", F.col("hybrid") + weight * F.col("keyword_score"))


class _SharedWords:
    """The different words of queries, to be compared with those of texts (all in lower case)."""

    # White space as Java's (?U)\s has it.
    SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")

    def __init__(self) -> None:
        self.code: dict[str, int] = {}
        self.own: list[np.ndarray] = []
        self.mark = np.zeros(0, bool)

    def ask(self, texts: list[str]) -> None:
        code = self.code
        for t in texts:
            self.own.append(np.array([code.setdefault(w, len(code)) for w in set(self.SPACE.split(t)) if w], np.int32))

    def counts(self, texts: list[str], queries: np.ndarray, at: list[int]) -> list[int]:
        """How many words of each query its text has; the queries of text i stand from at[i] to at[i + 1]."""
        if len(self.mark) < len(self.code):
            self.mark = np.zeros(len(self.code), bool)
        code, own, mark, out, asked = self.code, self.own, self.mark, [], queries.tolist()
        for i, t in enumerate(texts):
            here = [n for w in set(self.SPACE.split(t)) if (n := code.get(w)) is not None]
            mark[here] = True
            out += [int(np.count_nonzero(mark[own[q]])) for q in asked[at[i] : at[i + 1]]]
            mark[here] = False
        return out


def dedupe_final(scored: DataFrame, k: int = 10) -> DataFrame:
    """Of chunks with the same text (``copy_of``) the best stays, then the ``k`` best of a query: adds final_rank."""
    order = [F.desc(F.round("final", 6)), F.col("chunk_id")]
    once = scored.withColumn("copy", F.row_number().over(Window.partitionBy("query_id", "copy_of").orderBy(*order))).where("copy = 1").drop("copy")
    return once.withColumn("final_rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("final_rank") <= k)


def two_stage(queries: DataFrame, clusters: DataFrame, vectors: DataFrame, top_clusters: int = 40, k: int = 40, lexical: DataFrame | None = None, members: DataFrame | None = None) -> DataFrame:
    """Cluster-routed retrieval: the best clusters of a query open their chunks, the best of which are taken.

    ``clusters`` has id and embedding, and chunks (array of chunk ids) unless ``members``
    (cluster, id) has a row for each chunk of a cluster.  ``lexical`` (query_id, id) adds
    clusters found by words; a cluster found both ways counts once, and so does a chunk
    of several clusters.  Queries meet the vectors of their clusters in blocks, so there
    is no frame of pairs.
    """
    found = dense_topk(queries, clusters, top_clusters).select("query_id", "id")
    if lexical is not None:
        found = found.unionByName(lexical.select("query_id", "id")).distinct()
    if members is None:
        members = clusters.select(F.col("id").alias("cluster"), F.explode("chunks").alias("id"))
    asking = found.withColumnRenamed("id", "cluster").join(queries.select("query_id", "embedding"), "query_id")
    there = members.select("cluster", "id").distinct().join(vectors.select("id", "embedding"), "id")
    return dense_topk(asking, there, k, within="cluster", several=True).select("query_id", "id", "similarity", "rank")


def routed_topk(queries: DataFrame, clusters: DataFrame, vectors: DataFrame, top_clusters: int = 40, k: int = 40, least: float = 80.0) -> DataFrame:
    """``two_stage`` with clusters found by vector and by words, without a frame of pairs: query_id, id, similarity, rank.

    ``queries`` has query_id, embedding and terms; ``clusters`` id, text, embedding and
    chunks.  By words a query finds a good share of all clusters, so it carries keys
    instead: its terms, and the clusters found by vector.  A chunk has the keys of its
    clusters and the terms that these hold (``lexical_clusters``, each different term
    once).  A task reads queries and its share of the chunks as a stream, scores a
    block at once, and a query sees the chunks that share a key with it.
    """
    vkind, qkind = (df.schema[c].dataType.simpleString() for df, c in ((vectors, "id"), (queries, "query_id")))
    usable = lambda c: (F.size(c) > 0) & F.forall(c, lambda x: x.isNotNull()) & F.exists(c, lambda x: x != 0)
    key = lambda kind, c: F.xxhash64(F.lit(kind), c)
    none = F.array().cast("array<bigint>")
    union = lambda c: F.array_distinct(F.flatten(F.collect_list(c)))
    queries, vectors = queries.where(usable("embedding")), vectors.where(usable("embedding"))
    near = dense_topk(queries, clusters, top_clusters).groupBy("query_id").agg(F.collect_list(key("cluster", F.col("id"))).alias("near"))
    asks = queries.hint("merge").join(near, "query_id", "left").select("query_id", "embedding", F.concat(F.coalesce(F.transform("terms", lambda t: key("term", t)), none), F.coalesce("near", none)).alias("keys"))
    terms = queries.select(F.explode("terms").alias("term")).distinct()
    held = lexical_clusters(terms.select(key("term", F.col("term")).alias("query_id"), F.array("term").alias("terms")), clusters, least)
    held = held.groupBy("id").agg(F.collect_set("query_id").alias("held"))
    opened = clusters.select("id", "chunks").hint("merge").join(held, "id", "left").select(F.concat(F.array(key("cluster", F.col("id"))), F.coalesce("held", none)).alias("keys"), F.explode(F.array_distinct("chunks")).alias("id"))
    items = vectors.hint("merge").join(opened.groupBy("id").agg(union("keys").alias("keys")), "id").select("id", "embedding", "keys")
    asks = cut(asks)
    size = asks.agg(F.count("*"), F.sum(F.size("keys"))).first()
    parts = max(1, -(-size[0] // 50_000), -(-(size[1] or 0) // 4_000_000))
    rows = _streams(asks, items, "query_id", "id", parts).select("kind", "query_id", "id", F.col("embedding").cast("array<double>").alias("embedding"), "keys")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: dict[int, list] = {}
        ready: dict[int, list] = {}
        for batch in batches:
            kind, found, keys = (batch.column(c) for c in ("kind", "embedding", "keys"))
            kind, dims = kind.to_numpy(), np.diff(found.offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                for side, name in ((0, "query_id"), (1, "id")):
                    at = np.flatnonzero((dims == dim) & (kind == side))
                    if not at.size or side and dim not in asked:
                        continue
                    ids, x, own = (c.take(pa.array(at)) for c in (batch.column(name), found, keys))
                    x = x.flatten().to_numpy().reshape(-1, dim)
                    x, sizes, own = x / np.linalg.norm(x, axis=1)[:, None], np.diff(own.offsets.to_numpy()), own.flatten().to_numpy()
                    if side == 0:
                        asked.setdefault(dim, []).append((ids, x, sizes, own))
                        continue
                    if dim not in ready:
                        y, sz, ks = (np.concatenate([a[i] for a in asked[dim]]) for i in (1, 2, 3))
                        ready[dim] = [pa.concat_arrays([a[0] for a in asked[dim]]), np.ascontiguousarray(y.T), _Postings(sz, ks, np.ones(len(ks))), _Best(len(y), k), []]
                        asked[dim] = [()]
                    _, y, post, best, seen = ready[dim]
                    n = sum(map(len, seen))
                    seen.append(ids)
                    for a, shared in post.scores(sizes, own, lambda f, size: f):
                        scores = x[a : a + len(shared)] @ y
                        scores[shared < post.least] = -np.inf
                        best.add(scores, n + a)
        for qids, _, _, best, seen in ready.values():
            yield from _found(best, qids, pa.concat_arrays(seen), ["query_id", "id", "similarity"])

    found = rows.mapInArrow(meet, f"query_id {qkind}, id {vkind}, similarity double").withColumn("similarity", F.round(F.round("similarity", 12), 6))
    return topk(found, k, "similarity", "id")


def retrieved_for_clusters(clusters: DataFrame, vectors: DataFrame, k: int = 10) -> DataFrame:
    """The chunks found for every cluster: cluster_id, label, keywords (sorted, each once), retrieved_count, chunks (id and score, best first).

    All clusters (cluster_id, label, keywords, embedding) are queries of one batch; a
    cluster without a usable vector has no chunks.
    """
    hits = dense_topk(clusters.select(F.col("cluster_id").alias("query_id"), "embedding"), vectors, k)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", "id", "similarity"))), lambda x: F.struct(x["id"].alias("id"), x["similarity"].alias("score")))
    per = hits.groupBy(F.col("query_id").alias("cluster_id")).agg(F.count("*").alias("retrieved_count"), listed.alias("chunks"))
    keys = F.array_sort(F.array_distinct(F.coalesce("keywords", F.array().cast("array<string>"))))
    none = F.array().cast(per.schema["chunks"].dataType)
    return clusters.select("cluster_id", "label", keys.alias("keywords")).join(per, "cluster_id", "left").select("cluster_id", "label", "keywords", F.coalesce("retrieved_count", F.lit(0)).cast("long").alias("retrieved_count"), F.coalesce("chunks", none).alias("chunks"))


def merge_clusters(semantic: DataFrame, lexical: DataFrame) -> DataFrame:
    """Clusters of both searches, each once per query: semantic ones first, then lexical ones, in their order."""
    both = semantic.select("query_id", "id", F.lit(0).alias("source"), "rank").unionByName(lexical.select("query_id", "id", F.lit(1).alias("source"), "rank"))
    first = both.withColumn("n", F.row_number().over(Window.partitionBy("query_id", "id").orderBy("source", "rank"))).where("n = 1")
    return first.withColumn("position", F.row_number().over(Window.partitionBy("query_id").orderBy("source", "rank", "id"))).drop("n")


def union_queries(results: DataFrame) -> DataFrame:
    """Results of several queries of one request as one list: of a chunk the first counts, by query_ord and rank."""
    w = Window.partitionBy("request_id", "chunk_id").orderBy("query_ord", "rank")
    return results.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


def rerank_budget(results: DataFrame, floor: float = 0.6, spread: float = 0.2, boost: float = 0.3, budget: int = 2500) -> DataFrame:
    """Keep results above a threshold, add a bonus for longer ones, and take the best while their tokens fit.

    ``results`` has query_id, chunk_id, score, token_count.  The threshold is
    max(floor, mean + spread * deviation) of the query's scores; where none reaches it
    the best one stays.  Adds final and running_tokens; null token counts are 0.
    """
    q = Window.partitionBy("query_id")
    r = results.withColumn("token_count", F.coalesce("token_count", F.lit(0)))
    r = r.withColumn("threshold", F.greatest(F.lit(floor), F.avg("score").over(q) + spread * F.stddev_pop("score").over(q)))
    r = r.withColumn("best", F.row_number().over(q.orderBy(F.desc("score"), "chunk_id"))).withColumn("any", F.max(F.round(F.col("score") - F.col("threshold"), 9) >= 0).over(q))
    kept = r.where((F.round(F.col("score") - F.col("threshold"), 9) >= 0) | (~F.col("any") & (F.col("best") == 1)))
    kept = kept.withColumn("final", F.round(F.col("score") + boost * F.log(1 + F.greatest(F.lit(1), F.col("token_count"))), 6))
    order = q.orderBy(F.desc("final"), "chunk_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return kept.withColumn("running_tokens", F.sum("token_count").over(order)).where(F.col("running_tokens") <= budget).select("query_id", "chunk_id", "final", "token_count", "running_tokens")


def context_prompt(results: DataFrame) -> DataFrame:
    """The texts of a query's results in rank order, joined for a prompt."""
    texts = F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda x: x["text"])
    return results.groupBy("query_id").agg(F.array_join(texts, "\n\n---\n\n").alias("context"))


def partial_ratio(term: str, text: str, least: float = 0.0) -> float:
    """Best similarity (0..100) of ``term`` to a window of ``text`` by insertions and deletions; 0 where it is under ``least``.

    A window can only be as similar as it has letters of the term, which is counted
    while it slides; the longest common subsequence is found, bit-parallel, for
    windows that may beat the best so far.
    """
    if not term or not text:
        return 0.0
    if len(term) > len(text):
        term, text = text, term
    if term in text:
        return 100.0
    m, n = len(term), len(text)
    masks: dict[str, int] = {}
    free: dict[str, int] = {}
    for i, c in enumerate(term):
        masks[c] = masks.get(c, 0) | 1 << i
        free[c] = free.get(c, 0) + 1
    full, best, common = (1 << m) - 1, least - 1e-9, 0
    for end in range(1, n + m):
        if end <= n and (c := text[end - 1]) in free:
            common += free[c] > 0
            free[c] -= 1
        start = end - m
        if start > 0 and (c := text[start - 1]) in free:
            free[c] += 1
            common -= free[c] > 0
        length = min(end, n) - max(start, 0)
        if 200.0 * common / (m + length) > best:
            s = full
            for c in text[max(0, start) : end]:
                u = s & masks.get(c, 0)
                s = (s + u) | (s - u)
            best = max(best, 200.0 * (m - (s & full).bit_count()) / (m + length))
    return best if best >= least else 0.0


def matching_terms(texts: list[str | None], terms: list[str], least: float) -> list[list[str]]:
    """The terms whose ``partial_ratio`` to each text is at least ``least``, for ``least`` over 200 / 3."""
    out: list[list[str]] = [[] for _ in texts]
    for term, found in _matches(texts, terms, least):
        for i in found:
            out[i].append(terms[term])
    return out


def _matches(texts: list[str | None], terms: list[str], least: float) -> Iterator[tuple[int, list[int]]]:
    """Numbers of terms, each with numbers of texts that it matches; a term may come again with other texts."""
    at: dict[str, list[int]] = {}
    for i, t in enumerate(texts):
        if t:
            at.setdefault(t, []).append(i)
    different = list(at)
    some = [i for i, t in enumerate(terms) if t]
    words = [terms[i] for i in some]
    for s, found in _alike(words, different, least, 0):
        yield some[s], [i for k in found for i in at[different[k]]]
    # A text shorter than the term is the one that slides.
    for s, found in _alike(different, words, least, 1):
        for k in found:
            yield some[k], at[different[s]]


BUCKETS = 512


def _least_pairs(m: int, n: int, least: float) -> int | None:
    """How many of the m - 1 pairs of neighbouring letters of a string stand in a window of n letters that is similar enough; none if none can be.

    With l letters in common, all pairs do but 2 (m - l) + (n - l), and 200 l >= least (m + n).
    """
    common = math.ceil(least * (m + n) / 200 - 1e-9)
    return 3 * common - m - n - 1 if common <= min(m, n) else None


def _pair_places(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For every pair of neighbouring letters its string's number and a bucket."""
    sizes = np.array([len(t) for t in strings])
    letters = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    of = np.repeat(np.arange(len(strings)), sizes)
    inside = of[:-1] == of[1:]
    return of[:-1][inside], ((letters[:-1] * 40_503 + letters[1:] * 977) % 65_521 % BUCKETS)[inside]


def _alike(shorts: list[str], longs: list[str], least: float, margin: int) -> Iterator[tuple[int, list[int]]]:
    """For each short string the long ones, at least ``margin`` letters longer, that have a window similar enough.

    The pairs of letters that stand anywhere in the other string are counted for all
    strings at once by a product of matrices; only what has enough of them is compared
    window by window.
    """
    by_size = sorted(range(len(longs)), key=lambda k: len(longs[k]))
    order = sorted(range(len(shorts)), key=lambda k: len(shorts[k]))
    sizes = np.array([len(shorts[k]) for k in order])
    need = {m: min((p for n in range(1, m + 1) if (p := _least_pairs(m, n, least)) is not None), default=m) for m in set(sizes.tolist())}
    a = 0
    while a < len(by_size):
        z = min(len(by_size), a + 8192)
        while z > a + 1 and (z - a) * len(longs[by_size[z - 1]]) > 1 << 22:
            z = a + (z - a) // 2
        block = by_size[a:z]
        a = z
        there = [longs[k] for k in block]
        length = np.array([len(t) for t in there])
        fit = int(np.searchsorted(sizes, length[-1] - margin, "right"))
        if not fit:
            continue
        windows = _Windows(there, int(sizes[fit - 1]), least)
        present = np.zeros((len(there), BUCKETS), np.float32)
        present[_pair_places(there)] = 1
        tile = max(1, (1 << 22) // len(there))
        for b in range(0, fit, tile):
            part = order[b : min(fit, b + tile)]
            of, bucket = _pair_places([shorts[k] for k in part])
            counts = np.bincount(of * BUCKETS + bucket, minlength=len(part) * BUCKETS).astype(np.float32).reshape(-1, BUCKETS)
            m = sizes[b : b + len(part)]
            enough = counts @ present.T >= np.array([need[x] for x in m.tolist()])[:, None] - 0.5
            enough &= m[:, None] + margin <= length[None]
            for i, k in enumerate(part):
                rows = np.flatnonzero(enough[i])
                if rows.size and (found := windows.like(shorts[k], rows)):
                    yield k, [block[r] for r in found]


class _Windows:
    """The windows of long strings, to be compared with shorter strings of up to ``edge`` letters."""

    def __init__(self, longs: list[str], edge: int, least: float) -> None:
        self.longs, self.edge, self.least = longs, edge, least
        self.ids: dict[str, int] = {}
        self.letters: dict[str, int] = {}
        self.length = np.array([len(t) for t in longs])
        self.longest = int(self.length.max())
        self.width = self.longest + 2 * edge
        self.pairs = np.zeros((len(longs), self.width), np.int32)  # 0 is no pair
        codes = np.zeros((len(longs), self.width), np.int32)  # 0 is no letter
        for k, t in enumerate(longs):
            self.pairs[k, edge : edge + len(t) - 1] = [self.ids.setdefault(t[j : j + 2], len(self.ids) + 1) for j in range(len(t) - 1)]
            codes[k, edge : edge + len(t)] = [self.letters.setdefault(c, len(self.letters) + 1) for c in t]
        self.codes = codes.ravel()

    def like(self, term: str, rows: np.ndarray) -> list[int]:
        """Those of the rows that have a window as similar to the term as ``least``."""
        m = len(term)
        held = np.array([term in self.longs[k] for k in rows.tolist()])
        out, rows = rows[held].tolist(), rows[~held]
        if not rows.size:
            return out
        length = self.length[rows]
        row, start = self._places(term, rows, length)
        good = np.zeros(len(rows), bool)
        for a in range(0, len(row), 1 << 19):
            r, w = row[a : a + (1 << 19)], start[a : a + (1 << 19)]
            size = np.minimum(length[r], w + m) - np.maximum(w, 0)
            common = self._common(term, rows[r] * self.width + self.edge + w)
            good[r[200.0 * common / (m + size) >= self.least - 1e-9]] = True
        return out + rows[good].tolist()

    def _places(self, term: str, rows: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``rows`` and starts of the windows that have enough of the term's pairs of letters, but for the term itself."""
        m = len(term)
        # Windows that go over an end of their string are shorter.
        shorter = [(n, low) for n in range(1, m) if (low := _least_pairs(m, n, self.least)) is not None]
        sizes, lows = np.array([n for n, _ in shorter], np.int64), np.array([low for _, low in shorter], np.int64)
        alone = math.ceil(self.least * m / 100 - 1e-9) == m  # of whole windows only the term itself is similar enough
        if alone:
            r, n = np.repeat(np.arange(len(rows)), len(sizes)), np.tile(sizes, len(rows))
            return np.concatenate([r, r]), np.concatenate([n - m, length[r] - n])
        wanted = np.zeros(len(self.ids) + 1, bool)
        wanted[[self.ids[p] for j in range(m - 1) if (p := term[j : j + 2]) in self.ids]] = True
        longest = int(length.max())
        here = wanted[self.pairs[rows, self.edge : self.edge + longest]]
        seen = np.zeros((len(rows), longest + 1), np.int16 if longest < 1 << 15 else np.int32)
        np.cumsum(here, axis=1, out=seen[:, 1:], dtype=seen.dtype)
        r, w = np.nonzero(seen[:, m - 1 : longest] - seen[:, : longest - m + 1] >= _least_pairs(m, m, self.least))
        inside = w + m <= length[r]
        first, n = np.nonzero(seen[:, sizes - 1] >= lows)
        each = np.arange(len(rows))[:, None]
        last, z = np.nonzero(seen[each, length[:, None] - 1] - seen[each, length[:, None] - sizes] >= lows)
        return np.concatenate([r[inside], first, last]), np.concatenate([w[inside], sizes[n] - m, length[last] - sizes[z]])

    def _common(self, term: str, at: np.ndarray) -> np.ndarray:
        """Length of the longest common subsequence of the term and each window of as many letters, bit-parallel, 62 bits a word."""
        m, bits, size = len(term), 62, -(-len(term) // 62)
        masks = np.zeros((size, len(self.letters) + 1), np.uint64)
        for i, c in enumerate(term):
            if c in self.letters:
                masks[i // bits, self.letters[c]] |= np.uint64(1 << i % bits)
        full = np.uint64((1 << bits) - 1)
        state = [np.full(len(at), full) for _ in range(size)]
        for j in range(m):
            letter = self.codes[at + j]
            carry = None
            for w in range(size):
                s = state[w]
                u = s & masks[w][letter]
                t = s + u if carry is None else s + u + carry
                carry = t >> np.uint64(bits)
                state[w] = (t & full) | (s & ~u)
        tops = [min(bits, m - w * bits) for w in range(size)]
        return m - sum(np.bitwise_count(s & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in zip(state, tops))


def lexical_clusters(terms: DataFrame, clusters: DataFrame, least: float = 80.0) -> DataFrame:
    """Clusters (id, text) whose lower-case text fuzzily holds a term of the query: query_id, id.

    A task holds queries and reads its share of the clusters as a stream.  Different
    terms are few beside queries, so each is matched once; the queries of a cluster's
    terms are united where they are found, so pairs are not shuffled.
    """
    ckind, qkind = clusters.schema["id"].dataType.simpleString(), terms.schema["query_id"].dataType.simpleString()
    parts = max(1, -(-terms.count() // 50_000))
    asks = terms.select("query_id", F.explode("terms").alias("term")).groupBy("query_id").agg(F.collect_set("term").alias("terms"))
    rows = _streams(asks, clusters.select("id", F.lower("text").alias("text")), "query_id", "id", parts, "id").select("kind", "query_id", "id", "terms", "text")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, words, post, qids, held = [], [], [], None, None
        for batch in batches:
            first = int(np.searchsorted(batch.column("kind").to_numpy(), 1))
            if first:
                asked.append(batch.slice(0, first).select(["query_id", "terms"]))
            if first == batch.num_rows or not asked:
                continue
            if qids is None:
                qids = pa.concat_arrays([x.column("query_id") for x in asked])
                coded = pa.concat_arrays([x.column("terms").flatten() for x in asked]).dictionary_encode()
                of = np.repeat(np.arange(len(qids)), np.concatenate([np.diff(x.column("terms").offsets.to_numpy()) for x in asked]))
                words, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
                order = np.argsort(code, kind="stable")
                post = np.split(of[order], np.searchsorted(code[order], np.arange(1, len(words))))
            part = batch.slice(first).select(["id", "text"])
            part = part if held is None else pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
            # The rows of one id are neighbours; those of the last one may go on in the next batch.
            ids = part.column("id")
            cuts = _cuts(ids)
            held = part.slice(cuts[-1])
            yield from _hits(part.slice(0, cuts[-1]), cuts[:-1], words, post, qids, least)
        if held is not None:
            yield from _hits(held, np.zeros(1, np.int64), words, post, qids, least)

    return rows.mapInArrow(match, f"query_id {qkind}, id {ckind}")


def _cuts(ids: pa.Array) -> np.ndarray:
    """Where runs of equal ids start."""
    code = ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
    return np.concatenate([[0], np.flatnonzero(code[1:] != code[:-1]) + 1])


def _hits(part: pa.RecordBatch, cuts: np.ndarray, words: list[str], post: list[np.ndarray], qids: pa.Array, least: float) -> Iterator[pa.RecordBatch]:
    """The pairs of queries and ids, of which each starts at a cut."""
    if not part.num_rows:
        return
    of = np.repeat(np.arange(len(cuts)), np.diff([*cuts, part.num_rows])).tolist()
    found: list[list[int]] = [[] for _ in cuts]
    for term, at in _matches(part.column("text").to_pylist(), words, least):
        for i in at:
            found[of[i]].append(term)
    query, item, n = [], [], 0
    for c, terms in enumerate(found):
        if terms:
            hit = np.zeros(len(qids), bool)
            for t in terms:
                hit[post[t]] = True
            query.append(np.flatnonzero(hit))
            item.append(np.full(len(query[-1]), cuts[c]))
            n += len(query[-1])
        if n and (n > 1 << 17 or c == len(cuts) - 1):
            yield pa.RecordBatch.from_arrays([qids.take(pa.array(np.concatenate(query))), part.column("id").take(pa.array(np.concatenate(item)))], names=["query_id", "id"])
            query, item, n = [], [], 0


def detect_language(c: Column) -> Column:
    """A coarse vote of stop words: en, de, fr, es; English for fewer than 20 characters and for ties."""
    votes = {"en": "the of and is to in for when", "de": "der die das und ist wenn für den", "fr": "le la les des est quand pour une", "es": "el los las que cuando para una por"}
    w = words(F.lower(c))

    def count(vocabulary: str) -> Column:
        return F.size(F.filter(w, lambda x: x.isin(vocabulary.split())))

    scores = F.array(*[F.struct(count(v).alias("n"), F.lit(-i).alias("o"), F.lit(k).alias("l")) for i, (k, v) in enumerate(votes.items())])
    return F.when(F.length(normalize_space(c)) < 20, "en").otherwise(F.coalesce(F.array_max(scores)["l"], F.lit("en")))


def expanded_queries(original: Column, answer: Column, k: int = 3) -> Column:
    """The original query and the non-blank lines of a model's answer, ``k`` in all."""
    lines = F.filter(F.transform(F.split(F.coalesce(answer, F.lit("")), "\n"), F.trim), lambda x: x != "")
    return F.slice(F.concat(F.array(original), lines), 1, k)
