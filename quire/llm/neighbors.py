"""Problem 6: the k most similar vectors for every vector.

Method: a hash-prefix forest.  Every tree gives each vector a long string of bits and
keeps the vectors sorted by it.  The first letter of a string names which of 64 random
directions the vector, seen from the mean, lies nearest to, and on which side (7 bits);
such a letter prunes several times better than 7 sides of planes.  The further bits are
sides of random planes.

A vector descends to the longest prefix that it shares with others in each tree and then
ascends in all trees at once, one bit at a time, until the vectors that share its
prefixes in all trees together are ``candidates`` or more; these are compared.

A tree is sorted across the cluster: counts of short prefixes, of fixed size, cut it
into ranges of whole prefixes that each fit a task.  The same counts tell each vector
its level of ascent before anything is sent.  A vector whose prefix spans several ranges
asks in each of them.  Where even the longest counted prefix is too full, the task
descends by itself to the bits behind it.

Vectors travel as unit vectors of half precision, or of 6 bits a number where the cosines
are computed again exactly.  Equal vectors are merged before, so copies neither fill the
candidate lists nor make a prefix that cannot be divided.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.cut import cut

BITS, LETTER, DIRECTIONS = 48, 7, 64


def unit_vectors(df: DataFrame, key: str, field: str, exact: bool = True) -> DataFrame:
    """``id``, ``dim``, ``class`` and ``unit`` of every usable vector: not null, finite, not all zero.

    ``unit`` holds numbers of half precision, or of 6 bits if not ``exact``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, names, units = [], [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.array([np.nan]) if not v.is_valid else v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                norm = np.sqrt(x @ x) if x.size else 0.0
                if i is not None and norm > 0 and np.isfinite(norm):
                    ids.append(i)
                    dims.append(x.size)
                    names.append(hashlib.md5(x.tobytes()).digest())
                    units.append(((x / norm).astype(np.float16) if exact else _six_bits(x)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(names, pa.binary()), pa.array(units, pa.binary())], names=["id", "dim", "class", "unit"])

    return df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{field}`").alias("v")).mapInArrow(run, "id long, dim int, class binary, unit binary")


def _six_bits(x: np.ndarray) -> np.ndarray:
    """The numbers from -31 to 31 that are nearest in proportion to ``x``, four of them in three bytes."""
    q = np.zeros(-(-x.size // 4) * 4, np.uint8)
    q[: x.size] = (np.rint(x * (31 / np.abs(x).max())) + 32).astype(np.uint8)
    a, b, c, d = q.reshape(-1, 4).T
    return np.stack([a << 2 | b >> 4, b << 4 | c >> 2, c << 6 | d], axis=1)


def _matrix(units, dim: int) -> np.ndarray:
    units = list(units)
    if not units or len(units[0]) == 2 * dim:
        return np.frombuffer(b"".join(units), np.float16).reshape(-1, dim).astype(np.float32)
    u, v, w = np.frombuffer(b"".join(units), np.uint8).reshape(-1, 3).T
    q = np.stack([u >> 2, (u & 3) << 4 | v >> 4, (v & 15) << 2 | w >> 6, w & 63], axis=1)
    x = q.reshape(len(units), -1)[:, :dim].astype(np.float32) - 32
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


@lru_cache(256)
def _tree(seed: int, tree: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The directions of the first letter and the planes of the further bits of a tree."""
    rng = np.random.default_rng([seed, tree, dim])
    return rng.standard_normal((dim, DIRECTIONS)).astype(np.float32), rng.standard_normal((dim, BITS - LETTER)).astype(np.float32)


def hash_strings(x: np.ndarray, mean: np.ndarray, tree: int, seed: int, bits: int = BITS) -> np.ndarray:
    """The first ``bits`` bits of each vector's string in a tree, as a number whose high bits come first."""
    directions, planes = _tree(seed, tree, x.shape[1])
    y = x - mean
    along = y @ directions
    near = np.abs(along).argmax(1)
    side = np.take_along_axis(along, near[:, None], 1)[:, 0] > 0
    code = side.astype(np.uint64) << np.uint64(LETTER - 1) | near.astype(np.uint64)
    if bits <= LETTER:
        return code >> np.uint64(LETTER - bits)
    more = bits - LETTER
    return code << np.uint64(more) | (y @ planes[:, :more] > 0).astype(np.uint64) @ (np.uint64(1) << np.arange(more - 1, -1, -1, dtype=np.uint64))


def ranges(counts: np.ndarray, most: int, least: int) -> np.ndarray:
    """For each short prefix the number of its range: whole prefixes, at most ``most`` vectors where a cut leaves ``least`` on both sides."""
    total = np.concatenate([[0], np.cumsum(counts)])
    out, k, stack = np.zeros(len(counts), np.int64), 0, [(0, len(counts), 0, len(counts))]
    while stack:
        lo, hi, a, b = stack.pop()
        mid = (a + b) // 2
        left, right = total[mid] - total[lo], total[hi] - total[mid]
        if left + right <= most or b - a == 1:
            out[lo:hi] = k
            k += 1
        elif left < least:
            stack.append((lo, hi, mid, b))
        elif right < least:
            stack.append((lo, hi, a, mid))
        else:
            stack += [(mid, hi, mid, b), (lo, mid, a, mid)]
    return out


def best_of(sims: np.ndarray, k: int, block: int = 64) -> np.ndarray:
    """Columns of the k largest of each row.  They lie in the k blocks with the largest maxima, so most values are looked at once."""
    rows, n = sims.shape
    if n <= 4 * k * block:
        return np.argpartition(-sims, min(k, n) - 1, axis=1)[:, :k]
    full = n // block * block
    top = sims[:, :full].reshape(rows, -1, block).max(2)
    at = np.argpartition(-top, k - 1, axis=1)[:, :k]
    cols = (at[:, :, None] * block + np.arange(block)).reshape(rows, -1)
    cols = np.concatenate([cols, np.broadcast_to(np.arange(full, n), (rows, n - full))], 1)
    pick = np.argpartition(-np.take_along_axis(sims, cols, 1), k - 1, axis=1)[:, :k]
    return np.take_along_axis(cols, pick, 1)


def levels(total: np.ndarray, codes: np.ndarray, short: int, candidates: int) -> tuple[np.ndarray, np.ndarray]:
    """The longest prefix, the same in all trees, that at least ``candidates`` vectors share with each vector; and how many do.

    ``total`` (trees, 2**short + 1) sums the counts of the short prefixes, ``codes``
    (trees, vectors) are the short prefixes of the vectors.
    """
    level = np.zeros(codes.shape[1], np.int64)
    shared = np.full(codes.shape[1], total[0, -1])
    for n in range(1, short + 1):
        up = short - n
        first = codes >> up << up
        size = np.take_along_axis(total, first + (1 << up), 1).sum(0) - np.take_along_axis(total, first, 1).sum(0)
        deep = size >= candidates
        level[deep], shared[deep] = n, size[deep]
    return level, shared


def searcher(dim: int, mean: np.ndarray, trees: int, seed: int, short: int, share: int, k: int, least: float | None):
    """The search in one range of a tree, as a function of its rows: members, and those that ask, with their level."""

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["cell"].iloc[0]) % trees
        x, ids, role = _matrix(pdf["unit"], dim), pdf["id"].to_numpy(), pdf["role"].to_numpy()
        code = hash_strings(x, mean, tree, seed)
        member = np.flatnonzero(role & 1)
        member = member[np.argsort(code[member], kind="stable")]
        keys, y = code[member], x[member]
        place = np.full(len(ids), -1)
        place[member] = np.arange(len(member))
        asks = np.flatnonzero(role >> 1)
        level = (role[asks] >> 1) - 1

        def bounds(at, level):
            up = (BITS - level).astype(np.uint64)
            first = code[at] >> up << up
            return np.searchsorted(keys, first), np.searchsorted(keys, first + (np.uint64(1) << up) - np.uint64(1), side="right")

        lo, hi = bounds(asks, level)
        full = np.flatnonzero((level == short) & (hi - lo > 2 * share))
        for n in range(short + 1, BITS + 1):
            if not full.size:
                break
            a, b = bounds(asks[full], np.full(full.size, n))
            enough = b - a > share
            full, a, b = full[enough], a[enough], b[enough]
            lo[full], hi[full] = a, b
        order = np.lexsort((hi, lo))
        asks, lo, hi = asks[order], lo[order], hi[order]
        starts = np.flatnonzero(np.concatenate([[True], (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])) if asks.size else np.zeros(0, int)
        out_id, out_n, out_c = [], [], []
        for s, e in zip(starts, [*starts[1:], len(asks)]):
            a, b = int(lo[s]), int(hi[s])
            for at in range(s, e, 256):
                q = asks[at : min(e, at + 256)]
                sims = x[q] @ y[a:b].T
                own = np.flatnonzero(place[q] >= 0)
                sims[own, place[q][own] - a] = -2
                if least is not None:
                    hit = np.flatnonzero((sims >= least).any(1))
                    q, sims = q[hit], sims[hit]
                m = min(k, b - a)
                if not q.size or not m:
                    continue
                near = best_of(sims, m)
                cos = np.take_along_axis(sims, near, 1)
                good = cos >= (-1.5 if least is None else least)
                for i, j, c, g in zip(q, member[a + near], cos, good):
                    if g.any():
                        out_id.append(ids[i])
                        out_n.append(ids[j[g]])
                        out_c.append(c[g])
        return pd.DataFrame({"id": np.array(out_id, np.int64), "n": pd.Series(out_n, dtype=object), "c": pd.Series(out_c, dtype=object)})

    return search


def _by_length(reps: DataFrame, trees: int, candidates: int | None, seed: int):
    """For each length of vectors: (dim, rows, mean, candidates, short, summed counts of the short prefixes per tree).

    All of it is of fixed size: one row per length, one number per dimension, and at
    most trees * 2**16 counts, whatever the number of vectors.
    """
    for s in reps.groupBy("dim").count().collect():
        dim, n = s["dim"], s["count"]
        mine = reps.where(F.col("dim") == dim).select("id", "unit")

        def total(batches, dim=dim):
            for b in batches:
                if b.num_rows:
                    v = _matrix(b.column(0).to_pylist(), dim).sum(0, dtype=np.float64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(v)], names=["i", "v"])

        got = mine.select("unit").mapInArrow(total, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()
        mean = (np.array([r["v"] for r in got]) / n).astype(np.float32)
        want = max(1000, int(4 * n**0.7)) if candidates is None else candidates
        short = int(np.clip(np.ceil(np.log2(max(1, n * trees / want))) + 3, 1, 16))

        def tally(batches, dim=dim, mean=mean, short=short):
            counts = np.zeros((trees, 1 << short), np.int64)
            for b in batches:
                if b.num_rows:
                    x = _matrix(b.column(0).to_pylist(), dim)
                    for t in range(trees):
                        counts[t] += np.bincount(hash_strings(x, mean, t, seed, short).astype(np.int64), minlength=1 << short)
            t, c = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(c), pa.array(counts[t, c])], names=["t", "c", "n"])

        counted = mine.select("unit").mapInArrow(tally, "t long, c long, n long").groupBy("t", "c").agg(F.sum("n").alias("n")).toArrow()
        hist = np.zeros((trees, 1 << short), np.int64)
        hist[counted.column("t").to_numpy(), counted.column("c").to_numpy()] = counted.column("n").to_numpy()
        yield dim, mine, mean, want, short, hist


def rep_neighbours(reps: DataFrame, k: int, trees: int, candidates: int | None, seed: int, least: float | None = None, most: int = 20_000) -> DataFrame:
    """``id`` and ``near``, the k best (cosine, -id) of the merged trees, best first.  ``most``: vectors in a range of a tree."""
    parts = []
    for dim, mine, mean, want, short, hist in _by_length(reps, trees, candidates, seed):
        summed = np.concatenate([np.zeros((trees, 1), np.int64), np.cumsum(hist, 1)], 1)
        cell = np.stack([ranges(h, most, 1) for h in hist])

        def spread(batches, dim=dim, mean=mean, want=want, short=short, summed=summed, cell=cell):
            for b in batches:
                if not b.num_rows:
                    continue
                x = _matrix(b.column(1).to_pylist(), dim)
                codes = np.stack([hash_strings(x, mean, t, seed, short) for t in range(trees)]).astype(np.int64)
                level, _ = levels(summed, codes, short, want)
                for t in range(trees):
                    # Who ascends to the root would ask everybody in every tree; one is enough.
                    asks = (level > 0) | (t == 0)
                    up = short - level
                    first = codes[t] >> up << up
                    own = cell[t][codes[t]]
                    lo, hi = np.where(asks, cell[t][first], own), np.where(asks, cell[t][first + (1 << up) - 1], own)
                    at = np.repeat(np.arange(len(x)), hi - lo + 1)
                    c = lo[at] + np.arange(len(at)) - np.repeat(np.cumsum(hi - lo + 1) - (hi - lo + 1), hi - lo + 1)
                    role = np.where(asks[at], (level[at] + 1) << 1, 0) | (c == own[at])
                    take = pa.array(at)
                    yield pa.RecordBatch.from_arrays([pa.array(c * trees + t), pa.array(role.astype(np.int32)), b.column(0).take(take), b.column(1).take(take)], names=["cell", "role", "id", "unit"])

        sent = mine.mapInArrow(spread, "cell long, role int, id long, unit binary")
        # As many partitions as the rows ask for, so that no task grows with the table.
        sent = sent.repartition(max(1, math.ceil(int(summed[:, -1].sum()) / (4 * most))), "cell")
        parts.append(sent.groupBy("cell").applyInPandas(searcher(dim, mean, trees, seed, short, max(1, want // trees), k, least), "id long, n array<long>, c array<float>"))
    if not parts:
        return reps.select("id", F.array(F.struct(F.lit(0.0).cast("float").alias("c"), F.lit(0).cast("long").alias("i"))).alias("near")).where("false")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionAll(p)
    zipped = F.zip_with("c", "n", lambda c, n: F.struct(c.alias("c"), (-n).alias("i")))
    merged = F.sort_array(F.array_distinct(F.flatten(F.collect_list(zipped))), asc=False)
    # The same pair can differ in the last bit between trees; one entry per neighbour is kept.
    return found.groupBy("id").agg(F.slice(merged, 1, 3 * k).alias("near")).select(
        "id", F.slice(F.filter("near", lambda x, i: ~F.exists(F.slice("near", F.lit(1), i), lambda y: y["i"] == x["i"])), 1, k).alias("near")
    )


def effort(df: DataFrame, key: str, field: str, trees: int = 32, candidates: int | None = None, seed: int = 5) -> DataFrame:
    """One row: vectors (without copies), comparisons the forest makes for each in the mean, and their share of brute force.

    A vector that is met in several trees counts as often.  The descent behind the counted
    bits, inside a task, is not counted, so for hot prefixes the figure is too high.
    """
    base = cut(unit_vectors(df, key, field))
    first = base.groupBy("class").agg(F.min("id").alias("id"))
    reps = base.hint("merge").join(first.select("id").hint("merge"), "id", "left_semi").dropDuplicates(["id"])
    parts = []
    for dim, mine, mean, want, short, hist in _by_length(reps, trees, candidates, seed):
        summed = np.concatenate([np.zeros((trees, 1), np.int64), np.cumsum(hist, 1)], 1)

        def count(batches, dim=dim, mean=mean, want=want, short=short, summed=summed):
            for b in batches:
                if b.num_rows:
                    x = _matrix(b.column(0).to_pylist(), dim)
                    codes = np.stack([hash_strings(x, mean, t, seed, short) for t in range(trees)]).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([len(x)]), pa.array([int(levels(summed, codes, short, want)[1].sum())]), pa.array([len(x) * int(summed[0, -1])])], names=["n", "compared", "every"])

        parts.append(mine.select("unit").mapInArrow(count, "n long, compared long, every long"))
    out = parts[0] if parts else base.selectExpr("id AS n", "id AS compared", "id AS every").where("false")
    for p in parts[1:]:
        out = out.unionAll(p)
    return out.agg(F.sum("n").alias("vectors"), F.round(F.sum("compared") / F.sum("n"), 1).alias("comparisons"), F.round(F.sum("compared") / F.sum("every"), 4).alias("share"))


def _cosine(a, b):
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda u, v: u.cast("double") * v), F.lit(0.0), lambda s, u: s + u)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def nearest(df: DataFrame, key: str, field: str, k: int = 10, trees: int = 32, candidates: int | None = None, seed: int = 5, least: float | None = None) -> DataFrame:
    """For every usable vector its ``k`` most similar others by cosine: row, other, rank (from 1), cosine.

    ``key`` must be a unique number.  Null, non-finite and all-zero vectors have no row;
    vectors of different length are compared among their own length only.  Equal
    cosines rank by the smaller key.  Of many equal vectors only the k + 1 with the
    smallest keys can be among anyone's k nearest, so only those are listed.

    ``candidates`` is 4 n ** 0.7 of n vectors (at least 1,000) unless given: the
    comparisons that equal recall asks for grow so for vectors without structure.
    With ``least``, only neighbours of at least this cosine are looked for, and their
    cosines and ranks are exact.
    """
    base = cut(unit_vectors(df, key, field, least is None))
    first = base.groupBy("class").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    members = base.select("id", "class").hint("merge").join(first.hint("merge"), "class")
    reps = cut(base.select("id", "dim", "unit").hint("merge").join(first.select(F.col("rep").alias("id")).hint("merge"), "id", "left_semi").dropDuplicates(["id"]))
    # Cosines of 6 bits are off by about 0.005: a margin, and some more neighbours, are kept until they are exact.
    lists = cut(rep_neighbours(reps, k if least is None else 2 * k, trees, candidates, seed, least if least is None else least - 0.03))
    place = F.row_number().over(Window.partitionBy("rep").orderBy("id"))
    several = members.where("copies > 1").select("rep", "id").distinct().withColumn("r", place).where(F.col("r") <= k + 1).groupBy("rep").agg(F.collect_list("id").alias("ids"))
    several = cut(several)
    pairs = lists.select(F.col("id").alias("rep"), F.explode("near").alias("x")).select("rep", F.col("x.c").cast("double").alias("c"), (-F.col("x.i")).alias("other"))
    if least is not None:
        vec = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{field}`").alias("v")).hint("merge")
        one = pairs.select("rep", "other").hint("merge").join(vec.withColumnsRenamed({"id": "rep", "v": "va"}), "rep").hint("merge")
        both = one.join(vec.withColumnsRenamed({"id": "other", "v": "vb"}), "other")
        pairs = both.select("rep", _cosine(F.col("va"), F.col("vb")).alias("c"), "other").where(F.col("c") >= least - 1e-9)
    wide = pairs.hint("merge").join(several.withColumnRenamed("rep", "other").hint("merge"), "other", "left").select("rep", "c", F.explode(F.coalesce("ids", F.array("other"))).alias("other"))
    own = several.select("rep", F.lit(1.0).alias("c"), F.explode("ids").alias("other"))
    ranked = wide.unionAll(own).groupBy("rep").agg(F.slice(F.sort_array(F.collect_list(F.struct("c", (-F.col("other")).alias("i"))), asc=False), 1, k + 1).alias("near"))
    return (
        members.select("id", "rep").hint("merge")
        .join(ranked.hint("merge"), "rep")
        .select("id", F.slice(F.filter("near", lambda x: x["i"] != -F.col("id")), 1, k).alias("near"))
        .select(F.col("id").alias("row"), F.posexplode("near").alias("p", "x"))
        .select("row", (-F.col("x.i")).alias("other"), (F.col("p") + 1).alias("rank"), F.col("x.c").cast("float").alias("cosine"))
    )


def similar_vector_pairs(df: DataFrame, key: str, field: str, least: float = 0.9, k: int = 10, **forest) -> DataFrame:
    """Pairs row_a < row_b of which one is among the ``k`` nearest of the other and whose exact cosine is at least ``least``."""
    near = nearest(df, key, field, k, least=least, **forest)
    return near.select(F.least("row", "other").alias("row_a"), F.greatest("row", "other").alias("row_b")).distinct()


def recall(df: DataFrame, key: str, field: str, k: int = 10, every: int = 20, block: int = 50_000, chunk: int = 5_000, **forest) -> DataFrame:
    """One row: queries (keys divisible by ``every``), found, wanted, recall of :func:`nearest` against brute force.

    Blocks of about ``block`` vectors meet chunks of about ``chunk`` queries, each pair of
    them in one task, which keeps the k best of each query.
    """
    base = cut(unit_vectors(df, key, field))
    n = base.count()
    blocks, chunks = n // block + 1, n // every // chunk + 1
    spot = lambda parts, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(parts))
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    asked = base.where(F.col("id") % every == 0).select("id", "dim", "unit", F.lit(True).alias("asks"), each(blocks).alias("block"), spot(chunks, 1).cast("int").alias("chunk"))
    there = base.select("id", "dim", "unit", F.lit(False).alias("asks"), spot(blocks, 2).cast("int").alias("block"), each(chunks).alias("chunk"))

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        dim = int(pdf["dim"].iloc[0])
        q, y = pdf[pdf["asks"]], pdf[~pdf["asks"]]
        rows, others, cos = [], [], []
        qi, yi, ym = q["id"].to_numpy(), y["id"].to_numpy(), _matrix(y["unit"], dim)
        m = min(k, len(yi))
        for a in range(0, len(qi) if m else 0, 256):
            sims = _matrix(q["unit"].iloc[a : a + 256], dim) @ ym.T
            sims[qi[a : a + 256, None] == yi[None, :]] = -2
            near = best_of(sims, m)
            rows.append(np.repeat(qi[a : a + 256], m))
            others.append(yi[near].ravel())
            cos.append(np.take_along_axis(sims, near, 1).ravel())
        return pd.DataFrame({"row": np.concatenate(rows) if rows else np.zeros(0, np.int64), "other": np.concatenate(others) if rows else np.zeros(0, np.int64), "c": np.concatenate(cos) if rows else np.zeros(0, np.float32)})

    best = asked.unionAll(there).groupBy("dim", "block", "chunk").applyInPandas(scan, "row long, other long, c float").where("c > -2")
    true = best.groupBy("row").agg(F.slice(F.sort_array(F.collect_list(F.struct("c", (-F.col("other")).alias("i"))), asc=False), 1, k).alias("t"))
    worst = true.select("row", F.element_at("t", -1)["c"].alias("least"), F.size("t").alias("n"))
    # A neighbour counts as found when its cosine is that of a true one, so ties do not count against it.
    hits = nearest(df, key, field, k, **forest).hint("merge").join(worst.hint("merge"), "row").where(F.col("cosine") >= F.col("least") - 1e-4).groupBy("row").agg(F.count("*").alias("hit"))
    return worst.hint("merge").join(hits.hint("merge"), "row", "left").agg(F.count("*").alias("queries"), F.sum(F.least(F.coalesce("hit", F.lit(0)), "n")).alias("found"), F.sum("n").alias("wanted")).withColumn("recall", F.round(F.col("found") / F.col("wanted"), 4))
