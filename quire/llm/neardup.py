"""Problem 3: groups of records that are slightly changed copies of each other.

Method: a partitioned Hamming search after the generalised pigeonhole principle.

* A text is the set of its runs of ``words`` consecutive words.  Min-wise hashing
  sketches it into a vector of SYMBOLS symbols; two texts of similarity s differ in
  each symbol with probability 1 - s, so similar texts are near in Hamming distance.
* The bits of a symbol differ together: they stay in one partition and count as one
  difference.  The symbols themselves come from independent orders and are put together
  as they come, so that whether two texts meet in a partition does not depend on
  whether they meet in another (grouped by joint agreement they did; see the README).
* Each partition gets a threshold of its own: how many of its symbols may differ, or -1
  for a partition that is not probed.  Dynamic programming allocates them at the least
  number of index rows and candidates, the latter estimated from all texts, and so
  that a pair at the similarity threshold is found with the probability ``recall``.
  Every second partition has the threshold that is cheapest in the mean, whatever its
  own counts: were all free, a large family of copies would decide by its own pairs
  which partitions are probed, and those in which its members meet would be the dear ones.
  The width of the partitions is the one of WIDTHS whose allocation is cheapest.
* Two texts differ in at most t of w symbols just when they agree on some w - t of
  them, whatever their positions; the index holds one row for each such choice.
* Every candidate is verified exactly on the sets.

The classic principle asks for thresholds that find every pair whatever the position
of its differences.  For similarity 0.6 these must add up to more than a third of all
symbols, which makes almost every pair of texts a candidate; the constraint is
therefore on the probability.  The thresholds are the same for all texts: chosen per
text by the counts of its own signatures they would avoid just those that it shares
with its copies.

Exact copies are merged into one class before the search, so a text held by any share
of the rows is searched once.  No join here may be broadcast: the optimiser takes the
output of Python for much smaller than it is, hence the merge hints.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.cut import cut

_WORD = re.compile(r"[^\W_]+")

SYMBOLS = 240
WIDTHS = {4: 1, 6: 2}  # width of a partition: the most symbols of it that may differ
CHOICES = {w: np.array([math.comb(w, t) for t in range(most + 1)]) for w, most in WIDTHS.items()}  # index rows for each threshold
SKETCH_BUCKETS = 1 << 10
_PAIR_COST = 8  # a candidate costs as much as so many index rows
_SEED = np.random.default_rng(20240229)
_XOR = _SEED.integers(0, 2**32, SYMBOLS, dtype=np.uint32)
_MUL = _SEED.integers(0, 2**32, SYMBOLS, dtype=np.uint32) | np.uint32(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


class _Words(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        b = word.encode()
        h = self[word] = zlib.crc32(b) << 32 | zlib.crc32(b[::-1] + b"|")
        return h


def shingles(texts: list[str | None], words: int, known: _Words) -> list[np.ndarray]:
    """For each text the sorted hashes of the runs of ``words`` words; empty for a text with fewer."""
    found = [_WORD.findall(t.lower()) if t else [] for t in texts]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    v = np.fromiter((known[w] for ws in found for w in ws), np.uint64, int(sizes.sum()))
    if len(v) < words:
        return [np.zeros(0, np.uint64)] * len(texts)
    text = np.repeat(np.arange(len(texts)), sizes)
    h = np.zeros(len(v) - words + 1, np.uint64)
    for k in range(words):
        h = _scramble(h * _MIX + v[k : len(v) - words + 1 + k])
    inside = text[: len(h)] == text[words - 1 :]
    h, text = h[inside], text[: len(h)][inside]
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    h, text = h[new], text[new]
    return np.split(h, np.cumsum(np.bincount(text, minlength=len(texts)))[:-1])


def shingle_sets(df: DataFrame, key: str, field: str, words: int) -> DataFrame:
    """``id``, ``class`` (shared by equal sets), ``n`` and ``grams`` of every text that has a shingle; one narrow pass.

    Classes are named by all 64 bits of each shingle, ``grams`` holds 32 of them: in a
    pair of texts of 100 shingles two different ones meet with a chance of 1 in 400,000.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = shingles(part.column(1).to_pylist(), words, known)
                keep = [i for i, s in enumerate(sets) if s.size]
                if not keep:
                    continue
                sets = [sets[i] for i in keep]
                grams = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]).astype(np.int32)), pa.array((np.concatenate(sets) >> np.uint64(32)).astype(np.uint32).view(np.int32)))
                names = pa.array([hashlib.md5(s.tobytes()).digest() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(keep)), names, pa.array([s.size for s in sets], pa.int32()), grams], names=["id", "class", "n", "grams"])

    return df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{field}`").alias("text")).mapInArrow(run, f"id {kind}, class binary, n int, grams array<int>")


def symbols(sets: list[np.ndarray]) -> np.ndarray:
    """The sketch of each set, (sets, SYMBOLS): the least of its shingles in SYMBOLS random orders."""
    flat, sizes = np.concatenate(sets), np.fromiter(map(len, sets), np.int64, len(sets))
    first = np.cumsum(sizes) - sizes
    out = np.empty((SYMBOLS, len(sets)), np.uint32)
    for j in range(SYMBOLS):
        out[j] = np.minimum.reduceat((flat ^ _XOR[j]) * _MUL[j], first)
    return out.T


def signatures(sketch: np.ndarray, groups: np.ndarray, differ: int) -> np.ndarray:
    """(texts, partitions, choices): a hash of the symbols of each partition, for each choice of all but ``differ`` of them."""
    each = _scramble(sketch.astype(np.uint64) + np.arange(SYMBOLS, dtype=np.uint64) * _MIX)[:, groups]
    whole = each.sum(2, keepdims=True)
    left_out = list(itertools.combinations(range(groups.shape[1]), differ))
    without = [sum((each[:, :, k] for k in out), np.zeros(each.shape[:2], np.uint64)) for out in left_out]
    name = (groups[:, :1] * 64 + np.arange(len(left_out))).astype(np.uint64) * _MIX
    return _scramble(whole - np.stack(without, axis=2) + name)


def allocate(costs: np.ndarray, gains: np.ndarray, need: float, steps: int = 500) -> np.ndarray:
    """Thresholds by dynamic programming: for each row and partition an option (or -1: not probed).

    ``costs`` (rows, partitions, options) are estimated candidate counts, ``gains``
    (options) what an option adds to -log(miss).  The sum of gains must reach ``need``
    (or the most that is possible) at the least cost.  Gains are rounded down to
    ``need / steps``, so the constraint always holds.
    """
    texts, parts, options = costs.shape
    unit = np.floor(gains / need * steps).astype(int)
    steps = min(steps, int(unit.max()) * parts)
    best = np.full((texts, steps + 1), np.inf)
    best[:, 0] = 0
    took = np.full((parts, texts, steps + 1), -1, np.int8)
    history = []
    for p in range(parts):
        history.append(best)
        new = best.copy()
        for o in range(options):
            # From every level up by the option's gain; what goes beyond the last level counts as the last.
            reach = np.full_like(best, np.inf)
            reach[:, unit[o] :] = best[:, : steps + 1 - unit[o]]
            reach[:, steps] = best[:, steps - unit[o] :].min(1)
            reach += costs[:, p, o, None]
            better = reach < new
            new[better] = reach[better]
            took[p][better] = o
        best = new
    out = np.full((texts, parts), -1, np.int8)
    level = np.full(texts, steps)
    for p in range(parts - 1, -1, -1):
        out[:, p] = took[p][np.arange(texts), level]
        for o in range(options):
            at = np.flatnonzero(out[:, p] == o)
            top = at[level[at] == steps]
            level[at] -= unit[o]
            if top.size:  # the last level may have come from any within reach
                level[top] = steps - unit[o] + history[p][top, steps - unit[o] :].argmin(1)
    return out


def _blocks(batches: Iterator[pa.RecordBatch], column: int, size: int = 1000) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows in blocks, each with the sketches of its sets."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            col = part.column(column)
            offs = col.offsets.to_numpy()
            vals = col.values.to_numpy().view(np.uint32)
            yield part, symbols([vals[a:b] for a, b in zip(offs, offs[1:])])


def _sums(reps: DataFrame, size: int, add) -> np.ndarray:
    """The sums over all texts of ``size`` counters, which ``add(counters, sketches)`` changes block by block in every task."""

    def tally(batches):
        counters = np.zeros(size, np.int64)
        for _, sketch in _blocks(batches, 0):
            add(counters, sketch)
        at = np.flatnonzero(counters)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counters[at])], names=["at", "c"])

    got = reps.select("grams").mapInArrow(tally, "at int, c long").groupBy("at").agg(F.sum("c").alias("c")).toArrow()
    out = np.zeros(size)
    out[got.column("at").to_numpy()] = got.column("c").to_numpy()
    return out


def candidate_counts(reps: DataFrame, groups: dict[int, np.ndarray]) -> tuple[dict[int, np.ndarray], int]:
    """For each width (partitions, thresholds): estimated pairs of texts within each threshold; and the number of texts.

    Every task counts the signatures of its texts in SKETCH_BUCKETS buckets per
    partition and threshold; the sums, of fixed size whatever the number of texts, give
    the second moments, corrected for texts that share a bucket by chance.
    """
    shapes = [(w, t, len(g)) for w, g in groups.items() for t in range(WIDTHS[w] + 1)]
    rows = sum(n for *_, n in shapes)

    def add(counters, sketch):
        first = 0
        for w, t, n in shapes:
            at = (signatures(sketch, groups[w], t) >> np.uint64(40)).astype(np.int64) % SKETCH_BUCKETS
            at += (first + np.arange(n))[None, :, None] * SKETCH_BUCKETS
            counters += np.bincount(at.ravel(), minlength=len(counters))
            first += n

    sums = _sums(reps, rows * SKETCH_BUCKETS, add).reshape(rows, SKETCH_BUCKETS)
    n = sums.sum(1)
    second = ((sums**2).sum(1) - n * n / SKETCH_BUCKETS) / (1 - 1 / SKETCH_BUCKETS)
    pairs = np.split(np.maximum(second - n, 0) / 2, np.cumsum([k for *_, k in shapes])[:-1])
    return {w: np.stack([x for x, (v, *_) in zip(pairs, shapes) if v == w], axis=1) for w in groups}, int(n[0])


def plan_of(reps: DataFrame, threshold: float, recall: float) -> dict[int, np.ndarray]:
    """For each threshold the partitions that are probed with it: the cheapest allocation over all widths."""
    groups = {w: np.arange(SYMBOLS).reshape(-1, w) for w in WIDTHS}
    pairs, n = candidate_counts(reps, groups)
    best, least = {}, math.inf
    for w, g in groups.items():
        hit = np.array([sum(math.comb(w, d) * threshold ** (w - d) * (1 - threshold) ** d for d in range(t + 1)) for t in range(WIDTHS[w] + 1)])
        gains, need = -np.log1p(-hit), -math.log(1 - recall)
        # A partition costs a row per text and choice, which is sent and sorted, and its candidates.
        costs = pairs[w] * _PAIR_COST + CHOICES[w] * max(n, 1)
        fixed, free = np.arange(0, len(g), 2), np.arange(1, len(g), 2)
        same = int(np.argmin(costs.mean(0) / gains))
        fixed = fixed[: math.ceil(need / 2 / gains[same])]
        took = np.full(len(g), -1)
        took[fixed] = same
        left = need - len(fixed) * gains[same]
        if left > 0:
            took[free] = allocate(costs[None, free], gains, left)[0]
        cost = sum(costs[p, t] for p, t in enumerate(took) if t >= 0)
        if cost < least and sum(gains[t] for t in took if t >= 0) >= need - 1e-9:
            least, best = cost, {int(t): g[took == t] for t in np.unique(took) if t >= 0}
    return best


def candidate_pairs(reps: DataFrame, threshold: float, recall: float = 0.998) -> DataFrame:
    """Distinct pairs a < b of ids that meet the threshold of a partition, and have compatible set sizes."""
    kind = reps.schema["id"].dataType.simpleString()
    probes = plan_of(reps, threshold, recall)

    def index(batches):
        for rows, sketch in _blocks(batches, 2):
            sig = np.concatenate([signatures(sketch, g, t).reshape(len(sketch), -1) for t, g in probes.items()], axis=1)
            at = pa.array(np.repeat(np.arange(len(sketch)), sig.shape[1]))
            yield pa.RecordBatch.from_arrays([pa.array(sig.reshape(-1).view(np.int64)), rows.column(0).take(at), rows.column(1).take(at)], names=["sig", "id", "n"])

    # Both sides are the same plan, so the index is made and sent once; hot signatures are split by adaptive execution.
    rows = reps.select("id", "n", "grams").mapInArrow(index, f"sig long, id {kind}, n int").hint("merge")
    a, b = F.col("x.n"), F.col("y.n")
    met = rows.alias("x").join(rows.alias("y"), (F.col("x.sig") == F.col("y.sig")) & (F.col("x.id") < F.col("y.id")) & (F.least(a, b) >= F.greatest(a, b) * F.lit(threshold) - 1e-9))
    return met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def similar_classes(sets: DataFrame, threshold: float, recall: float = 0.998) -> tuple[DataFrame, DataFrame]:
    """(members, links): id and rep of every record, and verified links (a, b, similarity) between representatives.

    ``sets`` is the output of :func:`shingle_sets`, cut.  The representative of a
    class of equal sets is its smallest id.
    """
    first = sets.groupBy("class").agg(F.min("id").alias("rep"))  # combined before the shuffle, so a hot class is one row per task
    members = cut(sets.select("id", "class").hint("merge").join(first.hint("merge"), "class").select("id", "rep"))
    own = members.where("id = rep").select("id").distinct().hint("merge")
    reps = cut(sets.select("id", "n", "grams").hint("merge").join(own, "id", "left_semi").dropDuplicates(["id"]))
    pairs = candidate_pairs(reps, threshold, recall).hint("merge")
    side = reps.select("id", "grams").hint("merge")
    checked = (
        pairs.join(side.withColumnsRenamed({"id": "a", "grams": "ga"}), "a").hint("merge")
        .join(side.withColumnsRenamed({"id": "b", "grams": "gb"}), "b")
        .withColumn("common", F.size(F.array_intersect("ga", "gb")))
        .withColumn("similarity", F.col("common") / (F.size("ga") + F.size("gb") - F.col("common")))
    )
    return members, checked.where(F.col("similarity") >= threshold - 1e-12).select("a", "b", "similarity")


def similar_pairs(df: DataFrame, key: str, field: str, words: int = 5, threshold: float = 0.8, salts: int = 16) -> DataFrame:
    """All pairs row_a < row_b of records with at least ``threshold`` of their shingles in common, exact copies too.

    Texts that are null or have fewer than ``words`` words have no shingle and no pair.
    Pairs within a class of copies are made salted, so that no task gets all pairs of
    a hot class.
    """
    members, links = similar_classes(cut(shingle_sets(df, key, field, words)), threshold)
    links = cut(links)
    salt = F.pmod(F.xxhash64("id"), F.lit(salts))
    twice = members.groupBy("rep").count().where("count > 1").select("rep")
    own = members.hint("merge").join(twice.hint("merge"), "rep", "left_semi")
    left = own.select("rep", F.col("id").alias("row_a"), salt.alias("salt"))
    right = own.select("rep", F.col("id").alias("row_b"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    same = left.hint("merge").join(right.hint("merge"), ["rep", "salt"]).where("row_a < row_b").select("row_a", "row_b")
    a, b = members.withColumnsRenamed({"id": "x", "rep": "a"}), members.withColumnsRenamed({"id": "y", "rep": "b"})
    cross = links.select("a", "b").hint("merge").join(a.hint("merge"), "a").hint("merge").join(b.hint("merge"), "b").select(F.least("x", "y").alias("row_a"), F.greatest("x", "y").alias("row_b"))
    return same.unionAll(cross)


def components(links: DataFrame) -> DataFrame:
    """(id, group) of every end of a link (a, b): connected components by least labels with pointer jumping.

    Each round is written to the shared checkpoint folder; the driver learns only
    whether a label changed.
    """
    both = cut(links.select("a", "b").unionAll(links.select("b", "a")).toDF("a", "b").distinct())
    label = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("group")))
    while True:
        near = both.hint("merge").join(label.hint("merge"), F.col("b") == F.col("id")).groupBy("a").agg(F.min("group").alias("m"))
        step = label.hint("merge").join(near.hint("merge"), F.col("id") == F.col("a"), "left").select("id", F.col("group").alias("old"), F.least("group", "m").alias("group"))
        up = label.select(F.col("id").alias("group"), F.col("group").alias("top"))
        new = cut(step.hint("merge").join(up.hint("merge"), "group", "left").select("id", "old", F.least("group", "top").alias("group")))
        if new.where("group <> old").isEmpty():
            return new.select("id", "group")
        label = new.select("id", "group")


def similar_groups(df: DataFrame, key: str, field: str, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row per record: ``key``, class_id (exact copies), group_id (linked classes), links of its class.

    A record without shingles is a class and group of its own, as is one without links.
    """
    members, links = similar_classes(cut(shingle_sets(df, key, field, words)), threshold)
    links = cut(links)
    group = components(links)
    degree = links.select(F.col("a").alias("rep")).unionAll(links.select(F.col("b").alias("rep"))).groupBy("rep").agg(F.count("*").alias("links"))
    known = members.hint("merge").join(degree.hint("merge"), "rep", "left").hint("merge").join(group.withColumnRenamed("id", "rep").hint("merge"), "rep", "left").hint("merge")
    return df.select(F.col(f"`{key}`").alias("id")).distinct().join(known, "id", "left").select(
        F.col("id").alias(key), F.coalesce("rep", "id").alias("class_id"), F.coalesce("group", "rep", "id").alias("group_id"), F.coalesce("links", F.lit(0).cast("long")).alias("links")
    )
