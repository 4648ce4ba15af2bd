"""Problem 8: mixing sources to target weights.

Method: Sainte-Laguë apportionment.  The mixture is as large as the whole collection
and is handed out in blocks of equal tokens, each to the source with the highest
quotient, until a source has as many blocks as its documents give at its most
repeats.  The blocks of a source are apportioned to its shards the same way, so each
shard has a whole quota and selects its documents by itself: in seeded order, as
many full rounds as the quota holds, and the first blocks of one more.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def sainte_lague(weights: list[float], seats: int, caps: list[int]) -> list[int]:
    """Seats by the highest quotients weight / (2 * seats + 1), at most ``caps`` each; ties to the earlier.

    A bisection of the divisor gives all but the last few seats at once, so the work
    does not grow with the number of seats.
    """
    n = len(weights)
    seats = min(seats, sum(c for w, c in zip(weights, caps) if w > 0))
    if seats <= 0:
        return [0] * n

    def at(scale: float) -> list[int]:
        return [min(c, int(w * scale + 0.5)) if w > 0 else 0 for w, c in zip(weights, caps)]

    low, high = 0.0, 1.0
    while sum(at(high)) < seats:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        if sum(at(mid)) <= seats:
            low = mid
        else:
            high = mid
    got = at(low)
    # One seat back for each, then the highest quotients decide: exact also at ties.
    got = [max(0, g - 1) for g in got]
    heap = [(-weights[i] / (2 * got[i] + 1), i) for i in range(n) if weights[i] > 0 and got[i] < caps[i]]
    heapq.heapify(heap)
    for _ in range(seats - sum(got)):
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < caps[i]:
            heapq.heappush(heap, (-weights[i] / (2 * got[i] + 1), i))
    return got


def source_name(col: Column) -> Column:
    """One spelling per source: lower case, no blanks around, hyphens and blanks as underscores; blank is null."""
    name = F.regexp_replace(F.lower(F.regexp_replace(col, r"(?U)^\s+|\s+$", "")), r"(?U)[\s-]+", "_")
    return F.when(name != "", name)


def mix(docs: DataFrame, targets: DataFrame, block_tokens: int = 256, shard_docs: int = 20_000, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """Draw a mixture from ``docs`` (doc_id, source, n_tokens) to ``targets`` (source, target_share, max_repeats).

    Returns (drawn, report).  ``drawn``: doc_id, source, n_tokens, repeats, one row per
    drawn document.  ``report``: one row per target with target_share, actual_share,
    tokens drawn and available, the mean repeats and whether the cap binds.

    The mixture has as many tokens as all of ``docs``.  Where a source runs out at its
    most repeats, its missing blocks go to the sources with the highest quotients, so
    the total is kept and the report shows the change.  Documents whose source is null,
    blank or no target stay out but count for the size; null or zero sizes are never
    drawn.  ``targets`` is the plan of a person (one row per source) and is collected.
    """
    docs = docs.select("doc_id", source_name(F.col("source")).alias("source"), F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)).alias("n_tokens"))
    plan: dict[str, tuple[float, int]] = {}
    for r in targets.select(source_name(F.col("source")).alias("source"), "target_share", "max_repeats").where("source is not null").orderBy("source").collect():
        plan[r["source"]] = (max(0.0, float(r["target_share"] or 0)), max(0, int(r["max_repeats"] or 0)))
    names = sorted(plan)
    spark = docs.sparkSession
    size = docs.agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows")).first()
    total, shards = size["tokens"] or 0, max(1, -(-size["rows"] // shard_docs))
    usable = docs.where(F.col("n_tokens") > 0).where(F.col("source").isin(names)).withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(shards)))
    per_shard = usable.groupBy("source", "shard").agg(F.sum("n_tokens").alias("available"))
    have = {r["source"]: r["available"] for r in per_shard.groupBy("source").agg(F.sum("available").alias("available")).collect()}  # one row per target
    seats = sainte_lague([plan[n][0] for n in names], round(total / block_tokens), [-(-have.get(n, 0) * plan[n][1] // block_tokens) for n in names])
    blocks = dict(zip(names, seats))

    def quotas(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard", ignore_index=True)
        name = pdf["source"].iloc[0]
        caps = [-(-int(a) * plan[name][1] // block_tokens) for a in pdf["available"]]
        pdf["quota"] = [q * block_tokens for q in sainte_lague([float(a) for a in pdf["available"]], blocks[name], caps)]
        return pdf[["source", "shard", "available", "quota"]]

    quota = per_shard.groupBy("source").applyInPandas(quotas, "source string, shard long, available long, quota long")
    most = F.create_map(*[F.lit(x) for n in names for x in (n, plan[n][1])]) if names else F.create_map(F.lit(""), F.lit(0))
    order = Window.partitionBy("source", "shard").orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    drawn = (
        usable.join(quota, ["source", "shard"])
        .withColumn("before", F.sum("n_tokens").over(order) - F.col("n_tokens"))
        .withColumn("rest", F.expr("quota % available"))
        .withColumn("repeats", F.least((F.expr("quota div available") + (F.col("before") + F.col("n_tokens") / 2 <= F.col("rest")).cast("int")).cast("int"), F.element_at(most, F.col("source"))))
        .where("repeats > 0")
        .select("doc_id", "source", "n_tokens", "repeats")
    )
    made = drawn.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("documents"), F.sum("repeats").alias("draws"))
    rows = [(n, plan[n][0], plan[n][1], int(have.get(n, 0)), bool(have.get(n, 0) * plan[n][1] < plan[n][0] * total)) for n in names]
    want = spark.createDataFrame(rows, T.StructType.fromDDL("source string, target_share double, max_repeats int, available_tokens long, capped boolean"))
    report = (
        want.join(made, "source", "left")
        .na.fill(0, ["tokens", "documents", "draws"])
        .withColumn("actual_share", F.coalesce(F.round(F.col("tokens") / F.sum("tokens").over(Window.partitionBy()), 6), F.lit(0.0)))  # one row per target
    )
    return drawn, report
