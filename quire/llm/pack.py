"""Problem 7: filling containers of fixed capacity with documents.

Method: first-fit decreasing.  Documents are spread over randomised groups of about
equal number; each group is packed by itself.  The first container with enough room
is found in a tournament tree, whose inner nodes hold the largest room below them, in
logarithmic time.  A document over the capacity is cut into full containers and one
rest; no other document is ever cut.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.cut import cut


class TournamentTree:
    """Room of numbered containers; ``first_fit`` gives the lowest number with enough room."""

    def __init__(self, containers: int, capacity: int) -> None:
        self.width = 1
        while self.width < max(1, containers):
            self.width *= 2
        self.room = [capacity] * (2 * self.width)

    def first_fit(self, size: int) -> int:
        room, at = self.room, 1
        if room[1] < size:
            raise ValueError("no container has enough room")
        while at < self.width:
            at *= 2
            if room[at] < size:
                at += 1
        room[at] -= size
        k = at // 2
        while k:
            most = max(room[2 * k], room[2 * k + 1])
            if room[k] == most:
                break
            room[k] = most
            k //= 2
        return at - self.width


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The container of each item; sizes must be in decreasing order."""
    tree = TournamentTree(len(sizes), capacity)
    return [tree.first_fit(s) for s in sizes]


def pack(items: DataFrame, key: str, size: str, limits: DataFrame, group_items: int = 4096, seed: int = 7) -> DataFrame:
    """Place every item of ``items`` (``key``, ``size``) into containers for each row of ``limits`` (purpose, limit_tokens).

    Returns purpose, container (group and number), place and offset in it, the key,
    piece_no, piece_start and n_tokens.  Sizes that are null count as 0; an item of
    size 0 gets a place too.  Items of equal size are taken in the order of the key,
    so the result is the same in every run.  Repeated rows are items of their own.

    Groups are made of pieces, by a seeded hash of key and piece number, ``group_items``
    in the mean, so neither a hot key nor a huge document makes a large group.
    ``limits`` is a table of a few purposes and is broadcast.
    """
    caps = limits.select("purpose", F.col("limit_tokens").cast("long").alias("capacity")).where("capacity > 0").dropDuplicates(["purpose"])
    total = F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0))
    pieces = (
        items.select(F.col(f"`{key}`").alias("key"), total.alias("total"))
        .crossJoin(F.broadcast(caps))  # one row per purpose, of which there are a few
        .withColumn("piece_no", F.explode(F.expr("sequence(0L, greatest(0L, (total - 1) div capacity))")))
        .withColumn("piece_start", F.expr("piece_no * capacity"))
        .withColumn("n_tokens", F.expr("least(capacity, total - piece_start)"))
    )
    counts = pieces.groupBy("purpose").count().collect()  # one row per purpose
    groups = F.create_map(*[F.lit(x) for r in counts for x in (r["purpose"], max(1, -(-r["count"] // group_items)))]) if counts else F.create_map(F.lit(""), F.lit(1))
    keyed = pieces.withColumn("group", F.pmod(F.xxhash64("key", "piece_no", F.lit(seed)), F.element_at(groups, F.col("purpose"))).cast("long"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "key", "piece_no"], ascending=[False, True, True], kind="stable", ignore_index=True)
        bins = pd.Series(first_fit_decreasing(pdf["n_tokens"].tolist(), int(pdf["capacity"].iloc[0])), index=pdf.index)
        by = pdf["n_tokens"].groupby(bins)
        return pd.DataFrame({
            "purpose": pdf["purpose"], "container": pdf["group"].astype(str) + "-" + bins.astype(str), "place": by.cumcount(), "offset": by.cumsum() - pdf["n_tokens"],
            "key": pdf["key"], "piece_no": pdf["piece_no"], "piece_start": pdf["piece_start"], "n_tokens": pdf["n_tokens"],
        })

    kind = keyed.schema["key"].dataType.simpleString()
    done = keyed.groupBy("purpose", "group").applyInPandas(one, f"purpose string, container string, place long, offset long, key {kind}, piece_no long, piece_start long, n_tokens long")
    return done.withColumnRenamed("key", key)


def sized(df: DataFrame, key: str, text: str, *more: str) -> DataFrame:
    """``key``, more columns and n_tokens of each row, counted once and written to the shared checkpoint folder."""
    from quire.llm.tokens import token_count

    return cut(df.select(key, *more, token_count(F.col(text)).alias("n_tokens")))


def fill_report(packed: DataFrame, limits: DataFrame) -> DataFrame:
    """Per purpose: containers, tokens, capacity in use and the share of it that is filled."""
    per = packed.groupBy("purpose", "container").agg(F.sum("n_tokens").alias("tokens"))
    return (
        per.groupBy("purpose")
        .agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"))
        .join(F.broadcast(limits.select("purpose", F.col("limit_tokens").cast("long").alias("limit_tokens"))), "purpose")
        .withColumn("filled", F.round(F.col("tokens") / (F.col("containers") * F.col("limit_tokens")), 6))
    )
