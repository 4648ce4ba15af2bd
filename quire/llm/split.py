"""Problem 5: cutting oversized texts at natural boundaries, with overlap.

Method: a recursive hierarchy of separators.  A text over the limit is split into
sections, a section that is still too large into paragraphs, then sentences, then
words, then characters; the units so found are packed greedily into pieces under the
limit, and each piece begins with the last ``overlap`` size units of the one before.

Sizes are tokens (the longest runs of characters other than blank, tab and line
feed) or, with ``unit="chars"``, characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKEN = r"[^ \t\n]+"

_TOKEN = re.compile(TOKEN)
_SECTION = re.compile(r"\f|\n(?=#{1,6} |\d+(?:\.\d+)* \S[^\n.;]{0,80}\n)|\n[ \t]*\n[ \t]*\n+")
_PARAGRAPH = re.compile(r"\n[ \t]*\n+|\n(?=[ \t]*(?:[-*•]|\d+[.)])[ \t])|(?<=[.!?:;])[ \t]*\n")
_SENTENCE = re.compile(r"(?<=[.!?…])[\"'”»)\]]*[ \t\n]+")
_LEVELS = (_SECTION, _PARAGRAPH, _SENTENCE)


def _cuts(text: str, starts: np.ndarray, unit: str) -> list[np.ndarray]:
    """For each level, the size units before which the text may be cut."""
    out = []
    for sep in _LEVELS:
        ends = np.fromiter((m.end() for m in sep.finditer(text)), np.int64)
        out.append(np.unique(np.searchsorted(starts, ends)) if len(ends) else ends)
    if unit == "chars":
        out.append(np.fromiter((m.start() for m in _TOKEN.finditer(text)), np.int64))
    return out


def _units(a: int, b: int, level: int, cuts: list[np.ndarray], budget: int) -> Iterator[tuple[int, int]]:
    if b - a <= budget:
        yield a, b
    elif level == len(cuts):  # single size units: words, or characters
        for x in range(a, b):
            yield x, x + 1
    else:
        own = cuts[level]
        edges = [a, *own[(own > a) & (own < b)].tolist(), b]
        for x, y in zip(edges, edges[1:]):
            yield from _units(x, y, level + 1, cuts, budget)


def split_text(text: str, limit: int, overlap: int, unit: str = "tokens") -> list[tuple[int, int, int]]:
    """(start, end, size) of the pieces of a text in characters; one piece if it is within the limit, none if blank."""
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be smaller than the limit")
    spans = [m.span() for m in _TOKEN.finditer(text)]
    if not spans:
        return []
    if unit == "chars":
        first, last = spans[0][0], spans[-1][1]
        starts = np.arange(last)
        ends, begin = starts + 1, first
    else:
        starts, ends = np.array(spans).T
        begin = 0
    n = len(starts)
    if n - begin <= limit:
        return [(int(starts[begin]), int(ends[n - 1]), n - begin)]
    pieces, a, e = [], begin, begin
    for x, y in _units(begin, n, 0, _cuts(text, starts, unit), limit - overlap):
        if y - a > limit:
            pieces.append((a, e))
            a = e - overlap
        e = y
    pieces.append((a, e))
    return [(int(starts[x]), int(ends[y - 1]), y - x) for x, y in pieces]


def split_oversized(df: DataFrame, key: str, field: str, limit: int, overlap: int, unit: str = "tokens") -> DataFrame:
    """All pieces of all texts: the columns of ``df`` but ``field``, then piece_no (from 0), pieces, piece_size, piece_text.

    Every piece is within ``limit``; neighbours share exactly ``overlap`` units.  A
    text within the limit is one piece, without blanks around; null and blank texts
    have none; exact copies are cut alike.  Columns of ``df`` named like one of the
    new ones are replaced.  Only texts over the limit reach Python; others are
    counted and passed on inside the JVM.  No shuffle.
    """
    new = ("piece_no", "pieces", "piece_size", "piece_text")
    kept = [c for c in df.columns if c not in new and c != field]
    size = F.length(F.regexp_replace(F.col(f"`{field}`"), r"^[ \t\n]+|[ \t\n]+$", "")) if unit == "chars" else F.regexp_count(F.col(f"`{field}`"), F.lit(TOKEN))
    src = df.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{field}`").alias("piece_text"), size.alias("piece_size")).where("piece_size > 0")
    small = src.where(F.col("piece_size") <= limit).select(
        *(F.col(f"`{c}`") for c in kept), F.lit(0).alias("piece_no"), F.lit(1).alias("pieces"), F.col("piece_size").cast("int"), F.regexp_replace("piece_text", r"^[ \t\n]+|[ \t\n]+$", "").alias("piece_text")
    )
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField("piece_no", T.IntegerType()), T.StructField("pieces", T.IntegerType()), T.StructField("piece_size", T.IntegerType()), T.StructField("piece_text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(len(kept)).to_pylist()
                found = [split_text(t, limit, overlap, unit) for t in texts]
                home = [i for i, f in enumerate(found) for _ in f]
                flat = [(k, len(f), n, texts[i][a:b]) for i, f in enumerate(found) for k, (a, b, n) in enumerate(f)]
                cols = list(zip(*flat)) if flat else [(), (), (), ()]
                taken = part.take(pa.array(home, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*(taken.column(c) for c in range(len(kept))), pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.string())],
                    names=[*kept, *new],
                )

    big = src.where(F.col("piece_size") > limit).drop("piece_size").mapInArrow(run, schema)
    return small.unionByName(big)
