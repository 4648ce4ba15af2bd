"""Problem 2: one consistent form for texts that read the same (canonical text).

Two texts have the same canonical form exactly when a reader sees the same: width
and joined shape of letters, the coding of accents, the kind of blank, invisible
characters and letters of other alphabets with the same shape are evened out.
Case, missing accents, sharp s, raised or circled figures, punctuation and the
length of dashes are kept.

Method: a quick-check class holds every character that normalisation may change
(the *unstable* ones).  A text without any is returned as it is.  Otherwise the
maximal unstable segments are isolated, each with its boundary context (the
starter before a combining mark, and all marks after it), only those segments are
normalised, and the results are spliced into the unchanged rest.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.cut import cut

# Letters and signs of other alphabets, each pair "foreign latin",
# that have the same shape in common text fonts.
SAME_SHAPE = """
а a  с c  ԁ d  е e  һ h  і i  ј j  ӏ l  о o  р p  ԛ q  ѕ s  ѵ v  ԝ w  х x  у y
А A  В B  С C  Е E  Ԍ G  Н H  І I  Ј J  К K  М M  О O  Р P  Ԛ Q  Ѕ S  Т T  Ѵ V  Ԝ W  Х X  Ү Y
Α A  Β B  Ε E  Ζ Z  Η H  Ι I  Κ K  Μ M  Ν N  Ο O  Ρ P  Τ T  Υ Y  Χ X  Ϲ C  Ϳ J
ο o  ϲ c  ϳ j  ν v
օ o  ո n  ս u  հ h  Տ S  Օ O
μ µ  ∆ Δ  ∑ Σ  ∏ Π
‐ -  ‑ -
"""
_SHAPE = dict(pair.split(" ") for line in SAME_SHAPE.strip().split("\n") for pair in re.split(r"\s{2,}", line.strip()))

# Invisible characters outside the general category Cf, and line ends.
_INVISIBLE_EXTRA = "͏ᅟᅠ឴឵᠋᠌᠍᠏ㅤﾠ"
_LINE_ENDS = "\r\x0b\x0c\x85  "
# Compatibility tags that only change width, joining or breaking, not the look.
_PLAIN_TAGS = ("<wide>", "<narrow>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>")


@lru_cache(maxsize=65536)
def _spread(ch: str) -> str:
    """One character fully decomposed into the characters that it looks like."""
    cat = unicodedata.category(ch)
    if ch in _LINE_ENDS:
        return "\n"
    if cat == "Zs":
        return " "
    if cat == "Cf" or ch in _INVISIBLE_EXTRA or "︀" <= ch <= "️" or "\U000e0100" <= ch <= "\U000e01ef":
        return ""
    if cat == "Cc" and ch not in "\t\n":
        return ""
    if ch in _SHAPE:
        return _SHAPE[ch]
    parts = unicodedata.decomposition(ch)
    if not parts:
        return unicodedata.normalize("NFD", ch) if "가" <= ch <= "힣" else ch
    tag, _, rest = parts.partition(" ") if parts[0] == "<" else ("", "", parts)
    if tag in ("", *_PLAIN_TAGS):
        pass
    elif tag == "<compat>" and unicodedata.name(ch, "").startswith(("LATIN SMALL LIGATURE", "LATIN CAPITAL LIGATURE", "ROMAN NUMERAL", "SMALL ROMAN", "ARMENIAN SMALL LIGATURE")):
        if ch == "ﬅ":  # long s with t keeps its long s
            return ch
    else:
        return ch
    return "".join(_spread(chr(int(x, 16))) for x in rest.split())


def _unstable(cp: int) -> bool:
    if 0x4E00 <= cp <= 0x9FFF or 0xAC00 <= cp <= 0xF8FF:  # ideographs, Hangul syllables, private use
        return False
    ch = chr(cp)
    cat = unicodedata.category(ch)
    if cat in ("Cs", "Co", "Cn"):
        return False
    # Quick check "maybe": marks, and the vowels and finals of Hangul, may join what stands before them.
    if unicodedata.combining(ch) or cat in ("Mn", "Mc", "Me") or 0x1161 <= cp <= 0x1175 or 0x11A8 <= cp <= 0x11C2:
        return True
    return unicodedata.normalize("NFC", _spread(ch)) != ch


def _class_of(test, end: int) -> str:
    """A regular-expression class of the code points below ``end`` for which ``test`` holds, as ranges."""
    out, start, last = [], None, None
    for cp in range(end + 1):
        if cp < end and test(cp):
            if start is None:
                start = cp
            last = cp
        elif start is not None:
            out.append((start, last))
            start = None
    return "".join(f"\\U{lo:08x}-\\U{hi:08x}" for lo, hi in out)


@lru_cache(maxsize=2)
def _segments(astral: bool = False) -> re.Pattern:
    """Maximal runs of unstable characters: the quick check and the isolation in one scan.

    The class over the basic plane compiles to a bit map, which is many times as fast
    as one that also has the astral planes; those are looked at only in texts that need it.
    """
    return re.compile(f"[{_class_of(_unstable, 0x30000 if astral else 0x10000)}{'\\U000e0001-\\U000e01ef' * astral}]+")


_ASTRAL = re.compile("[\U00010000-\U0010ffff]")


@lru_cache(maxsize=262144)
def _normal(segment: str) -> str:
    spread = unicodedata.normalize("NFD", "".join(map(_spread, unicodedata.normalize("NFD", segment))))
    return unicodedata.normalize("NFC", "".join(_SHAPE.get(c, c) for c in spread))


def canonical_text(text: str | None) -> str | None:
    """The canonical form of one text; null stays null."""
    if text is None:
        return None
    if text.isascii() and text.isprintable():
        return text
    if "\r\n" in text:
        text = text.replace("\r\n", "\n")
    out, done = [], 0
    for m in _segments(bool(_ASTRAL.search(text))).finditer(text):
        at = m.start()
        # A mark belongs to the starter before it, also over invisible characters, so the starter is taken along.
        if at > done:
            at -= 1
        out += (text[done:at], _normal(text[at : m.end()]))
        done = m.end()
    return "".join(out) + text[done:] if done else text


@F.pandas_udf(T.StringType())
def canonical_udf(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Arrow-batched :func:`canonical_text`."""
    for s in texts:
        yield pd.Series([canonical_text(x) for x in s], dtype=object)


def canonicalize(df: DataFrame, field: str, out: str = "canonical") -> DataFrame:
    """Add ``out``, the canonical form of ``field``.

    Null stays null, an empty text stays empty, a text of any length is treated
    whole, and all other columns stay as they are.  ``out`` replaces a column of
    that name.  One narrow pass without shuffle.
    """
    return df.withColumn(out, canonical_udf(F.col(f"`{field}`")))


def equal_looking(df: DataFrame, key: str, field: str) -> DataFrame:
    """Rows whose ``field`` looks like that of another row but differs in characters.

    Returns ``key``, ``look`` (an md5 of the canonical form, shared by all rows that
    look the same) and ``form`` (an md5 of the characters as stored, shared by exact
    copies): one row per row of ``df`` in a look that has more than one form.
    Rows whose text is null or blank are left out.

    Only two hashes leave the scan, written once (texts are normalised once); looks with one form are removed by an aggregate
    with map-side combining before anything is joined.
    """
    hashed = cut(
        canonicalize(df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{field}`").alias("raw")).where(F.col("raw").isNotNull()), "raw", "look")
        .where(F.trim("look") != "")
        .select("key", F.unhex(F.md5("look")).alias("look"), F.unhex(F.md5("raw")).alias("form"))
    )
    mixed = hashed.groupBy("look").agg(F.min("form").alias("a"), F.max("form").alias("b")).where("a <> b").select("look")
    return hashed.join(mixed, "look", "left_semi")


def equal_looking_pairs(df: DataFrame, key: str, field: str, salts: int = 16) -> DataFrame:
    """All pairs (``row_a`` < ``row_b``) of rows that look the same and differ in characters.

    Pairs are made between different forms of a look only, so exact copies never
    meet.  Each row is salted on one side and repeated on the other, so a look that
    holds a large share of the rows is spread over ``salts`` tasks.
    """
    rows = equal_looking(df, key, field)
    left = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(salts)))
    right = rows.select(F.col("look"), F.col("form").alias("form_b"), F.col("key").alias("key_b")).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return (
        left.join(right, ["look", "salt"])
        .where("form <> form_b and key < key_b")
        .select(F.col("key").alias("row_a"), F.col("key_b").alias("row_b"))
    )
