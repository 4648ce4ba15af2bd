"""Text rules as column expressions; all run inside whole-stage code generation or as JVM built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that carry no meaning in a German query, and words every record of such a knowledge base has
# (the name of the product it describes is added by the caller).
STOPWORDS = "der die das den dem des ein eine einer einem eines und oder aber nicht von mit zu im in an auf ist was wie wo wer warum für bei durch ohne gegen zwischen".split()
COMMON_WORDS = "erp system funktionen erp-system module prozesse prozess".split()
# Roots of German compounds.
COMPOUND_ROOTS = "stamm lohn daten kosten stelle stellen personal art arten zeit plan auftrag material artikel kunde adresse nummer regel regelung kalkulation preis gruppe".split()


def normalize_space(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), r"^ | $", "")


def words(c: Column) -> Column:
    """White-space tokens; none for a null or blank text."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda x: x != "")


def token_count(c: Column) -> Column:
    """Default size of a text: its white-space tokens."""
    return F.coalesce(F.size(words(F.coalesce(c, F.lit("")))), F.lit(0))


def content_id(text: Column, image_paths: Column | None = None) -> Column:
    """Identity of a chunk: md5 of its text, or of its image paths where it has none."""
    if image_paths is None:
        return F.md5(text)
    return F.md5(F.when(F.coalesce(text, F.lit("")) != "", text).otherwise(F.array_join(F.coalesce(image_paths, F.array().cast("array<string>")), " ")))


def merged_lines(c: Column) -> Column:
    """Text of a merged chunk without the line numbers in front and without blank lines."""
    lines = F.transform(F.split(c, "\n"), lambda x: F.trim(F.regexp_replace(x, r"^\s*\d+\s*;\s*", "")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def xml_safe(c: Column) -> Column:
    """Text that an XML document can hold: plain quotes and dashes, no control or invisible characters, marks escaped."""
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F­​-‍]", "")
    c = F.translate(c, "   „“”’‘–—", " \n\n\"\"\"''--")
    return F.replace(F.replace(c, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def safe_id(c: Column) -> Column:
    """An id that can be a file name."""
    return F.translate(F.replace(c, F.lit("::"), F.lit("__")), " /\\><", "_____")


def repaired_json(c: Column) -> Column:
    """The JSON object in a damaged text: no control characters, trailing commas, comments or Python literals, cut to its braces."""
    c = F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
    c = F.regexp_replace(c, r",\s*([}\]])", "$1")
    for bad, good in (("None", "null"), ("True", "true"), ("False", "false")):
        c = F.replace(c, F.lit(bad), F.lit(good))
    c = F.regexp_replace(F.regexp_replace(c, r"//[^\n]*?\n", ""), r"(?s)/\*.*?\*/", "")
    c = F.when(F.contains(c, F.lit('"')), c).otherwise(F.replace(c, F.lit("'"), F.lit('"')))
    start = F.instr(c, "{")
    end = F.length(c) - F.instr(F.reverse(c), "}") + 1
    return F.when((start > 0) & F.contains(c, F.lit("}")), F.when(end >= start, F.substring(c, start, end - start + 1)).otherwise("")).otherwise(c)


def keyword_score(query: Column, text: Column) -> Column:
    """How many different words of the query, in lower case, the text has."""
    return F.size(F.array_intersect(words(F.lower(query)), words(F.lower(text))))


def compound_parts(c: Column) -> Column:
    """Roots of a German compound, from the left, the longest first; other letters are passed over."""
    longest_first = "|".join(sorted(COMPOUND_ROOTS, key=lambda r: (-len(r), r)))
    return F.regexp_extract_all(F.lower(c), F.lit(f"({longest_first})"), F.lit(1))


def query_terms(c: Column, more_common: tuple[str, ...] = ()) -> Column:
    """Search terms of a query: its words but stop words and common words, all of them run together, and the roots of compounds; sorted, three letters at least."""
    plain = F.regexp_replace(F.replace(F.lower(c), F.lit("_"), F.lit(" ")), r"(?U)[^\w ]+", " ")
    kept = F.filter(F.split(plain, r"(?U)\s+"), lambda x: (x != "") & ~x.isin([*STOPWORDS, *COMMON_WORDS, *more_common]))
    alpha = F.filter(kept, lambda x: x.rlike(r"^(?U)\p{L}+$"))
    # The words are joined by a character that no root can cross.
    every = F.concat(kept, F.array(F.array_join(kept, "")), compound_parts(F.array_join(alpha, " ")))
    return F.array_sort(F.array_distinct(F.filter(every, lambda x: F.length(x) > 2)))


def path_of(cluster_id: Column) -> Column:
    """A dotted cluster id as numbers, so that ids sort by number."""
    return F.transform(F.split(cluster_id, r"\."), lambda x: x.cast("int"))


def ancestors(cluster_id: Column, with_self: bool = True) -> Column:
    """The ids above a cluster from the root down, by prefixes of its path."""
    parts = F.split(cluster_id, r"\.")
    n = F.size(parts) - (0 if with_self else 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "."))).otherwise(F.array().cast("array<string>"))


def padded_id(cluster_id: Column) -> Column:
    """A cluster id whose numbers have two digits at least, so that it sorts as text."""
    return F.array_join(F.transform(F.split(cluster_id, r"\."), lambda x: F.lpad(x, F.greatest(F.lit(2), F.length(x)), F.lit("0"))), ".")


def parent_id(cluster_id: Column) -> Column:
    return F.when(F.contains(cluster_id, F.lit(".")), F.regexp_replace(cluster_id, r"\.[^.]*$", ""))


def level_of(cluster_id: Column) -> Column:
    return F.size(F.split(cluster_id, r"\.")) - 1
