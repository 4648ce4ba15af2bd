"""Preparing chunks for the store: clean metadata, simplified blocks, and a class for every text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.models import Client, complete_text

# The classes of a text.
TEXT_CLASSES = (
    "Product description", "Process description", "Usage instructions", "Application description", "Legal terms", "Tale narrative",
    "Person description", "User manual", "Letter", "Email", "Requirements specification", "Other",
)

# What the stand-in classifier looks for; the first class with a hit is taken.
_RULES = {
    "Email": r"(?i)\b(subject|betreff|from|to):|\S+@\S+\.\S+",
    "Letter": r"(?i)\b(dear|sehr geehrte|yours (sincerely|faithfully)|mit freundlichen)",
    "Legal terms": r"(?i)\b(liability|warranty|haftung|gewährleistung|agb|contract|vertrag)",
    "Requirements specification": r"(?i)\b(must|shall|muss|soll)\b",
    "Usage instructions": r"(?i)\b(press|click|open|select|drücken|klicken|öffnen|wählen)",
    "Process description": r"(?i)\b(process|step|prozess|schritt|ablauf)",
}


class RuleClassifier:
    """A stand-in for a model that names a class: the first rule that the text between the marks meets."""

    def complete(self, prompt: str) -> str:
        text = prompt.partition("<<<")[2].rpartition(">>>")[0]
        return next((name for name, rule in _RULES.items() if re.search(rule, text)), "Other")


def class_prompt(text: Column) -> Column:
    head = "Name the one class that describes the text best, and nothing else. Classes: " + "; ".join(TEXT_CLASSES) + "\n\n<<<"
    return F.concat(F.lit(head), F.coalesce(text, F.lit("")), F.lit(">>>"))


def classify_texts(df: DataFrame, field: str = "text", factory: type[Client] = RuleClassifier) -> DataFrame:
    """``df`` with chunk_text_class: the model's answer if it is one of TEXT_CLASSES in any spelling of case, else Other.

    Null and blank texts are not sent and get null.
    """
    blank = F.coalesce(F.trim(F.col(field)), F.lit("")) == ""
    asked = complete_text(df.where(~blank).withColumn("prompt", class_prompt(F.col(field))), factory)
    known = F.create_map(*[x for name in TEXT_CLASSES for x in (F.lit(name.lower()), F.lit(name))])
    named = F.coalesce(F.try_element_at(known, F.lower(F.regexp_replace(F.trim("answer"), r"^\d+\.\s*|[.\s]+$", ""))), F.lit("Other"))
    done = asked.withColumn("chunk_text_class", named).drop("prompt", "answer", "status")
    return done.unionByName(df.where(blank).withColumn("chunk_text_class", F.lit(None).cast("string")))


def clean_metadata(df: DataFrame) -> DataFrame:
    """Empty lists become null, and ``blocks`` is dropped; other columns stay."""
    kept = [f for f in df.schema.fields if f.name != "blocks"]
    return df.select(*[F.when(F.size(f"`{f.name}`") > 0, F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f"`{f.name}`") for f in kept])


def simplified_blocks(blocks: Column) -> Column:
    """The blocks of a chunk as JSON without their spans: kind, text, page_num, heading_level."""
    return F.to_json(F.transform(blocks, lambda b: F.struct(b["kind"].alias("kind"), b["text"].alias("text"), b["page_num"].alias("page_num"), b["heading_level"].alias("heading_level"))))
