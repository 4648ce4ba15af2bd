"""Stages that call a language model: prompts in, salvaged JSON out, with retries, resume and order.

A client is any object with ``complete(prompt) -> str``; it is created once per
partition by a picklable factory.  Its errors become rows with a status, never lost
work.  :class:`MockClient` answers deterministically.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.cut import cut
from quire.functions.text import level_of, parent_id

# Relationship types an ontology may use.
RELATIONSHIP_TYPES = ("related_to", "part_of", "depends_on", "uses", "produces", "belongs_to", "associated_with")


class Client(Protocol):
    def complete(self, prompt: str) -> str: ...


TRANSLATE = "Translate the following text. Return only the translation, with no explanations or quotes.\nLanguage: "


class MockClient:
    """Answers every prompt with a JSON object made of the prompt's own words; a translation is the text itself."""

    def complete(self, prompt: str) -> str:
        if prompt.startswith(TRANSLATE):
            return prompt.split("\n\n", 1)[1]
        found = re.findall(r"[^\W\d_]{4,}", prompt)
        label = " ".join(found[-4:])
        body = {lang: {"summary": " ".join(found[-12:]), "label": label, "keywords": sorted(set(found))[:3]} for lang in ("EN", "DE")}
        return f"```json\n{json.dumps(body, ensure_ascii=False)}\n```"


def first_object(text: str | None) -> str | None:
    """The first balanced JSON object of a text, whatever fences or words are around it."""
    start = text.find("{") if text else -1
    while start >= 0:
        depth, quoted, escaped = 0, False, False
        for i in range(start, len(text)):
            c = text[i]
            if quoted:
                quoted = escaped or c != '"'
                escaped = c == "\\" and not escaped
            elif c == '"':
                quoted = True
            elif c in "{}":
                depth += 1 if c == "{" else -1
                if depth == 0:
                    return text[start : i + 1]
        start = text.find("{", start + 1)
    return None


def salvage(text: str | None) -> dict | None:
    """The object a model meant: read strictly first, then with the repairs of ``repaired_json``."""
    body = first_object(text)
    for attempt in (body, _repair(text or "")):
        try:
            got = json.loads(attempt) if attempt else None
        except ValueError:
            continue
        if isinstance(got, dict):
            return got
    return None


def _repair(text: str) -> str:
    text = re.sub(r",\s*(?=[}\]])", "", re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", text))
    text = re.sub(r"/\*.*?\*/", "", re.sub(r"//[^\n]*\n", "", text), flags=re.S)
    text = re.sub(r"\b(None|True|False)\b", lambda m: {"None": "null", "True": "true", "False": "false"}[m[0]], text)
    if '"' not in text:
        text = text.replace("'", '"')
    return text[text.find("{") : text.rfind("}") + 1]


@F.pandas_udf(T.StringType())
def salvaged_json(s: pd.Series) -> pd.Series:
    """The salvaged object of each answer as JSON text; null where there is none."""
    return pd.Series([None if (d := salvage(x)) is None else json.dumps(d, ensure_ascii=False, sort_keys=True) for x in s], dtype=object)


def complete(prompts: DataFrame, factory: Callable[[], Client] = MockClient, tries: int = 3, wait: float = 0.0, parallel: int | None = None) -> DataFrame:
    """Answers of a model: the columns of ``prompts`` (with ``prompt``), then answer, payload (salvaged JSON) and status.

    Status is done, or incomplete when ``tries`` answers held no object, or error.
    ``parallel`` bounds how many partitions call at once.
    """
    src = prompts.repartition(parallel) if parallel else prompts
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        for pdf in batches:
            rows = []
            for p in pdf["prompt"]:
                answer, payload, status = None, None, "incomplete"
                for n in range(tries):
                    try:
                        answer = client.complete(p)
                        got = salvage(answer)
                    except Exception as e:  # noqa: BLE001 - a failed call is a row, not a failed job
                        answer, got, status = f"[ERROR {e}]", None, "error"
                    if got is not None:
                        payload, status = json.dumps(got, ensure_ascii=False, sort_keys=True), "done"
                        break
                    if wait:
                        time.sleep(wait * 2**n)
                rows.append((answer, payload, status))
            yield pdf.assign(**{c: [r[i] for r in rows] for i, c in enumerate(("answer", "payload", "status"))})

    return src.mapInPandas(run, f"{schema}, answer string, payload string, status string")


def complete_text(prompts: DataFrame, factory: Callable[[], Client] = MockClient, tries: int = 3) -> DataFrame:
    """Plain answers of a model: the columns of ``prompts`` (with ``prompt``), then answer and status (done or error).

    Equal prompts within a batch are asked once.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in prompts.schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        for pdf in batches:
            said: dict[str, tuple[str | None, str]] = {}
            for p in pdf["prompt"].unique():
                said[p] = (None, "error")
                for _ in range(tries):
                    try:
                        said[p] = (client.complete(p), "done")
                        break
                    except Exception as e:  # noqa: BLE001 - a failed call is a row, not a failed job
                        said[p] = (f"[ERROR {e}]", "error")
            yield pdf.assign(answer=[said[p][0] for p in pdf["prompt"]], status=[said[p][1] for p in pdf["prompt"]])

    return prompts.mapInPandas(run, f"{schema}, answer string, status string")


def language_code(answer: Column) -> Column:
    """The language that a model named: two letters in capitals, else EN."""
    t = F.trim(answer)
    return F.when(t.rlike(r"^[A-Za-z]{2}$"), F.upper(t)).otherwise(F.lit("EN"))


def missing_labels(nodes: DataFrame) -> DataFrame:
    """The nodes whose label, summary or keywords are null or blank: the ones a repair run asks for."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    return nodes.where(blank(F.col("label")) | blank(F.col("summary")) | (F.coalesce(F.size("keywords"), F.lit(0)) <= 0))


def language_pick(nodes: DataFrame, override: str | None = None) -> DataFrame:
    """One row (language): ``override``, else the first language of the first node in path order that has one; none if no node has."""
    from quire.functions.text import path_of

    if override is not None:
        return nodes.sparkSession.createDataFrame([(override,)], "language string")
    first = nodes.where(F.size("languages") > 0).select(F.struct(path_of(F.col("cluster_id")).alias("path"), F.get("languages", F.lit(0)).alias("language")).alias("x")).agg(F.min("x").alias("x"))
    return first.where("x is not null").select("x.language")


def label_schema(languages: list[str]) -> str:
    """The JSON object that a labelling prompt asks for, as text: a block per language."""
    return json.dumps({lang: {"summary": "...", "label": "...", "keywords": ["..."]} for lang in languages}, indent=1)


def pending(tasks: DataFrame, done: DataFrame, *key: str) -> DataFrame:
    """Tasks without a finished output: an output whose payload is no valid JSON does not count."""
    valid = done.where(F.col("payload").isNotNull() & F.try_parse_json("payload").isNotNull())
    return tasks.join(valid.select(*key).distinct(), list(key), "left_anti")


def label_prompt(text: Column, languages: tuple[str, ...] = ("EN", "DE")) -> Column:
    """The prompt that asks for a summary, a label and keywords in every language, with the object wanted."""
    return F.concat(F.lit(f"Summarise the text, give it a short label and keywords, in {' and '.join(languages)}, as one JSON object {{language: {{summary, label, keywords}}}}.\n\n"), F.coalesce(text, F.lit("")))


BLOCK = "map<string,struct<summary:string,label:string,keywords:array<string>>>"


def label_tree(nodes: DataFrame, leaf_texts: DataFrame, factory: Callable[[], Client] = MockClient, cache: DataFrame | None = None, languages: tuple[str, ...] = ("EN", "DE")) -> DataFrame:
    """Labels of all nodes, children before parents: cluster_id, multilang, source_language, summary, label, status.

    Nodes of ``cache`` (the same columns, from an earlier run) whose label and summary
    are filled are taken as they are (status cached); only the others are asked for.

    A leaf is described by its chunk texts, an inner node by the summaries of its
    children in their source language.  One pass per level from the deepest up; each is
    written before the next, so a lost executor costs one level.
    """
    levels = nodes.select(level_of(F.col("cluster_id")).alias("l")).distinct().orderBy(F.desc("l")).collect()  # as many rows as the tree is deep
    done: DataFrame | None = None
    below: DataFrame | None = None  # the level below, the only one the next level reads
    for (level,) in levels:
        here = nodes.where(level_of(F.col("cluster_id")) == level)
        kept = None
        if cache is not None:
            good = cache.where((F.trim("label") != "") & (F.trim("summary") != "")).dropDuplicates(["cluster_id"])
            kept = here.join(good, "cluster_id").select("cluster_id", "multilang", "source_language", "summary", "label", F.lit("cached").alias("status"))
            here = here.join(good, "cluster_id", "left_anti")
        text = here.join(leaf_texts, "cluster_id", "left")
        if below is not None:
            kids = below.groupBy(parent_id(F.col("cluster_id")).alias("cluster_id")).agg(
                F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cluster_id", "summary"))), lambda x: x["summary"]), "\n\n").alias("below"),
                F.max_by("source_language", F.struct(F.length("summary"), F.col("source_language"))).alias("kid_language"), F.min_by("label", "cluster_id").alias("kid_label"),
            )
            text = text.join(kids, "cluster_id", "left")
        else:
            text = text.select("*", *[F.lit(None).cast("string").alias(c) for c in ("below", "kid_language", "kid_label")])
        asked = complete(text.select("cluster_id", "kid_language", "kid_label", label_prompt(F.coalesce("text", "below"), languages).alias("prompt")), factory)
        block = F.from_json("payload", BLOCK)
        longest = F.array_max(F.transform(F.map_entries(block), lambda e: F.struct(F.length(e["value"]["summary"]).alias("n"), e["key"].alias("k"))))["k"]
        lang = F.coalesce("kid_language", longest, F.lit("EN"))
        mine = asked.select("cluster_id", "kid_label", block.alias("multilang"), lang.alias("source_language"), "status")
        own = F.try_element_at("multilang", F.col("source_language"))
        fresh = mine.select("cluster_id", "multilang", "source_language", own["summary"].alias("summary"), label_fallback(own["label"], F.col("kid_label"), F.col("cluster_id")).alias("label"), "status")
        level_done = cut(fresh if kept is None else fresh.unionByName(kept))
        below = level_done
        done = level_done if done is None else done.unionByName(level_done)
    return done


def label_fallback(own: Column, first_child: Column, cluster_id: Column) -> Column:
    """A label that is never empty: the own one, else the first child's, else ``Cluster <id>``."""
    filled = lambda c: F.when(F.trim(c) != "", F.trim(c))
    return F.coalesce(filled(own), filled(first_child), F.concat(F.lit("Cluster "), cluster_id))


def source_language(children: DataFrame) -> DataFrame:
    """(parent, source_language): the language with the most summary characters among a node's children (parent, language, summary)."""
    per = children.groupBy("parent", "language").agg(F.sum(F.length("summary")).alias("n"), F.min("ord").alias("ord"))
    return per.groupBy("parent").agg(F.max_by("language", F.struct("n", -F.col("ord"))).alias("source_language"))


def ontology_tasks(baselines: DataFrame, part: str) -> DataFrame:
    """(cluster_id, idx, item): one task per entity, relationship or process of the cluster baselines."""
    return baselines.select("cluster_id", F.posexplode(F.coalesce(F.col(part), F.array().cast(baselines.schema[part].dataType))).alias("idx", "item"))


def ontology_step(tasks: DataFrame, instruction: str, fallback: Column, factory: Callable[[], Client] = MockClient) -> DataFrame:
    """One step over ontology tasks: cluster_id, idx, payload (``fallback`` where the answer held no object), status."""
    prompt = F.concat(F.lit(instruction + "\n\n"), F.to_json(F.struct("cluster_id", "idx", "item")))
    done = complete(tasks.withColumn("prompt", prompt).withColumn("fallback", F.to_json(fallback)), factory)
    return done.select("cluster_id", "idx", "item", F.coalesce("payload", "fallback").alias("payload"), "status")


def entity_stub(cluster_id: Column, idx: Column, name: Column) -> Column:
    """The element that stands in for an entity the model did not return."""
    none = F.array().cast("array<string>")
    return F.struct(F.concat_ws("::", cluster_id, idx.cast("string")).alias("id"), name.alias("name"), cluster_id.alias("cluster_id"), F.lit("").alias("description"), *[none.alias(c) for c in ("aliases", "attributes", "relationships", "processes")])


def valid_relationship(kind: Column) -> Column:
    return F.lower(F.regexp_replace(F.trim(kind), r"[\s-]+", "_")).isin(*RELATIONSHIP_TYPES)


def relationship_stub(cluster_id: Column, idx: Column, source: Column, target: Column, kind: Column) -> Column:
    """The element that stands in for a relationship the model did not return."""
    none = F.array().cast("array<string>")
    return F.struct(F.concat_ws("::", cluster_id, F.lit("rel"), idx.cast("string")).alias("id"), source.alias("source"), target.alias("target"), F.coalesce(kind, F.lit(RELATIONSHIP_TYPES[0])).alias("type"), F.lit("").alias("description"), F.lit(0.5).alias("confidence"), none.alias("attributes"), none.alias("constraints"), cluster_id.alias("cluster_id"))


def process_stub(cluster_id: Column, idx: Column, name: Column) -> Column:
    """The element that stands in for a process the model did not return."""
    none = F.array().cast("array<string>")
    return F.struct(F.concat_ws("::", cluster_id, F.lit("proc"), idx.cast("string")).alias("id"), name.alias("name"), cluster_id.alias("cluster_id"), F.lit("").alias("description"), *[none.alias(c) for c in ("steps", "inputs", "outputs", "entities_involved", "relationships_involved", "pre_requisites", "constraints")])


def language_view(labelled: DataFrame, language: str) -> DataFrame:
    """Labels of one language: cluster_id, summary, label, keywords; nodes without that language are left out."""
    block = F.try_element_at("multilang", F.lit(language))
    return labelled.where(block.isNotNull()).select("cluster_id", block["summary"].alias("summary"), block["label"].alias("label"), block["keywords"].alias("keywords"))


def extraction_inputs(nodes: DataFrame, leaf_texts: DataFrame, outputs: DataFrame, info_type: str, source_type: str | None = None, neighbours: DataFrame | None = None, top_n: int = 0) -> DataFrame:
    """Inputs of an extraction that are still to do: cluster_id, info_type, input.

    Without ``source_type`` a leaf is described by its chunk texts.  With it, by the
    cluster's own output of that type (clusters without one are skipped), followed by
    chunk texts and, up to ``top_n`` texts in all, by ``neighbours`` (cluster_id, rank,
    text).  ``outputs``: cluster_id, info_type, payload.
    """
    base = nodes.select("cluster_id").join(leaf_texts, "cluster_id", "left")
    if source_type is not None:
        own = outputs.where(F.col("info_type") == source_type).select("cluster_id", F.col("payload").alias("source"))
        base = base.join(own, "cluster_id")
        if neighbours is not None and top_n:
            near = neighbours.where(F.col("rank") <= top_n).groupBy("cluster_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda x: x["text"]), "\n\n").alias("near"))
            base = base.join(near, "cluster_id", "left").withColumn("text", F.concat_ws("\n\n", "text", "near"))
        base = base.withColumn("text", F.concat_ws("\n\n", "source", "text"))
    todo = pending(base.withColumn("info_type", F.lit(info_type)), outputs, "cluster_id", "info_type")
    return todo.where("text is not null").select("cluster_id", "info_type", F.col("text").alias("input"))


def merged_objects(rows: DataFrame) -> DataFrame:
    """Business objects of child clusters as their parent's: equal names are one object with all transitions.

    ``rows``: cluster_id, bo_name, bo_transitions (array of strings).
    """
    up = rows.select(parent_id(F.col("cluster_id")).alias("cluster_id"), "bo_name", F.explode_outer("bo_transitions").alias("t")).where("cluster_id is not null and bo_name is not null")
    return up.groupBy("cluster_id", "bo_name").agg(F.array_sort(F.collect_set("t")).alias("bo_transitions"))
