"""The staged building of an ontology from cluster baselines: entities, relationships and processes, each in steps that can be resumed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.cut import cut
from quire.operators.models import Client, MockClient, complete, entity_stub, ontology_tasks, process_stub, relationship_stub


@dataclass(frozen=True)
class Step:
    """One step: its name, what is asked, and what happens without an answer (``stub``, ``keep`` the input, or ``fail``)."""

    name: str
    instruction: str
    without: str


# The steps of each part, in order.
STEPS = {
    "entities": (Step("Entities_Step_1", "Write a stub of the entity as one JSON object.", "stub"), Step("Entities_Step_2", "Enrich the entity; return it as one JSON object.", "keep"), Step("Entities_Step_3", "Finalise the entity; return it as one JSON object.", "keep")),
    "relationships": (Step("Relationships_Step_1", "Write a skeleton of the relationship as one JSON object.", "stub"), Step("Relationships_Step_2", "Enrich the relationship; return it as one JSON object.", "keep")),
    "processes": (Step("Processes_Step_1", "Model the process as one JSON object.", "stub"), Step("Processes_Step_2", "Enrich the process; return it as one JSON object.", "keep"), Step("Processes_Step_3", "Finalise the process; return it as one JSON object.", "keep")),
    "attributes": (),
}


def loaded_baselines(nodes: DataFrame, baselines: DataFrame) -> DataFrame:
    """The baseline of every cluster, empty lists where it has none: cluster_id, label, entities, processes, relationships."""
    lists = [F.coalesce(c, F.array().cast(baselines.schema[c].dataType)).alias(c) for c in ("entities", "processes", "relationships")]
    return nodes.select("cluster_id").join(baselines, "cluster_id", "left").select("cluster_id", F.coalesce("label", F.lit("")).alias("label"), *lists)


def stub_of(part: str, item: Column) -> Column:
    """The element that stands in where the model gave none, as JSON."""
    cid, idx = F.col("cluster_id"), F.col("idx")
    if part == "relationships":
        return F.to_json(relationship_stub(cid, idx, item["source"], item["target"], item["type"]))
    return F.to_json((entity_stub if part == "entities" else process_stub)(cid, idx, item))


def run_part(baselines: DataFrame, part: str, factory: Callable[[], Client] = MockClient, done: DataFrame | None = None) -> DataFrame:
    """All steps of a part over all clusters: step, cluster_id, idx, payload, status.

    ``done`` (step, cluster_id, idx, payload) are outputs of an earlier run; such tasks
    are not asked again.  Every step is written before the next, so a lost executor
    costs a step.  A part without steps, such as attributes, gives no row.
    """
    empty = baselines.sparkSession.createDataFrame([], "step string, cluster_id string, idx int, payload string, status string")
    out, before = empty, None
    for step in STEPS[part]:
        if before is None:
            tasks = ontology_tasks(baselines, part).withColumn("input", stub_of(part, F.col("item"))).select("cluster_id", "idx", "input")
        else:
            tasks = before.select("cluster_id", "idx", F.col("payload").alias("input"))
        kept = None
        if done is not None:
            mine = done.where(F.col("step") == step.name).where(F.col("payload").isNotNull() & F.try_parse_json("payload").isNotNull()).select("cluster_id", "idx", "payload").dropDuplicates(["cluster_id", "idx"])
            kept = tasks.join(mine, ["cluster_id", "idx"]).select("cluster_id", "idx", "payload", F.lit("kept").alias("status"))
            tasks = tasks.join(mine, ["cluster_id", "idx"], "left_anti")
        asked = complete(tasks.withColumn("prompt", F.concat(F.lit(step.instruction + "\n\n"), "input")), factory)
        if step.without == "fail":
            lost = asked.where("payload is null").limit(1).collect()
            if lost:
                raise ValueError(f"{step.name}: no answer for {lost[0]['cluster_id']}/{lost[0]['idx']}")
        now = asked.select("cluster_id", "idx", F.coalesce("payload", "input").alias("payload"), "status")
        before = cut(now if kept is None else now.unionByName(kept))
        out = out.unionByName(before.select(F.lit(step.name).alias("step"), "cluster_id", "idx", "payload", "status"))
    return out


def step_states(outputs: DataFrame, expected: DataFrame, part: str) -> DataFrame:
    """(step, expected, done, state): a step is completed when every task (cluster_id, idx) has an output, running when some have."""
    names = expected.sparkSession.createDataFrame([(s.name,) for s in STEPS[part]], "step string")
    have = outputs.where("payload is not null").select("step", "cluster_id", "idx").distinct().groupBy("step").agg(F.count("*").alias("done"))
    n = expected.agg(F.count("*").alias("expected"))  # one row
    s = names.join(F.broadcast(n)).join(have, "step", "left").select("step", "expected", F.coalesce("done", F.lit(0)).cast("long").alias("done"))
    return s.withColumn("state", F.when(F.col("done") >= F.col("expected"), "completed").when(F.col("done") > 0, "running").otherwise("pending"))


def missing_outputs(tasks: DataFrame, outputs: DataFrame) -> DataFrame:
    """Diagnostics of tasks (cluster_id, idx): those without an output (missing) or with one that is no JSON (broken)."""
    per = outputs.select("cluster_id", "idx", F.try_parse_json("payload").isNotNull().alias("good")).groupBy("cluster_id", "idx").agg(F.max("good").alias("good"))
    j = tasks.select("cluster_id", "idx").join(per, ["cluster_id", "idx"], "left")
    return j.where(~F.coalesce("good", F.lit(False))).select("cluster_id", "idx", F.when(F.col("good").isNull(), "missing").otherwise("broken").alias("problem"))
