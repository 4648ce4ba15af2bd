"""Every query with SQL gives the rows of DuckDB on the smallest test data; the others run."""

import math
import os

import duckdb
import pytest

from quire.plans import catalog

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{FOLDER}/{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return round(float(v), 6) if hasattr(v, "quantize") else v


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    cols = sorted(df.columns)
    mine = sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())
    rel = duck.sql(catalog.ORACLES[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    assert mine == sorted(repr(tuple(plain(r[i]) for i in at)) for r in rel.fetchall())


def consecutive(rows, group, number):
    seen = {}
    for r in rows:
        seen.setdefault(tuple(r[g] for g in group), []).append(r[number])
    return all(sorted(v) == list(range(1, len(v) + 1)) for v in seen.values())


def unique(rows, *key):
    return len({tuple(r[k] for k in key) for r in rows}) == len(rows)


def length(duck, sql):
    return duck.sql(sql).fetchall()[0][0]


CLUSTERS = "SELECT count(DISTINCT cluster_id) FROM cluster_records"
KEYWORDS = "SELECT sum({}) FROM (SELECT arg_max(keywords, record_no) AS k FROM (SELECT * FROM cluster_records QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY record_no DESC) = 1) WHERE label IS NOT NULL GROUP BY cluster_id)"
# What holds for the rows of each query without SQL.
HOLDS = {
    "topic_tree": lambda rows, duck: unique(rows, "cluster_id") and sum(r["size"] for r in rows if r["is_leaf"]) == length(duck, "SELECT count(*) FROM embeddings WHERE len(embedding) > 0"),
    "harmonized": lambda rows, duck: unique(rows, "cluster_id", "child") and all(r["group_tokens"] > 0 for r in rows),
    "label_tree_mock": lambda rows, duck: unique(rows, "cluster_id") and len(rows) == length(duck, CLUSTERS) and all(r["label"].strip() for r in rows),
    "parsed_documents": lambda rows, duck: consecutive(rows, ["doc"], "chunk_id") and all(r["token_count"] == len(r["text"].split()) and r["chunk_type"] != "heading" for r in rows),
    "traced_windows": lambda rows, duck: unique(rows, "document_name", "merged_id", "window_no") and all(0 < r["token_end"] - r["token_start"] <= 384 for r in rows),
    "hybrid_all": lambda rows, duck: consecutive(rows, ["query_id"], "rank"),
    "keyword_rerank_all": lambda rows, duck: unique(rows, "query_id", "chunk_id"),
    "dedupe_final_all": lambda rows, duck: consecutive(rows, ["query_id"], "final_rank") and all(r["final_rank"] <= 10 for r in rows),
    "cluster_drift": lambda rows, duck: unique(rows, "cluster_id") and len(rows) == length(duck, CLUSTERS) and all(r["overlap_distance"] is None or 0 <= r["overlap_distance"] <= 1 for r in rows),
    "cluster_drift_global": lambda rows, duck: len(rows) == 1,
    "cluster_drift_by_depth": lambda rows, duck: unique(rows, "depth"),
    "cluster_records": lambda rows, duck: unique(rows, "cluster_id") and len(rows) == length(duck, CLUSTERS),
    "embedded_chunks": lambda rows, duck: all(r["embedding"] is None or abs(sum(x * x for x in r["embedding"]) - 1) < 1e-3 or not any(r["embedding"]) for r in rows),
    "answered_questions": lambda rows, duck: unique(rows, "request_id") and len(rows) == length(duck, "SELECT count(*) FROM qa_pairs WHERE pair_id % 20 = 0 AND question IS NOT NULL"),
    "extraction_mock": lambda rows, duck: unique(rows, "cluster_id", "info_type") and {r["status"] for r in rows} <= {"done", "incomplete"},
    "ontology_mock": lambda rows, duck: unique(rows, "cluster_id", "idx") and all(r["payload"].startswith("{") for r in rows),
    "ontology_entities": lambda rows, duck: unique(rows, "step", "cluster_id", "idx") and len(rows) == 3 * length(duck, KEYWORDS.format("coalesce(len(k), 0)")),
    "ontology_processes": lambda rows, duck: unique(rows, "step", "cluster_id", "idx") and len(rows) == 3 * length(duck, KEYWORDS.format("least(coalesce(len(k), 0), 2)")),
    "ontology_relationships": lambda rows, duck: unique(rows, "step", "cluster_id", "idx") and len(rows) == 2 * length(duck, KEYWORDS.format("greatest(coalesce(len(k), 0) - 1, 0)")),
    "baselines_mock": lambda rows, duck: len(rows) == length(duck, CLUSTERS) and all(r["payload"].startswith("{") for r in rows),
    "chunk_prompts_mock": lambda rows, duck: unique(rows, "chunk_id") and all(r[c] for r in rows for c in ("concepts", "steps", "objects", "keywords")),
    "rewritten_documents": lambda rows, duck: unique(rows, "doc") and all(r["changed"] <= r["paragraphs"] for r in rows),
}


# Compares every term with every cluster; tested on a fixture.
@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES) - {"lexical_clusters"}))
def test_query_without_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    assert df.schema == catalog.QUERIES[name](spark, FOLDER).schema
    rows = df.collect()
    assert rows and HOLDS[name](rows, duck)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
