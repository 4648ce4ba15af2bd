"""Further queries: preparing chunks, retrieval for clusters, extraction tasks, baselines, ontology steps, documents as files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.operators import docx, enrich, extraction, models, ontology, retrieval, store
from quire.plans.catalog import CHUNKS, LEAF, LEVEL, NODES, chunks_view, leaf_view, nodes_view, query, table, vectors_view


@query("SELECT record_no, id, text, CASE WHEN len(metadata.heading_path) > 0 THEN array_to_string(metadata.heading_path, '|') END AS heading_path, CASE WHEN len(metadata.image_paths) > 0 THEN array_to_string(metadata.image_paths, '|') END AS image_paths, CASE WHEN len(metadata.pages) > 0 THEN array_to_string(metadata.pages, '|') END AS pages FROM vector_records")
def clean_metadata(spark, d):
    rows = enrich.clean_metadata(table(spark, d, "vector_records").select("record_no", "id", "text", "metadata.heading_path", "metadata.image_paths", "metadata.pages", F.lit("x").alias("blocks")))
    return rows.select("record_no", "id", "text", *[F.array_join(F.transform(c, lambda x: x.cast("string")), "|").alias(c) for c in ("heading_path", "image_paths", "pages")])


_CLASS_SQL = " ".join(f"WHEN regexp_matches(text, '{rule}') THEN '{name}'" for name, rule in enrich._RULES.items())


@query(f"SELECT chunk_row, CASE WHEN trim(coalesce(text, ''), ' ') = '' THEN NULL {_CLASS_SQL} ELSE 'Other' END AS chunk_text_class FROM structural_chunks")
def text_classes(spark, d):
    return enrich.classify_texts(table(spark, d, "structural_chunks").select("chunk_row", "text")).select("chunk_row", "chunk_text_class")


@query(f"""WITH {NODES}, v AS (SELECT vec_id AS id, embedding FROM embeddings), s AS (SELECT cluster_id, id, round(list_cosine_similarity(n.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) AS score FROM nodes n, v WHERE len(n.embedding) > 0 AND len(list_filter(n.embedding, lambda x: x <> 0)) > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY score DESC, id) AS rank FROM s), g AS (SELECT cluster_id, count(*) AS retrieved_count, string_agg(id || ':' || printf('%.6f', score), '|' ORDER BY rank) AS chunks FROM r WHERE rank <= 10 GROUP BY cluster_id)
SELECT cluster_id, label, array_to_string(list_sort(list_distinct(coalesce(keywords, []))), '|') AS keywords, coalesce(retrieved_count, 0) AS retrieved_count, coalesce(chunks, '') AS chunks FROM nodes LEFT JOIN g USING (cluster_id)""")
def retrieved_for_clusters(spark, d):
    r = retrieval.retrieved_for_clusters(nodes_view(spark, d), vectors_view(spark, d), 10)
    return r.select("cluster_id", "label", F.array_join("keywords", "|").alias("keywords"), "retrieved_count", F.array_join(F.transform("chunks", lambda x: F.format_string("%d:%.6f", x["id"], x["score"])), "|").alias("chunks"))


@query(f"WITH {NODES} SELECT arg_min(upper(trim(source_language)), list_transform(string_split(cluster_id, '.'), lambda x: x::INT)) AS language FROM nodes WHERE trim(coalesce(source_language, '')) <> ''")
def language_pick(spark, d):
    lang = F.when(F.trim(F.coalesce("source_language", F.lit(""))) != "", F.array(F.upper(F.trim("source_language"))))
    return models.language_pick(nodes_view(spark, d).select("cluster_id", lang.alias("languages")))


@query(f"WITH {NODES} SELECT cluster_id FROM nodes WHERE trim(coalesce(label, '')) = '' OR trim(coalesce(summary, '')) = '' OR coalesce(len(keywords), 0) = 0")
def missing_labels(spark, d):
    return models.missing_labels(nodes_view(spark, d)).select("cluster_id")


@query("SELECT record_no, CASE WHEN regexp_full_match(trim(source_language), '[A-Za-z]{2}') THEN upper(trim(source_language)) ELSE 'EN' END AS language FROM cluster_records")
def language_codes(spark, d):
    return table(spark, d, "cluster_records").select("record_no", models.language_code(F.col("source_language")).alias("language"))


@query("WITH o AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY record_no) AS a, row_number() OVER (PARTITION BY cluster_id ORDER BY record_no DESC) AS z FROM cluster_records) SELECT cluster_id, record_no, label, summary FROM o WHERE z = 1")
def clusters_replaced(spark, d):
    """Clusters labelled again take the place of their first record: a delete-then-add by key."""
    rows = table(spark, d, "cluster_records").select("cluster_id", "record_no", "label", "summary")
    first = rows.withColumn("n", F.row_number().over(Window.partitionBy("cluster_id").orderBy("record_no"))).where("n = 1").drop("n")
    again = store.latest(rows.join(first.select("record_no"), "record_no", "left_anti"), "cluster_id", "record_no")
    return store.upsert(first, again, key="cluster_id").select("cluster_id", "record_no", "label", "summary")


_SPEC_SQL = "specs AS (SELECT * FROM (VALUES " + ", ".join(f"('{s.info_type}', {s.on_leaves}, {s.on_inner}, {repr(s.source) if s.source else 'NULL::VARCHAR'}, {s.neighbours}, {s.from_children})" for s in extraction.SPECS) + ") t(info_type, on_leaves, on_inner, source, neighbours, from_children))"
_DONE_SQL = "done AS (SELECT DISTINCT cluster_id, info_type FROM qa_pairs UNION SELECT cluster_id, 'questions' FROM qa_pairs UNION SELECT cluster_id, 'process_b' FROM cluster_records WHERE record_no % 3 = 0)"


def _outputs(spark, d):
    qa = table(spark, d, "qa_pairs")
    more = table(spark, d, "cluster_records").where("record_no % 3 = 0").select("cluster_id", F.lit("process_b").alias("info_type"))
    return qa.select("cluster_id", "info_type").unionAll(qa.select("cluster_id", F.lit("questions"))).unionAll(more)


@query(f"WITH {NODES}, {_SPEC_SQL}, {_DONE_SQL} SELECT cluster_id, s.info_type, s.source, s.neighbours, s.from_children FROM nodes JOIN specs s ON CASE WHEN coalesce(is_leaf, false) THEN on_leaves ELSE on_inner END LEFT JOIN (SELECT *, 1 AS h FROM done) a USING (cluster_id, info_type) LEFT JOIN (SELECT cluster_id, info_type AS source, 1 AS g FROM done) b USING (cluster_id, source) WHERE a.h IS NULL AND (s.source IS NULL OR b.g = 1)")
def due_tasks(spark, d):
    return extraction.due_tasks(nodes_view(spark, d).select("cluster_id", "is_leaf"), _outputs(spark, d), extraction.spec_table(spark))


@query(f"WITH {NODES} SELECT regexp_replace(cluster_id, '\\.[^.]*$', '') AS cluster_id, 'summary' AS info_type, string_agg(summary, chr(10) || chr(10) ORDER BY list_transform(string_split(cluster_id, '.'), lambda x: x::INT)) AS input FROM nodes WHERE contains(cluster_id, '.') AND summary IS NOT NULL GROUP BY 1")
def child_outputs(spark, d):
    return extraction.child_outputs(nodes_view(spark, d).select("cluster_id", F.lit("summary").alias("info_type"), F.col("summary").alias("payload")))


@query(f"WITH {CHUNKS}, {LEAF}, tx AS (SELECT cluster_id, string_agg(text, chr(10) || chr(10) ORDER BY text) AS input FROM leaf JOIN chunks USING (chunk_id) WHERE text IS NOT NULL GROUP BY cluster_id) SELECT cluster_id, 'concept' AS info_type, md5(input) AS input_md5 FROM nodes JOIN tx USING (cluster_id) WHERE NOT ends_with(cluster_id, '1')")
def extraction_inputs(spark, d):
    texts = leaf_view(spark, d).join(chunks_view(spark, d).select("chunk_id", "text").where("text is not null"), "chunk_id").groupBy("cluster_id").agg(F.array_join(F.array_sort(F.collect_list("text")), "\n\n").alias("text"))
    n = nodes_view(spark, d).select("cluster_id")
    done = n.where("cluster_id like '%1'").select("cluster_id", F.lit("concept").alias("info_type"), F.lit("{}").alias("payload"))
    return models.extraction_inputs(n, texts, done, "concept").select("cluster_id", "info_type", F.md5("input").alias("input_md5"))


def _matching(spark, d):
    rows = table(spark, d, "cluster_records").select("record_no", "cluster_id", "cluster_chunks")
    return store.latest(rows, "cluster_id", "record_no").select("cluster_id", F.posexplode("cluster_chunks").alias("p", "chunk_id")).select("cluster_id", (F.col("p") + 1).alias("rank"), "chunk_id")


_MATCH_SQL = "lr AS (SELECT cluster_id, cluster_chunks FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY record_no DESC) AS rn FROM cluster_records) WHERE rn = 1), mt AS (SELECT cluster_id, unnest(cluster_chunks) AS chunk_id, generate_subscripts(cluster_chunks, 1) AS rank FROM lr)"


@query(f"WITH {CHUNKS}, {NODES}, {_MATCH_SQL}, tx AS (SELECT cluster_id, count(*) AS chunks, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS input FROM mt JOIN chunks USING (chunk_id) WHERE rank <= 10 AND text IS NOT NULL GROUP BY cluster_id) SELECT cluster_id, label, coalesce(tx.chunks, 0) AS chunks, md5(input) AS input_md5 FROM nodes LEFT JOIN tx USING (cluster_id) WHERE cluster_id NOT IN (SELECT cluster_id FROM cluster_records WHERE record_no % 4 = 0)")
def baseline_inputs(spark, d):
    done = table(spark, d, "cluster_records").where("record_no % 4 = 0").select("cluster_id")
    r = extraction.baseline_inputs(nodes_view(spark, d), _matching(spark, d), chunks_view(spark, d), done)
    return r.select("cluster_id", "label", "chunks", F.md5("input").alias("input_md5"))


@query(f"WITH {NODES}, dn AS (SELECT DISTINCT cluster_id, 1 AS d FROM cluster_records WHERE record_no % 4 = 0) SELECT {LEVEL} AS level, count(*) AS expected, count(d) AS done, count(*) - count(d) AS missing FROM nodes LEFT JOIN dn USING (cluster_id) GROUP BY 1")
def baseline_status(spark, d):
    return extraction.baseline_status(nodes_view(spark, d), table(spark, d, "cluster_records").where("record_no % 4 = 0").select("cluster_id"))


@query()
def baselines_mock(spark, d):
    none = nodes_view(spark, d).select("cluster_id").where("false")
    inputs = extraction.baseline_inputs(nodes_view(spark, d), _matching(spark, d), chunks_view(spark, d), none)
    return extraction.baselines(inputs)


@query()
def chunk_prompts_mock(spark, d):
    heads = {"concepts": "Name the concepts.", "steps": "Name the steps.", "objects": "Name the objects.", "keywords": "Name the keywords."}
    return extraction.chunk_prompts(chunks_view(spark, d).select("chunk_id", "text"), heads)


def _baselines(spark, d):
    """Baselines from the stored clusters: keywords as entities and processes, neighbouring keywords as relationships."""
    n = nodes_view(spark, d).where("label IS NOT NULL")
    link = lambda x, i: F.struct(F.get("keywords", i).alias("source"), F.get("keywords", i + 1).alias("target"), F.lit("related_to").alias("type"))
    pairs = F.filter(F.transform("keywords", link), lambda p: p["target"].isNotNull())
    return n.select("cluster_id", "label", F.col("keywords").alias("entities"), F.slice("keywords", 1, 2).alias("processes"), pairs.alias("relationships"))


@query(f"WITH {NODES}, b AS (SELECT * FROM nodes WHERE label IS NOT NULL) SELECT cluster_id, coalesce(b.label, '') AS label, array_to_string(coalesce(b.keywords, []), '|') AS entities, array_to_string(coalesce(b.keywords[1:2], []), '|') AS processes, greatest(coalesce(len(b.keywords), 0) - 1, 0)::BIGINT AS relationships FROM nodes LEFT JOIN b USING (cluster_id)")
def loaded_baselines(spark, d):
    b = ontology.loaded_baselines(nodes_view(spark, d), _baselines(spark, d))
    return b.select("cluster_id", "label", F.array_join("entities", "|").alias("entities"), F.array_join("processes", "|").alias("processes"), F.size("relationships").cast("long").alias("relationships"))


@query()
def ontology_entities(spark, d):
    return ontology.run_part(ontology.loaded_baselines(nodes_view(spark, d), _baselines(spark, d)), "entities")


@query()
def ontology_relationships(spark, d):
    return ontology.run_part(ontology.loaded_baselines(nodes_view(spark, d), _baselines(spark, d)), "relationships")


@query()
def ontology_processes(spark, d):
    return ontology.run_part(ontology.loaded_baselines(nodes_view(spark, d), _baselines(spark, d)), "processes")


@query(f"WITH {NODES}, t AS (SELECT cluster_id, unnest(range(0, len(keywords))) AS idx FROM nodes WHERE label IS NOT NULL) SELECT cluster_id, idx::INT AS idx, CASE WHEN idx % 3 = 0 THEN 'missing' ELSE 'broken' END AS problem FROM t WHERE idx % 3 < 2")
def missing_outputs(spark, d):
    tasks = models.ontology_tasks(_baselines(spark, d), "entities")
    outputs = tasks.where("idx % 3 > 0").select("cluster_id", "idx", F.when(F.col("idx") % 3 == 1, "{broken").otherwise('{"id": 1}').alias("payload"))
    return ontology.missing_outputs(tasks, outputs)


_PARTS = f"""SELECT cluster_id, 0 AS part, '' AS kind, 0 AS item_no, 'Heading ' || least({LEVEL} + 1, 6) AS style, coalesce(label, '') AS text FROM nodes
UNION ALL SELECT cluster_id, 1, '', 0, 'Normal', summary FROM nodes WHERE summary IS NOT NULL
UNION ALL SELECT cluster_id, 2, coalesce(info_type, ''), coalesce(item_no, 0), 'Heading ' || least({LEVEL} + 2, 6), question FROM qa_pairs SEMI JOIN nodes USING (cluster_id) WHERE question IS NOT NULL
UNION ALL SELECT cluster_id, 3, coalesce(info_type, ''), coalesce(item_no, 0), 'Normal', coalesce(answer, '') FROM qa_pairs SEMI JOIN nodes USING (cluster_id) WHERE question IS NOT NULL"""


@query(f"WITH {NODES} {_PARTS}")
def document_rows(spark, d):
    return docx.document_rows(nodes_view(spark, d), table(spark, d, "qa_pairs"))


def _files(spark, d):
    """One file per branch below the root."""
    rows = docx.document_rows(nodes_view(spark, d), table(spark, d, "qa_pairs"))
    return docx.render(rows.withColumn("doc", F.substring_index("cluster_id", ".", 2)))


@query(f"WITH {NODES}, p AS ({_PARTS}) SELECT array_to_string(string_split(cluster_id, '.')[1:2], '.') AS doc, count(*) AS paragraphs, count(*) FILTER (WHERE starts_with(style, 'Heading')) AS headings FROM p GROUP BY 1")
def rendered_documents(spark, d):
    """Files are rendered and read again; their paragraphs are counted."""
    p = docx.read_paragraphs(_files(spark, d))
    return p.groupBy("doc").agg(F.count("*").alias("paragraphs"), F.sum(F.col("style").startswith("Heading").cast("long")).alias("headings"))


@query()
def rewritten_documents(spark, d):
    p = docx.read_paragraphs(_files(spark, d))
    r = docx.rewritten(p, models.TRANSLATE + "de", models.MockClient)
    return r.groupBy("doc").agg(F.count("*").alias("paragraphs"), F.sum(F.col("changed").cast("long")).alias("changed"))
