"""All queries over the test tables, each through an operator of the library, with SQL that gives the same rows.

Every query reads its whole tables.  Searches ask with every row whose id is divisible
by 20, against all rows; ``answered_questions`` asks all questions.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions import text as T
from quire.operators import chunking, documents, drift, embed, hierarchy, layout, models, retrieval, store
from quire.plans import serving
from quire.sources.tables import table
from quire.streaming import ingest

QUERIES: dict = {}
ORACLES: dict = {}
FLAGSHIP = "dense_topk"


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL where it has one."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


# ---- canonical views, in both dialects ------------------------------------------------


def chunks_view(spark, d):
    """The stored chunks: one row per id, the first stored one."""
    m = "metadata"
    rows = table(spark, d, "vector_records").where("id is not null").select(F.col("id").alias("chunk_id"), "record_no", "text", *[F.col(f"{m}.{c}").alias(c) for c in ("document_name", "token_count", "chunk_text_class", "heading_path", "pages", "image_paths", "chunk_type")])
    first = rows.groupBy("chunk_id").agg(F.min("record_no").alias("record_no"))
    return rows.join(first, ["chunk_id", "record_no"], "left_semi")


def nodes_view(spark, d):
    """The clusters, each with its latest labels."""
    rows = table(spark, d, "cluster_records").select("record_no", "cluster_id", "label", "summary", "keywords", "metadata.is_leaf", "leaf_chunks", "source_language", "embedding")
    return store.latest(rows, "cluster_id", "record_no")


def retrieved_view(spark, d):
    """The chunks that are stored as retrieved for the clusters, of each the latest record."""
    rows = table(spark, d, "cluster_records").select("record_no", "cluster_id", "cluster_chunks")
    return store.latest(rows, "cluster_id", "record_no").select("cluster_id", F.explode("cluster_chunks").alias("chunk_id"))


def chunks_of_nodes(spark, d):
    """All chunks of each cluster, inner ones too: those retrieved and those of leaves."""
    rows = table(spark, d, "cluster_records").select("record_no", "cluster_id", "cluster_chunks", "leaf_chunks")
    none = F.array().cast("array<string>")
    return store.latest(rows, "cluster_id", "record_no").select("cluster_id", F.array_union(F.coalesce("cluster_chunks", none), F.coalesce("leaf_chunks", none)).alias("chunks"))


def leaf_view(spark, d):
    return nodes_view(spark, d).where("is_leaf").select("cluster_id", F.explode("leaf_chunks").alias("chunk_id"))


def vectors_view(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def spans_view(spark, d):
    """Chunk sentences as layout spans whose geometry follows from their lengths."""
    once = table(spark, d, "structural_chunks").where("document_name is not null").select("chunk_row", "document_name", "chunk_id", "pages", "text")
    first = once.groupBy("document_name", "chunk_id").agg(F.min("chunk_row").alias("chunk_row"))
    lines = once.join(first, ["document_name", "chunk_id", "chunk_row"], "left_semi").where("text is not null").select(F.col("document_name").alias("doc"), F.coalesce(F.get("pages", F.lit(0)), F.lit(1)).alias("page_num"), F.col("chunk_id").alias("block_no"), F.posexplode(F.split("text", r"\. ")).alias("line_no", "text"))
    n = F.length("text")
    return lines.where(F.trim("text") != "").select("doc", "page_num", "block_no", "line_no", F.lit(0).alias("span_no"), "text", (8.0 + n % 5).alias("font_size"), (n % 7 == 0).alias("bold"), (n * 13 % 400).cast("double").alias("x0"), ((F.col("line_no") * 31 + F.col("block_no") * 7) % 780).cast("double").alias("y0"), F.lit(False).alias("is_image")).select("*", (F.col("x0") + 100).alias("x1"), (F.col("y0") + 12).alias("y1"))


def pages_view(spark, d):
    return spans_view(spark, d).select("doc", "page_num").distinct().select("*", F.lit(595.0).alias("width"), F.lit(800.0).alias("height"))


def illustrated_view(spark, d):
    """The spans of the chunks and one per image path below the text of its chunk."""
    once = table(spark, d, "structural_chunks").where("document_name is not null").select("chunk_row", "document_name", "chunk_id", "pages", "text", "image_paths")
    first = once.groupBy("document_name", "chunk_id").agg(F.min("chunk_row").alias("chunk_row"))
    page, below = F.coalesce(F.get("pages", F.lit(0)), F.lit(1)).alias("page_num"), F.coalesce(F.size(F.split("text", r"\. ")), F.lit(0))
    i = once.join(first, ["document_name", "chunk_id", "chunk_row"], "left_semi").select(F.col("document_name").alias("doc"), page, F.col("chunk_id").alias("block_no"), F.greatest(below, F.lit(0)).alias("line_no"), F.posexplode("image_paths").alias("span_no", "image_path"))
    y = ((F.col("line_no") * 31 + F.col("block_no") * 7) % 700).cast("double")
    i = i.where("image_path is not null").select("*", F.lit("").alias("text"), F.lit(None).cast("double").alias("font_size"), F.lit(False).alias("bold"), F.lit(150.0).alias("x0"), y.alias("y0"), F.lit(True).alias("is_image"), F.lit(450.0).alias("x1"), (y + 60).alias("y1"))
    return spans_view(spark, d).withColumn("image_path", F.lit(None).cast("string")).unionByName(i)


def illustrated_pages_view(spark, d):
    return illustrated_view(spark, d).select("doc", "page_num").distinct().select("*", F.lit(595.0).alias("width"), F.lit(800.0).alias("height"))


def label_tree_view(spark, d):
    """Vectors as a tree of labels: leaf 0.<label>.<vec_id % 4>."""
    v = table(spark, d, "embeddings")
    return v.select(F.concat(F.lit("0."), F.col("label").cast("string"), F.lit("."), (F.col("vec_id") % 4).cast("string")).alias("cluster_id"), F.col("vec_id").alias("chunk_id"), "embedding", "label")


CHUNKS = "chunks AS (SELECT * FROM (SELECT id AS chunk_id, record_no, text, metadata.document_name AS document_name, metadata.token_count AS token_count, metadata.chunk_text_class AS chunk_text_class, metadata.heading_path AS heading_path, metadata.pages AS pages, metadata.image_paths AS image_paths, metadata.chunk_type AS chunk_type, row_number() OVER (PARTITION BY id ORDER BY record_no) AS rn FROM vector_records WHERE id IS NOT NULL) WHERE rn = 1)"
NODES = "nodes AS (SELECT * FROM (SELECT record_no, cluster_id, label, summary, keywords, metadata.is_leaf AS is_leaf, leaf_chunks, source_language, embedding, row_number() OVER (PARTITION BY cluster_id ORDER BY record_no DESC) AS rn FROM cluster_records) WHERE rn = 1)"
LEAF = f"{NODES}, leaf AS (SELECT cluster_id, unnest(leaf_chunks) AS chunk_id FROM nodes WHERE is_leaf)"
ANC = "list_transform(range(1, len(string_split(cluster_id, '.')) + 1), lambda n: array_to_string(string_split(cluster_id, '.')[1:n], '.'))"
PARENT = "CASE WHEN contains(cluster_id, '.') THEN regexp_replace(cluster_id, '\\.[^.]*$', '') END"
LEVEL = "(len(string_split(cluster_id, '.')) - 1)"
WORDS = "list_filter(regexp_split_to_array(coalesce({}, ''), '\\s+'), lambda x: x <> '')"
_SPACE = "[\\s\\x{00a0}\\x{2000}-\\x{200a}\\x{202f}\\x{205f}\\x{3000}\\x{1680}\\x{2028}\\x{2029}\\x{0085}\\x0b\\x1c-\\x1f]+"
SPANS = """spans0 AS (SELECT * FROM (SELECT document_name AS doc, coalesce(pages[1], 1) AS page_num, chunk_id AS block_no, text AS full_text, row_number() OVER (PARTITION BY document_name, chunk_id ORDER BY chunk_row) AS rn FROM structural_chunks WHERE document_name IS NOT NULL) WHERE rn = 1 AND full_text IS NOT NULL),
spans1 AS (SELECT doc, page_num, block_no, unnest(range(0, len(string_split(full_text, '. ')))) AS line_no, unnest(string_split(full_text, '. ')) AS text FROM spans0),
spans AS (SELECT doc, page_num, block_no, line_no, text, 8.0 + length(text) % 5 AS font_size, length(text) % 7 = 0 AS bold, (length(text) * 13 % 400)::DOUBLE AS x0, ((line_no * 31 + block_no * 7) % 780)::DOUBLE AS y0, (length(text) * 13 % 400)::DOUBLE + 100 AS x1, ((line_no * 31 + block_no * 7) % 780)::DOUBLE + 12 AS y1 FROM spans1 WHERE trim(text) <> '')"""
TREE = "tree AS (SELECT '0.' || label || '.' || (vec_id % 4) AS cluster_id, vec_id AS chunk_id, embedding, label FROM embeddings)"

# ---- dense, sparse and hybrid retrieval -------------------------------------------------

_DENSE = "SELECT query_id, id, similarity, round(1 - similarity, 6) AS distance, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank FROM (SELECT q.vec_id AS query_id, v.vec_id AS id, round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) AS similarity FROM embeddings q, embeddings v WHERE q.vec_id % 20 = 0{})) WHERE rank <= {}"


def _asking(spark, d):
    return vectors_view(spark, d).where("id % 20 = 0").select(F.col("id").alias("query_id"), "embedding", "label")


@query(_DENSE.format("", 10))
def dense_topk(spark, d):
    return retrieval.dense_topk(_asking(spark, d), vectors_view(spark, d), 10)


@query(f"SELECT * FROM ({_DENSE.format('', 500)}) WHERE distance <= 0.7")
def dense_max_distance(spark, d):
    return retrieval.dense_topk(_asking(spark, d), vectors_view(spark, d), 500, max_distance=0.7)


@query(f"SELECT query_id, id, similarity, rank FROM ({_DENSE.format(' AND q.label = v.label', 30)})")
def search_filtered(spark, d):
    return retrieval.dense_topk(_asking(spark, d), vectors_view(spark, d), 30, within="label").select("query_id", "id", "similarity", "rank")


@query("SELECT document_name, count(*) AS results, grouping(document_name) = 1 AS total FROM (SELECT coalesce(metadata.document_name, 'Unknown Document') AS document_name FROM vector_records) GROUP BY ROLLUP (document_name)")
def result_summary(spark, d):
    return retrieval.result_summary(table(spark, d, "vector_records").select("metadata.document_name"))


def _all_questions(spark, d):
    return table(spark, d, "qa_pairs").where("question IS NOT NULL").select(F.col("pair_id").alias("query_id"), F.col("question").alias("text"))


def _questions(spark, d):
    return _all_questions(spark, d).where("query_id % 20 = 0")


def _bm25_sql(chunks: str, queries: str) -> str:
    return f"""tok AS (SELECT chunk_id, unnest({WORDS.format('text')}) AS term FROM {chunks}), tf AS (SELECT chunk_id, term, count(*) AS f FROM tok GROUP BY ALL),
dl AS (SELECT chunk_id, len({WORDS.format('text')}) AS dl FROM {chunks}), sz AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
raw AS (SELECT term, ln(n - df + 0.5) - ln(df + 0.5) AS raw FROM df, sz), idf AS (SELECT term, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM raw) ELSE raw END AS idf FROM raw),
ask AS (SELECT query_id, term, count(*) AS times FROM (SELECT query_id, unnest({WORDS.format('text')}) AS term FROM {queries}) GROUP BY ALL),
scored AS (SELECT query_id, chunk_id, sum(times * idf * f * 2.5 / (f + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score FROM ask JOIN idf USING (term) JOIN tf USING (term) JOIN dl USING (chunk_id), sz GROUP BY ALL)"""


_ASK = "asked AS (SELECT pair_id AS query_id, question AS text FROM qa_pairs WHERE pair_id % 20 = 0 AND question IS NOT NULL)"


@query(f"WITH {CHUNKS}, {_ASK}, {_bm25_sql('chunks', 'asked')} SELECT query_id, chunk_id, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, chunk_id) AS rank FROM scored) WHERE rank <= 20")
def bm25_topk(spark, d):
    return retrieval.bm25_topk(chunks_view(spark, d).select("chunk_id", "text"), _questions(spark, d), 20).select("query_id", "chunk_id", F.round("score", 6).alias("score"), "rank")


def _texts(spark, d):
    """All documents that have a text, as chunks, and every twentieth, whole, as queries; the stored vectors of those that have one.

    Texts and vectors are frames of their own: no text is shuffled to meet its vector.
    """
    docs = table(spark, d, "documents").where("text is not null").select(F.col("doc_id").alias("chunk_id"), "text")
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding").join(docs.select(F.col("chunk_id").alias("id")), "id", "left_semi")
    return docs, docs.where("chunk_id % 20 = 0").withColumnRenamed("chunk_id", "query_id"), vectors, vectors.where("id % 20 = 0").withColumnRenamed("id", "query_id")


_HYB = f"""WITH docs AS (SELECT doc_id AS chunk_id, text, embedding FROM documents LEFT JOIN embeddings ON vec_id = doc_id WHERE text IS NOT NULL),
asked AS (SELECT chunk_id AS query_id, text, embedding FROM docs WHERE chunk_id % 20 = 0), {_bm25_sql('docs', 'asked')},
sparse0 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, chunk_id) AS rank FROM scored) WHERE rank <= 40),
sparse AS (SELECT query_id, chunk_id, score / (sqrt(sum(score * score) OVER (PARTITION BY query_id)) + 1e-6) AS sparse FROM sparse0),
dense AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dense DESC, chunk_id) AS rank FROM (SELECT q.query_id, v.chunk_id, round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) AS dense FROM asked q, docs v WHERE q.embedding IS NOT NULL AND v.embedding IS NOT NULL)) WHERE rank <= 40),
both_ AS (SELECT coalesce(a.query_id, b.query_id) AS query_id, coalesce(a.chunk_id, b.chunk_id) AS chunk_id, coalesce(dense, 0) AS dense, coalesce(sparse, 0) AS sparse, sparse IS NOT NULL AS s FROM dense a FULL JOIN sparse b ON a.query_id = b.query_id AND a.chunk_id = b.chunk_id),
hyb0 AS (SELECT query_id, chunk_id, dense, sparse, CASE WHEN bool_or(s) OVER (PARTITION BY query_id) THEN 0.5 * dense + 0.5 * sparse ELSE dense END AS hybrid FROM both_),
hyb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(hybrid, 6) DESC, chunk_id) AS rank FROM hyb0) WHERE rank <= 40)"""


def _hybrid(docs, asked, vectors, asking):
    dense = retrieval.dense_topk(asking, vectors, 40)
    sparse = retrieval.bm25_topk(docs, asked, 40)
    return docs, asked, retrieval.hybrid(dense, sparse)


@query(f"{_HYB} SELECT query_id, chunk_id, dense, round(sparse + 1e-9, 5) AS sparse, round(hybrid + 1e-9, 5) AS hybrid, rank FROM hyb")
def hybrid_topk(spark, d):
    return _hybrid(*_texts(spark, d))[2].select("query_id", "chunk_id", "dense", *[F.round(F.col(c) + 1e-9, 5).alias(c) for c in ("sparse", "hybrid")], "rank")


_RERANK = f"{_HYB}, fin AS (SELECT h.query_id, h.chunk_id, d.text, len(list_intersect({WORDS.format('lower(q.text)')}, {WORDS.format('lower(d.text)')})) AS keyword_score, hybrid FROM hyb h JOIN asked q USING (query_id) JOIN docs d USING (chunk_id)), ranked AS (SELECT *, hybrid + 0.2 * keyword_score AS final FROM fin)"


@query(f"{_RERANK} SELECT query_id, chunk_id, keyword_score, round(final + 1e-9, 5) AS final FROM ranked")
def keyword_rerank(spark, d):
    docs, asked, ranked = _hybrid(*_texts(spark, d))
    return retrieval.rerank_keywords(ranked, asked, docs).select("query_id", "chunk_id", "keyword_score", F.round(F.col("final") + 1e-9, 5).alias("final"))


@query(f"{_RERANK}, once AS (SELECT *, row_number() OVER (PARTITION BY query_id, md5(trim(text, ' \n\t\r')) ORDER BY round(final, 6) DESC, chunk_id) AS copy FROM ranked) SELECT query_id, chunk_id, final_rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(final, 6) DESC, chunk_id) AS final_rank FROM once WHERE copy = 1) WHERE final_rank <= 10")
def dedupe_final(spark, d):
    docs, asked, ranked = _hybrid(*_texts(spark, d))
    return retrieval.dedupe_final(retrieval.rerank_keywords(ranked, asked, docs)).select("query_id", "chunk_id", "final_rank")


# The three queries above search all documents, those without a stored vector by their words
# only.  The three below ask with whole questions and have a computed vector for every document.


def _all_texts(spark, d):
    """All documents that have a text, and the whole questions, and the vectors of the texts of both; a document without an id has none."""
    docs = table(spark, d, "documents").where("text is not null").select(F.col("doc_id").alias("chunk_id"), "text")
    asked, vector = _questions(spark, d), embed.embed(F.col("text")).alias("embedding")
    return docs, asked, docs.where("chunk_id is not null").select(F.col("chunk_id").alias("id"), vector), asked.select("query_id", vector)


@query()
def hybrid_all(spark, d):
    return _hybrid(*_all_texts(spark, d))[2].select("query_id", "chunk_id", "dense", *[F.round(F.col(c) + 1e-9, 5).alias(c) for c in ("sparse", "hybrid")], "rank")


@query()
def keyword_rerank_all(spark, d):
    docs, asked, ranked = _hybrid(*_all_texts(spark, d))
    return retrieval.rerank_keywords(ranked, asked, docs).select("query_id", "chunk_id", "keyword_score", F.round(F.col("final") + 1e-9, 5).alias("final"))


@query()
def dedupe_final_all(spark, d):
    docs, asked, ranked = _hybrid(*_all_texts(spark, d))
    return retrieval.dedupe_final(retrieval.rerank_keywords(ranked, asked, docs)).select("query_id", "chunk_id", "final_rank")


_BUDGET = """WITH r AS (SELECT doc_id % 50 AS query_id, doc_id AS chunk_id, round((doc_id % 97) / 97.0, 6)::DOUBLE AS score, coalesce(n_chars // 6, 0) AS token_count FROM documents),
t AS (SELECT *, greatest(0.6, avg(score) OVER w + 0.2 * stddev_pop(score) OVER w) AS threshold, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS best FROM r WINDOW w AS (PARTITION BY query_id)),
a AS (SELECT *, bool_or(round(score - threshold, 9) >= 0) OVER (PARTITION BY query_id) AS any_ FROM t), k AS (SELECT query_id, chunk_id, token_count, round(score + 0.3 * ln(1 + greatest(1, token_count)), 6) AS final FROM a WHERE round(score - threshold, 9) >= 0 OR (NOT any_ AND best = 1))
SELECT * FROM (SELECT query_id, chunk_id, final, token_count, sum(token_count) OVER (PARTITION BY query_id ORDER BY final DESC, chunk_id ROWS UNBOUNDED PRECEDING)::BIGINT AS running_tokens FROM k) WHERE running_tokens <= 2500"""


@query(_BUDGET)
def rerank_budget(spark, d):
    r = table(spark, d, "documents").select((F.col("doc_id") % 50).alias("query_id"), F.col("doc_id").alias("chunk_id"), F.round((F.col("doc_id") % 97) / 97.0, 6).alias("score"), F.coalesce(F.expr("n_chars div 6"), F.lit(0)).alias("token_count"))
    return retrieval.rerank_budget(r)


def _label_clusters(spark, d):
    v = vectors_view(spark, d)
    return v.groupBy(F.col("label").cast("long").alias("id")).agg(F.min_by("embedding", "id").alias("embedding"))


@query("""WITH c AS (SELECT label AS id, arg_min(embedding, vec_id) AS embedding FROM embeddings GROUP BY label), q AS (SELECT vec_id AS query_id, embedding FROM embeddings WHERE vec_id % 20 = 0),
top AS (SELECT query_id, id FROM (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS r FROM (SELECT query_id, id, round(list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 6) AS s FROM q, c)) WHERE r <= 3)
SELECT query_id, id, similarity, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank FROM (SELECT q.query_id, v.vec_id AS id, round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) AS similarity FROM top JOIN q USING (query_id) JOIN embeddings v ON v.label = top.id)) WHERE rank <= 20""")
def two_stage(spark, d):
    members = vectors_view(spark, d).select(F.col("label").cast("long").alias("cluster"), "id")
    return retrieval.two_stage(_asking(spark, d), _label_clusters(spark, d), vectors_view(spark, d), 3, 20, members=members)


@query(f"WITH r AS ({_DENSE.format('', 10)}) SELECT request_id, chunk_id, query_ord, rank FROM (SELECT query_id % 100 AS request_id, id AS chunk_id, query_id AS query_ord, rank, row_number() OVER (PARTITION BY query_id % 100, id ORDER BY query_id, rank) AS n FROM r) WHERE n = 1")
def multi_query_union(spark, d):
    r = retrieval.dense_topk(_asking(spark, d), vectors_view(spark, d), 10)
    return retrieval.union_queries(r.select((F.col("query_id") % 100).alias("request_id"), F.col("id").alias("chunk_id"), F.col("query_id").alias("query_ord"), "rank"))


@query(f"WITH a AS ({_DENSE.format('', 5)}), b AS ({_DENSE.format(' AND q.label = v.label', 5)}), u AS (SELECT query_id, id, 0 AS source, rank FROM a UNION ALL SELECT query_id, id, 1, rank FROM b), f AS (SELECT *, row_number() OVER (PARTITION BY query_id, id ORDER BY source, rank) AS n FROM u) SELECT query_id, id, source, rank, row_number() OVER (PARTITION BY query_id ORDER BY source, rank, id) AS position FROM f WHERE n = 1")
def merge_clusters(spark, d):
    q = _asking(spark, d)
    return retrieval.merge_clusters(retrieval.dense_topk(q, vectors_view(spark, d), 5), retrieval.dense_topk(q, vectors_view(spark, d), 5, within="label"))


_STOP = ", ".join(f"'{w}'" for w in T.STOPWORDS + T.COMMON_WORDS)
_ROOTS = "|".join(sorted(T.COMPOUND_ROOTS, key=lambda r: (-len(r), r)))


@query(f"""WITH k AS (SELECT pair_id, list_filter(regexp_split_to_array(regexp_replace(replace(lower(question), '_', ' '), '[^\\p{{L}}\\p{{N}}_ ]+', ' ', 'g'), '\\s+'), lambda x: x <> '' AND x NOT IN ({_STOP})) AS kept FROM qa_pairs WHERE question IS NOT NULL)
SELECT pair_id, array_to_string(list_sort(list_distinct(list_filter(list_concat(kept, [array_to_string(kept, '')], regexp_extract_all(array_to_string(list_filter(kept, lambda x: regexp_full_match(x, '\\p{{L}}+')), ' '), '{_ROOTS}')), lambda x: length(x) > 2))), '|') AS terms FROM k""")
def extract_terms(spark, d):
    return table(spark, d, "qa_pairs").where("question is not null").select("pair_id", F.array_join(T.query_terms(F.col("question")), "|").alias("terms"))


@query(f"SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '{_ROOTS}'), '|') AS parts FROM documents WHERE text IS NOT NULL")
def compound_split(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.array_join(T.compound_parts(F.col("text")), "|").alias("parts"))


@query(f"WITH {NODES} SELECT cluster_id, 'Topic label: ' || coalesce(label, '') || chr(10) || 'Summary: ' || coalesce(summary, '') || chr(10) || 'Keywords: ' || coalesce(array_to_string(keywords, ', '), '') || chr(10) || 'Retrieve text relevant to this topic.' AS query FROM nodes")
def cluster_queries(spark, d):
    return nodes_view(spark, d).select("cluster_id", retrieval.cluster_query(F.col("label"), F.col("summary"), F.col("keywords")).alias("query"))


@query("SELECT query_id, string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank, text) AS context FROM (SELECT doc_id % 50 AS query_id, doc_id AS rank, text FROM documents WHERE text IS NOT NULL) GROUP BY query_id")
def context_prompts(spark, d):
    return retrieval.context_prompt(table(spark, d, "documents").where("text is not null").select((F.col("doc_id") % 50).alias("query_id"), F.col("doc_id").alias("rank"), "text"))


@query()
def lexical_clusters(spark, d):
    asked = _questions(spark, d).select("query_id", T.query_terms(F.col("text")).alias("terms"))
    return retrieval.lexical_clusters(asked, nodes_view(spark, d).select(F.col("cluster_id").alias("id"), F.concat_ws(" ", "label", F.array_join("keywords", " ")).alias("text")))


_VOTES = {"en": "the of and is to in for when", "de": "der die das und ist wenn für den", "fr": "le la les des est quand pour une", "es": "el los las que cuando para una por"}
_VOTE_SQL = ", ".join("len(list_filter(w, lambda x: x IN (" + ", ".join(f"'{x}'" for x in v.split()) + f"))) AS {k}" for k, v in _VOTES.items())


@query(f"SELECT doc_id, CASE WHEN short OR en >= greatest(de, fr, es) THEN 'en' WHEN de >= greatest(fr, es) THEN 'de' WHEN fr >= es THEN 'fr' ELSE 'es' END AS language FROM (SELECT doc_id, short, {_VOTE_SQL} FROM (SELECT doc_id, length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) < 20 AS short, {WORDS.format('lower(text)')} AS w FROM documents WHERE text IS NOT NULL))")
def detect_language(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", retrieval.detect_language(F.col("text")).alias("language"))


# ---- the topic hierarchy ----------------------------------------------------------------


@query(f"WITH {LEAF}, l AS (SELECT {LEVEL} AS level, count(*) AS clusters FROM nodes GROUP BY 1), c AS (SELECT {LEVEL} AS level, count(DISTINCT chunk_id) AS leaf_chunks FROM leaf GROUP BY 1) SELECT level, clusters, coalesce(leaf_chunks, 0) AS leaf_chunks FROM l LEFT JOIN c USING (level)")
def level_summary(spark, d):
    return hierarchy.level_summary(nodes_view(spark, d), leaf_view(spark, d))


@query(f"""WITH {CHUNKS}, {LEAF}, s AS (SELECT DISTINCT chunk_id FROM chunks), p AS (SELECT DISTINCT chunk_id FROM leaf) SELECT 'stored' AS what, count(*) AS v FROM s UNION ALL SELECT 'leaf_entries', count(chunk_id) FROM leaf UNION ALL SELECT 'leaf_ids', count(*) FROM p
UNION ALL SELECT 'missing', count(*) FROM s ANTI JOIN p USING (chunk_id) UNION ALL SELECT 'extra', count(*) FROM p ANTI JOIN s USING (chunk_id)""")
def lossless_check(spark, d):
    return hierarchy.lossless_check(chunks_view(spark, d), leaf_view(spark, d))


_UP = f"up AS (SELECT unnest({ANC}) AS cluster_id, chunk_id FROM leaf)"


@query(f"WITH {CHUNKS}, {LEAF}, {_UP} SELECT cluster_id, count(*) AS chunks, sum(coalesce(token_count, 0))::BIGINT AS tokens, count(DISTINCT document_name) AS documents FROM up LEFT JOIN chunks USING (chunk_id) GROUP BY cluster_id")
def token_rollup(spark, d):
    return hierarchy.token_rollup(leaf_view(spark, d), chunks_view(spark, d))


def _share_sql(column: str) -> str:
    return f"WITH {CHUNKS}, {LEAF}, {_UP}, t AS (SELECT cluster_id, {column} AS name, sum(coalesce(token_count, 0))::BIGINT AS tokens FROM up LEFT JOIN chunks USING (chunk_id) GROUP BY ALL), s AS (SELECT *, sum(tokens) OVER (PARTITION BY cluster_id)::BIGINT AS total FROM t) SELECT cluster_id, name, tokens, total, CASE WHEN total > 0 THEN round(tokens / total * 100, 2) ELSE 0.0 END AS share FROM s WHERE name IS NOT NULL AND name <> ''"


@query(_share_sql("document_name"))
def doc_share(spark, d):
    return hierarchy.shares(leaf_view(spark, d), chunks_view(spark, d), "document_name")


@query(_share_sql("chunk_text_class"))
def class_share(spark, d):
    return hierarchy.shares(leaf_view(spark, d), chunks_view(spark, d), "chunk_text_class")


@query(f"WITH x AS ({_share_sql('chunk_text_class')}) SELECT cluster_id, string_agg(printf('%s (%.1f%%)', name, CASE WHEN total > 0 THEN tokens / total * 100 ELSE 0.0 END), chr(10) ORDER BY name) AS shares FROM x GROUP BY cluster_id")
def share_lists(spark, d):
    return hierarchy.share_list(hierarchy.shares(leaf_view(spark, d), chunks_view(spark, d), "chunk_text_class"))


@query(f"""WITH {NODES}, n AS (SELECT cluster_id, is_leaf, {PARENT} AS parent FROM nodes), k AS (SELECT parent AS cluster_id, sum(is_leaf::INT) AS leaf_kids, count(*) AS kids FROM n WHERE parent IS NOT NULL GROUP BY parent),
a AS (SELECT n.*, coalesce(k.leaf_kids, 0) AS lk, coalesce(k.kids, 0) AS kk, coalesce(s.leaf_kids, 0) AS sl, coalesce(s.kids, 0) AS sk FROM n LEFT JOIN k ON k.cluster_id = n.cluster_id LEFT JOIN k s ON s.cluster_id = n.parent)
SELECT cluster_id, is_leaf, lk > 0 AS document_cluster, lk = kk AS all_child_leaf, lk = 0 AS all_child_internal, sl - is_leaf::INT > 0 AS has_leaf_sibling, sk - sl - (1 - is_leaf::INT) > 0 AS has_internal_sibling, {LEVEL} AS level, array_to_string(list_transform(string_split(cluster_id, '.'), lambda x: CASE WHEN length(x) < 2 THEN lpad(x, 2, '0') ELSE x END), '.') AS padded FROM a""")
def node_flags(spark, d):
    return hierarchy.node_flags(nodes_view(spark, d).select("cluster_id", "is_leaf"))


@query(f"WITH {NODES} SELECT cluster_id, label, {LEVEL} AS level FROM nodes WHERE cluster_id = '0.1' OR starts_with(cluster_id, '0.1.')")
def subtree(spark, d):
    return hierarchy.subtree(nodes_view(spark, d).select("cluster_id", "label", T.level_of(F.col("cluster_id")).alias("level")), "0.1")


@query(f"WITH {NODES}, e AS (SELECT DISTINCT unnest({ANC}) AS cluster_id FROM nodes) SELECT e.cluster_id, n.cluster_id IS NULL AS synthetic FROM e LEFT JOIN nodes n USING (cluster_id)")
def gaps_filled(spark, d):
    return hierarchy.with_gaps_filled(nodes_view(spark, d).select("cluster_id"))


@query(f"""WITH {NODES}, n AS (SELECT cluster_id, is_leaf, {PARENT} AS parent FROM nodes), f AS (SELECT parent AS cluster_id, bool_and(is_leaf) AS al, bool_or(is_leaf) AS ol FROM n GROUP BY parent), m AS (SELECT n.*, al, ol, NOT is_leaf AND coalesce(al, false) AS lp FROM n LEFT JOIN f USING (cluster_id)),
s AS (SELECT parent AS cluster_id, bool_and(is_leaf OR lp) AS sh, bool_or(lp) AS olp FROM m GROUP BY parent) SELECT cluster_id, CASE WHEN is_leaf THEN 'leaf' WHEN lp THEN 'leaf_parent' WHEN coalesce(sh, false) AND coalesce(olp, false) AND coalesce(ol, false) THEN 'group' ELSE 'inner' END AS kind FROM m LEFT JOIN s USING (cluster_id)""")
def group_candidates(spark, d):
    return hierarchy.node_kinds(nodes_view(spark, d).select("cluster_id", "is_leaf"))


_CENTER = f"vals AS (SELECT cluster_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM tree), lc AS (SELECT cluster_id, pos, avg(x) AS value FROM vals GROUP BY ALL), cen AS (SELECT cluster_id, pos, avg(value) AS value FROM (SELECT unnest({ANC}) AS cluster_id, pos, value FROM lc) GROUP BY ALL)"


@query(f"WITH {TREE}, {_CENTER} SELECT cluster_id, pos, round(value, 6) AS value FROM cen")
def centroids(spark, d):
    t = label_tree_view(spark, d)
    return hierarchy.centroids(t.select("cluster_id", "chunk_id"), t.select("chunk_id", "embedding")).select("cluster_id", "pos", F.round("value", 6).alias("value"))


@query(f"WITH {NODES} SELECT cluster_id, source_language, coalesce(nullif(trim(label), ''), 'Cluster ' || cluster_id) AS label FROM nodes")
def label_fallback(spark, d):
    return nodes_view(spark, d).select("cluster_id", "source_language", models.label_fallback(F.col("label"), F.lit(None).cast("string"), F.col("cluster_id")).alias("label"))


@query(f"WITH {NODES}, k AS (SELECT {PARENT} AS parent, coalesce(source_language, '') AS language, sum(length(coalesce(summary, ''))) AS n, min(record_no) AS ord FROM nodes WHERE contains(cluster_id, '.') GROUP BY ALL) SELECT parent, arg_max(language, struct_pack(n := n, o := -ord)) AS source_language FROM k GROUP BY parent")
def source_language(spark, d):
    kids = nodes_view(spark, d).where("cluster_id like '%.%'").select(T.parent_id(F.col("cluster_id")).alias("parent"), F.coalesce("source_language", F.lit("")).alias("language"), F.coalesce("summary", F.lit("")).alias("summary"), F.col("record_no").alias("ord"))
    return models.source_language(kids)


@query("SELECT vec_id AS chunk_id, '0.' || r AS cluster_id FROM embeddings JOIN (SELECT label, row_number() OVER (ORDER BY min(vec_id)) - 1 AS r FROM embeddings GROUP BY label) USING (label)")
def renumber(spark, d):
    v = table(spark, d, "embeddings")
    # The level below the label has one child each, so it is dropped.
    return hierarchy.renumber(v.select(F.col("vec_id").alias("chunk_id"), F.concat(F.lit("0."), F.col("label").cast("string"), F.lit(".0")).alias("path")))


@query()
def topic_tree(spark, d):
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding")
    leaves = hierarchy.build_tree(v, cutoff=0.95, decay=0.85, min_cutoff=0.15)
    return hierarchy.nodes_of(leaves)


@query()
def harmonized(spark, d):
    t = label_tree_view(spark, d)
    # A mixed branching: even labels are split in leaves, odd ones are leaves themselves.
    leaf = t.select(F.when(F.col("label") % 2 == 1, F.concat(F.lit("0."), F.col("label").cast("string"))).otherwise(F.col("cluster_id")).alias("cluster_id"), "chunk_id")
    chunks = t.select("chunk_id", (F.col("chunk_id") % 200 + 50).alias("token_count"), F.lit("d").alias("document_name"))
    return hierarchy.harmonize(hierarchy.nodes_of(leaf), leaf, chunks, t.select("chunk_id", "embedding"))


@query(f"WITH {NODES} SELECT cluster_id, root FROM (SELECT cluster_id, string_split(cluster_id, '.')[1] AS root, list_transform(string_split(cluster_id, '.'), lambda x: x::INT) AS p FROM nodes WHERE cluster_id NOT IN (SELECT {PARENT} FROM nodes WHERE contains(cluster_id, '.'))) ORDER BY p, cluster_id LIMIT 1")
def tree_root(spark, d):
    return documents.root_of(nodes_view(spark, d).select("cluster_id"))


@query(f"WITH {CHUNKS}, {LEAF}, {_UP}, e AS (SELECT DISTINCT unnest({ANC}) AS cluster_id FROM leaf), r AS (SELECT cluster_id, count(*) AS chunks, sum(coalesce(token_count, 0))::BIGINT AS tokens FROM up LEFT JOIN chunks USING (chunk_id) GROUP BY cluster_id), known AS (SELECT DISTINCT cluster_id, true AS k FROM leaf) SELECT e.cluster_id, len(string_split(e.cluster_id, '.')) - 1 AS level, coalesce(chunks, 0) AS chunks, coalesce(tokens, 0) AS tokens, k IS NULL AS synthetic FROM e LEFT JOIN r USING (cluster_id) LEFT JOIN known USING (cluster_id)")
def tree_print_rows(spark, d):
    return documents.tree_rows(leaf_view(spark, d), chunks_view(spark, d)).drop("path")


@query(f"""WITH {NODES}, l AS (SELECT unnest(({ANC})[1:{LEVEL}]) AS cluster_id, {LEVEL} AS ll FROM nodes WHERE is_leaf), dp AS (SELECT cluster_id, max(ll) AS deepest FROM l GROUP BY cluster_id), g AS (SELECT DISTINCT regexp_replace(p, '\\.[^.]*$', '') AS cluster_id FROM (SELECT {PARENT} AS p FROM nodes WHERE NOT is_leaf) WHERE contains(p, '.'))
SELECT cluster_id, depth, allowed, depth <= allowed AS valid FROM (SELECT n.cluster_id, coalesce(deepest - (len(string_split(n.cluster_id, '.')) - 1), 0) AS depth, CASE WHEN g.cluster_id IS NOT NULL THEN 3 ELSE 2 END AS allowed FROM nodes n LEFT JOIN dp USING (cluster_id) LEFT JOIN g USING (cluster_id) WHERE NOT is_leaf)""")
def document_depth(spark, d):
    return documents.document_depth(nodes_view(spark, d).select("cluster_id", "is_leaf"))


# ---- drift --------------------------------------------------------------------------------


def _drift_parts(spark, d):
    t = label_tree_view(spark, d)
    nodes = hierarchy.nodes_of(t.select("cluster_id", "chunk_id")).select("cluster_id", "size", "level")
    own = drift.subtree_chunks(t.select("cluster_id", "chunk_id"))
    # What retrieval would give: each label's node gets the vectors whose number says so.
    matched = t.select(F.concat(F.lit("0."), (F.col("chunk_id") * 7 % 10).cast("string")).alias("cluster_id"), "chunk_id")
    return t, nodes, own, matched


_DRIFT = f"""{TREE}, own AS (SELECT unnest({ANC}) AS cluster_id, chunk_id FROM tree), nn AS (SELECT cluster_id, count(*) AS size FROM own GROUP BY cluster_id), mat AS (SELECT '0.' || (chunk_id * 7 % 10) AS cluster_id, chunk_id FROM tree),
pr AS (SELECT cluster_id, chunk_id, max(o) AS o, max(m) AS m FROM (SELECT cluster_id, chunk_id, 1 AS o, 0 AS m FROM own UNION ALL SELECT cluster_id, chunk_id, 0, 1 FROM mat) GROUP BY ALL), od AS (SELECT cluster_id, round(1 - sum(o * m) / count(*), 6) AS overlap_distance FROM pr GROUP BY cluster_id),
mv AS (SELECT side, cluster_id, pos, avg(x) AS value FROM (SELECT side, z.cluster_id, unnest(t.embedding)::DOUBLE AS x, generate_subscripts(t.embedding, 1) AS pos FROM (SELECT 'a' AS side, * FROM own UNION ALL SELECT 'b', * FROM mat) z JOIN tree t USING (chunk_id)) GROUP BY ALL),
cv AS (SELECT side, cluster_id, list(value ORDER BY pos) AS c FROM mv GROUP BY ALL), sh AS (SELECT a.cluster_id, round(1 - list_cosine_similarity(a.c, b.c), 6) AS semantic_shift FROM cv a JOIN cv b ON a.cluster_id = b.cluster_id AND a.side = 'a' AND b.side = 'b'),
dr AS (SELECT nn.cluster_id, size, overlap_distance, semantic_shift FROM nn LEFT JOIN od USING (cluster_id) LEFT JOIN sh USING (cluster_id))"""


@query(f"WITH {_DRIFT} SELECT cluster_id, overlap_distance FROM dr")
def overlap_distance(spark, d):
    _, nodes, own, matched = _drift_parts(spark, d)
    return drift.overlap_distance(own, matched, nodes)


@query(f"WITH {_DRIFT} SELECT cluster_id, semantic_shift FROM dr")
def semantic_shift(spark, d):
    t, nodes, own, matched = _drift_parts(spark, d)
    return drift.semantic_shift(own, matched, t.select("chunk_id", "embedding"), nodes)


def _drift_frame(spark, d):
    t, nodes, own, matched = _drift_parts(spark, d)
    return nodes.join(drift.overlap_distance(own, matched, nodes), "cluster_id").join(drift.semantic_shift(own, matched, t.select("chunk_id", "embedding"), nodes), "cluster_id")


def _stat_sql(c: str) -> str:
    return f"round(avg({c}), 6) AS {c}_mean, round(max({c}), 6) AS {c}_max, round(sum({c} * size) / sum(size), 6) AS {c}_weighted, " + ", ".join(f"round(quantile_cont({c}, {p / 100}), 6) AS {c}_p{p}" for p in (25, 50, 75, 95))


@query(f"WITH {_DRIFT} SELECT {_stat_sql('overlap_distance')}, {_stat_sql('semantic_shift')} FROM dr WHERE size > 0")
def drift_global(spark, d):
    return drift.drift_global(_drift_frame(spark, d))


@query(f"WITH {_DRIFT} SELECT {LEVEL} AS depth, round(avg(overlap_distance), 6) AS overlap_mean, round(avg(semantic_shift), 6) AS shift_mean, greatest(count(overlap_distance), count(semantic_shift)) AS cluster_count FROM dr GROUP BY 1")
def drift_by_depth(spark, d):
    return drift.drift_by_depth(_drift_frame(spark, d))


_LINEAGE = f"lin AS (SELECT u.cluster_id, array_to_string((list(label ORDER BY pos))[4:], ' | ') AS lineage FROM (SELECT cluster_id, unnest({ANC}) AS id, unnest(range(0, len(string_split(cluster_id, '.')))) AS pos FROM nodes) u JOIN (SELECT cluster_id AS id, label FROM nodes WHERE label IS NOT NULL AND label <> '') USING (id) GROUP BY u.cluster_id)"


@query(f"WITH {NODES}, {_LINEAGE} SELECT cluster_id, coalesce(lineage, '') AS lineage FROM nodes LEFT JOIN lin USING (cluster_id)")
def lineage(spark, d):
    return drift.lineage(nodes_view(spark, d).select("cluster_id", "label")).select("cluster_id", F.array_join("lineage", " | ").alias("lineage"))


@query(f"WITH {CHUNKS}, {LEAF}, {_UP}, c AS (SELECT cluster_id, array_to_string(heading_path, ' > ') AS heading, count(*) AS n FROM up JOIN chunks USING (chunk_id) WHERE len(heading_path) > 0 GROUP BY ALL) SELECT * FROM (SELECT cluster_id, heading, n, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, heading) AS rank FROM c) WHERE rank <= 5")
def heading_top5(spark, d):
    pairs = drift.subtree_chunks(leaf_view(spark, d)).join(chunks_view(spark, d).select("chunk_id", "heading_path"), "chunk_id")
    return drift.heading_top(pairs)


_TOP5 = ORACLES["heading_top5"].split("SELECT * FROM (SELECT cluster_id, heading, n, row_number()")[0].removeprefix(f"WITH {CHUNKS}, {LEAF}, ")


@query(f"WITH {CHUNKS}, {LEAF}, {_TOP5}, hd AS (SELECT cluster_id, string_agg(heading, ' | ' ORDER BY r) AS headings FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, heading) AS r FROM c) WHERE r <= 5 GROUP BY cluster_id), {_LINEAGE} SELECT cluster_id, array_to_string(list_filter([coalesce(label, ''), coalesce(summary, ''), coalesce(array_to_string(keywords, ', '), ''), coalesce(lineage, ''), coalesce(headings, '')], lambda x: x <> ''), chr(10)) AS embedding_text FROM nodes LEFT JOIN lin USING (cluster_id) LEFT JOIN hd USING (cluster_id)")
def embed_text(spark, d):
    n = nodes_view(spark, d)
    pairs = drift.subtree_chunks(leaf_view(spark, d)).join(chunks_view(spark, d).select("chunk_id", "heading_path"), "chunk_id")
    heads = drift.heading_top(pairs).groupBy("cluster_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "heading"))), lambda x: x["heading"]).alias("headings"))
    r = n.join(drift.lineage(n.select("cluster_id", "label")), "cluster_id").join(heads, "cluster_id", "left")
    return r.select("cluster_id", drift.embedding_text(F.col("label"), F.col("summary"), F.col("keywords"), F.col("lineage"), F.col("headings")).alias("embedding_text"))


def _cluster_drift(spark, d):
    """Size and drift of all clusters between the chunks of their subtrees and the ones retrieved for them."""
    nodes, chunks = nodes_view(spark, d).select("cluster_id"), chunks_view(spark, d)
    vectors = chunks.where("text is not null").select("chunk_id", embed.embed(F.col("text")).alias("embedding"))
    own, matched = drift.subtree_chunks(leaf_view(spark, d)), retrieved_view(spark, d)
    size = own.groupBy("cluster_id").agg(F.count("*").alias("size"))
    r = nodes.join(drift.overlap_distance(own, matched, nodes), "cluster_id").join(drift.semantic_shift(own, matched, vectors, nodes), "cluster_id")
    return r.join(size, "cluster_id", "left").na.fill(0, ["size"])


@query()
def cluster_drift(spark, d):
    return _cluster_drift(spark, d)


@query()
def cluster_drift_global(spark, d):
    return drift.drift_global(_cluster_drift(spark, d))


@query()
def cluster_drift_by_depth(spark, d):
    return drift.drift_by_depth(_cluster_drift(spark, d))


@query()
def cluster_records(spark, d):
    n, leaf, matched = nodes_view(spark, d), leaf_view(spark, d), retrieved_view(spark, d)
    heads = drift.heading_top(matched.join(chunks_view(spark, d).select("chunk_id", "heading_path"), "chunk_id"))
    r = drift.cluster_records(n.select("cluster_id", "label", "summary", "keywords", "is_leaf"), _cluster_drift(spark, d).drop("size"), drift.lineage(n), heads, matched, leaf)
    return r.select("cluster_id", F.to_json("metadata").alias("metadata"), F.size("cluster_chunks").alias("chunks"), F.md5("embedding_text").alias("text_md5"))


# ---- chunking, layout and text rules -------------------------------------------------------


@query(f"SELECT chunk_row, window_no, token_start, least(n, token_start + 384) AS token_end, array_to_string(w[token_start + 1:token_start + 384], ' ') AS chunk_text FROM (SELECT chunk_row, w, len(w) AS n, unnest(range(0, len(w), 320)) AS token_start, unnest(range(0, len(range(0, len(w), 320)))) AS window_no FROM (SELECT chunk_row, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\s\\x{{00a0}}\\x{{2000}}-\\x{{200a}}\\x{{202f}}\\x{{205f}}\\x{{3000}}\\x{{1680}}\\x{{2028}}\\x{{2029}}\\x{{0085}}\\x0b]+'), lambda x: x <> '') AS w FROM structural_chunks))")
def token_windows(spark, d):
    return chunking.token_windows(table(spark, d, "structural_chunks").select("chunk_row", "text"), "chunk_row")


_MERGED = f"""c AS (SELECT document_name, chunk_id, heading_path[1] AS top, coalesce(text, '') AS text, len(list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'), lambda x: x <> '')) AS n, row_number() OVER (PARTITION BY document_name ORDER BY chunk_id, chunk_row) AS i FROM structural_chunks WHERE document_name IS NOT NULL),
r AS (SELECT document_name, i, 1 AS merged_id, n AS total, top FROM c WHERE i = 1 UNION ALL SELECT c.document_name, c.i, CASE WHEN c.top IS NOT DISTINCT FROM r.top AND r.total + c.n < 80 THEN r.merged_id ELSE r.merged_id + 1 END, CASE WHEN c.top IS NOT DISTINCT FROM r.top AND r.total + c.n < 80 THEN r.total + c.n ELSE c.n END, c.top FROM r JOIN c ON c.document_name = r.document_name AND c.i = r.i + 1),
m AS (SELECT document_name, merged_id, string_agg(chunk_id, ',' ORDER BY i) AS merged_from, string_agg(text, chr(10) ORDER BY i) AS text FROM r JOIN c USING (document_name, i) GROUP BY ALL)"""


@query(f"WITH RECURSIVE {_MERGED} SELECT document_name, merged_id, merged_from, text FROM m")
def merge_small(spark, d):
    m = chunking.merge_small(table(spark, d, "structural_chunks"))
    return m.select("document_name", "merged_id", F.array_join(F.transform("merged_from", lambda x: x.cast("string")), ",").alias("merged_from"), "text")


@query()
def traced_windows(spark, d):
    c = table(spark, d, "structural_chunks").where("document_name is not null")
    once = c.join(c.groupBy("document_name", "chunk_id").agg(F.min("chunk_row").alias("chunk_row")), ["document_name", "chunk_id", "chunk_row"], "left_semi")
    w = chunking.traced_windows(chunking.merge_small(once), once.select("document_name", "chunk_id", "text", "pages", "heading_path", "image_paths"))
    return w.withColumn("merged_original_texts", F.to_json("merged_original_texts"))


@query("SELECT text, min(record_no) AS record_no, array_to_string(list_sort(list_distinct(flatten(list(coalesce(metadata.image_paths, []))))), '|') AS image_paths FROM vector_records WHERE text IS NOT NULL GROUP BY text")
def dedupe_text(spark, d):
    rows = table(spark, d, "vector_records").where("text is not null").select("record_no", "text", "metadata.image_paths")
    return store.merge_duplicates(rows, "record_no").select("text", "record_no", F.array_join("image_paths", "|").alias("image_paths"))


@query("WITH old AS (SELECT doc_id, source, text FROM documents), new AS (SELECT doc_id, source, 'new: ' || text AS text FROM documents WHERE doc_id % 5 = 0) SELECT * FROM new UNION ALL SELECT * FROM old WHERE doc_id % 5 <> 0 AND NOT coalesce(source = 'legal_terms', false)")
def upsert_scope(spark, d):
    old = table(spark, d, "documents").select("doc_id", "source", "text")
    return store.upsert(old, old.where("doc_id % 5 = 0").withColumn("text", F.concat(F.lit("new: "), F.col("text"))), F.col("source") == "legal_terms", "doc_id")


@query("SELECT record_no, md5(text) AS content_id, id = md5(text) AS same FROM vector_records WHERE text IS NOT NULL")
def content_ids(spark, d):
    return table(spark, d, "vector_records").where("text is not null").select("record_no", T.content_id(F.col("text")).alias("content_id"), (F.col("id") == T.content_id(F.col("text"))).alias("same"))


_SIG = "CASE WHEN regexp_full_match(trim(text), '\\d+') THEN 'PAGE_NUMBER' ELSE trim(text) END AS sig_text, round(font_size, 1) AS font, round(x0, 1) AS x"


@query(f"WITH {SPANS} SELECT doc, sig_text, font, x, count(DISTINCT page_num) AS pages FROM (SELECT doc, page_num, {_SIG} FROM spans) GROUP BY ALL HAVING count(DISTINCT page_num) >= 3")
def repeated_lines(spark, d):
    return layout.repeated_lines(spans_view(spark, d)).select("doc", F.col("sig.text").alias("sig_text"), F.col("sig.font").alias("font"), F.col("sig.x").alias("x"), "pages")


@query(f"WITH {SPANS}, s AS (SELECT *, {_SIG} FROM spans), r AS (SELECT doc, sig_text, font, x FROM s GROUP BY ALL HAVING count(DISTINCT page_num) >= 3) SELECT s.doc, page_num, block_no, line_no, text FROM s LEFT JOIN r USING (doc, sig_text, font, x) WHERE NOT (r.doc IS NOT NULL AND (y1 < 64 OR y0 > 736))".replace("LEFT JOIN r USING (doc, sig_text, font, x) WHERE NOT (r.doc IS NOT NULL", "LEFT JOIN (SELECT *, true AS rep FROM r) r USING (doc, sig_text, font, x) WHERE NOT (coalesce(rep, false)"))
def headers_dropped(spark, d):
    return layout.drop_headers_footers(spans_view(spark, d), pages_view(spark, d)).select("doc", "page_num", "block_no", "line_no", "text")


@query("SELECT doc_id, regexp_matches(text, '\\.\\.\\.|___|···|—|–|\\.{5,}') AND regexp_matches(text, '\\d\\s*$') AND (regexp_matches(text, '\\p{L}') OR regexp_matches(text, '\\d+\\.\\d+')) AS toc FROM documents WHERE text IS NOT NULL")
def toc_lines(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", layout.toc_line(F.col("text")).alias("toc"))


_TOC = f"""WITH {SPANS}, s AS (SELECT doc, page_num, x0, x1, y0, CASE WHEN block_no % 4 = 0 THEN text || ' ........ ' || line_no WHEN block_no % 4 = 1 AND line_no % 2 = 0 THEN (block_no + line_no)::VARCHAR ELSE text END AS text FROM spans WHERE page_num <= {layout.TOC_PAGES}),
ln AS (SELECT doc, page_num, round(y0 / 3)::BIGINT AS line, string_agg(text, ' ' ORDER BY x0, text) AS text, min(y0) AS y, max(x1) AS edge FROM s GROUP BY ALL), lg AS (SELECT * FROM ln WHERE length(trim(text)) > 3),
hit AS (SELECT *, (regexp_matches(text, '{layout.LEADER}') AND regexp_matches(text, '\\d\\s*$') AND (regexp_matches(text, '\\p{{L}}') OR regexp_matches(text, '\\d+\\.\\d+'))) OR (regexp_full_match(trim(text), '\\d+') AND edge > 0.65 * 595 AND y BETWEEN 40 AND 760 AND EXISTS (SELECT 1 FROM lg WHERE lg.doc = ln.doc AND lg.page_num = ln.page_num AND abs(lg.y - ln.y) < 3 AND lg.line <> ln.line AND abs(lg.line - ln.line) <= 1)) AS h FROM ln)
SELECT doc, page_num, round(avg(h::INT), 6) AS share FROM hit GROUP BY ALL HAVING avg(h::INT) >= {layout.TOC_SHARE}"""


@query(_TOC)
def toc_pages(spark, d):
    """A quarter of the blocks is given leaders and a figure, half the lines of another quarter are bare numbers."""
    s, n = spans_view(spark, d), F.col("block_no") % 4
    text = F.when(n == 0, F.concat("text", F.lit(" ........ "), F.col("line_no").cast("string"))).when((n == 1) & (F.col("line_no") % 2 == 0), (F.col("block_no") + F.col("line_no")).cast("string")).otherwise(F.col("text"))
    return layout.toc_pages(s.withColumn("text", text), pages_view(spark, d)).select("doc", "page_num", F.round("share", 6).alias("share"))


@query(f"WITH {SPANS}, x AS (SELECT *, (x0 + x1) / 2 AS xc, coalesce(((x0 + x1) / 2 - lag((x0 + x1) / 2) OVER w >= 20)::INT, 0) AS jump FROM spans WINDOW w AS (PARTITION BY doc, page_num ORDER BY (x0 + x1) / 2, block_no, line_no)) SELECT doc, page_num, block_no, line_no, sum(jump) OVER (PARTITION BY doc, page_num ORDER BY xc, block_no, line_no ROWS UNBOUNDED PRECEDING)::BIGINT AS column_id FROM x")
def column_islands(spark, d):
    return layout.column_ids(spans_view(spark, d)).select("doc", "page_num", "block_no", "line_no", "column_id")


_BODY = """sized AS (SELECT doc, round(font_size, 1) AS f, count(*) AS n FROM spans GROUP BY ALL), body AS (SELECT doc, arg_max(f, struct_pack(n := n, f := -f)) AS body_font FROM sized GROUP BY doc), av AS (SELECT doc, avg(font_size) AS avg_font FROM spans GROUP BY doc),
blk AS (SELECT doc, page_num, block_no, trim(regexp_replace(string_agg(text, ' ' ORDER BY line_no), '\\s+', ' ', 'g')) AS text, count(*) AS lines, bool_and(bold) AS all_bold, max(font_size) AS max_font, arg_min(font_size, line_no) AS first_font, count(*) AS spans, count(DISTINCT round(x0 / 10) * 10) AS columns FROM spans GROUP BY ALL)"""


@query(f"WITH {SPANS}, {_BODY} SELECT doc, page_num, block_no, lines, all_bold, max_font, first_font, spans, columns, body_font, round(avg_font, 6) AS avg_font FROM blk JOIN body USING (doc) JOIN av USING (doc)")
def block_agg(spark, d):
    return layout.blocks_of(spans_view(spark, d)).select("doc", "page_num", "block_no", "lines", "all_bold", "max_font", "first_font", "spans", "columns", "body_font", F.round("avg_font", 6).alias("avg_font"))


_N = WORDS.format("{}")
_ENDS = "(ends_with({0}, ':') OR NOT (ends_with({0}, '.') OR ends_with({0}, ';')))"
_KINDS = f"""WITH {SPANS}, {_BODY.replace("'\\s+'", f"'{_SPACE}'").replace("arg_min(font_size, line_no) AS first_font", "arg_min(font_size, line_no) AS first_font, arg_min(x0, line_no) AS x0, arg_min(x1, line_no) AS x1")},
a AS (SELECT *, trim(regexp_replace(text, '{layout.NUMBER_PREFIX}', '')) AS rest, regexp_matches(text, '{layout.NUMBER_PREFIX}') AS numbered, regexp_extract(text, '{layout.NUMBER_PREFIX}', 1) AS num, lines <= 2 AS few FROM blk JOIN body USING (doc) JOIN av USING (doc)),
e AS (SELECT *, numbered AND few AND len({_N.format('rest')}) <= {layout.HEADING_WORDS} AND {_ENDS.format('rest')} AND (all_bold OR regexp_matches(rest, '{layout.HEADING}')) AS early, (regexp_matches(text, '{layout.HEADING}') OR all_bold OR max_font > 1.05 * body_font) AND len({_N.format('text')}) <= {layout.HEADING_WORDS} AND few AND {_ENDS.format('text')} AS general FROM a),
t AS (SELECT doc, page_num, block_no, text, max_font, first_font, avg_font, x0, x1, num, NOT early AND regexp_matches(text, '{layout.PROCESS_STEP}') AS is_process_step, CASE WHEN spans > 5 AND columns >= 2 THEN 'table' WHEN early OR general THEN 'heading' WHEN regexp_matches(text, '{layout.LIST_ITEM}') THEN 'list_item' ELSE 'paragraph' END AS kind FROM e),
im AS (SELECT doc, page_num, block_no FROM (SELECT document_name AS doc, coalesce(pages[1], 1) AS page_num, chunk_id AS block_no, unnest(image_paths) AS image_path FROM (SELECT *, row_number() OVER (PARTITION BY document_name, chunk_id ORDER BY chunk_row) AS rn FROM structural_chunks WHERE document_name IS NOT NULL) WHERE rn = 1) WHERE image_path IS NOT NULL),
u AS (SELECT * FROM t UNION ALL SELECT doc, page_num, block_no, '', NULL, NULL, NULL, 150, 450, '', false, 'image' FROM im), w AS (SELECT *, CASE WHEN regexp_matches(text, '{layout.CAPTION}') AND first_font < avg_font THEN 'caption' ELSE kind END AS worded FROM u),
c AS (SELECT *, CASE WHEN worded = 'paragraph' AND first_font < 0.9 * avg_font AND (coalesce(lag(worded) OVER o IN ('table', 'image'), false) OR coalesce(lead(kind) OVER o IN ('table', 'image'), false)) THEN 'caption' ELSE worded END AS kind2 FROM w WINDOW o AS (PARTITION BY doc ORDER BY page_num, block_no, kind = 'image')),
p1 AS (SELECT DISTINCT doc, 595 AS width FROM (SELECT doc, page_num FROM spans UNION SELECT doc, page_num FROM im) WHERE page_num = 1), s AS (SELECT c.*, CASE WHEN kind2 NOT IN ('heading', 'image') AND coalesce(x1 - x0 < 0.4 * width AND (x0 < 50 OR x1 > width - 50), false) THEN 'sidebar' ELSE kind2 END AS kind3 FROM c LEFT JOIN p1 USING (doc)),
hr AS (SELECT doc, max_font, dense_rank() OVER (PARTITION BY doc ORDER BY max_font DESC) AS fr FROM (SELECT DISTINCT doc, max_font FROM s WHERE kind3 = 'heading'))
SELECT s.doc, page_num, block_no, kind3 AS kind, is_process_step, CASE WHEN kind3 = 'heading' THEN CASE WHEN num <> '' THEN length(num) - length(replace(num, '.', '')) + 1 ELSE coalesce(fr, 1) END END AS heading_level FROM s LEFT JOIN hr ON s.doc = hr.doc AND s.max_font = hr.max_font"""


@query(_KINDS)
def block_kinds(spark, d):
    b = layout.mark_sidebars(layout.mark_captions(layout.mark_tables(layout.blocks_of(illustrated_view(spark, d)))), illustrated_pages_view(spark, d))
    return layout.heading_levels(b).select("doc", "page_num", "block_no", "kind", "is_process_step", "heading_level")


@query("""WITH h AS (SELECT chunk_row, document_name, coalesce(token_count, 0) % 9 AS max_font, text FROM structural_chunks WHERE text IS NOT NULL AND document_name IS NOT NULL AND len(heading_path) = 1), r AS (SELECT *, dense_rank() OVER (PARTITION BY document_name ORDER BY max_font DESC) AS fr, regexp_extract(text, '^\\s*(\\d+(?:\\.\\d+)*)(?:[.)])?\\s+', 1) AS num FROM h)
SELECT chunk_row, CASE WHEN num <> '' THEN length(num) - length(replace(num, '.', '')) + 1 ELSE fr END AS heading_level FROM r""")
def heading_levels(spark, d):
    b = table(spark, d, "structural_chunks").where("text is not null and document_name is not null and size(heading_path) = 1").select("chunk_row", F.col("document_name").alias("doc"), (F.coalesce("token_count", F.lit(0)) % 9).alias("max_font"), "text", F.lit("heading").alias("kind"))
    return layout.heading_levels(b).select("chunk_row", "heading_level")


@query()
def parsed_documents(spark, d):
    return layout.parse_documents(illustrated_view(spark, d), illustrated_pages_view(spark, d))


_XML = "replace(replace(translate(regexp_replace(replace(text, '&', '&amp;'), '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x{00AD}\\x{200B}-\\x{200D}]', '', 'g'), chr(160) || chr(8232) || chr(8233) || '„“”’‘–—', ' ' || chr(10) || chr(10) || '\"\"\"''''--'), '<', '&lt;'), '>', '&gt;')"


@query(f"SELECT doc_id, {_XML} AS safe FROM documents")
def sanitize_xml(spark, d):
    return table(spark, d, "documents").select("doc_id", T.xml_safe(F.col("text")).alias("safe"))


@query("SELECT pair_id, CASE WHEN pair_id % 2 = 0 THEN pair_id::VARCHAR END AS n, CASE WHEN pair_id % 2 = 0 THEN 'true' END AS ok, CASE WHEN pair_id % 2 = 0 THEN coalesce(info_type, '') END AS kind, pair_id % 2 = 0 AS has_object FROM qa_pairs")
def json_repair(spark, d):
    damaged = F.concat(F.lit("Answer: {\"n\": "), F.col("pair_id").cast("string"), F.lit(", \"ok\": True, \"x\": None, \"kind\": \""), F.coalesce("info_type", F.lit("")), F.lit("\",} // done\n"))
    broken = F.when(F.col("pair_id") % 2 == 0, damaged).otherwise(F.lit("no object here"))
    got = T.repaired_json(broken)
    keys = [F.get_json_object(got, f"$.{k}").alias(k) for k in ("n", "ok", "kind")]
    return table(spark, d, "qa_pairs").select("pair_id", *keys, F.coalesce(F.get_json_object(got, "$.n") == F.col("pair_id").cast("string"), F.lit(False)).alias("has_object"))


@query("SELECT pair_id, regexp_replace(replace(coalesce(question, ''), '::', '__'), '[ /\\\\><]', '_', 'g') AS safe FROM qa_pairs")
def safe_ids(spark, d):
    return table(spark, d, "qa_pairs").select("pair_id", T.safe_id(F.coalesce("question", F.lit(""))).alias("safe"))


@query("SELECT safe, count(*) AS names FROM (SELECT DISTINCT name, regexp_replace(replace(name, '::', '__'), '[ /\\\\><]', '_', 'g') AS safe FROM (SELECT source AS name FROM documents WHERE source IS NOT NULL UNION ALL SELECT replace(source, '_', ' ') FROM documents WHERE source IS NOT NULL)) GROUP BY safe HAVING count(*) > 1")
def name_collisions(spark, d):
    s = table(spark, d, "documents").where("source is not null").select(F.col("source").alias("name"))
    return documents.name_collisions(s.unionAll(s.select(F.replace("name", F.lit("_"), F.lit(" ")).alias("name"))))


@query("SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '^\\s*\\d+\\s*;\\s*', ''))), lambda x: x <> ''), chr(10)) AS merged FROM documents")
def merged_lines(spark, d):
    return table(spark, d, "documents").select("doc_id", T.merged_lines(F.col("text")).alias("merged"))


@query("SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS normal, len(list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda x: x <> '')) AS tokens FROM documents")
def normalized_text(spark, d):
    return table(spark, d, "documents").select("doc_id", T.normalize_space(F.col("text")).alias("normal"), T.token_count(F.col("text")).alias("tokens"))


# ---- extraction, outlines, exports, ingest ---------------------------------------------------


@query("SELECT pair_id FROM qa_pairs WHERE pair_id NOT IN (SELECT pair_id FROM qa_pairs WHERE pair_id % 3 = 0)")
def resume_pending(spark, d):
    qa = table(spark, d, "qa_pairs").select("pair_id")
    done = qa.select("pair_id", F.when(F.col("pair_id") % 3 == 0, F.lit('{"a": 1}')).otherwise(F.lit("{broken")).alias("payload"))
    return models.pending(qa, done, "pair_id")


@query(f"WITH {CHUNKS}, {LEAF} SELECT cluster_id, chunk_id, chunk_type, document_name, array_to_string(pages, chr(10)) AS pages, array_to_string(heading_path, chr(10)) AS heading_path, array_to_string(image_paths, chr(10)) AS image_paths, token_count, chunk_text_class FROM leaf JOIN chunks USING (chunk_id)")
def chunks_csv(spark, d):
    return documents.chunk_rows(leaf_view(spark, d), chunks_view(spark, d))


_LINES = "SELECT cluster_id, string_agg(printf('%s (%.1f%%)', name, CASE WHEN total > 0 THEN tokens / total * 100 ELSE 0.0 END), chr(10) ORDER BY name) AS shares FROM ({}) GROUP BY cluster_id"
_FLAGS = ORACLES["node_flags"].split("SELECT cluster_id, is_leaf, lk > 0", 1)


@query(f"""{_FLAGS[0].replace(f"WITH {NODES}", f"WITH {CHUNKS}, {LEAF}, {_UP}")}, fl AS (SELECT cluster_id, is_leaf, lk > 0{_FLAGS[1]}), roll AS (SELECT cluster_id, count(*) AS size, sum(coalesce(token_count, 0))::BIGINT AS token_count FROM up LEFT JOIN chunks USING (chunk_id) GROUP BY cluster_id),
kid AS (SELECT {PARENT} AS cluster_id, count(*) AS children FROM nodes WHERE contains(cluster_id, '.') GROUP BY 1), sd AS ({_LINES.format(_share_sql('document_name'))}), tc AS ({_LINES.format(_share_sql('chunk_text_class'))}) SELECT padded AS cluster_id, coalesce(size, 0) AS size, coalesce(children, 0) AS children, summary, label, coalesce(token_count, 0) AS token_count, document_cluster, fl.is_leaf, all_child_leaf, all_child_internal, has_leaf_sibling, has_internal_sibling,
CASE WHEN contains(padded, '.') THEN regexp_replace(padded, '\\.[^.]*$', '') END AS parent, level, sd.shares AS source_documents, tc.shares AS text_class FROM fl JOIN nodes USING (cluster_id) LEFT JOIN roll USING (cluster_id) LEFT JOIN kid USING (cluster_id) LEFT JOIN sd USING (cluster_id) LEFT JOIN tc USING (cluster_id)""")
def clusters_csv(spark, d):
    return documents.cluster_rows(nodes_view(spark, d), leaf_view(spark, d), chunks_view(spark, d))


_SHARE4 = "SELECT cluster_id, string_agg(printf('%s=%.4f', name, share), '|' ORDER BY name) AS s FROM ({}) GROUP BY cluster_id"


@query(f"""{_FLAGS[0].replace(f"WITH {NODES}", f"WITH {CHUNKS}, {LEAF}, {_UP}")}, fl AS (SELECT cluster_id, is_leaf, lk > 0{_FLAGS[1]}), sd AS ({_SHARE4.format(_share_sql('document_name'))}), tc AS ({_SHARE4.format(_share_sql('chunk_text_class'))})
SELECT cluster_id, label, summary, array_to_string(keywords, '|') AS keywords, document_cluster AS is_document_cluster, sd.s AS source_documents, tc.s AS text_class FROM nodes JOIN fl USING (cluster_id) LEFT JOIN sd USING (cluster_id) LEFT JOIN tc USING (cluster_id)""")
def category_records(spark, d):
    c = documents.category_records(nodes_view(spark, d), leaf_view(spark, d), chunks_view(spark, d))
    listed = lambda col, name: F.array_join(F.transform(col, lambda x: F.format_string("%s=%.4f", x[name], x["tokens_percentage"])), "|").alias(col)
    return c.select("cluster_id", "label", "summary", F.array_join("keywords", "|").alias("keywords"), "is_document_cluster", listed("source_documents", "document_name"), listed("text_class", "class"))


@query()
def extraction_mock(spark, d):
    leaf = leaf_view(spark, d)
    texts = leaf.join(chunks_view(spark, d).select("chunk_id", "text"), "chunk_id").groupBy("cluster_id").agg(F.array_join(F.array_sort(F.collect_list("text")), "\n\n").alias("text"))
    n = nodes_view(spark, d).select("cluster_id")
    done = n.where("cluster_id like '%1'").select("cluster_id", F.lit("concept").alias("info_type"), F.lit("{}").alias("payload"))
    todo = models.extraction_inputs(n, texts, done, "concept")
    return models.complete(todo.withColumn("prompt", F.concat(F.lit("Describe the concept of the text as JSON.\n\n"), F.col("input")))).select("cluster_id", "info_type", "payload", "status")


@query()
def answered_questions(spark, d):
    chunks = chunks_view(spark, d).where("text is not null").select("chunk_id", "text", "token_count", embed.embed(F.col("text")).alias("embedding"))
    labels = F.concat_ws(" ", "label", "summary")
    groups = nodes_view(spark, d).join(chunks_of_nodes(spark, d), "cluster_id").select(F.col("cluster_id").alias("id"), F.concat_ws(" ", labels, F.array_join("keywords", " ")).alias("text"), embed.embed(labels).alias("embedding"), "chunks")
    return serving.answer(_all_questions(spark, d).withColumnRenamed("query_id", "request_id"), groups, chunks).select("request_id", "language", "status", F.length("context").alias("context_length"))


@query(f"WITH {NODES}, q AS (SELECT cluster_id, coalesce(info_type, '') AS kind, string_agg(coalesce(item_no::VARCHAR, '') || ':' || question || ' => ' || coalesce(answer, ''), chr(10) ORDER BY item_no NULLS FIRST, question, answer NULLS FIRST) AS body FROM qa_pairs WHERE question IS NOT NULL GROUP BY ALL), k AS (SELECT cluster_id, count(*) AS kinds, md5(string_agg('[' || kind || ']' || chr(10) || regexp_replace(body, '(^|\\n)\\d*:', '\\1', 'g'), chr(10) ORDER BY kind)) AS body_md5 FROM q GROUP BY cluster_id) SELECT cluster_id, label, summary, array_to_string(keywords, '|') AS keywords, coalesce(kinds, 0) AS kinds, body_md5 FROM nodes LEFT JOIN k USING (cluster_id)")
def outlines(spark, d):
    o = documents.outline(nodes_view(spark, d).select("cluster_id", "label", "summary", "keywords"), table(spark, d, "qa_pairs"))
    body = F.array_join(F.transform("qa", lambda x: F.concat(F.lit("["), F.coalesce(x["info_type"], F.lit("")), F.lit("]\n"), F.array_join(F.transform(x["elements"], lambda e: F.regexp_replace(F.concat(e["question"], F.lit(" => "), F.coalesce(e["answer"], F.lit(""))), r"(^|\n)\d*:", "$1")), "\n"))), "\n")
    return o.select("cluster_id", F.col("header.label").alias("label"), F.col("header.summary").alias("summary"), F.array_join("header.keywords", "|").alias("keywords"), F.coalesce(F.size("qa"), F.lit(0)).cast("long").alias("kinds"), F.md5(body).alias("body_md5"))


@query("SELECT doc, idx, page, CASE WHEN starts_with(lower(style), 'heading') THEN 'heading' ELSE 'body' END AS text_type FROM (SELECT document_name AS doc, chunk_row AS idx, text, chunk_type, coalesce(chunk_type, '') AS style, 1 + sum((coalesce(chunk_type, '') = 'table')::INT) OVER (PARTITION BY document_name ORDER BY chunk_row ROWS UNBOUNDED PRECEDING)::BIGINT AS page FROM structural_chunks WHERE document_name IS NOT NULL) WHERE coalesce(chunk_type, '') <> 'list_item' AND regexp_matches(text, '\\p{L}')")
def rewritable_paragraphs(spark, d):
    p = table(spark, d, "structural_chunks").where("document_name is not null").select(F.col("document_name").alias("doc"), F.col("chunk_row").alias("idx"), "text", F.coalesce("chunk_type", F.lit("")).alias("style"))
    p = p.withColumn("has_break", F.col("style") == "table").withColumn("in_toc", F.col("style") == "list_item")
    return documents.rewritable_paragraphs(p).select("doc", "idx", "page", "text_type")


@query()
def label_tree_mock(spark, d):
    leaf = leaf_view(spark, d)
    texts = leaf.join(chunks_view(spark, d).select("chunk_id", "text"), "chunk_id").groupBy("cluster_id").agg(F.array_join(F.array_sort(F.collect_list("text")), "\n\n").alias("text"))
    return models.label_tree(nodes_view(spark, d).select("cluster_id"), texts).select("cluster_id", "source_language", "label", "status")


@query()
def ontology_mock(spark, d):
    base = nodes_view(spark, d).select("cluster_id", F.col("keywords").alias("entities"))
    tasks = models.ontology_tasks(base, "entities")
    return models.ontology_step(tasks, "Describe the entity as one JSON object.", models.entity_stub(F.col("cluster_id"), F.col("idx"), F.col("item")))


@query()
def embedded_chunks(spark, d):
    return chunks_view(spark, d).select("chunk_id", embed.embed(F.col("text")).alias("embedding"))


@query("SELECT day, count(chunk_row) AS rows, sum((loaded_at > exported_at + INTERVAL 7 DAY)::INT)::BIGINT AS late FROM (SELECT *, exported_at::DATE AS day FROM structural_chunks) GROUP BY day".replace("sum((loaded_at > exported_at + INTERVAL 7 DAY)::INT)", "sum(coalesce(loaded_at > exported_at + INTERVAL 7 DAY, false)::INT)"))
def late_rows(spark, d):
    return ingest.late_rows(table(spark, d, "structural_chunks"), "chunk_row", "exported_at", "loaded_at")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def windowed_counts(spark, d):
    return ingest.windowed_counts(table(spark, d, "events"))
