"""The pN_ queries: each applies its problem's operator to its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def _fields(spark: SparkSession, d: str, cluster_field: str, *more: str) -> list[tuple[str, DataFrame]]:
    """The chunk texts and the cluster field of the problems that look at both: (rec, rows of row_no, text, more)."""
    chunks = table(spark, d, "structural_chunks").select(F.col("chunk_row").alias("row_no"), "text", *more)
    clusters = table(spark, d, "cluster_records").select(F.col("record_no").alias("row_no"), F.col(cluster_field).alias("text"), *more)
    return [("chunk", chunks), ("cluster", clusters)]


@query
def p2_found(spark, d):
    from quire.llm.canonical import equal_looking_pairs

    found = [equal_looking_pairs(df, "row_no", "text").select(F.lit(rec).alias("rec"), "row_a", "row_b") for rec, df in _fields(spark, d, "summary")]
    return found[0].unionAll(found[1])


@query
def p2_canonical(spark, d):
    from quire.llm.canonical import canonicalize

    done = [canonicalize(df, "text").select(F.lit(rec).alias("rec"), "row_no", "canonical") for rec, df in _fields(spark, d, "summary")]
    return done[0].unionAll(done[1])


def _language_model(spark, d):
    """Trained on lang_samples and a bounded sample of declared rows of both tables."""
    from quire.llm.language import train

    (_, chunks), (_, clusters) = _fields(spark, d, "label", "source_language")
    return train(table(spark, d, "lang_samples"), [(chunks, False), (clusters, True)])


@query
def p1_found(spark, d):
    from quire.llm.language import wrong_labels

    model = _language_model(spark, d)
    found = [wrong_labels(df, "row_no", "text", "source_language", model, rec == "cluster").select(F.lit(rec).alias("rec"), F.col("key").alias("row_no"), "lang") for rec, df in _fields(spark, d, "label", "source_language")]
    return found[0].unionAll(found[1])


@query
def p1_segments(spark, d):
    from quire.llm.language import identify

    model = _language_model(spark, d)
    done = [identify(df, "row_no", "text", model, rec == "cluster").select(F.lit(rec).alias("rec"), F.col("key").alias("row_no"), F.posexplode("segments").alias("seg_no", "s")).select("rec", "row_no", "seg_no", "s.*") for rec, df in _fields(spark, d, "label")]
    return done[0].unionAll(done[1])


def _limits(spark, d, *purposes):
    return table(spark, d, "size_limits").where(F.col("purpose").isin(*purposes)).select("purpose", "limit_tokens", "overlap_tokens")


def _pieces(spark, d):
    from quire.llm.split import split_oversized

    limit = _limits(spark, d, "split_chunk").first()
    chunks = table(spark, d, "structural_chunks").select("chunk_row", "heading_path", "text")
    return split_oversized(chunks, "chunk_row", "text", limit["limit_tokens"], limit["overlap_tokens"])


@query
def p5_found(spark, d):
    # The first further piece of a chunk shows that it was over the limit.
    return _pieces(spark, d).where("piece_no = 1").select("chunk_row")


@query
def p5_pieces(spark, d):
    return _pieces(spark, d)


ORACLES["p5_found"] = "SELECT chunk_row FROM structural_chunks WHERE len(list_filter(regexp_split_to_array(text, '[ \\t\\n]+'), lambda x: x <> '')) > (SELECT limit_tokens FROM size_limits WHERE purpose = 'split_chunk')"


@query
def p7_containers(spark, d):
    from quire.llm.pack import pack, sized

    docs = sized(table(spark, d, "documents"), "doc_id", "text")
    return pack(docs, "doc_id", "n_tokens", _limits(spark, d, "pack_small", "pack_large"))


@query
def p7_fill(spark, d):
    from quire.llm.pack import fill_report

    return fill_report(p7_containers(spark, d), _limits(spark, d, "pack_small", "pack_large"))


def _mixture(spark, d):
    from quire.llm.mix import mix
    from quire.llm.pack import sized

    return mix(sized(table(spark, d, "documents"), "doc_id", "text", "source"), table(spark, d, "mix_targets"))


@query
def p8_mixture(spark, d):
    drawn, report = _mixture(spark, d)
    return drawn.join(F.broadcast(report.select("source", "target_share", "actual_share")), "source")  # one row per target


@query
def p8_shares(spark, d):
    return _mixture(spark, d)[1]


@query
def p3_found(spark, d):
    from quire.llm.neardup import similar_pairs

    # The words and the threshold are those of the statement of problem 3.
    return similar_pairs(table(spark, d, "vector_records").select("record_no", "text"), "record_no", "text", words=3, threshold=0.6)


@query
def p3_groups(spark, d):
    from quire.llm.neardup import similar_groups

    return similar_groups(table(spark, d, "vector_records").select("record_no", "text"), "record_no", "text", words=3, threshold=0.6)


def _vectors(spark, d):
    return table(spark, d, "cluster_records").select("record_no", "embedding")


@query
def p6_found(spark, d):
    from quire.llm.neighbors import similar_vector_pairs

    return similar_vector_pairs(_vectors(spark, d), "record_no", "embedding")


@query
def p6_neighbours(spark, d):
    from quire.llm.neighbors import nearest

    return nearest(_vectors(spark, d), "record_no", "embedding").select(F.col("row").alias("record_no"), F.col("other").alias("other_no"), "rank", "cosine")


@query
def p6_recall(spark, d):
    """Share of the true k nearest (brute force) that the forest finds, for every record whose number is divisible by 20."""
    from quire.llm.neighbors import recall

    return recall(_vectors(spark, d), "record_no", "embedding")


@query
def p6_effort(spark, d):
    """How many vectors the forest compares each vector with, and their share of brute force."""
    from quire.llm.neighbors import effort

    return effort(_vectors(spark, d), "record_no", "embedding")


def _abuse(spark, d):
    from quire.llm.abuse import known_words, score_documents, train
    from quire.llm.mix import source_name

    docs = table(spark, d, "documents").select("doc_id", source_name(F.col("source")).alias("source"), "text")
    model = train(docs, table(spark, d, "review_labels"), "doc_id", "text", known_words(table(spark, d, "lang_samples")))
    return score_documents(docs, "doc_id", "text", "source", model=model)


@query
def p9_found(spark, d):
    from quire.llm.abuse import flagged

    return flagged(_abuse(spark, d), "doc_id")


@query
def p9_scores(spark, d):
    return _abuse(spark, d)


@query
def p9_rates(spark, d):
    from quire.llm.abuse import rates

    return rates(_abuse(spark, d), "source")


@query
def p4_found(spark, d):
    from quire.llm.qa import find_defects, question_languages, train

    pairs = table(spark, d, "qa_pairs").select("pair_id", "question", "answer")
    model = question_languages(pairs, _language_model(spark, d))
    return find_defects(pairs, "pair_id", model, train(pairs, model))
