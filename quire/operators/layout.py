"""Page layout: spans to logical blocks.

Frames: spans (doc, page_num, block_no, line_no, span_no, text, font_size, bold, x0,
y0, x1, y1, is_image, image_path) and pages (doc, page_num, width, height).  Rules that
look at one row or at neighbours are columns and windows; the two rules that carry
state along a document run per document as grouped pandas functions.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.cut import cut
from quire.functions.text import normalize_space, token_count, words

# Patterns and limits of the layout rules.
HEADING = r"^(?:[0-9]+(\.[0-9]+)*)?\s*[A-Z][A-Z0-9\s\-\.,]{3,}$"
LIST_ITEM = r"^(\s*[-*•]\s+|\s*[0-9]+\.\s+)"
PROCESS_STEP = r"^\s*(Step\s*[0-9]+:|[0-9]+\.)\s+"
CAPTION = r"^(Figure|Fig\.|Table)\s*\d+[:.\-]"
NUMBER_PREFIX = r"^\s*(\d+(?:\.\d+)*)(?:[.)])?\s+"
LEADER = r"\.\.\.|___|···|—|–|\.{5,}"
HEADING_WORDS, REPEATS, MARGIN, TOC_PAGES, TOC_SHARE = 50, 3, 0.08, 7, 0.20
MAX_TOKENS, BREAK_LEVEL = 1500, 4
RUNS = 64  # so many sections are folded in one Python group


def is_bold(font: Column) -> Column:
    return F.contains(font, F.lit("Bold")) | F.contains(font, F.lit("bold"))


def signature(text: Column, font_size: Column, x0: Column) -> Column:
    """What a repeated header or footer has in common; any figure counts as the page number."""
    t = F.trim(text)
    return F.struct(F.when(t.rlike(r"^\d+$"), "PAGE_NUMBER").otherwise(t).alias("text"), F.round(font_size, 1).alias("font"), F.round(x0, 1).alias("x"))


def repeated_lines(spans: DataFrame, least: int = REPEATS) -> DataFrame:
    """(doc, sig, pages): signatures of text spans on at least ``least`` different pages."""
    return spans.where(~F.col("is_image")).groupBy("doc", signature(F.col("text"), F.col("font_size"), F.col("x0")).alias("sig")).agg(F.count_distinct("page_num").alias("pages")).where(F.col("pages") >= least)


def drop_headers_footers(spans: DataFrame, pages: DataFrame) -> DataFrame:
    """Spans without those that repeat and lie in the top or bottom margin; images stay."""
    s = spans.withColumn("sig", F.when(~F.col("is_image"), signature(F.col("text"), F.col("font_size"), F.col("x0"))))
    marked = s.join(repeated_lines(spans).select("doc", "sig", F.lit(True).alias("rep")), ["doc", "sig"], "left").join(pages.select("doc", "page_num", "height"), ["doc", "page_num"], "left")
    edge = (F.col("y1") < MARGIN * F.col("height")) | (F.col("y0") > (1 - MARGIN) * F.col("height"))
    return marked.where(~(F.coalesce("rep", F.lit(False)) & F.coalesce(edge, F.lit(False)))).select(*spans.columns)


def toc_line(text: Column) -> Column:
    """A line of a table of contents: a leader, a figure at the end, and a letter or a number of several levels."""
    return text.rlike(LEADER) & text.rlike(r"\d\s*$") & (text.rlike(r"(?U)\p{L}") | text.rlike(r"\d+\.\d+"))


def toc_pages(spans: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc, page_num, share) of table-of-contents pages among the first pages."""
    early = spans.where(~F.col("is_image") & (F.col("page_num") <= TOC_PAGES))
    key = F.round(F.col("y0") / 3).cast("long")
    lines = early.groupBy("doc", "page_num", key.alias("line")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "text"))), lambda x: x["text"]), " ").alias("text"), F.min("y0").alias("y"), F.max("x1").alias("right"))
    lines = lines.join(pages, ["doc", "page_num"], "left")
    # Lines within three points of a bare number: equal or neighbouring line keys, so this is an equi-join on the key.
    long_ = lines.where(F.length(F.trim("text")) > 3).select("doc", "page_num", F.col("line").alias("l2"), F.col("y").alias("y2"), F.explode(F.array(F.col("line") - 1, F.col("line"), F.col("line") + 1)).alias("line"))
    number = lines.where(F.trim("text").rlike(r"^\d+$") & (F.col("right") > 0.65 * F.col("width")) & (F.col("y").between(0.05 * F.col("height"), 0.95 * F.col("height"))))
    near = number.join(long_, ["doc", "page_num", "line"]).where((F.abs(F.col("y") - F.col("y2")) < 3) & (F.col("line") != F.col("l2"))).select("doc", "page_num", "line").distinct().withColumn("b", F.lit(True))
    hit = (toc_line(F.col("text")) | F.coalesce("b", F.lit(False))).cast("int")
    return lines.join(near, ["doc", "page_num", "line"], "left").groupBy("doc", "page_num").agg(F.avg(hit).alias("share")).where(F.col("share") >= TOC_SHARE)


def column_ids(spans: DataFrame, tolerance: float = 20.0) -> DataFrame:
    """Spans with column_id: a new column starts where the x-centre jumps by ``tolerance`` on a page."""
    xc = (F.col("x0") + F.col("x1")) / 2
    w = Window.partitionBy("doc", "page_num").orderBy("xc", "block_no", "line_no", "span_no")
    jump = (F.col("xc") - F.lag("xc").over(w) >= tolerance).cast("int")
    return spans.withColumn("xc", xc).withColumn("jump", F.coalesce(jump, F.lit(0))).withColumn("column_id", F.sum("jump").over(w)).drop("jump")


def lines_of(spans: DataFrame) -> DataFrame:
    """Lines of text spans: joined text, mean font, all bold, bounding box."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("span_no", "text"))), lambda x: x["text"])
    return spans.where(~F.col("is_image")).groupBy("doc", "page_num", "block_no", "line_no").agg(F.array_join(ordered, " ").alias("text"), F.avg("font_size").alias("font_size"), F.min("bold").alias("bold"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count("*").alias("spans"))


def fonts(spans: DataFrame) -> DataFrame:
    """(doc, body_font, avg_font): the most frequent size, ties to the smaller, and the mean over all spans."""
    sized = spans.where(~F.col("is_image")).groupBy("doc", F.round("font_size", 1).alias("f")).agg(F.count("*").alias("n"))
    body = sized.groupBy("doc").agg(F.max_by("f", F.struct("n", -F.col("f"))).alias("body_font"))
    return body.join(spans.groupBy("doc").agg(F.avg("font_size").alias("avg_font")), "doc")


def classify(blocks: DataFrame) -> DataFrame:
    """Adds kind and is_process_step to blocks (text, lines, all_bold, max_font, body_font)."""
    t = F.col("text")
    after = F.trim(F.regexp_replace(t, NUMBER_PREFIX, ""))
    numbered = t.rlike(NUMBER_PREFIX)
    ends = lambda c: c.endswith(":") | ~(c.endswith(".") | c.endswith(";"))
    short = F.size(words(t)) <= HEADING_WORDS
    few = F.col("lines") <= 2
    early = numbered & few & (F.size(words(after)) <= HEADING_WORDS) & ends(after) & (F.col("all_bold") | after.rlike(HEADING))
    general = (t.rlike(HEADING) | F.col("all_bold") | (F.col("max_font") > 1.05 * F.col("body_font"))) & short & few & ends(t)
    kind = F.when(early | general, "heading").when(t.rlike(LIST_ITEM), "list_item").otherwise("paragraph")
    return blocks.withColumn("kind", kind).withColumn("is_process_step", ~early & t.rlike(PROCESS_STEP))


def blocks_of(spans: DataFrame) -> DataFrame:
    """Classified text blocks of spans, one row per (doc, page_num, block_no), and a block of the kind image per image span."""
    lines = lines_of(spans)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"])
    columns = F.size(F.array_distinct(F.collect_list(F.round(F.col("x0") / 10) * 10)))
    b = lines.groupBy("doc", "page_num", "block_no").agg(normalize_space(F.array_join(ordered, " ")).alias("text"), F.count("*").alias("lines"), F.min("bold").alias("all_bold"), F.max("font_size").alias("max_font"), F.min_by("font_size", "line_no").alias("first_font"), F.min_by("x0", "line_no").alias("x0"), F.min_by("x1", "line_no").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"), F.sum("spans").alias("spans"), columns.alias("columns"))
    return classify(b.join(fonts(spans), "doc")).withColumn("image_paths", _no_paths()).unionByName(image_blocks(spans), allowMissingColumns=True)


def _no_paths() -> Column:
    return F.array().cast("array<string>")


def image_blocks(spans: DataFrame) -> DataFrame:
    """The image spans as blocks without text, numbered by ``image_no``."""
    path = F.col("image_path") if "image_path" in spans.columns else F.lit(None).cast("string")
    number = F.concat_ws(".", "block_no", "line_no", "span_no").alias("image_no")
    return spans.where("is_image").select("doc", "page_num", "block_no", F.lit("").alias("text"), "x0", "x1", "y0", "y1", F.lit(1).cast("long").alias("spans"), F.lit("image").alias("kind"), F.lit(False).alias("is_process_step"), F.array_compact(F.array(path)).alias("image_paths"), number)


def mark_tables(blocks: DataFrame) -> DataFrame:
    """More than five spans in two or more columns make a block a table."""
    return blocks.withColumn("kind", F.when((F.col("spans") > 5) & (F.col("columns") >= 2), "table").otherwise(F.col("kind")))


def mark_captions(blocks: DataFrame) -> DataFrame:
    """Captions: by wording and a smaller font, or a small paragraph beside a table or an image."""
    order = Window.partitionBy("doc").orderBy("page_num", "block_no", F.col("kind") == "image")
    worded = F.col("text").rlike(CAPTION) & (F.col("first_font") < F.col("avg_font"))
    b = blocks.withColumn("was", F.col("kind")).withColumn("kind", F.when(worded, "caption").otherwise(F.col("kind")))
    beside = F.coalesce(F.lag("kind").over(order).isin("table", "image"), F.lit(False)) | F.coalesce(F.lead("was").over(order).isin("table", "image"), F.lit(False))
    small = (F.col("kind") == "paragraph") & (F.col("first_font") < 0.9 * F.col("avg_font"))
    return b.withColumn("kind", F.when(small & beside, "caption").otherwise(F.col("kind"))).drop("was")


def mark_sidebars(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """Narrow blocks at a page's edge that are no heading or image are sidebars; the width is that of page 1."""
    first = pages.where("page_num = 1").select("doc", "width")
    narrow = (F.col("x1") - F.col("x0") < 0.4 * F.col("width")) & ((F.col("x0") < 50) | (F.col("x1") > F.col("width") - 50))
    return blocks.join(first, "doc", "left").withColumn("kind", F.when(~F.col("kind").isin("heading", "image") & F.coalesce(narrow, F.lit(False)), "sidebar").otherwise(F.col("kind"))).drop("width")


def heading_levels(blocks: DataFrame) -> DataFrame:
    """Adds heading_level: rank of the font size among a document's headings, or the depth of a leading number."""
    heads = blocks.where("kind = 'heading'").select("doc", "max_font").distinct()
    rank = heads.withColumn("font_rank", F.dense_rank().over(Window.partitionBy("doc").orderBy(F.desc("max_font"))))
    number = F.regexp_extract("text", NUMBER_PREFIX, 1)
    level = F.when(F.col("kind") == "heading", F.when(number != "", F.length(F.regexp_replace(number, r"[^.]", "")) + 1).otherwise(F.coalesce("font_rank", F.lit(1))))
    return blocks.join(rank, ["doc", "max_font"], "left").withColumn("heading_level", level).drop("font_rank")


def attach_images(blocks: DataFrame, images: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc, page_num, image_no, block_page, block_no): the text block each image belongs to.

    On its page the nearest block above within a fifth of the height that is no
    heading; for an image in the top tenth the last block of the page before; else the
    first paragraph below.
    """
    i = images.join(pages.select("doc", "page_num", "height"), ["doc", "page_num"])
    b = blocks.where("kind <> 'heading'").select("doc", F.col("page_num").alias("block_page"), "block_no", F.col("y0").alias("b0"), F.col("y1").alias("b1"), "kind")
    same = i.join(b, (i["doc"] == b["doc"]) & (F.col("block_page") == F.col("page_num"))).drop(b["doc"])
    above = same.where((F.col("b1") <= F.col("y0")) & (F.col("y0") - F.col("b1") <= 0.2 * F.col("height"))).withColumn("prio", F.lit(1)).withColumn("dist", F.col("y0") - F.col("b1"))
    below = same.where((F.col("kind") == "paragraph") & (F.col("b0") >= F.col("y1"))).withColumn("prio", F.lit(2)).withColumn("dist", F.col("b0") - F.col("y1"))
    last = b.groupBy("doc", "block_page").agg(F.max("block_no").alias("block_no")).withColumn("next_page", F.col("block_page") + 1)
    top = i.where(F.col("y0") < 0.1 * F.col("height")).join(last, (i["doc"] == last["doc"]) & (F.col("next_page") == F.col("page_num"))).drop(last["doc"]).withColumn("prio", F.lit(0)).withColumn("dist", F.lit(0.0))
    columns = ["doc", "page_num", "image_no", "block_page", "block_no", "prio", "dist"]
    every = above.select(columns).unionByName(below.select(columns)).unionByName(top.select(columns))
    best = Window.partitionBy("doc", "page_num", "image_no").orderBy("prio", "dist", "block_no")
    return every.withColumn("n", F.row_number().over(best)).where("n = 1").select(columns[:5])


def place_images(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """Blocks without the images, whose paths go to the blocks that ``attach_images`` finds for them, in their order."""
    images, text = blocks.where("kind = 'image'"), blocks.where("kind <> 'image'")
    found = attach_images(text, images.select("doc", "page_num", "image_no", "y0", "y1"), pages)
    paths = found.join(images.select("doc", "page_num", "image_no", F.col("block_no").alias("own_no"), "image_paths"), ["doc", "page_num", "image_no"])
    held = paths.groupBy("doc", F.col("block_page").alias("page_num"), "block_no").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("page_num", "own_no", "image_no", "image_paths"))), lambda x: x["image_paths"])).alias("held"))
    return text.join(held, ["doc", "page_num", "block_no"], "left").withColumn("image_paths", F.coalesce("held", _no_paths())).drop("held", "image_no")


def _fold_in(blocks: DataFrame) -> DataFrame:
    return blocks.select(*_FOLD_IN, F.col("image_paths") if "image_paths" in blocks.columns else _no_paths().alias("image_paths"))


_FOLD_IN = ["doc", "page_num", "block_no", "text", "kind", "heading_level", "y0"]


def merge_cross_page(blocks: DataFrame) -> DataFrame:
    """Paragraphs that go on at the top of the next page become one block; a run goes one page on at most.

    Only runs of blocks that may go on, which are short, are folded in Python, each by
    itself; all other blocks pass as they are.
    """

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        out: list[dict] = []
        for r in pdf.sort_values(["page_num", "block_no"]).to_dict("records"):
            p = out[-1] if out else None
            if p and r["page_num"] == p["page_num"] + 1:
                p["text"] = f"{p['text']} {r['text']}"
                p["image_paths"] = [*p["image_paths"], *r["image_paths"]]
            else:
                out.append(r)
        return pd.DataFrame(out, columns=[*_FOLD_IN, "image_paths"])

    src = _fold_in(blocks)
    order = Window.partitionBy("doc").orderBy("page_num", "block_no")
    stop = F.col("text").rlike(HEADING) | F.col("text").rlike(LIST_ITEM) | F.col("text").rlike(CAPTION)
    page = F.lag("page_num").over(order)
    may = (F.col("kind") == "paragraph") & (F.lag("kind").over(order) == "paragraph") & F.col("page_num").isin(page, page + 1) & (F.col("y0") < 100) & ~stop
    marked = src.withColumn("may", F.coalesce(may, F.lit(False)))
    run = marked.withColumn("run", F.sum((~F.col("may")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    run = run.withColumn("alone", ~F.col("may") & ~F.coalesce(F.lead("may").over(order), F.lit(False)))
    return run.where("alone").select(*src.columns).unionByName(run.where("not alone").select("run", *src.columns).groupBy("doc", "run").applyInPandas(one, src.schema))


def structural_chunks(blocks: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Chunks of a document's blocks in order, with heading path, pages, kinds, tokens and images.

    A chunk ends before a heading (a numbered one of level 4 or less, or any other), at
    a new page, where the kind changes (paragraphs and list items go together), and
    before it would exceed ``max_tokens``.  Chunks of headings only are dropped.

    A document is cut before headings of the first level, where nothing of what stands
    above matters any more, and some such sections go to one Python group, so that the
    largest document is no single group.
    """
    prefix = re.compile(NUMBER_PREFIX)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        chunks: list[tuple] = []
        path: list[str] = []
        now: list[dict] = []

        def close():
            nonlocal now
            kinds = sorted({b["kind"] for b in now})
            if any(k != "heading" for k in kinds):
                text = " ".join(" ".join(b["text"] for b in now).split())
                chunks.append((pdf["doc"].iloc[0], pdf["part"].iloc[0], len(chunks) + 1, sorted({int(b["page_num"]) for b in now}), list(path), text, len(text.split()), kinds[0] if len(kinds) == 1 else "mixed", " + ".join(kinds), [p for b in now for p in b["image_paths"]]))
            now = []

        for b in pdf.sort_values(["page_num", "block_no"]).to_dict("records"):
            if b["kind"] == "heading":
                level = int(b["heading_level"]) if b["heading_level"] == b["heading_level"] and b["heading_level"] else 1
                breaks = not prefix.match(b["text"]) or level <= BREAK_LEVEL
                if breaks:
                    close()
                path = path[: level - 1] + [b["text"]]
                now.append(b)
                continue
            textual = {"paragraph", "list_item"}
            if now and b["page_num"] != now[-1]["page_num"]:
                close()
            if now and b["kind"] != now[-1]["kind"] and not {b["kind"], now[-1]["kind"]} <= textual:
                close()
            if now and sum(len(x["text"].split()) for x in [*now, b]) > max_tokens:
                close()
            now.append(b)
        close()
        return pd.DataFrame(chunks, columns=["doc", "part", "n", *rest])

    rest = ["pages", "heading_path", "text", "token_count", "chunk_type", "mixed_combo", "image_paths"]
    src = _fold_in(blocks)
    order = Window.partitionBy("doc").orderBy("page_num", "block_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opens = ((F.col("kind") == "heading") & (F.coalesce("heading_level", F.lit(1)) <= 1)).cast("int")
    parts = src.withColumn("part", F.floor(F.sum(opens).over(order) / RUNS))
    folded = parts.groupBy("doc", "part").applyInPandas(one, "doc string, part long, n int, pages array<int>, heading_path array<string>, text string, token_count int, chunk_type string, mixed_combo string, image_paths array<string>")
    return folded.select("doc", F.row_number().over(Window.partitionBy("doc").orderBy("part", "n")).alias("chunk_id"), *rest)


def parse_documents(spans: DataFrame, pages: DataFrame) -> DataFrame:
    """Spans of all documents to structural chunks: margins, contents pages, blocks, tables, captions, sidebars, levels, images, page merges."""
    spans, pages = cut(spans), cut(pages)
    body = cut(drop_headers_footers(spans, pages).join(toc_pages(spans, pages).select("doc", "page_num"), ["doc", "page_num"], "left_anti"))
    blocks = cut(heading_levels(cut(mark_sidebars(mark_captions(mark_tables(cut(blocks_of(body)))), pages))))
    return structural_chunks(merge_cross_page(place_images(blocks, pages)))
