"""Documents as rows of styled paragraphs, and as DOCX files: assembly, rendering, reading and rewriting.

A DOCX file is a ZIP archive with one XML part of paragraphs; files are made and read
one document per task, so a document must fit a task, the collection need not.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import level_of, path_of, xml_safe
from quire.operators.models import Client, complete_text

_W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
# The parts that every file of this kind holds.
_TYPES = '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/word/document.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"/></Types>'
_RELS = '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="word/document.xml"/></Relationships>'


def document_rows(nodes: DataFrame, qa: DataFrame) -> DataFrame:
    """The paragraphs of a document over a tree: cluster_id, part, kind, item_no, style, text.

    Each node (cluster_id, label, summary) gives a heading of its level and its summary;
    each of its questions (``qa``: cluster_id, info_type, item_no, question, answer) a
    heading one deeper and its answer.  Headings go down to six.  The order within a
    document is that of ``document_order``.
    """
    level = level_of(F.col("cluster_id"))
    style = lambda deeper: F.concat(F.lit("Heading "), F.least(level + deeper, F.lit(6)).cast("string"))
    none = F.lit("")
    head = nodes.select("cluster_id", F.lit(0).alias("part"), none.alias("kind"), F.lit(0).alias("item_no"), style(1).alias("style"), F.coalesce("label", none).alias("text"))
    body = nodes.where("summary is not null").select("cluster_id", F.lit(1).alias("part"), none.alias("kind"), F.lit(0).alias("item_no"), F.lit("Normal").alias("style"), F.col("summary").alias("text"))
    mine = qa.where("question is not null").join(nodes.select("cluster_id"), "cluster_id", "left_semi")
    asked = mine.select("cluster_id", F.lit(2).alias("part"), F.coalesce("info_type", none).alias("kind"), F.coalesce("item_no", F.lit(0)).alias("item_no"), style(2).alias("style"), F.col("question").alias("text"))
    said = mine.select("cluster_id", F.lit(3).alias("part"), F.coalesce("info_type", none).alias("kind"), F.coalesce("item_no", F.lit(0)).alias("item_no"), F.lit("Normal").alias("style"), F.coalesce("answer", none).alias("text"))
    return head.unionAll(body).unionAll(asked).unionAll(said)


def document_order() -> list:
    """How the rows of a document are sorted: nodes in path order, heading, summary, then questions each before its answer."""
    return [path_of(F.col("cluster_id")), F.when(F.col("part") < 2, F.col("part")).otherwise(2), F.col("kind"), F.col("item_no"), F.col("text").isNull(), F.col("part")]


def docx_bytes(paragraphs: list[tuple[str, str]]) -> bytes:
    """A DOCX file of (style, XML-safe text) paragraphs."""
    body = "".join(f'<w:p><w:pPr><w:pStyle w:val="{s.replace(" ", "")}"/></w:pPr>' + "<w:r><w:br/></w:r>".join(f'<w:r><w:t xml:space="preserve">{line}</w:t></w:r>' for line in t.split("\n")) + "</w:p>" for s, t in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in (("[Content_Types].xml", _TYPES), ("_rels/.rels", _RELS), ("word/document.xml", f'<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w="{_W}"><w:body>{body}</w:body></w:document>')):
            z.writestr(zipfile.ZipInfo(name), data)
    return out.getvalue()


def render(rows: DataFrame, document: str = "doc") -> DataFrame:
    """(document, content): one DOCX file per value of ``document``.  ``rows`` has it with the columns of ``document_rows``."""
    ordered = rows.withColumn("text", xml_safe(F.col("text"))).withColumn("at", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(document_order())]))

    listed = ordered.groupBy(F.col(document).alias("doc")).agg(F.array_sort(F.collect_list(F.struct("at", "style", "text"))).alias("p"))
    flat = listed.select("doc", F.transform("p", lambda x: x["style"]).alias("styles"), F.transform("p", lambda x: x["text"]).alias("texts"))
    kind = flat.schema["doc"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            files = [docx_bytes(list(zip(s, [t or "" for t in ts]))) for s, ts in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(files, pa.binary())], names=["doc", "content"])

    return flat.mapInArrow(pack, f"doc {kind}, content binary")


def paragraphs_of(content: bytes) -> list[tuple[str, str, bool, bool]]:
    """(style, text, has_break, in_toc) of every paragraph of a DOCX file, tables, headers and footers included; none of a broken file."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            parts = [n for n in z.namelist() if re.fullmatch(r"word/(document|header\d*|footer\d*)\.xml", n)]
            trees = [ElementTree.fromstring(z.read(n)) for n in sorted(parts)]
    except (zipfile.BadZipFile, ElementTree.ParseError, KeyError):
        return []
    out = []
    for tree in trees:
        for p in tree.iter(f"{{{_W}}}p"):
            style = p.find(f"{{{_W}}}pPr/{{{_W}}}pStyle")
            name = style.get(f"{{{_W}}}val", "") if style is not None else ""
            text = "".join("\n" if e.tag.endswith("}br") else e.text or "" for e in p.iter() if e.tag in (f"{{{_W}}}t", f"{{{_W}}}br"))
            breaks = any(e.tag == f"{{{_W}}}lastRenderedPageBreak" for e in p.iter())
            out.append((name, text, breaks, name.lower().startswith("toc")))
    return out


def read_paragraphs(files: DataFrame) -> DataFrame:
    """Paragraphs of DOCX files (doc, content): doc, idx, style, text, has_break, in_toc."""
    kind = files.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ps = paragraphs_of(content or b"")
                cols = list(zip(*ps)) if ps else [(), (), (), ()]
                types = [pa.string(), pa.string(), pa.bool_(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array([doc] * len(ps), b.schema.field(0).type), pa.array(range(len(ps)), pa.int32()), *(pa.array(c, t) for c, t in zip(cols, types))], names=["doc", "idx", "style", "text", "has_break", "in_toc"])

    return files.select("doc", "content").mapInArrow(run, f"doc {kind}, idx int, style string, text string, has_break boolean, in_toc boolean")


def rewritten(paragraphs: DataFrame, instruction: str, factory: Callable[[], Client]) -> DataFrame:
    """All paragraphs with the rewritable ones rewritten by a model: doc, idx, style, text, changed.

    What is in a table of contents or has no letter stays, and so does a paragraph whose
    answer is empty or failed.
    """
    ask = ~F.col("in_toc") & F.col("text").rlike(r"\p{L}")
    said = complete_text(paragraphs.where(ask).withColumn("prompt", F.concat(F.lit(instruction + "\n\n"), "text")), factory)
    new = F.when((F.col("status") == "done") & (F.trim("answer") != ""), F.trim("answer")).otherwise(F.col("text"))
    mine = said.select("doc", "idx", "style", new.alias("text"), (new != F.col("text")).alias("changed"))
    return mine.unionAll(paragraphs.where(~F.coalesce(ask, F.lit(False))).select("doc", "idx", "style", "text", F.lit(False).alias("changed")))
