from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.operators import chunking as C
from quire.operators import layout as L

SPAN = "doc string, page_num int, block_no int, line_no int, span_no int, text string, font_size double, bold boolean, x0 double, y0 double, x1 double, y1 double, is_image boolean"


def span(page, block, text, y=300.0, font=10.0, bold=False, x0=100.0, line=0, no=0, image=False):
    return ("d", page, block, line, no, text, font, bold, x0, y, x0 + 300, y + 10, image)


def test_headers_repeat_and_middle_lines_stay(spark):
    rows = [span(p, 0, "Company manual", y=5.0) for p in (1, 2, 3)] + [span(p, 9, str(p), y=790.0) for p in (1, 2, 3)] + [span(p, 5, "Same line", y=400.0) for p in (1, 2, 3)] + [span(1, 1, "Body", y=6.0)]
    pages = spark.createDataFrame([("d", p, 600.0, 800.0) for p in (1, 2, 3)], "doc string, page_num int, width double, height double")
    left = L.drop_headers_footers(spark.createDataFrame(rows, SPAN), pages).collect()
    assert sorted(r.text for r in left) == ["Body", "Same line", "Same line", "Same line"]


def test_toc_only_on_first_pages(spark):
    rows = [span(p, i, f"Chapter {i} ........ {i}", y=20.0 * i) for p in (2, 8) for i in range(5)]
    pages = spark.createDataFrame([("d", p, 600.0, 800.0) for p in (2, 8)], "doc string, page_num int, width double, height double")
    assert [r.page_num for r in L.toc_pages(spark.createDataFrame(rows, SPAN), pages).collect()] == [2]


def test_kinds_and_chunks(spark):
    rows = [span(1, 0, "1 GENERAL PART", font=14.0, bold=True), span(1, 1, "Some text of the body."), span(1, 2, "- an item"), span(1, 3, "1.1.1.1.1 DEEP PART", bold=True), span(1, 4, "More text."), span(2, 5, "goes on here", y=50.0), span(2, 6, "LAST HEADING", bold=True)]
    rows += [span(1, 7, f"cell {i}", x0=50.0 * i, no=i, line=i) for i in range(6)]
    pages = spark.createDataFrame([("d", p, 600.0, 800.0) for p in (1, 2)], "doc string, page_num int, width double, height double")
    b = L.heading_levels(L.mark_tables(L.blocks_of(spark.createDataFrame(rows, SPAN))))
    kind = {r.block_no: (r.kind, r.heading_level) for r in b.collect()}
    assert kind[0] == ("heading", 1) and kind[1][0] == "paragraph" and kind[2][0] == "list_item" and kind[3] == ("heading", 5) and kind[7][0] == "table"
    chunks = L.structural_chunks(b).orderBy("chunk_id").collect()
    assert chunks[0].text.startswith("1 GENERAL PART") is False and chunks[0].heading_path == ["1 GENERAL PART", "1.1.1.1.1 DEEP PART"]
    assert [c.chunk_type for c in chunks][0] == "mixed" and all("LAST HEADING" not in c.text for c in chunks)


def test_chunk_limit(spark):
    for words, n in ((750, 1), (751, 2)):
        blocks = spark.createDataFrame([("d", 1, i, "w " * (750 if i == 0 else words), "paragraph", None, 0.0) for i in range(2)], "doc string, page_num int, block_no int, text string, kind string, heading_level int, y0 double")
        assert L.structural_chunks(blocks).count() == n


def test_cross_page_merge(spark):
    b = spark.createDataFrame([("d", 1, 0, "a text that", "paragraph", None, 700.0), ("d", 2, 0, "goes on", "paragraph", None, 50.0), ("d", 3, 0, "new page", "paragraph", None, 60.0), ("d", 4, 0, "far down", "paragraph", None, 120.0)], "doc string, page_num int, block_no int, text string, kind string, heading_level int, y0 double")
    assert [r.text for r in L.merge_cross_page(b).orderBy("page_num").collect()] == ["a text that goes on", "new page", "far down"]


@settings(max_examples=15, deadline=None)
@given(st.sampled_from([0, 1, 320, 384, 385, 640, 704, 705]))
def test_windows(spark, n):
    df = spark.createDataFrame([(1, " ".join(f"t{i}" for i in range(n)))], "chunk_id int, text string")
    got = [(r.token_start, r.token_end, r.chunk_text.split()) for r in C.token_windows(df).orderBy("token_start").collect()]
    assert [g[0] for g in got] == list(range(0, n, 320))
    assert all(w == [f"t{i}" for i in range(a, min(n, a + 384))] and b == min(n, a + 384) for a, b, w in got)


def test_merge_small(spark):
    rows = [("d", 1, ["A"], "x " * 30), ("d", 2, ["A"], "x " * 40), ("d", 3, ["A"], "x " * 30), ("d", 4, ["B"], "x"), ("d", 5, None, "x"), ("d", 6, [], None)]
    got = C.merge_small(spark.createDataFrame(rows, "document_name string, chunk_id int, heading_path array<string>, text string")).orderBy("merged_id").collect()
    assert [r.merged_from for r in got] == [[1, 2], [3], [4], [5, 6]]


def test_images_and_captions(spark):
    pages = spark.createDataFrame([("d", 1, 600.0, 800.0), ("d", 2, 600.0, 800.0)], "doc string, page_num int, width double, height double")
    blocks = spark.createDataFrame([("d", 1, 1, "paragraph", 100.0, 200.0), ("d", 1, 2, "heading", 210.0, 220.0), ("d", 1, 3, "paragraph", 700.0, 720.0)], "doc string, page_num int, block_no int, kind string, y0 double, y1 double")
    images = spark.createDataFrame([("d", 1, 0, 250.0, 300.0), ("d", 2, 0, 10.0, 60.0), ("d", 1, 1, 500.0, 600.0)], "doc string, page_num int, image_no int, y0 double, y1 double")
    got = {(r.page_num, r.image_no): r.block_no for r in L.attach_images(blocks, images, pages).collect()}
    assert got == {(1, 0): 1, (2, 0): 3, (1, 1): 3}


def test_images_of_spans_reach_their_chunks_and_make_captions(spark):
    rows = [span(1, 0, "The pump stands beside the tank.", y=300.0) + (None,), span(1, 1, "", y=320.0, image=True) + ("p1.jpg",), span(1, 2, "the pump from above", y=420.0, font=6.0) + (None,)]
    rows += [span(1, 4, f"Body line {i} of the page.", y=500.0 + 12 * i, line=i) + (None,) for i in range(4)] + [span(2, 5, "", y=20.0, image=True) + ("p2.jpg",), span(2, 6, "Far below it goes on.", y=300.0) + (None,)]
    spans = spark.createDataFrame(rows, SPAN + ", image_path string")
    pages = spark.createDataFrame([("d", p, 600.0, 800.0) for p in (1, 2)], "doc string, page_num int, width double, height double")
    kinds = {r.block_no: r.kind for r in L.mark_captions(L.mark_tables(L.blocks_of(spans))).collect()}
    assert kinds == {0: "paragraph", 1: "image", 2: "caption", 4: "paragraph", 5: "image", 6: "paragraph"}
    chunks = L.parse_documents(spans, pages).orderBy("chunk_id").collect()
    assert [(c.chunk_type, c.image_paths) for c in chunks] == [("paragraph", ["p1.jpg"]), ("caption", []), ("paragraph", ["p2.jpg"]), ("paragraph", [])]
