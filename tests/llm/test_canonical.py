import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import canonical as C

SAME = ["café", "café", "ｃａｆé", "c​afé", "саfé", "ca­fé"]


def test_look():
    assert len({C.canonical_text(x) for x in SAME}) == 1
    assert C.canonical_text("ﬁn a b c　d") == "fin a b c d"
    different = ["a", "A", "á", "ß", "ss", "2", "²", "②", "a-b", "a–b", "a.b", "a;b", "ſ"]
    assert len({C.canonical_text(x) for x in different}) == len(different)
    assert C.canonical_text(None) is None and C.canonical_text("") == ""
    assert C.canonical_text("e​́") == "é"


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("aeéñßſﬁ²①аοΩµ́̈ ​­\t\n\r Kㄱ가각\U0001d400\U000e0100")), max_size=30))
def test_segments_equal_whole_normalisation(text):
    whole = unicodedata.normalize("NFD", text.replace("\r\n", "\n"))
    whole = unicodedata.normalize("NFD", "".join(map(C._spread, whole)))
    whole = unicodedata.normalize("NFC", "".join(C._SHAPE.get(c, c) for c in whole))
    assert C.canonical_text(text) == whole
    assert C.canonical_text(whole) == whole


def test_pairs_against_brute_force(spark):
    rows = [(i, x) for i, x in enumerate(SAME + ["café", "Café", "", " ", None, "x", "x", "x​", "long " * 5000, "long " * 5000])]
    df = spark.createDataFrame(rows, "key int, look string")  # a column named like one of the operator's
    got = {(r.row_a, r.row_b) for r in C.equal_looking_pairs(df, "key", "look").collect()}
    want = {(a, b) for a, x in rows for b, y in rows if a < b and x and y and x != y and C.canonical_text(x) == C.canonical_text(y) and C.canonical_text(x).strip()}
    assert got == want and got
    assert C.equal_looking_pairs(df.limit(0), "key", "look").count() == 0


def test_hot_look(spark):
    df = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 'same' when id = 1 then 'sаme' else concat('t', id) end as text")
    assert C.equal_looking_pairs(df, "id", "text").count() == 1000


def test_marks_join_over_invisible_characters():
    for text in ("e\u200b\u0301", "\u1100\u00ad\u1161", "\uac00\ufeff\u11a8", "a\u200b\u200b\u0327\u0301x", "\u0301e", "\u00e9\u200b\u0304"):
        got = C.canonical_text(text)
        assert got == unicodedata.normalize("NFC", got) and "\u200b" not in got
    assert C.canonical_text("e\u200b\u0301") == "\u00e9" and C.canonical_text("\u1100\u1161") == "\uac00"
