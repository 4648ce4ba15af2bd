import heapq

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.llm import mix as M
from quire.llm import pack as P
from quire.llm import split as S


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "bb.", "ccc", "\n", "\n\n", "Dd!", "\t", "1.", "\n- x"]), max_size=120), st.integers(2, 12), st.data())
def test_split_round_trip(parts, limit, data):
    overlap = data.draw(st.integers(0, limit - 1))
    text = " ".join(parts)
    tokens = S._TOKEN.findall(text)
    pieces = [S._TOKEN.findall(text[a:b]) for a, b, _ in S.split_text(text, limit, overlap)]
    assert all(0 < len(p) <= limit for p in pieces) and [len(p) for p in pieces] == [n for *_, n in S.split_text(text, limit, overlap)]
    joined = pieces[0] if pieces else []
    for a, b in zip(pieces, pieces[1:]):
        assert overlap == 0 or a[-overlap:] == b[:overlap]
        joined = joined + b[overlap:]
    assert joined == tokens


def test_split_prefers_boundaries():
    text = "One two three. Four five six. Seven eight nine ten."
    assert [text[a:b] for a, b, _ in S.split_text(text, 6, 0)] == ["One two three. Four five six.", "Seven eight nine ten."]
    assert [n for *_, n in S.split_text("x" * 25, 10, 2, unit="chars")] == [10, 10, 9]


def test_split_frame(spark):
    df = spark.createDataFrame([(1, "a " * 10, "p", 7), (2, None, "p", 7), (3, " \n", None, 7), (4, "w " * 1000, "q", 7), (4, "w " * 1000, "q", 7)], "k int, text string, heading string, pieces int")
    got = S.split_oversized(df, "k", "text", 384, 64).collect()
    assert sorted((r.k, r.piece_no, r.pieces, r.piece_size) for r in got) == [(1, 0, 1, 10)] + sorted([(4, 0, 3, 384), (4, 0, 3, 384), (4, 1, 3, 384), (4, 1, 3, 384), (4, 2, 3, 360), (4, 2, 3, 360)])
    assert {r.heading for r in got if r.k == 4} == {"q"} and S.split_oversized(df.limit(0), "k", "text", 384, 64).count() == 0


def first_fit(sizes, capacity):
    bins, out = [], []
    for s in sizes:
        k = next((i for i, b in enumerate(bins) if b + s <= capacity), len(bins))
        if k == len(bins):
            bins.append(0)
        bins[k] += s
        out.append(k)
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 20), max_size=60))
def test_first_fit_decreasing(sizes):
    sizes = sorted(sizes, reverse=True)
    assert P.first_fit_decreasing(sizes, 20) == first_fit(sizes, 20)


def test_pack(spark):
    items = spark.createDataFrame([(i, (i * 37) % 90) for i in range(300)] + [(1000, 2500), (1001, None), (1002, 100), (1002, 100)], "doc_id long, n_tokens long")
    limits = spark.createDataFrame([("small", 100), ("large", 400)], "purpose string, limit_tokens int")
    got = P.pack(items, "doc_id", "n_tokens", limits, group_items=100).cache()
    total = items.agg(F.sum("n_tokens")).first()[0]
    for purpose, cap in (("small", 100), ("large", 400)):
        mine = got.where(F.col("purpose") == purpose)
        assert mine.groupBy("container").agg(F.sum("n_tokens").alias("t")).where(F.col("t") > cap).isEmpty()
        assert mine.agg(F.sum("n_tokens")).first()[0] == total and mine.select("doc_id").distinct().count() == 303
        assert mine.groupBy("doc_id").count().where("count > 2 and doc_id <> 1000").isEmpty()
        assert mine.where("doc_id = 1000").count() == -(-2500 // cap)
    fill = {r.purpose: r.filled for r in P.fill_report(got, limits).collect()}
    assert min(fill.values()) > 0.9
    assert P.pack(items.limit(0), "doc_id", "n_tokens", limits).count() == 0


def quotients(weights, seats, caps):
    got = [0] * len(weights)
    heap = [(-w, i) for i, w in enumerate(weights) if w > 0 and caps[i] > 0]
    heapq.heapify(heap)
    for _ in range(seats):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < caps[i]:
            heapq.heappush(heap, (-weights[i] / (2 * got[i] + 1), i))
    return got


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 30)), min_size=1, max_size=8), st.integers(0, 120))
def test_sainte_lague(rows, seats):
    weights, caps = [w / 7 for w, _ in rows], [c for _, c in rows]
    assert M.sainte_lague(weights, seats, caps) == quotients(weights, seats, caps)


def test_mix(spark):
    docs = spark.createDataFrame([(i, ("a", "B ", "b", "c-d", None, "zz")[i % 6], 50 + i % 100) for i in range(6000)] + [(9001, "a", None), (9002, "a", 0)], "doc_id long, source string, n_tokens long")
    plan = spark.createDataFrame([("a", 0.2, 1), ("b", 0.5, 2), ("c_d", 0.3, 5), ("none", 0.0, 1)], "source string, target_share double, max_repeats int")
    drawn, report = M.mix(docs, plan, block_tokens=64, shard_docs=500)
    shares = {r.source: r for r in report.collect()}
    drawn = drawn.cache()
    rest = 1 - 1 / 6  # a gives all it has; the others share the rest as 5 to 3
    assert abs(shares["b"].actual_share - rest * 5 / 8) < 0.01 and abs(shares["c_d"].actual_share - rest * 3 / 8) < 0.01 and shares["a"].capped and not shares["b"].capped
    assert drawn.groupBy("doc_id").count().where("count > 1").isEmpty() and drawn.where("source is null or source = 'zz'").isEmpty()
    assert {r.source: r.m for r in drawn.groupBy("source").agg(F.max("repeats").alias("m")).collect()}["a"] == 1
    total, got = docs.agg(F.sum("n_tokens")).first()[0], drawn.agg(F.sum(F.col("n_tokens") * F.col("repeats"))).first()[0]
    assert abs(got - total) < 0.02 * total
    empty, report = M.mix(docs.limit(0), plan)
    assert empty.count() == 0 and report.count() == 4


def test_source_of_less_than_a_block_is_drawn(spark):
    rows = [(i, "large", 100) for i in range(100)] + [(1000, "small", 90)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("large", 0.9, 2), ("small", 0.1, 2)], "source string, target_share double, max_repeats int")
    drawn, report = M.mix(docs, targets)
    assert [r.repeats for r in drawn.where("source = 'small'").collect()] == [2]
    assert {r.source: r.tokens for r in report.collect()}["small"] == 180
