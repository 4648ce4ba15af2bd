import numpy as np

from quire.llm import neighbors as V

SCHEMA = "key int, embedding array<float>, unit string"


def frame(spark, x, extra=()):
    return spark.createDataFrame([(i, None if r is None else [float(v) for v in r], "u") for i, r in [*enumerate(x), *extra]], SCHEMA)


def truth(x, k):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    return np.argsort(-s, axis=1, kind="stable")[:, :k], s


def test_small_table_is_exact(spark):
    x = np.random.default_rng(0).standard_normal((200, 16))
    df = frame(spark, x, [(900, None), (901, []), (902, [0.0] * 16), (903, [1.0, 2.0]), (904, [2.0, 4.0])])
    got = {}
    for r in V.nearest(df, "key", "embedding").collect():
        got.setdefault(r.row, []).append((r["rank"], r.other))
    near, _ = truth(x, 10)
    same = sum(len({o for _, o in got[i]} & set(near[i].tolist())) for i in range(200))
    assert same >= 1990 and set(got) == {*range(200), 903, 904} and got[903] == [(1, 904)]


def test_forest_recall(spark):
    rng = np.random.default_rng(1)
    x = np.repeat(rng.standard_normal((40, 16)), 50, axis=0) + 0.4 * rng.standard_normal((2000, 16))
    df = frame(spark, x)
    row = V.recall(df, "key", "embedding", candidates=200).first()
    assert row.queries == 100 and row.wanted == 1000 and row.recall >= 0.9
    pairs = {(r.row_a, r.row_b) for r in V.similar_vector_pairs(df, "key", "embedding", candidates=200).collect()}
    near, s = truth(x, 10)
    want = {(min(i, j), max(i, j)) for i in range(2000) for j in near[i].tolist() if s[i, j] >= 0.9}
    assert pairs <= {(a, b) for a, b in pairs if s[a, b] >= 0.9 - 1e-6} and len(pairs & want) >= 0.97 * len(want)


def test_many_copies(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([np.repeat(rng.standard_normal((1, 8)), 150, axis=0), rng.standard_normal((100, 8))])
    got = {}
    for r in V.nearest(frame(spark, x), "key", "embedding").collect():
        got.setdefault(r.row, []).append((r["rank"], r.other, r.cosine))
    assert len(got) == 250 and all(len(v) == 10 for v in got.values())
    assert sorted(o for _, o, _ in got[140]) == list(range(10)) and sorted(o for _, o, _ in got[3]) == [0, 1, 2, 4, 5, 6, 7, 8, 9, 10]
    assert V.nearest(frame(spark, []), "key", "embedding").count() == 0


def test_ranges_and_best():
    counts = np.array([5, 5, 0, 1, 50, 60, 1, 1])
    cell = V.ranges(counts, most=20, least=4)
    assert (np.diff(cell) >= 0).all() and cell[0] != cell[4] and cell[4] != cell[5]
    s = np.random.default_rng(3).random((20, 5000)).astype(np.float32)
    assert (np.sort(np.take_along_axis(s, V.best_of(s, 10), 1)) == np.sort(s)[:, -10:]).all()


def test_six_bits():
    rng = np.random.default_rng(5)
    for dim in (1, 2, 3, 16, 63, 64):
        x = rng.standard_normal((50, dim))
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        y = V._matrix([V._six_bits(r).tobytes() for r in x], dim)
        assert y.shape == x.shape and ((u * y).sum(1) > 0.995).all()


def test_levels_are_synchronous():
    rng = np.random.default_rng(6)
    codes = rng.integers(0, 16, (3, 500))
    total = np.concatenate([np.zeros((3, 1), np.int64), np.cumsum([np.bincount(c, minlength=16) for c in codes], axis=1)], 1)
    level, shared = V.levels(total, codes, 4, 300)
    for i in range(0, 500, 17):
        sizes = [sum(((codes[t] >> 4 - n) == (codes[t, i] >> 4 - n)).sum() for t in range(3)) for n in range(5)]
        assert shared[i] == sizes[level[i]] >= 300 and (level[i] == 4 or sizes[level[i] + 1] < 300)


def test_hot_topic_and_pairs_over_a_limit(spark):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.standard_normal((1, 32)) + 0.25 * rng.standard_normal((1000, 32)), rng.standard_normal((2000, 32))])
    near, s = truth(x, 10)
    want = {(min(i, j), max(i, j)) for i in range(3000) for j in near[i].tolist() if s[i, j] >= 0.9}
    got = {(r.row_a, r.row_b) for r in V.similar_vector_pairs(frame(spark, x), "key", "embedding", candidates=1200).collect()}
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 0.03 * len(want)
    few = V.effort(frame(spark, x), "key", "embedding", candidates=300).first()
    assert few.vectors == 3000 and few.share < 0.7
