import random

import numpy as np

from quire.llm import neardup as N


def corpus(seed=0, n=240):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            ws = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, max(1, len(ws) // 12))):
                k = rng.randrange(len(ws))
                ws[k : k + 1] = rng.choice([[], [rng.choice(vocabulary)], [ws[k], rng.choice(vocabulary)]])
        else:
            ws = [rng.choice(vocabulary) for _ in range(rng.randint(3, 60))]
        rows.append((i, " ".join(ws)))
    return rows


def brute(rows, words, threshold):
    sets = {i: set(zip(*(t.lower().split()[k:] for k in range(words)))) for i, t in rows if t}
    out = set()
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if common / (len(sets[a]) + len(sets[b]) - common) >= threshold:
                    out.add((a, b))
    return out


def test_pairs_against_brute_force(spark):
    rows = corpus() + [(1000, None), (1001, ""), (1002, "two words"), (1003, "two words"), (1004, "A b C d"), (1005, "a B c D")]
    df = spark.createDataFrame(rows, "id int, text string").selectExpr("id as key", "text", "text as class")
    for words, threshold in ((3, 0.6), (5, 0.8)):
        got = [(r.row_a, r.row_b) for r in N.similar_pairs(df, "key", "text", words, threshold).collect()]
        want = brute([r for r in rows if r[1]], words, threshold)
        assert len(got) == len(set(got)) and set(got) <= want
        assert len(set(got)) >= 0.99 * len(want) and want


def test_groups(spark):
    rows = corpus(1, 120) + [(500, None)] + [(600 + i, "one text that is held many times by very many rows") for i in range(60)]
    df = spark.createDataFrame(rows, "id int, text string")
    got = {r.id: r for r in N.similar_groups(df, "id", "text", 3, 0.6).collect()}
    assert len(got) == len(rows) and got[500].group_id == 500 and got[500].links == 0
    for a, b in brute([r for r in rows if r[1]], 3, 0.6):
        assert got[a].group_id == got[b].group_id
    assert {got[600 + i].class_id for i in range(60)} == {600}
    assert N.similar_groups(df.limit(0), "id", "text").count() == 0


def test_allocation_is_optimal():
    import itertools

    rng = np.random.default_rng(0)
    costs, gains = rng.random((20, 4, 2)).astype(np.float32) * 10, np.array([0.5, 0.3])
    took = N.allocate(costs, gains, 1.0, steps=10)
    for t in range(20):
        cost = lambda ch: sum(costs[t, p, o] for p, o in enumerate(ch) if o >= 0)  # noqa: B023, E731
        best = min(cost(ch) for ch in itertools.product((-1, 0, 1), repeat=4) if sum(gains[o] for o in ch if o >= 0) >= 1 - 1e-9)
        assert sum(gains[o] for o in took[t] if o >= 0) >= 1 - 1e-9 and abs(cost(took[t]) - best) < 1e-4


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (100, 102)], "a int, b int")
    got = {r.id: r.group for r in N.components(links).collect()}
    assert all(got[i] == 0 for i in range(41)) and {got[i] for i in (100, 101, 102)} == {100}


def test_signatures_meet_just_within_the_threshold():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 2**32, (200, N.SYMBOLS), dtype=np.uint32)
    b = np.where(rng.random(a.shape) < 0.3, rng.integers(0, 2**32, a.shape, dtype=np.uint32), a)
    for width, most in N.WIDTHS.items():
        groups = rng.permutation(N.SYMBOLS).reshape(-1, width)
        differences = (a != b)[:, groups].sum(2)
        for t in range(most + 1):
            x, y = N.signatures(a, groups, t), N.signatures(b, groups, t)
            assert x.shape[2] == N.CHOICES[width][t]
            assert ((x == y).any(2) == (differences <= t)).all()


def test_two_large_families_are_found(spark):
    rng = random.Random(8)
    base = [f"w{rng.randrange(500)}" for _ in range(60)]
    other = base[:49] + [f"v{i}" for i in range(11)]
    rows = [(i, " ".join([*(base if i % 2 else other), f"x{i}"])) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, text string")
    got = {(r.row_a, r.row_b) for r in N.similar_pairs(df, "id", "text", 3, 0.6).collect()}
    want = brute(rows, 3, 0.6)
    assert len(want) == 120 * 119 // 2 and got <= want and len(got) >= 0.97 * len(want)


def test_no_join_is_broadcast(spark):
    df = spark.createDataFrame(corpus(2, 60), "id int, text string")
    for frame in (N.similar_pairs(df, "id", "text", 3, 0.6), N.similar_groups(df, "id", "text", 3, 0.6)):
        assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()
