import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.operators import hierarchy as H


def brute(x, cutoff):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    d = 1 - u @ u.T
    groups = [[i] for i in range(len(x))]
    while len(groups) > 1:
        h, a, b = min((d[np.ix_(groups[a], groups[b])].mean(), a, b) for a in range(len(groups)) for b in range(a + 1, len(groups)))
        if h >= cutoff:
            break
        groups[a] += groups.pop(b)
    return {frozenset(g) for g in groups}


@settings(max_examples=40, deadline=None)
@given(st.integers(2, 18), st.integers(0, 10_000), st.floats(0.1, 1.2))
def test_average_linkage_against_brute_force(n, seed, cutoff):
    x = np.random.default_rng(seed).standard_normal((n, 4))
    own = H.average_linkage(x, cutoff)
    assert {frozenset(np.flatnonzero(own == k).tolist()) for k in set(own)} == brute(x, cutoff)
    assert list(dict.fromkeys(own)) == list(range(own.max() + 1))  # numbered by first appearance


@pytest.mark.parametrize("max_group", [4000, 40])
def test_tree_is_lossless_and_gap_free(spark, max_group):
    rng = np.random.default_rng(1)
    x = np.repeat(rng.standard_normal((6, 8)), 20, axis=0) + 0.3 * rng.standard_normal((120, 8))
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "chunk_id long, embedding array<double>")
    leaves = H.build_tree(v, cutoff=0.6, max_group=max_group).cache()
    check = {r.what: r.v for r in H.lossless_check(v, leaves).collect()}
    assert check == {"stored": 120, "leaf_entries": 120, "leaf_ids": 120, "missing": 0, "extra": 0}
    nodes = H.nodes_of(leaves).collect()
    kids = {}
    for n in nodes:
        kids.setdefault(n.parent, []).append(int(n.cluster_id.split(".")[-1]))
    assert all(sorted(k) == list(range(len(k))) for k in kids.values())
    assert all(n.children != 1 for n in nodes)
    assert sum(n["size"] for n in nodes if n.is_leaf) == 120


def test_tree_does_not_depend_on_max_group(spark):
    rng = np.random.default_rng(1)
    x = np.repeat(rng.standard_normal((6, 8)), 20, axis=0) + 0.3 * rng.standard_normal((120, 8))
    x[7] = 0
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "chunk_id long, embedding array<double>")
    one, many = ({(r.cluster_id, r.chunk_id) for r in H.build_tree(v, cutoff=0.6, max_group=m).collect()} for m in (4000, 40))
    assert one == many


def test_linkage_of_equal_and_zero_vectors():
    x = np.array([[1.0, 0], [0, 0], [2, 0], [0, 3], [0, 0], [0, 1], [1, 0]] * 40)
    own = H.average_linkage(x, 0.5)
    assert len(set(own[[0, 2, 6]])) == len(set(own[[3, 5]])) == 1 and own.max() + 1 == 2 + 80  # zero vectors stay alone


def test_balance_rules():
    e = np.eye(3)
    assert H.balance([6000, 100, 100], [e[0], e[1], e[1]], 5000, 150) == [[0], [1, 2]]
    groups = H.balance([3000, 2500, 1000, 900], [e[0], e[1], e[0], e[1]], 5000, 1500)
    assert sorted(map(sorted, groups)) == [[0, 2], [1, 3]]
    assert H.balance([10, 10], [None, None], 5000, 1500) == [[0, 1]]


def test_kinds_and_flags(spark):
    ids = ["0", "0.0", "0.0.0", "0.0.1", "0.1", "0.10", "0.2"]
    n = spark.createDataFrame([(i, i not in ("0", "0.0")) for i in ids], "cluster_id string, is_leaf boolean")
    kinds = {r.cluster_id: r.kind for r in H.node_kinds(n).collect()}
    assert kinds["0"] == "group" and kinds["0.0"] == "leaf_parent" and kinds["0.1"] == "leaf"
    flags = {r.cluster_id: r for r in H.node_flags(n).collect()}
    assert flags["0"].document_cluster and not flags["0"].has_leaf_sibling and flags["0.1"].has_internal_sibling and flags["0.10"].padded == "00.10"
    assert [r.cluster_id for r in H.preorder(n).collect()][-2:] == ["0.2", "0.10"]
    with pytest.raises(KeyError):
        H.subtree(n, "7")


def test_empty_tree(spark):
    leaf = spark.createDataFrame([], "cluster_id string, chunk_id string")
    chunks = spark.createDataFrame([], "chunk_id string, token_count int, document_name string")
    assert H.token_rollup(leaf, chunks).count() == 0 and H.nodes_of(leaf).count() == 0
    assert H.build_tree(spark.createDataFrame([], "chunk_id long, embedding array<double>")).count() == 0


def test_metadata_encoding():
    import pandas as pd

    x = H.encode_metadata(pd.Series([["a", "b"], None, "a"]))
    assert x.tolist() == [[1, 1, 0], [0, 0, 1], [1, 0, 0]]
