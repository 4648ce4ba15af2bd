"""The topic hierarchy: recursive average-linkage clustering, roll-ups along paths, flags, harmonising.

A tree is two tables: nodes (cluster_id, ...) and leaf_chunks (cluster_id, chunk_id).
``cluster_id`` is the dotted path of a node, so everything about ancestors and subtrees
is an explode of path prefixes and one aggregate, without recursion.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.cut import cut
from quire.functions.text import ancestors, level_of, padded_id, parent_id, path_of


# ---- clustering -----------------------------------------------------------------


def average_linkage(x: np.ndarray, cutoff: float) -> np.ndarray:
    """Labels of agglomerative clustering by mean cosine distance, merging below ``cutoff``.

    The mean cosine distance of two clusters is 1 less the product of the means of
    their unit vectors, so a nearest-neighbour chain over these means gives the exact
    tree: quadratic time, but memory for the vectors only, at every size.  A cluster
    without a neighbour under the cutoff gets none by later merges and is left out.
    Labels are numbered by first appearance; zero vectors have distance 1 to all others.
    """
    n = len(x)
    if n == 0:
        return np.zeros(0, int)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    mean = np.divide(x, norm, out=np.zeros_like(x, dtype=np.float64), where=norm > 0)
    size = np.ones(n)
    alive = np.ones(n, bool)
    own = np.arange(n)  # the clusters that the rows of ``mean`` stand for
    merges = []
    chain: list[int] = []
    left = n
    while left > 1:
        if left < len(own) // 2 and not chain:
            mean, size, own = mean[alive], size[alive], own[alive]
            alive = np.ones(left, bool)
        if not chain:
            chain.append(int(alive.argmax()))
        a = chain[-1]
        row = 1 - mean @ mean[a]
        row[~alive] = np.inf
        row[a] = np.inf
        b = int(row.argmin())
        if row[b] >= cutoff:
            alive[chain.pop()] = False
            left -= 1
            continue
        if len(chain) > 1 and row[chain[-2]] <= row[b] + 1e-9:  # so that rounding makes no chain a circle
            b = chain[-2]
        if len(chain) > 1 and b == chain[-2]:
            chain = chain[:-2]
            merges.append((row[b], own[a], own[b]))
            mean[a] = (size[a] * mean[a] + size[b] * mean[b]) / (size[a] + size[b])
            size[a] += size[b]
            alive[b] = False
            left -= 1
        else:
            chain.append(b)
    # Average linkage is monotone, so all merges below the cutoff can be applied at once.
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for height, a, b in merges:
        if height < cutoff:
            root[find(b)] = find(a)
    label = np.array([find(i) for i in range(n)])
    _, first, inverse = np.unique(label, return_index=True, return_inverse=True)
    return np.argsort(np.argsort(first))[inverse]


def encode_metadata(values: pd.Series) -> np.ndarray:
    """Multi-hot columns of list-valued (or single) metadata in first-seen order; null is a category of its own."""
    lists = [[None] if v is None or (isinstance(v, float) and np.isnan(v)) else list(v) if isinstance(v, (list, tuple, np.ndarray)) else [v] for v in values]
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for ws in lists for w in ws))}
    out = np.zeros((len(lists), max(1, len(vocabulary))))
    for i, ws in enumerate(lists):
        for w in ws:
            out[i, vocabulary[w]] = 1
    return out


def build_tree(vectors: DataFrame, cutoff: float = 0.5, decay: float = 0.85, min_cutoff: float = 0.05, min_size: int = 5, max_depth: int = 12, weight: float = 0.0, max_group: int = 4000) -> DataFrame:
    """Leaves of the recursive clustering of ``vectors`` (chunk_id, embedding[, heading]): chunk_id, path.

    A group is split by average linkage at its cutoff; parts of at least ``min_size``
    are split again with the cutoff times ``decay``, one level deeper, until a group is
    small, the cutoff is under ``min_cutoff`` or the depth over ``max_depth``.  With
    ``weight`` the multi-hot headings of the group are appended.  One grouped pass per
    level; levels are bounded by ``max_depth``.

    Linkage of a group is exact at every size; it holds its vectors and takes quadratic
    time in one task.  ``max_group`` is accepted and does not change the tree.
    """
    with_heading = weight > 0 and "heading" in vectors.columns
    state = vectors.where(F.size("embedding") > 0).select("chunk_id", "embedding", *(["heading"] if with_heading else []), F.lit("0").alias("path"), F.lit(True).alias("open"))
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in state.schema)
    level = 0
    while level <= max_depth and cutoff >= min_cutoff:
        def split(pdf: pd.DataFrame, cutoff=cutoff) -> pd.DataFrame:
            pdf = pdf.sort_values("chunk_id", ignore_index=True)
            if not pdf["open"].iloc[0] or len(pdf) < min_size:
                return pdf.assign(open=False)
            x = np.stack(pdf["embedding"]).astype(np.float64)
            if with_heading:
                x = np.hstack([x, weight * encode_metadata(pdf["heading"])])
            own = average_linkage(x, cutoff)
            sizes = np.bincount(own)
            return pdf.assign(path=pdf["path"] + "." + own.astype(str), open=sizes[own] >= min_size)

        state = cut(state.groupBy("path").applyInPandas(_one_argument(split), columns))
        if state.where("open").isEmpty():
            break
        level += 1
        cutoff *= decay
    return renumber(state.select("chunk_id", "path"))


def _one_argument(fn):
    return lambda pdf: fn(pdf)


def renumber(leaves: DataFrame) -> DataFrame:
    """chunk_id and cluster_id: levels with a single child are dropped and children numbered without gaps by first member."""
    split = leaves.select("chunk_id", F.split("path", r"\.").alias("p"))
    prefixes = split.select("chunk_id", F.size("p").alias("depth"), F.posexplode(F.transform(F.sequence(F.lit(1), F.size("p")), lambda k: F.array_join(F.slice("p", F.lit(1), k), "."))).alias("pos", "prefix"))
    nodes = prefixes.groupBy("pos", "prefix").agg(F.min("chunk_id").alias("first")).withColumn("up", parent_id(F.col("prefix")))
    ranked = nodes.withColumn("n", F.row_number().over(Window.partitionBy("up").orderBy("first")) - 1).withColumn("siblings", F.count("*").over(Window.partitionBy("up")))
    label = ranked.select("prefix", "pos", F.when((F.col("siblings") > 1) | (F.col("pos") == 0), F.col("n").cast("string")).alias("part"))
    parts = prefixes.select("chunk_id", "prefix").join(label, "prefix").where("part is not null").groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("pos", "part"))).alias("x"))
    return parts.select("chunk_id", F.array_join(F.transform("x", lambda x: x["part"]), ".").alias("cluster_id"))


def nodes_of(leaf_chunks: DataFrame) -> DataFrame:
    """All nodes of a tree given by leaf_chunks: cluster_id, parent, level, size, is_leaf, children."""
    leaf = leaf_chunks.groupBy("cluster_id").agg(F.count("*").alias("n"))
    up = leaf.select("cluster_id", "n", F.explode(ancestors(F.col("cluster_id"))).alias("id"))
    nodes = up.groupBy("id").agg(F.sum("n").alias("size"), F.max((F.col("id") == F.col("cluster_id"))).alias("is_leaf"))
    children = nodes.select(parent_id(F.col("id")).alias("id")).groupBy("id").agg(F.count("*").alias("children"))
    return nodes.join(children, "id", "left").select(F.col("id").alias("cluster_id"), parent_id(F.col("id")).alias("parent"), level_of(F.col("id")).alias("level"), "size", "is_leaf", F.coalesce("children", F.lit(0).cast("long")).alias("children"))


# ---- checks and summaries ---------------------------------------------------------


def lossless_check(chunks: DataFrame, leaf_chunks: DataFrame) -> DataFrame:
    """One row: chunks stored, leaf entries, different leaf entries, missing and extra ones."""
    stored = chunks.select("chunk_id").distinct()
    placed = leaf_chunks.select("chunk_id").distinct()
    parts = [
        stored.agg(F.count("*").alias("v")).select(F.lit("stored").alias("what"), "v"),
        leaf_chunks.agg(F.count("chunk_id").alias("v")).select(F.lit("leaf_entries").alias("what"), "v"),
        placed.agg(F.count("*").alias("v")).select(F.lit("leaf_ids").alias("what"), "v"),
        stored.join(placed, "chunk_id", "left_anti").agg(F.count("*").alias("v")).select(F.lit("missing").alias("what"), "v"),
        placed.join(stored, "chunk_id", "left_anti").agg(F.count("*").alias("v")).select(F.lit("extra").alias("what"), "v"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def level_summary(nodes: DataFrame, leaf_chunks: DataFrame) -> DataFrame:
    """Per level: clusters, and different chunks in leaves of that level."""
    per = nodes.select(level_of(F.col("cluster_id")).alias("level")).groupBy("level").agg(F.count("*").alias("clusters"))
    chunks = leaf_chunks.groupBy(level_of(F.col("cluster_id")).alias("level")).agg(F.count_distinct("chunk_id").alias("leaf_chunks"))
    return per.join(chunks, "level", "left").na.fill(0, ["leaf_chunks"])


def node_flags(nodes: DataFrame) -> DataFrame:
    """Flags of each node (cluster_id, is_leaf): document cluster, kinds of children and siblings, level, padded id."""
    n = nodes.select("cluster_id", "is_leaf", parent_id(F.col("cluster_id")).alias("parent"))
    kids = n.where("parent is not null").groupBy(F.col("parent").alias("cluster_id")).agg(F.sum(F.col("is_leaf").cast("int")).alias("leaf_kids"), F.count("*").alias("kids"))
    all_ = n.join(kids.withColumnsRenamed({"cluster_id": "parent", "leaf_kids": "sib_leaves", "kids": "sibs"}), "parent", "left").join(kids, "cluster_id", "left").na.fill(0, ["leaf_kids", "kids", "sib_leaves", "sibs"])
    leaf = F.col("is_leaf").cast("int")
    return all_.select(
        "cluster_id", "is_leaf", (F.col("leaf_kids") > 0).alias("document_cluster"),
        (F.col("leaf_kids") == F.col("kids")).alias("all_child_leaf"), (F.col("leaf_kids") == 0).alias("all_child_internal"),
        (F.col("sib_leaves") - leaf > 0).alias("has_leaf_sibling"), (F.col("sibs") - F.col("sib_leaves") - (1 - leaf) > 0).alias("has_internal_sibling"),
        level_of(F.col("cluster_id")).alias("level"), padded_id(F.col("cluster_id")).alias("padded"),
    )


def token_rollup(leaf_chunks: DataFrame, chunks: DataFrame) -> DataFrame:
    """Per node: chunks, tokens and different documents of its subtree; chunks without a row or count weigh 0.

    Tokens are summed per leaf before the prefixes are exploded, so what is
    multiplied by the depth is one row per leaf and document.
    """
    per = leaf_chunks.join(chunks.select("chunk_id", "token_count", "document_name"), "chunk_id", "left").groupBy("cluster_id", "document_name").agg(F.count("*").alias("chunks"), F.sum(F.coalesce("token_count", F.lit(0))).alias("tokens"))
    up = per.select(F.explode(ancestors(F.col("cluster_id"))).alias("cluster_id"), "document_name", "chunks", "tokens")
    return up.groupBy("cluster_id").agg(F.sum("chunks").alias("chunks"), F.sum("tokens").alias("tokens"), F.count_distinct("document_name").alias("documents"))


def shares(leaf_chunks: DataFrame, chunks: DataFrame, column: str) -> DataFrame:
    """Per node and value of ``column`` (document or text class): tokens, total of the node and share in percent.

    Values that are null or empty count in the whole but have no row.
    """
    per = leaf_chunks.join(chunks.select("chunk_id", "token_count", F.col(column).alias("name")), "chunk_id", "left").groupBy("cluster_id", "name").agg(F.sum(F.coalesce("token_count", F.lit(0))).alias("tokens"))
    up = per.select(F.explode(ancestors(F.col("cluster_id"))).alias("cluster_id"), "name", "tokens").groupBy("cluster_id", "name").agg(F.sum("tokens").alias("tokens"))
    up = up.withColumn("total", F.sum("tokens").over(Window.partitionBy("cluster_id")))
    return up.withColumn("share", F.when(F.col("total") > 0, F.round(F.col("tokens") / F.col("total") * 100, 2)).otherwise(F.lit(0.0))).where("name is not null and name <> ''")


def share_list(shared: DataFrame) -> DataFrame:
    """Per node the shares as text, one line per name in order: ``name (12.5%)``."""
    percent = F.when(F.col("total") > 0, F.col("tokens") / F.col("total") * 100).otherwise(F.lit(0.0))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("name", F.bround(percent, 1).alias("p")))), lambda x: F.format_string("%s (%.1f%%)", x["name"], x["p"]))
    return shared.groupBy("cluster_id").agg(F.array_join(lines, "\n").alias("shares"))


def subtree(nodes: DataFrame, branch: str) -> DataFrame:
    """A node and all below it; raises when the tree lacks it."""
    found = nodes.where((F.col("cluster_id") == branch) | F.col("cluster_id").startswith(branch + "."))
    if found.isEmpty():
        raise KeyError(f"no cluster {branch}")
    return found


def preorder(nodes: DataFrame) -> DataFrame:
    return nodes.orderBy(path_of(F.col("cluster_id")))


def with_gaps_filled(ids: DataFrame) -> DataFrame:
    """All ids and the ancestors they imply: cluster_id, synthetic (true where no row has it)."""
    every = ids.select(F.explode(ancestors(F.col("cluster_id"))).alias("cluster_id")).distinct()
    return every.join(ids.select("cluster_id", F.lit(False).alias("known")).distinct(), "cluster_id", "left").select("cluster_id", F.col("known").isNull().alias("synthetic"))


def centroids(leaf_chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    """Per node the centroid as (cluster_id, pos, value): leaves the mean of their vectors, inner nodes the mean of their leaves' centroids."""
    values = leaf_chunks.join(vectors, "chunk_id").select("cluster_id", F.posexplode("embedding").alias("pos", "x"))
    leaf = values.groupBy("cluster_id", "pos").agg(F.avg(F.col("x").cast("double")).alias("value"))
    up = leaf.select(F.explode(ancestors(F.col("cluster_id"))).alias("cluster_id"), "pos", "value")
    return up.groupBy("cluster_id", "pos").agg(F.avg("value").alias("value"))


# ---- harmonising ------------------------------------------------------------------


def node_kinds(nodes: DataFrame) -> DataFrame:
    """Kind of each node (cluster_id, is_leaf): leaf, leaf_parent, group (leaves and leaf parents only, both present) or inner."""
    n = nodes.select("cluster_id", "is_leaf", parent_id(F.col("cluster_id")).alias("parent"))
    first = n.groupBy("parent").agg(F.min("is_leaf").alias("all_leaf"), F.max("is_leaf").alias("any_leaf"))
    mid = n.join(first.withColumnRenamed("parent", "cluster_id"), "cluster_id", "left").withColumn("leaf_parent", ~F.col("is_leaf") & F.coalesce("all_leaf", F.lit(False)))
    second = mid.groupBy("parent").agg(F.min(F.col("is_leaf") | F.col("leaf_parent")).alias("shallow"), F.max("leaf_parent").alias("any_lp"))
    full = mid.join(second.withColumnRenamed("parent", "cluster_id"), "cluster_id", "left")
    group = ~F.col("is_leaf") & F.coalesce("shallow", F.lit(False)) & F.coalesce("any_lp", F.lit(False)) & F.coalesce("any_leaf", F.lit(False))
    return full.select("cluster_id", F.when(F.col("is_leaf"), "leaf").when(F.col("leaf_parent"), "leaf_parent").when(group, "group").otherwise("inner").alias("kind"))


def big_groups(nodes: DataFrame, leaf_chunks: DataFrame, chunks: DataFrame, max_tokens: int = 5000) -> DataFrame:
    """Groups whose subtree has more than ``max_tokens`` tokens."""
    return node_kinds(nodes).where("kind = 'group'").join(token_rollup(leaf_chunks, chunks).select("cluster_id", "tokens"), "cluster_id").where(F.col("tokens") > max_tokens).select("cluster_id", "tokens")


def _similar(a, b) -> float:
    if a is None or b is None:
        return 0.0
    n = np.linalg.norm(a) * np.linalg.norm(b)
    return float(a @ b / n) if n else 0.0


def _mean(vs) -> np.ndarray | None:
    vs = [v for v in vs if v is not None]
    return np.mean(vs, axis=0) if vs else None


def balance(tokens: list[int], centers: list, max_tokens: int, min_tokens: int) -> list[list[int]]:
    """Groups of children under a token budget.

    A child over the budget stays alone; the others, largest first, each join the most
    similar group with room; then groups under the minimum join the most similar one,
    at most 50 times.
    """
    groups = [[i] for i, t in enumerate(tokens) if t > max_tokens]
    total = lambda g: sum(tokens[i] for i in g)
    center = lambda g: _mean([centers[i] for i in g])
    for i in sorted((i for i, t in enumerate(tokens) if t <= max_tokens), key=lambda i: -tokens[i]):
        room = [(-_similar(center(g), centers[i]), k) for k, g in enumerate(groups) if total(g) + tokens[i] <= max_tokens]
        if room:
            groups[min(room)[1]].append(i)
        else:
            groups.append([i])
    for _ in range(50):
        small = [(total(g), k) for k, g in enumerate(groups) if total(g) < min_tokens]
        if not small or len(groups) < 2:
            break
        k = min(small)[1]
        lost = groups[k]
        goal = min((-_similar(center(g), center(lost)), j) for j, g in enumerate(groups) if j != k)[1]
        groups[goal] += lost
        del groups[k]
    return groups


def harmonize(nodes: DataFrame, leaf_chunks: DataFrame, chunks: DataFrame, vectors: DataFrame, max_tokens: int = 5000, min_tokens: int = 1500) -> DataFrame:
    """New intermediate nodes for groups over budget: cluster_id, child, group, group_tokens, penalty.

    The children of one group (the branching of one node) are balanced together.
    """
    big = big_groups(nodes, leaf_chunks, chunks, max_tokens).select(F.col("cluster_id").alias("parent"))
    child = nodes.select("cluster_id", parent_id(F.col("cluster_id")).alias("parent")).join(big, "parent")
    center = centroids(leaf_chunks, vectors).groupBy("cluster_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"]).alias("center"))
    items = child.join(token_rollup(leaf_chunks, chunks).select("cluster_id", "tokens"), "cluster_id", "left").join(center, "cluster_id", "left")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(order=pdf["cluster_id"].map(lambda c: [int(p) for p in c.split(".")])).sort_values("order", ignore_index=True)
        tokens = [int(t) if t == t else 0 for t in pdf["tokens"]]
        groups = balance(tokens, [None if c is None else np.asarray(c) for c in pdf["center"]], max_tokens, min_tokens)
        rows = []
        for k, g in enumerate(groups):
            total = sum(tokens[i] for i in g)
            penalty = 5 * max(0, total - max_tokens) + 3 * max(0, min_tokens - total)
            rows += [(pdf["parent"].iloc[0], pdf["cluster_id"].iloc[i], k, total, penalty) for i in g]
        return pd.DataFrame(rows, columns=["cluster_id", "child", "group", "group_tokens", "penalty"])

    return items.groupBy("parent").applyInPandas(one, "cluster_id string, child string, group int, group_tokens long, penalty long")
