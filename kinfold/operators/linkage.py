"""Average-linkage clustering of scored pairs.

Average linkage is reducible: merging two clusters never brings the result closer to a
third one than the nearer of them was. All pairs of clusters that are each other's nearest
can therefore merge in one round and give the tree of the one-merge-at-a-time algorithm.
Only edges are kept, never a matrix of all pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import skew
from .components import star_edges
from .graph import codes
from .skew import lookup_join

MAX_ROUNDS = 10_000
#: Similarities are added as whole numbers of this size, so sums don't depend on their order.
SCALE = 1 << 30
# Components up to this many edges merge inside one task (some 100 bytes each), larger ones in Spark rounds; smaller ones share a task of about BUCKET_EDGES.
LOCAL_EDGES, BUCKET_EDGES = 8_000_000, 200_000
# Components of so many nodes merge in chains instead of in rounds, of which equal similarities make very many.
CHAIN_FROM = 32


def scaled(similarity: Column) -> Column:
    return F.floor(similarity * SCALE + 0.5)


def merge_rounds(a: np.ndarray, b: np.ndarray, w: np.ndarray, t: float, n: int) -> np.ndarray:
    """Cluster label of ``n`` nodes; ``a < b`` are edge ends, ``w`` summed similarities in units of 1 / ``SCALE``."""
    limit = np.floor(t * SCALE + 0.5)
    label, size = np.arange(n), np.ones(n)
    while len(a):
        mean = w / (size[a] * size[b])
        close = mean > limit
        if not close.any():
            break
        order = np.lexsort((b[close], a[close], -mean[close]))
        x, y = a[close][order], b[close][order]
        rank = np.arange(len(x))
        nearest = np.full(n, len(x))
        np.minimum.at(nearest, x, rank)
        np.minimum.at(nearest, y, rank)
        mutual = (nearest[x] == rank) & (nearest[y] == rank)
        into = np.arange(n)
        into[y[mutual]] = x[mutual]
        size[x[mutual]] += size[y[mutual]]
        label = into[label]
        p, q = into[a], into[b]
        live = p != q
        code, where = np.unique(np.minimum(p, q)[live] * n + np.maximum(p, q)[live], return_inverse=True)
        w = np.bincount(where, weights=w[live])
        a, b = code // n, code % n
    return label


def merge_chain(a: np.ndarray, b: np.ndarray, w: np.ndarray, ts: Sequence[float], n: int) -> list[np.ndarray]:
    """``merge_rounds`` for several limits on the same edges, by chains of nearest neighbours: about ``3 n`` looks at the edges of one cluster, however alike the nodes are.

    The order of pairs (mean, then the smaller end, then the larger) is the same, so the nearest of a cluster is the first of the largest means.
    Clusters merge as lists of edges; a list learns of other merges when it is looked at. No merge is nearer than those it builds on, so the merges
    above a higher limit are among those above the lowest.
    """
    limit = np.floor(min(ts) * SCALE + 0.5)
    ends, others = np.concatenate([a, b]), np.concatenate([b, a])
    order = np.lexsort((others, ends))
    cuts = np.cumsum(np.bincount(ends, minlength=n))[:-1]
    ids, sums = np.split(others[order], cuts), np.split(np.concatenate([w, w])[order], cuts)
    into, size, open_ = np.arange(n), np.ones(n), np.ones(n, bool)

    merges = []

    def nearest(x: int) -> tuple[int, float]:
        """The nearest cluster and its mean; -1 if none is above the limit."""
        now = into[ids[x]]
        while not np.array_equal(now, further := into[now]):
            now = further
        if len(now) and (now != ids[x]).any():
            into[ids[x]] = now
            now, where = np.unique(now, return_inverse=True)
            added, rest = np.bincount(where, weights=sums[x]), now != x
            ids[x], sums[x] = now[rest], added[rest]
        # The same division as in the rounds, so that equal means stay equal.
        mean = sums[x] / (size[x] * size[ids[x]])
        best = int(mean.argmax()) if len(mean) else -1
        return (int(ids[x][best]), float(mean[best])) if best >= 0 and mean[best] > limit else (-1, 0.0)

    for start in range(n):
        chain = [start]
        while open_[start]:
            x = chain[-1]
            y, mean = nearest(x)
            if y < 0:
                # Merging others never brings them nearer.
                open_[x] = False
                chain.pop()
            elif len(chain) > 1 and y == chain[-2]:
                del chain[-2:]
                x, y = min(x, y), max(x, y)
                merges.append((x, y, mean))
                ids[x], sums[x] = np.concatenate([ids[x], ids[y]]), np.concatenate([sums[x], sums[y]])
                ids[y] = sums[y] = None
                size[x] += size[y]
                into[y], open_[y] = x, False
            else:
                chain.append(y)
            chain = chain or [start]
    kept, gone, means = (np.array(x) for x in zip(*merges)) if merges else (np.zeros(0, int),) * 3
    out = []
    for t in ts:
        label, near = np.arange(n), means > np.floor(t * SCALE + 0.5)
        label[gone[near]] = kept[near]
        while not np.array_equal(label, further := label[label]):
            label = further
        out.append(label)
    return out


def _clusters(root: np.ndarray, a: np.ndarray, b: np.ndarray, w: np.ndarray, ts: Sequence[float], n: int) -> list[np.ndarray]:
    """Cluster labels of ``n`` nodes in components ``root``, for each limit: components of many nodes one by one in chains, the others together in rounds."""
    component = np.zeros(n, np.int64)
    component[a] = component[b] = root
    used = np.zeros(n, bool)
    used[a] = used[b] = True
    large = (np.bincount(component[used], minlength=int(root.max(initial=0)) + 1) >= CHAIN_FROM)[root]
    labels = [merge_rounds(a[~large], b[~large], w[~large], t, n) for t in ts]
    order = np.argsort(root[large], kind="stable")
    p, q, v, r = (x[large][order] for x in (a, b, w, root))
    for x, y, z in zip(*(np.split(x, np.flatnonzero(np.diff(r)) + 1) for x in (p, q, v))):
        ids, code = np.unique(np.concatenate([x, y]), return_inverse=True)
        if len(ids):
            for label, found in zip(labels, merge_chain(*np.split(code, 2), z, ts, len(ids))):
                label[ids] = ids[found]
    return labels


def _merge_bucket(thresholds: Sequence[float]):
    def merge(edges: pa.Table) -> pa.Table:
        ends = pa.concat_arrays([x for side in "ab" for x in edges[side].chunks])
        ids, place, number = np.unique(codes(ends), return_index=True, return_inverse=True)
        a, b = np.split(number, 2)
        names = ends.take(pa.array(place))
        root = np.unique(edges["root"].to_numpy(), return_inverse=True)[1]
        similarity, w, level = (edges[c].to_numpy() for c in ("similarity", "w", "t"))
        alike, out = [], []
        for t in thresholds:
            # Edges of one level, or of all of them (null, read as NaN). Several levels may have the same ones.
            here = np.flatnonzero((similarity >= t) & ((level == t) | np.isnan(level)))
            if alike and np.array_equal(alike[-1][0], here):
                alike[-1][1].append(t)
            else:
                alike.append((here, [t]))
        for here, ts in alike:
            nodes = np.unique(np.concatenate([a[here], b[here]]))
            for t, label in zip(ts, _clusters(root[here], a[here], b[here], w[here].astype(np.float64), ts, len(ids))):
                columns = [pa.array(np.full(len(nodes), t)), names.take(pa.array(nodes)), names.take(pa.array(label[nodes]))]
                out.append(pa.Table.from_arrays(columns, ["t", "id", "cluster"]))
        return pa.concat_tables(out)

    return merge


def _local(edges: DataFrame, thresholds: Sequence[float], n_edges: int) -> DataFrame:
    """Whole components, many per task; a component here has at most ``LOCAL_EDGES`` edges.

    ``edges`` is ``(root, a, b, similarity, w, t)`` with plain ids; without ``t`` an edge takes part in all levels it reaches.
    """
    buckets = n_edges // BUCKET_EDGES + 8
    flat = edges.select(F.pmod("root", F.lit(buckets)).alias("bucket"), "root", "a", "b", "similarity", "w", "t")
    merged = flat.groupBy("bucket").applyInArrow(_merge_bucket(thresholds), "t double, id string, cluster string")
    return merged.select(
        F.struct("t", "id").alias("node"), F.struct("t", F.col("cluster").alias("id")).alias("cluster")
    )


def _rooted(edges: DataFrame, n_edges: int) -> DataFrame:
    """``edges`` with the smallest node ``root`` of their component and its number of edges ``n``."""
    # The larger end of an edge is never the smallest node of its component.
    roots = star_edges(edges.select("a", "b")).select(F.col("hi").alias("b"), F.col("lo").alias("root"))
    # Edges are counted by node first, so sizes take no second join of all edges.
    counts = edges.groupBy("b").agg(F.count(F.lit(1)).alias("n")).join(roots, "b")
    sizes = counts.groupBy("root").agg(F.sum("n").alias("n"))
    return cut_lineage(lookup_join(edges, cut_lineage(roots.join(sizes, "root")), "b", "a", n_edges))


def _relabel(edges: DataFrame, moves: DataFrame, side: str, n: int) -> DataFrame:
    """New cluster key and size for one end of every edge."""
    other = "b" if side == "a" else "a"
    moves = moves.select(F.col("old").alias(side), F.col("new").alias("_new"), F.col("size").alias("_size"))
    out = lookup_join(edges, moves, side, other, n, "left")
    return out.withColumn(f"n{side}", F.coalesce("_size", f"n{side}")).withColumn(
        side, F.coalesce("_new", side)
    ).drop("_new", "_size")


def _distributed(edges: DataFrame) -> DataFrame:
    """The same rounds as Spark jobs, for components too large for one task."""
    one = F.lit(1).cast("bigint")
    edges = cut_lineage(edges.select("root", "a", "b", "w", one.alias("na"), one.alias("nb")))
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    members = cut_lineage(nodes.select("node", F.col("node").alias("cluster")))
    n_members = members.count()
    for _ in range(MAX_ROUNDS):
        close = edges.withColumn("s", F.col("w") / (F.col("na") * F.col("nb"))).filter(F.col("s") > scaled(F.col("a.t")))
        ends = close.select(
            F.explode(F.array("a", "b")).alias("u"),
            F.struct((-F.col("s")).alias("d"), "a", "b", (F.col("na") + F.col("nb")).alias("size")).alias("e"),
        )
        nearest = ends.groupBy("u").agg(F.min("e").alias("e"))
        mutual = nearest.groupBy("e.a", "e.b", "e.size").agg(F.count(F.lit(1)).alias("_n")).filter("_n = 2")
        moves = cut_lineage(
            mutual.select(F.explode(F.array("a", "b")).alias("old"), F.col("a").alias("new"), "size")
        )
        if moves.isEmpty():
            return members
        # Components without a pair above the limit are finished; there are few large components.
        edges = cut_lineage(edges.join(close.select("root").distinct(), "root", "left_semi"))
        n_edges = edges.count()
        half = _relabel(edges, moves, "a", n_edges)
        if n_edges >= skew.SALT_FROM:
            half = cut_lineage(half)
        moved = _relabel(half, moves, "b", n_edges).filter("a <> b")
        ordered = F.col("a") < F.col("b")
        edges = cut_lineage(
            moved.select(
                "root",
                F.least("a", "b").alias("a"),
                F.greatest("a", "b").alias("b"),
                "w",
                F.when(ordered, F.col("na")).otherwise(F.col("nb")).alias("na"),
                F.when(ordered, F.col("nb")).otherwise(F.col("na")).alias("nb"),
            )
            .groupBy("root", "a", "b")
            .agg(F.sum("w").alias("w"), F.max("na").alias("na"), F.max("nb").alias("nb"))
        )
        lookup = moves.select(F.col("old").alias("cluster"), "new")
        members = cut_lineage(
            lookup_join(members, lookup, "cluster", "node", n_members, "left").select(
                "node", F.coalesce("new", "cluster").alias("cluster")
            )
        )
    raise RuntimeError(f"linkage did not settle in {MAX_ROUNDS} rounds")


def average_linkage(pairs: DataFrame, thresholds: Sequence[float], nodes: DataFrame | None = None) -> DataFrame:
    """``(threshold, profile_id, cluster_id)``; all thresholds run together.

    ``pairs`` is ``(profile_id_1, profile_id_2, similarity)``, each pair once; ``nodes`` has ``profile_id`` of
    all profiles, without it only paired ones are listed. Pairs below a
    threshold count as similarity 0; clusters merge while their mean similarity is above it,
    so nothing merges across components and each component can be solved where it fits.
    """
    levels = F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("t")
    thresholds = sorted({float(t) for t in thresholds})
    # Components of the lowest level hold those of all others, so edges are shuffled once and not for every level.
    lowest = min(thresholds)
    ends = [f("profile_id_1", "profile_id_2").alias(c) for f, c in ((F.least, "a"), (F.greatest, "b"))]
    similarity = F.col("similarity").cast("double")
    edges = pairs.filter(F.col("similarity") >= lowest).select(*ends, similarity.alias("similarity"), scaled(similarity).alias("w"))
    edges = cut_lineage(edges.filter("a <> b"))
    n_edges = edges.count()
    rooted = _rooted(edges, n_edges)
    number = F.xxhash64("root").alias("root")
    merged = _local(
        rooted.filter(F.col("n") <= LOCAL_EDGES).select(number, "a", "b", "similarity", "w", F.lit(None).cast("double").alias("t")),
        thresholds, n_edges,
    )
    large = rooted.filter(F.col("n") > LOCAL_EDGES)
    if not large.isEmpty():
        # What is too large at the lowest level may fall into smaller components at a higher one.
        wide = large.select(levels, "a", "b", "similarity", "w").filter("similarity >= t")
        wide = cut_lineage(wide.select(*[F.struct("t", F.col(c).alias("id")).alias(c) for c in "ab"], "similarity", "w"))
        n_wide = wide.count()
        by_level = _rooted(wide, n_wide)
        plain = ["a.t", F.col("a.id").alias("a"), F.col("b.id").alias("b"), "similarity", "w"]
        merged = merged.unionByName(_local(by_level.filter(F.col("n") <= LOCAL_EDGES).select(number, *plain), thresholds, n_wide))
        rest = by_level.filter(F.col("n") > LOCAL_EDGES)
        if not rest.isEmpty():
            merged = merged.unionByName(_distributed(rest))
    if nodes is None:
        listed = pairs.select(F.explode(F.array("profile_id_1", "profile_id_2")).alias("id")).distinct()
    else:
        listed = nodes.select(F.col("profile_id").alias("id")).distinct()
    return listed.select(levels, "id").select(F.struct("t", "id").alias("node")).join(merged, "node", "left").select(
        F.col("node.t").alias("threshold"),
        F.col("node.id").alias("profile_id"),
        F.coalesce("cluster.id", "node.id").alias("cluster_id"),
    )
