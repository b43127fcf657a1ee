"""Connected components and cluster tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AUTO_MERGE_THRESHOLD, REVIEW_THRESHOLD
from ..session import cut_lineage
from . import graph, skew
from .blocking import attach_both

from .skew import lookup_join

# Names of the three decisions.
AUTO_MERGE = "AUTO_MERGE"
REVIEW = "REVIEW"
KEEP_SEPARATE = "KEEP_SEPARATE"
# End of fixed values.

MAX_ROUNDS = 100
#: Edges left by the forests of all tasks that one task may finish; with names of 12 letters a few hundred MB.
ONE_TASK_EDGES = 1_500_000


def action(
    prob: Column, auto: float = AUTO_MERGE_THRESHOLD, review: float = REVIEW_THRESHOLD
) -> Column:
    """M4: decision for a probability."""
    return F.when(prob >= auto, AUTO_MERGE).when(prob >= review, REVIEW).otherwise(KEEP_SEPARATE)


def accepted_edges(scored: DataFrame, min_action: str = AUTO_MERGE) -> DataFrame:
    """G1: AUTO_MERGE pairs only, or REVIEW pairs too."""
    accepted = [AUTO_MERGE] if min_action == AUTO_MERGE else [AUTO_MERGE, REVIEW]
    return scored.filter(F.col("action").isin(accepted)).select("profile_id_1", "profile_id_2")


def _state(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    smallest = edges.groupBy("hi").agg(F.min("lo").alias("m")).withColumnRenamed("hi", "lo")
    joined = lookup_join(edges, smallest, "lo", "hi", n, "left")
    return joined.select("hi", F.coalesce("m", "lo").alias("lo"))


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    smallest = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = lookup_join(edges, smallest, "hi", "lo", n).filter("lo <> m")
    return moved.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).unionByName(
        smallest.select("hi", F.col("m").alias("lo"))
    )


def star_edges(edges: DataFrame) -> DataFrame:
    """Edges ``(hi, lo)`` where ``lo`` is the smallest node of the component of ``hi``.

    Every task first cuts its edges to a forest with the same components, which is a small part of them where groups
    are dense. Up to ``ONE_TASK_EDGES`` edges are then finished in one task, more of them by alternating large-star and small-star
    (Kiveris et al. 2014). Each round is stored, so a lost executor repeats one round at most and the plan does not grow.
    """
    a, b = edges.columns[:2]
    ends = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).filter("hi <> lo")
    known = graph.numbered(ends.schema["hi"].dataType)
    current = cut_lineage((ends.mapInArrow(graph.forest, ends.schema) if known else ends).distinct())
    state = _state(current)
    if known and 0 < state[0] <= ONE_TASK_EDGES:
        return cut_lineage(current.coalesce(1).mapInArrow(graph.stars, current.schema))
    for _ in range(MAX_ROUNDS):
        if state[0] == 0:
            return current
        n = state[0]
        linked = _large_star(current, n).distinct()
        if n >= skew.SALT_FROM:
            linked = cut_lineage(linked)
        current = cut_lineage(_small_star(linked, n).distinct())
        previous, state = state, _state(current)
        if state == previous:
            return current
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def connected_components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(profile_id, cluster_id)`` for all nodes; the id is the smallest member."""
    stars = star_edges(edges)
    return nodes.select("profile_id").join(
        stars.select(F.col("hi").alias("profile_id"), "lo"), "profile_id", "left"
    ).select("profile_id", F.coalesce("lo", "profile_id").alias("cluster_id"))


def extend_components(clusters: DataFrame, new_edges: DataFrame, new_nodes: DataFrame | None = None) -> DataFrame:
    """Add edges to an existing cluster map by joining whole clusters."""
    if new_nodes is not None:
        fresh = new_nodes.select("profile_id").join(clusters, "profile_id", "left_anti")
        clusters = clusters.unionByName(fresh.select("profile_id", F.col("profile_id").alias("cluster_id")))
    a, b = new_edges.columns[:2]
    ends = new_edges.select(F.col(a).alias("profile_id_1"), F.col(b).alias("profile_id_2"))
    contracted = attach_both(ends, clusters, ["cluster_id"]).select(
        F.coalesce("cluster_id_1", "profile_id_1").alias("a"), F.coalesce("cluster_id_2", "profile_id_2").alias("b")
    )
    stars = star_edges(contracted)
    # A cluster may be large, so its members are spread while looking up the new id.
    moved = stars.select(F.col("hi").alias("cluster_id"), "lo")
    return lookup_join(clusters, moved, "cluster_id", "profile_id", clusters.count(), "left").select(
        "profile_id", F.coalesce("lo", "cluster_id").alias("cluster_id")
    )


def cluster_sizes(clusters: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Members per cluster (order by size to read it)."""
    return clusters.groupBy(*by, "cluster_id").agg(F.count(F.lit(1)).alias("size"))


def inference_summary(profiles: DataFrame, scored: DataFrame, clusters: DataFrame) -> DataFrame:
    """One row of counts, zeros when there are no pairs."""
    people = profiles.agg(F.count(F.lit(1)).alias("n_profiles"))
    pairs = scored.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.count_if(F.col("action") == AUTO_MERGE).alias("n_auto"),
        F.count_if(F.col("action") == REVIEW).alias("n_review"),
    )
    groups = cluster_sizes(clusters).agg(F.count_if(F.col("size") > 1).alias("n_clusters_with_dups"))
    # Three single rows.
    return people.join(F.broadcast(pairs)).join(F.broadcast(groups))


def size_truth_vs_predicted(profiles: DataFrame, clusters: DataFrame) -> DataFrame:
    """Number of true and predicted groups per size above one."""
    true = (
        profiles.filter(F.col("entity_id").isNotNull())
        .groupBy("entity_id")
        .agg(F.count(F.lit(1)).alias("size"))
        .filter("size > 1")
        .groupBy("size")
        .agg(F.count(F.lit(1)).alias("n_true"))
    )
    predicted = cluster_sizes(clusters).filter("size > 1").groupBy("size").agg(
        F.count(F.lit(1)).alias("n_predicted")
    )
    return true.join(predicted, "size", "full").select(
        "size",
        F.coalesce("n_true", F.lit(0)).alias("n_true"),
        F.coalesce("n_predicted", F.lit(0)).alias("n_predicted"),
    )


BROWSE_COLS = ("email", "phone", "first_name")


def browse_pairs(
    scored: DataFrame, profiles: DataFrame, actions: Sequence[str], min_prob: float, top: int = 500
) -> DataFrame:
    """The best pairs with contact columns of both sides."""
    best = (
        scored.filter(F.col("action").isin(list(actions)) & (F.col("prob_match") >= min_prob))
        .orderBy(F.desc("prob_match"), "profile_id_1", "profile_id_2")
        .limit(top)
    )
    return attach_both(best, profiles, BROWSE_COLS)


def largest_clusters(clusters: DataFrame, top: int = 50) -> DataFrame:
    """Clusters with more than one member, largest first."""
    return cluster_sizes(clusters).filter("size > 1").orderBy(F.desc("size"), "cluster_id").limit(top)


def cluster_members(clusters: DataFrame, profiles: DataFrame, chosen: DataFrame) -> DataFrame:
    """Profile rows of the chosen clusters (a top list, hence the broadcast)."""
    members = clusters.join(F.broadcast(chosen.select("cluster_id")), "cluster_id", "left_semi")
    return members.join(profiles, "profile_id")


def pairs_in_clusters(scored: DataFrame, clusters: DataFrame) -> DataFrame:
    """Scored pairs whose sides are in one cluster."""
    return attach_both(scored, clusters, ["cluster_id"]).filter("cluster_id_1 = cluster_id_2").select(
        *scored.columns, F.col("cluster_id_1").alias("cluster_id")
    )
