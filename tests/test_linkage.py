"""Average linkage against brute force, and both of its ways against each other."""

import random

import numpy as np
import pytest

from kinfold.operators import components, linkage, skew


def brute(edges, nodes, t):
    clusters = [frozenset([n]) for n in nodes]
    sim = {frozenset(e[:2]): e[2] for e in edges if e[2] >= t}

    def mean(p, q):
        return sum(sim.get(frozenset([x, y]), 0.0) for x in p for y in q) / (len(p) * len(q))

    while len(clusters) > 1:
        best, i, j = max(
            ((mean(clusters[i], clusters[j]), i, j) for i in range(len(clusters)) for j in range(i)),
            key=lambda x: x[0],
        )
        if best <= t:
            break
        merged = clusters[i] | clusters[j]
        clusters = [c for k, c in enumerate(clusters) if k not in (i, j)] + [merged]
    return set(clusters)


def graph(seed, n=24, m=70):
    rnd = random.Random(seed)
    nodes = [f"n{i:02d}" for i in range(n)]
    edges = {}
    for _ in range(m):
        a, b = sorted(rnd.sample(nodes, 2))
        edges[(a, b)] = rnd.random()
    return [(a, b, s) for (a, b), s in edges.items()]


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault((r["threshold"], r["cluster_id"]), set()).add(r["profile_id"])
    for (_, cid), members in out.items():
        assert cid == min(members)
    return out


@pytest.mark.parametrize("local_edges", [100_000, 5, 0])
def test_average_linkage_equals_brute_force(spark, monkeypatch, local_edges):
    monkeypatch.setattr(linkage, "LOCAL_EDGES", max(local_edges, 1))
    if local_edges == 0:
        monkeypatch.setattr(skew, "SALT_FROM", 0)
    edges = graph(7)
    nodes = sorted({x for e in edges for x in e[:2]})
    df = spark.createDataFrame(edges, "profile_id_1 string, profile_id_2 string, similarity double")
    thresholds = [0.05, 0.3, 0.6]
    clusters = found(linkage.average_linkage(df, thresholds))
    for t in thresholds:
        got = {frozenset(m) for (level, _), m in clusters.items() if level == t}
        assert got == brute(edges, nodes, t)


def test_no_pair_above_threshold_gives_singletons(spark):
    df = spark.createDataFrame([("a", "b", 0.2)], "profile_id_1 string, profile_id_2 string, similarity double")
    assert found(linkage.average_linkage(df, [0.5])) == {(0.5, "a"): {"a"}, (0.5, "b"): {"b"}}


def test_equal_to_threshold_does_not_merge(spark):
    df = spark.createDataFrame([("a", "b", 0.5)], "profile_id_1 string, profile_id_2 string, similarity double")
    assert len(found(linkage.average_linkage(df, [0.5]))) == 2


@pytest.mark.parametrize("salt_from", [1_000_000, 0])
def test_components_of_chain_star_and_shuffled_edges(spark, monkeypatch, salt_from):
    monkeypatch.setattr(skew, "SALT_FROM", salt_from)
    rnd = random.Random(3)
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(120)]
    star = [("s000", f"s{i:03d}") for i in range(1, 150)]
    edges = [(a, b) if rnd.random() < 0.5 else (b, a) for a, b in chain + star]
    rnd.shuffle(edges)
    nodes = sorted({x for e in edges for x in e}) + ["lonely"]
    got = components.connected_components(
        spark.createDataFrame(edges, "a string, b string"), spark.createDataFrame([(x,) for x in nodes], "profile_id string")
    )
    want = {x: {"c": "c000", "s": "s000", "l": "lonely"}[x[0]] for x in nodes}
    assert {r["profile_id"]: r["cluster_id"] for r in got.collect()} == want


def test_chains_equal_rounds():
    """the same labels, also where many means are equal."""
    rnd = random.Random(5)
    for n, m, kinds in ((6, 9, 1), (30, 300, 3), (40, 780, 1), (40, 780, 2), (60, 500, 50), (80, 200, 4)):
        ends = sorted(rnd.sample([(i, j) for i in range(n) for j in range(i + 1, n)], m))
        a, b = np.array(ends).T
        w = np.array([rnd.randint(1, kinds) / kinds * linkage.SCALE for _ in ends]) // 1
        ts = (0.0, 0.3, 0.5, 0.7)
        for t, label in zip(ts, linkage.merge_chain(a, b, w, ts, n)):
            assert label.tolist() == linkage.merge_chain(a, b, w, [t], n)[0].tolist() == linkage.merge_rounds(a, b, w, t, n).tolist()


def test_equal_similarities_do_not_take_a_round_for_each_node(spark, monkeypatch):
    """a dense group of near copies is merged in one task, not in Spark rounds, and not once more for every threshold."""
    monkeypatch.setattr(linkage, "_distributed", None)
    monkeypatch.setattr(linkage, "merge_rounds", lambda a, b, w, t, n, plain=linkage.merge_rounds: plain(a, b, w, t, n) if len(a) < 1000 else 1 / 0)
    edges = [(f"n{i:03}", f"n{j:03}", 0.5 + (i % 2 == j % 2) * 0.25) for i in range(460) for j in range(i + 1, 460)]
    df = spark.createDataFrame([*edges, ("x", "y", 0.4)], "profile_id_1 string, profile_id_2 string, similarity double")
    clusters = found(linkage.average_linkage(df, [0.3, 0.6, 0.9]))
    assert len(edges) > 100_000
    assert {k: len(v) for k, v in clusters.items() if len(v) > 1} == {(0.3, "n000"): 460, (0.3, "x"): 2, (0.6, "n000"): 230, (0.6, "n001"): 230}
    assert sum(len(v) for v in clusters.values()) == 3 * 462


@pytest.mark.parametrize("chain_from", [2, 1000])
@pytest.mark.parametrize("local_edges", [30, 100_000])
def test_levels_in_one_task_equal_brute_force(spark, monkeypatch, chain_from, local_edges):
    monkeypatch.setattr(linkage, "CHAIN_FROM", chain_from)
    monkeypatch.setattr(linkage, "LOCAL_EDGES", local_edges)
    edges = graph(11, 26, 60)
    nodes = sorted({x for e in edges for x in e[:2]})
    df = spark.createDataFrame(edges, "profile_id_1 string, profile_id_2 string, similarity double")
    thresholds = [0.7, 0.1, 0.4]
    clusters = found(linkage.average_linkage(df, thresholds))
    for t in thresholds:
        assert {frozenset(m) for (level, _), m in clusters.items() if level == t} == brute(edges, nodes, t)
