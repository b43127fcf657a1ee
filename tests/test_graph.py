"""Forests inside tasks, components from them, and sweeps that join a pair once."""

import random

import numpy as np
import pyarrow as pa
import pytest

from kinfold.operators import components, graph, review


def labels(edges):
    """The smallest node of each component, one edge at a time."""
    at = {x: x for e in edges for x in e}
    for _ in at:
        moved = [(e, min(at[e[0]], at[e[1]])) for e in edges if at[e[0]] != at[e[1]]]
        if not moved:
            break
        for e, low in moved:
            at[e[0]] = at[e[1]] = low
    return at


def test_spanning_forest():
    rng = random.Random(1)
    for n, m in ((2, 1), (50, 40), (60, 400), (200, 199)):
        a, b = np.array([rng.sample(range(n), 2) for _ in range(m)]).T
        kept, label = graph.spanning(a, b, n)
        want = labels(list(zip(a.tolist(), b.tolist())))
        assert all(label[x] == want.get(x, x) for x in range(n))
        assert labels(list(zip(a[kept].tolist(), b[kept].tolist()))) == want
        assert len(kept) == n - len(set(label.tolist()))


def test_codes_keep_the_order():
    words = ["b", None, "Я", "a", "aa", "b", "", "\U0001f600", "￮"]
    got = graph.codes(pa.array(words))
    order = sorted(range(len(words)), key=lambda i: (words[i] is not None, (words[i] or "").encode()))
    assert [got[i] for i in order] == sorted(got) and got[0] == got[5] and len(set(got)) == 8
    pairs = [{"t": 0.5, "id": "b"}, {"t": 0.25, "id": "c"}, {"t": 0.5, "id": "a"}, {"t": 0.25, "id": "c"}]
    assert graph.codes(pa.array(pairs, pa.struct({"t": pa.float64(), "id": pa.string()}))).tolist() == [2, 0, 1, 0]


def test_forest_keeps_components_of_many_batches(monkeypatch):
    monkeypatch.setattr(graph, "AT_ONCE", 150)
    rng = random.Random(2)
    edges = [tuple(sorted(rng.sample([f"n{i // 12:02}{i:03}" for i in range(k * 12, k * 12 + 12)], 2))) for k in [rng.randrange(10) for _ in range(900)]]
    batches = [pa.RecordBatch.from_pydict({"hi": [b for _, b in edges[i : i + 7]], "lo": [a for a, _ in edges[i : i + 7]]}) for i in range(0, 900, 7)]
    left = [(a, b) for x in graph.forest(iter(batches)) for b, a in zip(x["hi"].to_pylist(), x["lo"].to_pylist())]
    assert labels(left) == labels(edges) and len(left) == 110


@pytest.mark.parametrize("one_task", [0, 1_000])
def test_dense_groups_reach_the_rounds_as_forests(spark, monkeypatch, one_task):
    """tasks cut edges before any shuffle, and few edges need no rounds."""
    monkeypatch.setattr(components, "ONE_TASK_EDGES", one_task)
    seen, plain = [], components._state
    monkeypatch.setattr(components, "_state", lambda edges: seen.append(plain(edges)) or seen[-1])
    made = [(k, f"n{i}", f"n{j}") for k in (0.5, 0.25) for i in range(10, 50) for j in range(i + 1, 50) if i % 4 == j % 4]
    table = spark.createDataFrame(made, "t double, p string, q string").repartition(2)
    edges = table.selectExpr("struct(t, p as id) as a", "struct(t, q as id) as b")
    got = {(r["hi"]["t"], r["hi"]["id"]): (r["lo"]["t"], r["lo"]["id"]) for r in components.star_edges(edges).collect()}
    assert got == {(k, f"n{i}"): (k, f"n{10 + (i - 10) % 4}") for k in (0.5, 0.25) for i in range(14, 50)}
    assert seen[0][0] <= 2 * 72 < len(made) / 2 and (len(seen) == 1) == (one_task > 0)


def test_sweep_joins_a_pair_once(spark):
    """clusters of all thresholds come in one row per profile, so pairs aren't shuffled threshold by threshold."""
    rng = random.Random(3)
    clusters = [(t, f"p{i}", f"p{i // k}") for t, k in ((0.1, 6), (0.4, 3), (0.8, 1)) for i in range(24)] + [(None, "p0", "p0"), (0.1, "p30", None), (0.4, "p3", "p1")]
    pairs = [(f"p{i}", f"p{j}", rng.random()) for i in range(24) for j in range(i + 1, 24)] + [("p0", "p30", 0.5), (None, "p1", 0.2)]
    left = spark.createDataFrame(clusters, "threshold double, profile_id string, cluster_id string")
    right = spark.createDataFrame(pairs, "profile_id_1 string, profile_id_2 string, similarity double")
    found = review.cluster_quality(left, right)
    got = {r["threshold"]: (r["fp_count"], r["total_pairs"]) for r in found.collect()}
    inner = [(t, s) for p, q, s in pairs for t, x, c in clusters for u, y, d in clusters if (x, y) == (p, q) and t == u and c == d and None not in (t, c)]
    assert got == {t: (sum(u == t and s < t * review.SUSPICIOUS_FACTOR for u, s in inner), sum(u == t for u, _ in inner)) for t in {u for u, _ in inner}}
    joins = [x for x in found._jdf.queryExecution().analyzed().toString().splitlines() if "Join" in x]
    assert len(joins) == 2 and not any("threshold" in x for x in joins)
