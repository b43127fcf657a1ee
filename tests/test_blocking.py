"""Exact set join and block refinement against brute force, and recall of the profile blocks."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks import queries
from kinfold.operators import blocking, refine
from kinfold.operators.setjoin import similar_sets
from kinfold.plans import inference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sets():
    rng = random.Random(3)
    made: dict[str, frozenset] = {}
    for i in range(240):
        if i % 3 and made:
            s = set(made[rng.choice(list(made))])
            for _ in range(rng.randint(0, 4)):
                if s and rng.random() < 0.5:
                    s.discard(rng.choice(sorted(s)))
                s.add(f"w{int(rng.paretovariate(0.7)) % 500}")
        else:
            s = {f"w{int(rng.paretovariate(0.6)) % 800}" for _ in range(rng.randint(1, 25))}
        made[f"p{i:03}"] = frozenset(s)
    # A token that all have, sets that differ only in how characters are divided among tokens, and many copies.
    made = {p: s | {"everywhere"} for p, s in made.items()}
    made |= {"q1": frozenset({"ab", "c"}), "q2": frozenset({"a", "bc"})} | {f"r{i:02}": frozenset({"x", "y", "z"}) for i in range(30)}
    return made


@pytest.mark.parametrize("threshold", [0.1, 0.3, 0.5, 0.8, 1.0])
def test_similar_sets(spark, sets, threshold):
    rows = [(p, t) for p, s in sets.items() for t in s]
    classes, pairs = similar_sets(spark.createDataFrame(rows, "profile_id string, token string").repartition(5), threshold)
    first: dict[frozenset, str] = {}
    for p in sorted(sets):
        first.setdefault(sets[p], p)
    assert sorted(map(tuple, classes.collect())) == sorted((p, first[s], len(s)) for p, s in sets.items())
    firsts, want = sorted(first.values()), []
    for i, p in enumerate(firsts):
        for q in firsts[i + 1 :]:
            n = len(sets[p] & sets[q])
            similarity = n / (len(sets[p]) + len(sets[q]) - n)
            if similarity >= threshold:
                want.append((p, q, n, similarity))
    assert sorted(map(tuple, pairs.collect())) == want


def test_similar_sets_of_nothing(spark):
    classes, pairs = similar_sets(spark.createDataFrame([], "profile_id string, token string"), 0.5)
    assert classes.count() == 0 and pairs.count() == 0
    with pytest.raises(ValueError):
        similar_sets(spark.createDataFrame([], "profile_id string, token string"), 0.0)


def refined(members, values, top, order):
    """Blocks and lost pairs by the rule, in plain Python; sampled blocks only by size."""
    blocks, lost = {}, Counter()
    pairs = lambda n: n * (n - 1) // 2
    open_ = {k: m for k, m in members.items() if len(m) > 1}
    for name in order:
        after = {}
        for k, m in open_.items():
            if len(m) <= top:
                blocks[k] = m
                continue
            parts = {}
            for p in m:
                v = values[p].get(name)
                parts.setdefault(f"{k}|{name}" + ("" if v is None else f"={v}"), []).append(p)
            gone = pairs(len(m)) - sum(pairs(len(x)) for x in parts.values())
            if gone:
                lost[k, f"split {name}"] = gone
            after |= {x: y for x, y in parts.items() if len(y) > 1}
        open_ = after
    for k, m in open_.items():
        blocks[k] = m
        if len(m) > top:
            lost[k, "sample"] = pairs(len(m)) - pairs(top)
    return blocks, lost


def test_refined_blocks(spark):
    rng = random.Random(1)
    values = {f"p{i:03}": {"a": rng.choice([None, "x", "y", ""]), "b": rng.choice([None, *"uvw"])} for i in range(400)}
    members = {"big": list(values), "small": ["p000", "p001"], "lone": ["p002"], "mid": sorted(values)[:90]}
    keys = spark.createDataFrame([(k, p) for k, m in members.items() for p in m], "block_key string, profile_id string").repartition(4)
    rows = spark.createDataFrame([(p, v["a"], v["b"]) for p, v in values.items()], "profile_id string, a string, b string")
    got, ledger = refine.refine_blocks(keys, rows, 30, ("a", "b"))
    want, lost = refined(members, values, 30, ("a", "b"))
    found: dict[str, set] = {}
    for r in got.collect():
        found.setdefault(r["block_key"], set()).add(r["profile_id"])
    assert {k: len(m) for k, m in found.items()} == {k: min(len(m), 30) for k, m in want.items()}
    assert all(m <= set(want[k]) for k, m in found.items())
    assert {(r["block_key"], r["rule"]): r["pairs_lost"] for r in ledger.collect()} == dict(lost)
    assert any(rule == "sample" for _, rule in lost)


def test_ledger_of_published_limits(spark):
    keys = spark.range(500).select(F.explode(F.array(F.lit("dom::x"), F.lit("site::y"))).alias("block_key"), F.col("id").cast("string").alias("profile_id"))
    got = {r["block_key"]: (r["rule"], r["size"], r["kept"], r["pairs_lost"]) for r in refine.dropped_blocks(keys, 300, 150).collect()}
    assert got == {"dom::x": ("sample", 500, 300, 500 * 499 // 2 - 300 * 299 // 2), "site::y": ("site_stop", 500, 0, 500 * 499 // 2)}


@pytest.mark.parametrize("rule", [refine.PUBLISHED, refine.REFINED, refine.BlockRule(12, None, refine.REFINED.split_by)])
def test_recall_of_profile_blocks(spark, rule):
    people = queries.people(spark, SF)
    row = blocking.blocking_recall(inference.candidates(people, rule, labeled=True), people.rows).first()
    assert row["total"] > 0 and row["recall"] >= 0.95
