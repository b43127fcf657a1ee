"""Comparison of chunks inside tasks, and pairs of blocks spread over tasks, against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from kinfold.operators import blocking, setcells, setjoin


def chunk(sets):
    return setcells.Chunk(
        np.array([s for s, _ in sets], np.int64), np.array([len(w) for _, w in sets], np.int64), np.array([x for _, w in sets for x in w], np.int32)
    )


@pytest.mark.parametrize("at_once", [1, 50, 4_000_000])
@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.7, 1.0])
def test_similar_rows(monkeypatch, threshold, at_once):
    monkeypatch.setattr(setcells, "AT_ONCE", at_once)
    rng = random.Random(7)
    made = []
    for _ in range(120):
        words = set(rng.choice(made)[1]) if made and rng.random() < 0.6 else {int(rng.paretovariate(0.5)) % 300 for _ in range(rng.randint(1, 60))}
        words |= {rng.randrange(300) for _ in range(rng.randint(0, 5))}
        # Some tokens are shared by no other set.
        made.append((len(words) + rng.randint(0, 3), sorted(words)))
    # As in a chunk: too few shared words have no partner.
    made = sorted((s for s in made if len(s[1]) >= threshold * s[0]), key=lambda s: s[0])
    for left, right, same in ((made, made, True), (made[:60], made[60:], False)):
        got = {(int(i), int(j)): int(k) for x, y, n in setcells.similar_rows(chunk(left), chunk(right), threshold, same) for i, j, k in zip(x, y, n)}
        want = {}
        for i, (s, w) in enumerate(left):
            for j, (u, v) in enumerate(right):
                n = len(set(w) & set(v))
                if (i < j or not same) and n / (s + u - n) >= threshold:
                    want[i, j] = n
        assert got == want


def test_many_chunks_and_repeated_rows(spark, monkeypatch):
    """Sets dealt into many chunks; rows that come twice count in the size, not in the overlap."""
    monkeypatch.setattr(setjoin, "CHUNK_LEAST", 200)
    rng = random.Random(5)
    sets = {f"p{i:02}": {f"w{int(rng.paretovariate(0.7)) % 40}" for _ in range(rng.randint(1, 30))} for i in range(90)}
    rows = [(p, t) for p, s in sets.items() for t in s]
    rows += [(p, t) for p, t in rows if p < "p20"]
    classes, pairs = setjoin.similar_sets(spark.createDataFrame(rows, "profile_id string, token string").repartition(3), 0.3)
    first = sorted({r["class_id"] for r in classes.collect()})
    size = {p: len(sets[p]) * (2 if p < "p20" else 1) for p in sets}
    want = []
    for i, p in enumerate(first):
        for q in first[i + 1 :]:
            n = len(sets[p] & sets[q])
            if n / (size[p] + size[q] - n) >= 0.3:
                want.append((p, q, n, n / (size[p] + size[q] - n)))
    assert sorted(map(tuple, pairs.collect())) == want


def test_tokens_are_not_written_again(spark, monkeypatch):
    """Steps write packed sets, no copy of the long table; tokens beyond the frequent ones give the same pairs."""
    written, plain_store = [], setjoin.store

    def store(df, name="table"):
        out = plain_store(df, name)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(setjoin, "store", store)
    rng = random.Random(9)
    sets = {f"p{i:02}": {f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(rng.randint(5, 40))} for i in range(80)}
    sets |= {f"q{i:02}": sets[f"p{i:02}"] for i in range(20)}
    table = plain_store(spark.createDataFrame([(p, t) for p, s in sets.items() for t in s], "profile_id string, token string"))
    classes, pairs = setjoin.similar_sets(table, 0.3)
    want = sorted(map(tuple, pairs.collect()))
    assert max(n for _, n in written) <= len(sets) < table.count() / 5
    members = {r["profile_id"]: r["class_id"] for r in classes.collect()}
    assert members == {p: min(q for q in sets if sets[q] == s) for p, s in sets.items()}
    brute = [(p, q, len(sets[p] & sets[q])) for p in sets for q in sets if p < q and members[p] == p and members[q] == q]
    assert [w[:3] for w in want] == sorted(x for x in brute if x[2] / len(sets[x[0]] | sets[x[1]]) >= 0.3)
    for often in (0, 300):
        monkeypatch.setattr(setjoin, "OFTEN_BYTES", often)
        assert sorted(map(tuple, setjoin.similar_sets(table, 0.3)[1].collect())) == want


def test_pairs_are_spread(spark, monkeypatch):
    monkeypatch.setattr(blocking, "PAIRS_PER_TASK", 50)
    rng = random.Random(2)
    blocks = [(f"b{rng.randrange(4)}", f"p{rng.randrange(60):02}") for _ in range(150)]
    table = spark.createDataFrame(blocks, "block_key string, profile_id string")
    got = blocking.paired(blocking.block_members(table))
    want = {(p, q) for a, p in blocks for b, q in blocks if a == b and p < q}
    assert Counter((r["profile_id_1"], r["profile_id_2"]) for r in got.collect()) == Counter(want)
    members = Counter(a for a, _ in set(blocks))
    assert got.rdd.getNumPartitions() == sum(n * (n - 1) // 2 for n in members.values()) // 50 + 1


def test_chunk_pairs_are_not_shuffled(spark):
    """Pairs of chunks come once, also of records that come twice; only members are shuffled."""
    rng = random.Random(3)
    rows = [(f"r{rng.randrange(90):02}", rng.choice(["a.ru", "b.ru", None])) for _ in range(130)]
    table = spark.createDataFrame(rows, "record_id string, email_domain string")
    chunks = blocking.split_blocks(blocking.domain_keys(table, "record_id"), 200, "record_id").collect()
    want = {(x["record_id"], y["record_id"]) for x in chunks for y in chunks if x["block_key"] == y["block_key"] and x["record_id"] < y["record_id"]}
    got = blocking.split_strategy_pairs(table, "email_only", 200, "record_id")
    assert got.columns == ["profile_id_1", "profile_id_2"]
    assert Counter((r["profile_id_1"], r["profile_id_2"]) for r in got.collect()) == Counter(want)
    assert "HashAggregate" not in got._jdf.queryExecution().executedPlan().toString()


def test_chunks_are_read_by_cells_not_shuffled(spark, monkeypatch):
    """A chunk is written once, however many cells need it."""
    monkeypatch.setattr(setjoin, "CHUNK_LEAST", 200)
    rng = random.Random(4)
    sets = [(f"p{i:02}", 30, sorted(rng.sample(range(1, 50), 30))) for i in range(60)] + [("q", 2, [])]
    table = spark.createDataFrame(sets, "profile_id string, size bigint, words array<int>")
    pairs = setjoin.close_sets(table, 0.3)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan
    want = {(p, q, len(set(v) & set(w)), s, t) for p, s, v in sets for q, t, w in sets if p < q and len(set(v) & set(w)) >= 0.3 * len(set(v) | set(w))}
    assert len(want) > 500 and Counter(map(tuple, pairs.collect())) == Counter(want)


def test_blocks_pair_once_without_a_shuffle_of_pairs(spark):
    """only members are shuffled; pairs that several blocks hold come once, null keys and repeated rows make none."""
    rng = random.Random(6)
    blocks = [(rng.choice(["a", "b", "c", "d", None]), rng.choice([None, *range(25)])) for _ in range(200)]
    table = spark.createDataFrame(blocks, "block_key string, profile_id bigint")
    got = blocking.pairs_from_blocks(table)
    real = {(k, p) for k, p in blocks if k is not None and p is not None}
    assert Counter(map(tuple, got.collect())) == Counter({(p, q) for a, p in real for b, q in real if a == b and p < q})
    assert "HashAggregate" not in got._jdf.queryExecution().executedPlan().toString()


def test_labels_come_with_the_pairs(spark):
    """members bring their entity along, so pairs aren't joined with profiles; a missing entity never matches."""
    blocks = spark.createDataFrame([("a", "p"), ("a", "q"), ("b", "p"), ("b", "q"), ("b", "r"), ("b", "s"), ("b", "t")], "block_key string, profile_id string")
    profiles = spark.createDataFrame([("p", "x"), ("q", "x"), ("r", None), ("s", None)], "profile_id string, entity_id string")
    got = blocking.labelled_pairs_from_blocks(blocks, profiles)
    assert got._jdf.queryExecution().executedPlan().toString().count("Join") == 1
    want = sorted(map(tuple, blocking.label_pairs(blocking.pairs_from_blocks(blocks), profiles).collect()))
    assert sorted(map(tuple, got.collect())) == want and len(want) == 10 and sum(n for *_, n in want) == 1


@pytest.mark.parametrize("long_list", [1, 3, 1000])
def test_long_and_short_lists_of_holders(monkeypatch, long_list):
    """lists that are copied and lists that are gathered give the same pairs, also where a chunk meets itself slice by slice."""
    monkeypatch.setattr(setcells, "LONG_LIST", long_list)
    monkeypatch.setattr(setcells, "AT_ONCE", 400)
    rng = random.Random(long_list)
    made = [sorted({int(rng.paretovariate(0.6)) % 90 for _ in range(rng.randint(1, 70))}) for _ in range(80)]
    made = sorted(((len(w) + rng.randint(0, 2), w) for w in made), key=lambda s: s[0])
    made = [s for s in made if len(s[1]) >= 0.3 * s[0]]
    for left, right, same in ((made, made, True), (made[:30], made[30:], False), (made[30:], made[:30], False)):
        got = [(int(i), int(j), int(k)) for x, y, n in setcells.similar_rows(chunk(left), chunk(right), 0.3, same) for i, j, k in zip(x, y, n)]
        want = [(i, j, len(set(w) & set(v))) for i, (_, w) in enumerate(left) for j, (_, v) in enumerate(right) if i < j or not same]
        want = [(i, j, n) for i, j, n in want if n / (left[i][0] + right[j][0] - n) >= 0.3]
        assert sorted(got) == want and len(want) > 5


def test_long_unrelated_sets_are_not_compared_whole(monkeypatch):
    """long sets share some prefix words by chance; that alone must not have them compared."""
    compared, plain = [], setcells._overlaps
    monkeypatch.setattr(setcells, "_overlaps", lambda a, b, x, y, n: compared.append(len(x)) or plain(a, b, x, y, n))
    rng = np.random.default_rng(1)
    sets = [np.sort(rng.choice(40_000, 2_000, replace=False)) for _ in range(40)]
    sets.append(np.unique(np.concatenate([sets[0][:1_500], sets[1][:600]])))
    made = sorted(((len(w), w) for w in sets), key=lambda s: s[0])
    got = [(int(i), int(j)) for x, y, _ in setcells.similar_rows(chunk(made), chunk(made), 0.3, True) for i, j in zip(x, y)]
    want = [(i, j) for i in range(len(made)) for j in range(i + 1, len(made)) if 1.3 * len(np.intersect1d(made[i][1], made[j][1])) >= 0.3 * (made[i][0] + made[j][0])]
    assert sorted(got) == want and want and sum(compared) < 40
