"""Small cases for the rules that are easy to get wrong."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import inputs
from kinfold.config import ProfileSchema
from kinfold.functions import normalize as n
from kinfold.functions import parsing, similarity
from kinfold.operators import blocking, collapse, evaluate, features, profiling, skew
from kinfold.operators.flatten import flatten
from kinfold.sources import events as io


def column(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v")).alias("o")).collect()]


def test_tokens_and_pairs(spark):
    text = "['source_site_365:6307' 'has_click_365:6880' \"is_gmail\" 'a:b:c' 'a:2' 'k' 'k']"
    df = spark.createDataFrame([(text,)], "v string").select(parsing.kv_entries(F.col("v")).alias("e"))
    first = df.select(parsing.kv_first_map(F.col("e"))).first()[0]
    joined = df.select(parsing.kv_joined_map(F.col("e"))).first()[0]
    lone = df.select(parsing.kv_lone_flags(F.col("e"))).first()[0]
    assert first["a"] == "b:c" and first["source_site_365"] == "6307"
    assert joined["a"] == "b:c|2" and joined["k"] == "True|True"
    assert lone == ["is_gmail"]


def test_token_list_of_other_shapes(spark):
    assert column(spark, ["[]", "", "{}", None, "plain", " ['x']"], parsing.token_list) == [[], [], [], [], [], ["x"]]
    assert column(spark, [["a:1", None], None], lambda c: parsing.token_list(c, True), "array<string>") == [["a:1"], []]


def test_json(spark):
    out = column(spark, ['{"a":1,"a":2}', "[1]", "{bad", None], parsing.json_map)
    assert out == [{"a": "2"}, {}, {}, {}]


def raw_row(pid, at, fs, **more):
    base = dict.fromkeys(("first_name", "last_name", "email", "phone", "birthday", "sex", "entity_id"))
    return {**base, "event_id": 0, "created_at": at, "profile_id": pid, "non_processing_features": "[]",
            "realtime_features": "{}", "fs_features": fs, **more}


RAW = ("event_id bigint, created_at timestamp_ntz, first_name string, last_name string, email string, phone string, "
       "birthday date, sex string, non_processing_features string, realtime_features string, fs_features string, "
       "profile_id string, entity_id string")


def raw_table(spark, rows):
    names = [c.strip().split()[0] for c in RAW.split(",")]
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], RAW)


def test_collapse_rules(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    rows = [
        raw_row("p", t1, "['visited_30:x' 'visited_30:y']", first_name="x", sex="m"),
        raw_row("p", t2, "['visited_30']", sex=None, event_id=1),
        raw_row("p", None, "['has_account' 'has_account']", first_name=None, sex="late", event_id=2),
        raw_row(None, t1, "['visited_30:q']"),
    ]
    out = collapse.collapse(flatten(raw_table(spark, rows))).collect()
    assert len(out) == 1
    p = out[0]
    assert (p["first_name"], p["sex"], p["created_at"]) == ("x", "late", t2)
    assert p["fs_visited_30"] == ["x", "y"] and p["fs_has_account"] == ["True"] and p["fs_visited_365"] is None


def test_contacts(spark):
    assert column(spark, ["8 (900) 123-45-67", "79001234567", "+8900", "123", " ", None], n.normalize_phone) == [
        "+79001234567", "+79001234567", "invalid_phone_format", "invalid_phone_format", None, None]
    assert column(spark, ["a.b@gmail.ru", "x@bk.ru", "A@qmail.com", "nodomain", "a@b@c", "@b", "a@"], n.normalize_email) == [
        "ab@gmail.com", "x@mail.ru", "a@gmail.com", "invalid_email_no_at", "invalid_email_multiple_at",
        "invalid_email_empty_login", "invalid_email_empty_domain"]
    assert column(spark, ["  ", "", None, " A  B "], n.normalize_name) == ["", None, None, "a b"]
    assert column(spark, ["nodomain", "a@b", None], n.email_domain) == ["nodomain", "b", None]


def test_day_gap_floors_before_sign(spark):
    day = dt.datetime(2024, 1, 2)
    rows = [(day - dt.timedelta(hours=12), day), (day + dt.timedelta(hours=12), day)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(similarity.day_gap(F.col("a"), F.col("b"))).collect()] == [1, 0]


def test_set_rules(spark):
    df = spark.createDataFrame([([], ["a"]), (None, ["a"]), (["a"], ["b"]), (["a", "b"], ["b"])], "a array<string>, b array<string>")
    o = similarity.set_overlap(F.col("a"), F.col("b"))
    j = similarity.jaccard_of(o, F.size("a"), F.size("b"))
    assert [tuple(r) for r in df.select(o, j).collect()] == [(-1, -1.0), (-1, -1.0), (0, 0.0), (1, 0.5)]


def test_token_sort_counts_repeats(spark):
    df = spark.createDataFrame([("a a b", "a b"), ("b a", "a b"), ("", "a"), (None, "a")], "a string, b string")
    got = [r[0] for r in df.select(similarity.token_sort_similarity(F.col("a"), F.col("b"))).collect()]
    assert got == [0.8, 1.0, 0.0, 0.0]


@pytest.mark.parametrize("n_sites,kept", [(150, 150), (151, 0)])
def test_stop_limit(spark, n_sites, kept):
    keys = spark.range(n_sites).select(F.lit("site::x").alias("block_key"), F.col("id").cast("string").alias("profile_id"))
    assert blocking.prune_blocks(keys, 300, 150).count() == kept


def test_block_cap_and_lone_members(spark):
    keys = spark.range(1000).select(F.lit("dom::x").alias("block_key"), F.col("id").cast("string").alias("profile_id"))
    lone = spark.createDataFrame([("dom::y", "1")], keys.schema)
    assert blocking.prune_blocks(keys.unionByName(lone), 300, 150).groupBy("block_key").count().collect()[0][1] == 300


def test_block_cap_limits_rows_before_the_shuffle(spark):
    keys = spark.range(1000).select((F.col("id") % 3).cast("string").alias("block_key"), F.col("id").cast("string").alias("profile_id"))
    plan = blocking.prune_blocks(keys, 300, 150)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


@pytest.mark.parametrize("rows,chunks", [(141, 1), (142, 1), (143, 2), (500, 4)])
def test_chunks(spark, rows, chunks):
    keys = spark.range(rows).select(F.lit("k").alias("block_key"), F.format_string("%05d", "id").alias("profile_id"))
    out = blocking.split_blocks(keys).groupBy("block_key").agg(F.count("*").alias("n"), F.min("profile_id"), F.max("profile_id"))
    got = sorted(tuple(r)[1:] for r in out.collect())
    assert len(got) == chunks and sum(g[0] for g in got) == rows and max(g[0] for g in got) <= 142


def test_unknown_strategy_and_format(spark):
    with pytest.raises(ValueError):
        blocking.strategy_keys(spark.range(1), "other")
    with pytest.raises(ValueError):
        io.read_events(spark, "/tmp/events.xlsx")


def test_average_precision_is_not_the_trapezoid(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.6, 0)], "score double, y int")
    curve = evaluate.pr_curve(df)
    assert evaluate.average_precision(curve).first()[0] == pytest.approx(0.8333333)
    row = evaluate.calibrate(curve).first()
    assert row["auto_merge"] == 0.9 and row["review"] == 0.7


def test_grid_ties(spark):
    df = spark.createDataFrame([(0.9, 1), (0.1, 0)], "score double, y int")
    grid = evaluate.grid_metrics(df, [0.2, 0.5, 0.8])
    assert evaluate.best_of_grid(grid, True).first()["threshold"] == 0.8
    assert evaluate.best_of_grid(grid, False).first()["threshold"] == 0.2


def test_empty_truth(spark):
    people = spark.createDataFrame([("a", None), ("b", "e")], "profile_id string, entity_id string")
    pairs = spark.createDataFrame([("a", "b", 0)], "profile_id_1 string, profile_id_2 string, is_match int")
    assert blocking.blocking_recall(pairs, people).first()["recall"] == 1.0
    assert blocking.recall_found_missed(pairs, people).first()["recall"] == 0.0


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.6,), (1.0,)], "s double")
    got = {r["bin"]: r["n"] for r in evaluate.range_histogram(df, "s", [0.0, 0.6, 1.0]).collect()}
    assert got == {None: 1, "0.0-0.6": 1, "0.6-1.0": 1}


def test_time_gaps_of_one_hot_entity(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("hot", base + dt.timedelta(hours=i * i)) for i in range(200)] + [("one", base), ("none", None)]
    out = {r["e"]: tuple(r)[1:] for r in profiling.time_gaps(
        spark.createDataFrame(rows, "e string, t timestamp_ntz"), "e", "t").collect()}
    assert out["hot"] == (1.0, 397.0, pytest.approx(199.0), 200)
    assert out["one"] == (0.0, 0.0, 0.0, 1) and out["none"] == (0.0, 0.0, 0.0, 1)


def test_hash_sample_is_exact(spark):
    df = spark.range(5000).withColumnRenamed("id", "i")
    for k in (0, 1, 777, 6000):
        assert skew.hash_sample(df, ["i"], 1, k).distinct().count() == min(k, 5000)


def test_salted_join_equals_plain(spark):
    big = spark.range(3000).select(F.when(F.col("id") < 1500, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), "id")
    lookup = big.select("k").distinct().withColumn("v", F.length("k"))
    hot = skew.hot_keys(big.groupBy("k").agg(F.count("*").alias("n")), "k", "n", share=10)
    assert hot.count() == 1
    plain = big.join(lookup, "k").select("k", "id", "v")
    salted = skew.salted_join(big, lookup, "k", hot, F.col("id")).select("k", "id", "v")
    assert plain.exceptAll(salted).count() == 0 and salted.count() == 3000


def test_pair_invariants(spark):
    keys = spark.createDataFrame([("x", "b"), ("x", "a"), ("y", "a"), ("y", "b"), ("y", "c")], "block_key string, profile_id string")
    got = sorted(tuple(r) for r in blocking.pairs_from_blocks(keys).collect())
    assert got == [("a", "b"), ("a", "c"), ("b", "c")]


def test_bcubed_of_equal_partitions(spark):
    people = spark.createDataFrame([("a", "e"), ("b", "e"), ("c", "f")], "profile_id string, entity_id string")
    clusters = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "profile_id string, cluster_id int")
    assert tuple(evaluate.bcubed(clusters, people).first()) == (1.0, 1.0, 1.0)


@pytest.mark.parametrize("n", [0, 1, 700, 5000, 6000])
@pytest.mark.parametrize("at_once", [100_000, 3])
def test_sample_takes_the_smallest_hashes(spark, n, at_once):
    import hashlib

    df = spark.range(5000).select(F.col("id").cast("string").alias("i"), F.lit(1).alias("v")).repartition(4)
    order = sorted(range(5000), key=lambda i: hashlib.md5(f"7|{i}".encode()).hexdigest()[:12])
    got = sorted(int(r["i"]) for r in skew.hash_sample(df, ["i"], 7, n, at_once).collect())
    assert got == sorted(order[:n])
    by_column = skew.hash_sample(df.withColumn("k", F.lit(n)), ["i"], 7, F.col("k"), at_once)
    assert sorted(int(r["i"]) for r in by_column.collect()) == got


def test_sample_ranks_few_rows(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("i"))
    plan = skew.hash_sample(df, ["i"], 1, 10_000, 50)._jdf.queryExecution().optimizedPlan().toString()
    low, high = (int(x) for x in __import__("re").search(r"_h#\d+L >= (\d+)\) AND \(_h#\d+L < (\d+)\)", plan).groups())
    inside = df.filter(F.conv(F.substring(F.md5(F.concat(F.lit("1|"), "i")), 1, 12), 16, 10).cast("bigint").between(low, high - 1)).count()
    assert 0 < inside <= 50
    # Repeated rows can't be told apart; the number is still exact.
    same = spark.range(3000).select(F.lit("x").alias("i"))
    assert skew.hash_sample(same, ["i"], 1, 1234, 50).count() == 1234


def test_events_of_one_file_are_parsed_by_many_tasks(spark, tmp_path):
    rows = [(i, i % 40, f'{{"k": {i % 9}}}') for i in range(400)]
    table = spark.createDataFrame(rows, "event_id bigint, user_id bigint, props string")
    table = table.withColumn("ts", F.lit("2024-01-01 10:00:00").cast("timestamp_ntz"))
    table.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    raw = inputs.raw_events(spark, str(tmp_path))
    per_task = raw.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in per_task) == 400
    assert len(per_task) > 1 and max(r["count"] for r in per_task) < 200


def test_entries_are_cut_at_the_first_colon(spark):
    texts = ["['a:b:c' 'flag' ':x' 'y:' '' \"q:'\"]"]
    want = [("a", "b:c"), ("flag", None), ("", "x"), ("y", ""), ("", None), ("q", "'")]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(parsing.kv_entries(F.col("t")).alias("e")).first()["e"]
    assert [tuple(e) for e in got] == want
