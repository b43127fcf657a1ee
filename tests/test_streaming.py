"""Panes against plain windows, and a scoring stream that fails half-way."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kinfold.session import scratch_path
from kinfold.streaming import incremental, monitor

SCHEMA = "ts timestamp, stage string, status string, latency_s double, action string"


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(8)
    start = dt.datetime(2024, 1, 1)
    rows = [
        (start + dt.timedelta(seconds=rng.random() * 1800), rng.choice("ab"), rng.choice(["ok", "ok", "error"]), rng.random(), rng.choice(["REVIEW", "KEEP_SEPARATE"]))
        for _ in range(4000)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


def plain(log, minutes, by, *aggs):
    """Every row copied to each window it lies in."""
    names = [f"c{i}" for i in range(len(aggs))]
    grouped = log.groupBy(F.window("ts", f"{minutes} minutes", "30 seconds"), *by).agg(*[a.alias(c) for a, c in zip(aggs, names)])
    return sorted(tuple(r) for r in grouped.select("window.start", *by, *names).collect())


def test_panes_equal_windows_of_rows(log):
    got = monitor.availability(log).select("window_start", "n_ok", "n_all").collect()
    assert sorted(map(tuple, got)) == plain(log, 5, [], F.count_if(F.col("status") == "ok"), F.count(F.lit(1)))
    got = monitor.review_share(log).select("window_start", "n_review", "n_all").collect()
    assert sorted(map(tuple, got)) == plain(log, 10, [], F.count_if(F.col("action") == "REVIEW"), F.count(F.lit(1)))
    got = monitor.latency_p95(log).select("window_start", "stage", "p95").collect()
    assert sorted(map(tuple, got)) == plain(log, 5, ["stage"], F.percentile_approx("latency_s", 0.95, 100_000))


def test_rows_are_not_copied_before_they_are_aggregated(log):
    for out in (monitor.latency_p95(log), monitor.availability(log), monitor.review_share(log)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Expand") <= 1 and plan.index("Expand") < plan.rindex("Aggregate")


def test_rank_error_of_a_thinned_sketch(log):
    wide = log.withColumn("ts", F.lit(dt.datetime(2024, 1, 1, 0, 0, 1)))
    values = {s: sorted(r[0] for r in log.filter(F.col("stage") == s).select("latency_s").collect()) for s in "ab"}
    for r in monitor.latency_p95(wide, k=200).collect():
        below = sum(v <= r["p95"] for v in values[r["stage"]]) / len(values[r["stage"]])
        assert abs(below - 0.95) <= 2 * 1.65 / 200


def test_scoring_stream_survives_a_failure(spark):
    folder, out, state = (scratch_path(spark, n) for n in ("requests", "out", "state"))
    spark.range(40).select(F.col("id").cast("string").alias("key"), (F.col("id") / 40).alias("x")).repartition(4).write.parquet(folder)
    seen: list[int] = []

    def fail_once(number: int) -> None:
        seen.append(number)
        if seen.count(1) == 1 and number == 1:
            raise RuntimeError("lost after writing, before the batch was noted as done")

    def run():
        requests = incremental.read_stream(spark, folder, "key string, x double", per_trigger=1)
        return incremental.score_stream(requests, lambda t: t.select("key", (F.col("x") * 2).alias("score")), out, state, fail_once)

    with pytest.raises(Exception):
        run()
    done = run()
    assert seen.count(1) == 2 and sorted(set(seen)) == [0, 1, 2, 3]
    assert sorted((r["key"], r["score"]) for r in done.collect()) == sorted((str(i), i / 20) for i in range(40))
    # Files that come later are added, nothing is repeated.
    spark.createDataFrame([("new", 0.5)], "key string, x double").write.mode("append").parquet(folder)
    assert run().count() == 41
