"""Time-window monitoring of the decision log.

The log has ts, stage, status, latency_s, prob_match, action. Window aggregates take a
batch or a streaming table; alert rules over window history take a batch table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Limits, windows and hold times of the published alert rules.
P95_LIMIT_S = 0.1
LATENCY_WINDOW = "5 minutes"
LATENCY_HOLD_S = 600
AVAILABILITY_LIMIT = 0.999
AVAILABILITY_WINDOW = "5 minutes"
AVAILABILITY_HOLD_S = 300
DRIFT_LIMIT = 0.05
DRIFT_HOLD_S = 1800
REVIEW_LIMIT = 0.30
REVIEW_WINDOW = "10 minutes"
REVIEW_HOLD_S = 1800
ABSENCE_S = 120
RULE_INTERVAL = "30 seconds"
RULE_INTERVAL_S = 30
# End of fixed values.

WATERMARK = "10 minutes"
#: Values that a sketch keeps before it thins them out.
SKETCH_K = 4096
HOUR_S, WEEK_S, DRIFT_BUCKET_S = 3600, 7 * 86400, 300


def _timed(log: DataFrame) -> DataFrame:
    """Event time with a zone (the session is UTC); late rows are bounded on streams."""
    typed = log.withColumn("ts", F.col("ts").cast("timestamp"))
    return typed.withWatermark("ts", WATERMARK) if log.isStreaming else typed


def _flat(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *cols)


def _paned(log: DataFrame, window: str, slide: str, by: Sequence[str], parts: dict[str, Column], whole: dict[str, Column]) -> DataFrame:
    """Sliding windows by panes: rows meet once, in the pane of one ``slide`` that they are in; windows put panes together.

    ``parts`` aggregates rows of a pane, ``whole`` its results over the panes of a window. Only panes are copied to the windows they lie in.
    """
    panes = _timed(log).groupBy(F.window("ts", slide), *by).agg(*[c.alias(k) for k, c in parts.items()])
    placed = panes.groupBy(F.window(F.window_time("window"), window, slide), *by)
    return placed.agg(*[c.alias(k) for k, c in whole.items()])


def latency_p95(log: DataFrame, window: str = LATENCY_WINDOW, slide: str = RULE_INTERVAL, k: int = SKETCH_K) -> DataFrame:
    """95th percentile of latency per stage in sliding windows.

    Panes hold KLL sketches. Up to ``k`` values in a window the percentile is exact, beyond that its rank is off by about 1.65 / ``k``.
    """
    sketch = F.kll_sketch_agg_double(F.col("latency_s").cast("double"), k)
    merged = F.kll_merge_agg_double("sketch", k)
    grouped = _paned(log, window, slide, ["stage"], {"sketch": sketch}, {"p95": F.kll_sketch_get_quantile_double(merged, F.lit(0.95))})
    return _flat(grouped, "stage", "p95", (F.col("p95") > P95_LIMIT_S).alias("breach"))


def _shares(log: DataFrame, window: str, slide: str, name: str, hit: Column) -> tuple[DataFrame, Column]:
    sums = {c: F.sum(c) for c in (name, "n_all")}
    grouped = _paned(log, window, slide, [], {name: F.count_if(hit), "n_all": F.count(F.lit(1))}, sums)
    return grouped, F.col(name) / F.col("n_all")


def availability(log: DataFrame, window: str = AVAILABILITY_WINDOW, slide: str = RULE_INTERVAL) -> DataFrame:
    """Share of ok answers in sliding windows."""
    grouped, share = _shares(log, window, slide, "n_ok", F.col("status") == "ok")
    return _flat(grouped, "n_ok", "n_all", share.alias("availability"), (share < AVAILABILITY_LIMIT).alias("breach"))


def review_share(log: DataFrame, window: str = REVIEW_WINDOW, slide: str = RULE_INTERVAL) -> DataFrame:
    """T4: share of REVIEW decisions in sliding windows."""
    grouped, share = _shares(log, window, slide, "n_review", F.col("action") == "REVIEW")
    return _flat(grouped, "n_review", "n_all", share.alias("review_share"), (share > REVIEW_LIMIT).alias("breach"))


def action_counts(log: DataFrame, window: str = LATENCY_WINDOW) -> DataFrame:
    """Decisions per action, and the mean probability, in tumbling windows."""
    grouped = _timed(log).groupBy(F.window("ts", window), "action").agg(
        F.count(F.lit(1)).alias("n"), F.avg("prob_match").alias("mean_prob")
    )
    return _flat(grouped, "action", "n", "mean_prob")


def probability_drift(log: DataFrame) -> DataFrame:
    """Mean probability of the last hour against the seven days before it.

    Rows shrink to one per five minutes first; the windows then run over the calendar,
    whose length does not depend on the number of decisions.
    """
    second = F.unix_timestamp(F.col("ts").cast("timestamp"))
    bucket = F.floor(second / DRIFT_BUCKET_S) * DRIFT_BUCKET_S
    buckets = log.groupBy(bucket.alias("bucket")).agg(
        F.sum("prob_match").alias("_s"), F.count(F.lit(1)).alias("_n")
    )
    timeline = Window.partitionBy(F.lit(0)).orderBy("bucket")
    hour = timeline.rangeBetween(-(HOUR_S - DRIFT_BUCKET_S), 0)
    week = timeline.rangeBetween(-(HOUR_S + WEEK_S - DRIFT_BUCKET_S), -HOUR_S)

    def mean(frame) -> Column:
        return F.sum("_s").over(frame) / F.sum("_n").over(frame)

    drift = F.abs(F.col("mean_1h") - F.col("mean_7d"))
    return buckets.select(
        F.timestamp_seconds(F.col("bucket") + DRIFT_BUCKET_S).alias("at"),
        mean(hour).alias("mean_1h"),
        mean(week).alias("mean_7d"),
    ).select("*", drift.alias("drift"), F.coalesce(drift > DRIFT_LIMIT, F.lit(False)).alias("breach"))


def sustained(
    ticks: DataFrame, hold_s: int, at: str = "window_end", series: Sequence[str] = (), step_s: int = RULE_INTERVAL_S
) -> DataFrame:
    """T5: periods where ``breach`` holds at every tick for at least ``hold_s`` seconds.

    Ticks are windows of the calendar, so a series is short whatever the load.
    """
    tick = F.floor(F.unix_timestamp(F.col(at)) / step_s)
    keys = list(series)
    order = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_tick")
    islands = (
        ticks.filter("breach")
        .withColumn("_tick", tick)
        .withColumn("_island", F.col("_tick") - F.row_number().over(order))
        .groupBy(*keys, "_island")
        .agg(F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count(F.lit(1)).alias("n_ticks"))
    )
    return islands.filter((F.col("n_ticks") - 1) * step_s >= hold_s).select(*keys, "first_at", "last_at", "n_ticks")


def absence(log: DataFrame, hold_s: int = ABSENCE_S, step_s: int = 60) -> DataFrame:
    """Periods of at least ``hold_s`` seconds in which no minute has a row."""
    slot = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / step_s)
    seen = log.select(slot.alias("slot")).filter(F.col("slot").isNotNull()).distinct()
    spine = seen.agg(F.min("slot").alias("a"), F.max("slot").alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("slot")
    )
    order = Window.partitionBy(F.lit(0)).orderBy("slot")
    empty = spine.join(seen, "slot", "left_anti")
    islands = empty.withColumn("_island", F.col("slot") - F.row_number().over(order)).groupBy("_island").agg(
        F.min("slot").alias("_a"), F.max("slot").alias("_b")
    )
    seconds = (F.col("_b") - F.col("_a") + 1) * step_s
    return islands.filter(seconds >= hold_s).select(
        F.timestamp_seconds(F.col("_a") * step_s).alias("first_at"),
        F.timestamp_seconds((F.col("_b") + 1) * step_s).alias("until"),
        seconds.alias("seconds"),
    )


def null_share_drift(baseline: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null share per field in both periods."""

    def shares(df: DataFrame, name: str) -> DataFrame:
        row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
        return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias(name)) for c in cols])))

    both = shares(baseline, "baseline").join(shares(current, "current"), "field")
    return both.withColumn("change", F.col("current") - F.col("baseline"))


def overlap_drift(baseline: DataFrame, current: DataFrame, overlap: str = "overlap_any_site") -> DataFrame:
    """Share of pairs per overlap in both periods."""

    def shares(df: DataFrame, name: str) -> DataFrame:
        counts = df.groupBy(F.col(overlap).alias("overlap")).agg(F.count(F.lit(1)).alias("_n"))
        total = counts.agg(F.sum("_n").alias("_t"))
        return counts.join(F.broadcast(total)).select("overlap", (F.col("_n") / F.col("_t")).alias(name))

    both = shares(baseline, "baseline").join(shares(current, "current"), "overlap", "full")
    return both.fillna(0.0, ["baseline", "current"])


def unseen_domains(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """E-mail domains that the baseline does not have, with their rows."""
    counts = current.filter(F.col("email_domain").isNotNull()).groupBy("email_domain").agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    known = baseline.select("email_domain").distinct()
    return counts.join(known, "email_domain", "left_anti")
