"""Curves, thresholds and quality of scored pairs.

Input tables have a score column and a 0/1 label column; names are arguments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import running_totals

# Targets and gates of the published rules.
TARGET_PRECISION = 0.99
AUTO_FALLBACK = 0.99
F1_EPSILON = 1e-12
MIN_PR_AUC = 0.70
MIN_BCUBED_F1 = 0.90
MIN_BLOCKING_RECALL = 0.95
MAX_PR_AUC_DROP = 0.05
SHADOW_PR_AUC_DROP = 0.02
SHADOW_LATENCY_FACTOR = 1.5
# End of fixed values.


def linspace(first: float, last: float, n: int) -> list[float]:
    step = (last - first) / (n - 1)
    return [first + i * step for i in range(n - 1)] + [last]


REVIEW_GRID = linspace(0.05, 0.95, 46)
SWEEP_GRID = linspace(0.1, 0.9, 90)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _f1(tp: Column, predicted: Column, positive: Column) -> Column:
    return _ratio(2 * tp, predicted + positive)


def pr_curve(scored: DataFrame, score: str = "score", label: str = "y") -> DataFrame:
    """M7: one row per distinct score: matches and pairs at or above it, precision, recall.

    Equal scores combine first; running totals then need no window over all scores.
    """
    points = scored.groupBy((-F.col(score)).alias("_down")).agg(
        F.sum(label).cast("bigint").alias("n_pos"), F.count(F.lit(1)).alias("n_all")
    )
    run = running_totals(points, [], ["_down"], {"tp": "n_pos", "predicted": "n_all"})
    return run.select(
        (-F.col("_down")).alias("score"),
        "n_pos",
        "tp",
        "predicted",
        F.col("tp_all").alias("positives"),
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        F.when(F.col("tp_all") > 0, F.col("tp") / F.col("tp_all")).otherwise(1.0).alias("recall"),
    )


def average_precision(curve: DataFrame) -> DataFrame:
    """Precision weighted by the recall gained at each score, no interpolation."""
    gain = F.col("n_pos") / F.col("positives") * F.col("precision")
    return curve.agg(F.coalesce(F.sum(F.when(F.col("positives") > 0, gain)), F.lit(0.0)).alias("pr_auc"))


def calibrate(curve: DataFrame, target_precision: float = TARGET_PRECISION) -> DataFrame:
    """Lowest score that reaches the target precision, and best F1."""
    p, r, s = F.col("precision"), F.col("recall"), F.col("score")
    f1 = 2 * p * r / (p + r + F1_EPSILON)
    good = p >= target_precision
    row = curve.agg(
        F.min(F.when(good, F.struct("score", "precision"))).alias("auto"),
        F.max(F.struct(f1.alias("f1"), (-s).alias("down"), p.alias("p"), r.alias("r"))).alias("best"),
    )
    return row.select(
        F.coalesce("auto.score", F.lit(AUTO_FALLBACK)).alias("auto_merge"),
        (-F.col("best.down")).alias("review"),
        F.coalesce("auto.precision", F.lit(1.0)).alias("auto_precision"),
        F.col("best.p").alias("review_precision"),
        F.col("best.r").alias("review_recall"),
        F.col("best.f1").alias("review_f1"),
    )


def grid_metrics(scored: DataFrame, grid: Sequence[float], score: str = "score", label: str = "y") -> DataFrame:
    """Counts, precision, recall and F1 for every threshold of a grid.

    A score is counted under the number of thresholds it reaches, so the table shrinks
    to one row per threshold before anything is accumulated.
    """
    levels = F.array(*[F.lit(t) for t in grid])
    reached = F.size(F.filter(levels, lambda t: t <= F.col(score)))
    counts = scored.groupBy(reached.alias("_k")).agg(
        F.sum(label).cast("bigint").alias("_pos"), F.count(F.lit(1)).alias("_n")
    )
    spread = counts.select(
        "_k", "_pos", "_n", F.explode(F.sequence(F.lit(0), F.lit(len(grid) - 1))).alias("_i")
    ).groupBy("_i").agg(
        F.sum(F.when(F.col("_k") > F.col("_i"), F.col("_pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("_k") > F.col("_i"), F.col("_n")).otherwise(0)).alias("predicted"),
        F.sum("_pos").alias("positives"),
    )
    tp, predicted, positives = F.col("tp"), F.col("predicted"), F.col("positives")
    return spread.select(
        F.get(levels, F.col("_i")).alias("threshold"),
        "tp",
        "predicted",
        "positives",
        _ratio(tp, predicted).alias("precision"),
        _ratio(tp, positives).alias("recall"),
        _f1(tp, predicted, positives).alias("f1"),
    )


def best_of_grid(metrics: DataFrame, highest: bool) -> DataFrame:
    """M10 (highest threshold on ties) and M11 (lowest threshold on ties)."""
    t = F.col("threshold")
    order = F.struct("f1", (t if highest else -t).alias("_t"))
    return metrics.agg(
        F.max_by("threshold", order).alias("threshold"),
        F.max("f1").alias("f1"),
        F.max_by("precision", order).alias("precision"),
        F.max_by("recall", order).alias("recall"),
    )


def _predicted(scored: DataFrame, threshold: float, score: str, label: str) -> DataFrame:
    return scored.select(F.col(label).alias("y"), (F.col(score) >= threshold).cast("int").alias("p"))


def confusion(scored: DataFrame, threshold: float, score: str = "score", label: str = "y") -> DataFrame:
    """The four cells, empty ones as zero."""
    cells = _predicted(scored, threshold, score, label).agg(
        *[
            F.count_if((F.col("y") == y) & (F.col("p") == p)).alias(f"_{y}{p}")
            for y in (0, 1)
            for p in (0, 1)
        ]
    )
    rows = F.array(
        *[
            F.struct(F.lit(y).alias("actual"), F.lit(p).alias("predicted"), F.col(f"_{y}{p}").alias("n"))
            for y in (0, 1)
            for p in (0, 1)
        ]
    )
    return cells.select(F.inline(rows))


def pair_metrics(scored: DataFrame, threshold: float, score: str = "score", label: str = "y") -> DataFrame:
    """Accuracy, precision, recall and F1, zero where undefined."""
    y, p = F.col("y"), F.col("p")
    c = _predicted(scored, threshold, score, label).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y == p).alias("hits"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if(p == 1).alias("predicted"),
        F.count_if(y == 1).alias("positives"),
    )
    tp, predicted, positives = F.col("tp"), F.col("predicted"), F.col("positives")
    return c.select(
        _ratio(F.col("hits"), F.col("n")).alias("accuracy"),
        _ratio(tp, predicted).alias("precision"),
        _ratio(tp, positives).alias("recall"),
        _f1(tp, predicted, positives).alias("f1"),
    )


def classification_report(
    scored: DataFrame, threshold: float, score: str = "score", label: str = "y"
) -> DataFrame:
    """Per class, then macro and weighted averages, with the number of pairs."""
    cells = confusion(scored, threshold, score, label)
    classes = F.explode(F.array(F.lit(0), F.lit(1))).alias("c")
    hit = (F.col("actual") == F.col("c")) & (F.col("predicted") == F.col("c"))
    per_class = (
        cells.select("*", classes)
        .groupBy("c")
        .agg(
            F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("tp"),
            F.sum(F.when(F.col("predicted") == F.col("c"), F.col("n")).otherwise(0)).alias("predicted"),
            F.sum(F.when(F.col("actual") == F.col("c"), F.col("n")).otherwise(0)).alias("support"),
        )
        .select(
            F.col("c").cast("string").alias("name"),
            _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
            _ratio(F.col("tp"), F.col("support")).alias("recall"),
            _f1(F.col("tp"), F.col("predicted"), F.col("support")).alias("f1"),
            "support",
        )
    )
    numbers = ("precision", "recall", "f1")
    macro = per_class.agg(*[F.avg(c).alias(c) for c in numbers], F.sum("support").alias("support"))
    weighted = per_class.agg(
        *[_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in numbers],
        F.sum("support").alias("support"),
    )
    out = per_class
    for name, rows in (("macro avg", macro), ("weighted avg", weighted)):
        out = out.unionByName(rows.withColumn("name", F.lit(name)))
    return out


def errors(scored: DataFrame, threshold: float, score: str = "score", label: str = "y") -> DataFrame:
    """Wrong pairs with ``error`` FP or FN."""
    predicted = F.col(score) >= threshold
    kind = F.when(predicted & (F.col(label) == 0), "FP").when(~predicted & (F.col(label) == 1), "FN")
    return scored.withColumn("error", kind).filter(F.col("error").isNotNull())


def score_histogram(scored: DataFrame, bins: int = 20, score: str = "score", label: str = "y") -> DataFrame:
    """Pairs per class in even bins of [0, 1]; 1.0 is in the last bin."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return scored.groupBy(F.col(label).alias("y"), b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def missed_overlap_histogram(missed: DataFrame, overlap: str = "overlap_union") -> DataFrame:
    """Overlap of missed pairs."""
    return missed.groupBy(F.col(overlap).alias("overlap")).agg(F.count(F.lit(1)).alias("n"))


def range_histogram(df: DataFrame, col: str, edges: Sequence[float]) -> DataFrame:
    """Right-closed bins; values outside all of them are counted under null."""
    label = F.lit(None).cast("string")
    for low, high in reversed(list(zip(edges[:-1], edges[1:]))):
        label = F.when((F.col(col) > low) & (F.col(col) <= high), f"{low}-{high}").otherwise(label)
    return df.groupBy(label.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def bcubed(clusters: DataFrame, profiles: DataFrame) -> DataFrame:
    """B-cubed precision, recall and F1 from the sizes of cluster-entity overlaps.

    The overlaps are counted first; no cluster is ever gathered.
    """
    cells = (
        clusters.join(profiles.select("profile_id", "entity_id"), "profile_id")
        .filter(F.col("entity_id").isNotNull())
        .groupBy("cluster_id", "entity_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rows = []
    for key, name in (("cluster_id", "precision"), ("entity_id", "recall")):
        share = F.sum(F.col("n") * F.col("n")) / F.sum("n")
        rows.append(
            cells.groupBy(key)
            .agg(share.alias("_s"), F.sum("n").alias("_n"))
            .agg((F.sum("_s") / F.sum("_n")).alias(f"bcubed_{name}"))
        )
    p, r = F.col("bcubed_precision"), F.col("bcubed_recall")
    return rows[0].join(F.broadcast(rows[1])).withColumn("bcubed_f1", _ratio(2 * p * r, p + r))


def quality_gate(
    metrics: DataFrame,
    min_pr_auc: float = MIN_PR_AUC,
    min_bcubed_f1: float = MIN_BCUBED_F1,
    min_blocking_recall: float = MIN_BLOCKING_RECALL,
    max_pr_auc_drop: float = MAX_PR_AUC_DROP,
) -> DataFrame:
    """The rules a metrics row breaks; no row means the model may go on."""
    drop = F.coalesce(F.col("pr_auc_drop"), F.lit(0.0))
    rules = [
        ("pr_auc", F.col("pr_auc"), min_pr_auc, F.col("pr_auc") < min_pr_auc),
        ("bcubed_f1_review", F.col("bcubed_f1_review"), min_bcubed_f1, F.col("bcubed_f1_review") < min_bcubed_f1),
        ("blocking_recall", F.col("blocking_recall"), min_blocking_recall, F.col("blocking_recall") < min_blocking_recall),
        ("pr_auc_drop", drop, max_pr_auc_drop, drop > max_pr_auc_drop),
    ]
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("rule"), v.alias("value"), F.lit(lim).alias("bound"), bad.alias("failed"))
            for n, v, lim, bad in rules
        ]
    )
    return metrics.select(F.inline(rows)).filter("failed").drop("failed")


def shadow_comparison(pr_auc: DataFrame, latency: DataFrame, candidate: str, production: str) -> DataFrame:
    """PR-AUC and p95 latency of the candidate stage against production.

    Both inputs have one row per stage.
    """

    def of(stage: str, col: str) -> Column:
        return F.max(F.when(F.col("stage") == stage, F.col(col)))

    auc = pr_auc.agg(of(candidate, "pr_auc").alias("candidate_pr_auc"), of(production, "pr_auc").alias("production_pr_auc"))
    lat = latency.agg(of(candidate, "p95").alias("candidate_p95"), of(production, "p95").alias("production_p95"))
    worse_auc = F.col("candidate_pr_auc") < F.col("production_pr_auc") - SHADOW_PR_AUC_DROP
    slower = F.col("candidate_p95") > F.col("production_p95") * SHADOW_LATENCY_FACTOR
    return auc.join(F.broadcast(lat)).withColumn(
        "decision", F.when(worse_auc | slower, "rollback").otherwise("canary")
    )
