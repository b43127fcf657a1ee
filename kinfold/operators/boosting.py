"""Boosted trees stopped by PR-AUC: every prefix of the ensemble is scored, the best one stays (M1).

Spark's trees stop on loss. Here the ensemble is fitted to its full length once; its stored node table is read, and one job over the
validation pairs walks all trees and counts, for every prefix, pairs and matches per distinct score. Curves of all prefixes come from
running totals over sorted ranges, so neither a prefix nor the pairs have to fit into a task. Training would have stopped at the first prefix
that is ``patience`` trees behind the best so far; that best one is the model.

The node table has at most ``trees * 2 ** (depth + 1)`` rows, whatever the data, and travels to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, store
from .model import feature_cols_of, fill_missing, fit_gbt
from .skew import running_totals

# Fixed value: rounds without a better PR-AUC after which training stops.
PATIENCE = 50
# End of fixed value.
NODES = "tree int, weight double, node int, feature int, threshold double, left int, right int, prediction double"


def stored_trees(fitted: PipelineModel) -> DataFrame:
    """Node table of a fitted ensemble, as ``NODES``; a leaf has children -1."""
    session = SparkSession.active()
    path = scratch_path(session, "trees")
    fitted.stages[-1].write().save(path)
    weights = session.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    n = F.col("nodeData")
    nodes = session.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["split"]["featureIndex"].alias("feature"),
        F.try_element_at(n["split"]["leftCategoriesOrThreshold"], F.lit(1)).alias("threshold"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["prediction"].alias("prediction"),
    )
    return nodes.join(weights, "tree").select(*[f.split(" ")[0] for f in NODES.split(", ")])


class Forest:
    """Node table as arrays: one row per tree, one column per node."""

    def __init__(self, nodes: DataFrame):
        rows = nodes.select(*[f.split(" ")[0] for f in NODES.split(", ")]).toPandas()
        rows = rows[rows["tree"] >= 0]
        trees = int(rows["tree"].max()) + 1 if len(rows) else 0
        width = int(rows["node"].max()) + 1 if len(rows) else 0
        at = (rows["tree"].to_numpy(), rows["node"].to_numpy())

        def table(name: str, empty: float) -> np.ndarray:
            out = np.full((trees, width), empty)
            out[at] = rows[name].fillna(empty).to_numpy()
            return out

        self.feature, self.left, self.right = (table(c, -1).astype(np.int64) for c in ("feature", "left", "right"))
        self.threshold, self.prediction = table("threshold", 0.0), table("prediction", 0.0)
        self.weight = np.zeros(trees)
        self.weight[rows["tree"].to_numpy()] = rows["weight"].to_numpy()

    def margins(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """Sum of the weighted trees after each tree, for all rows of ``x``."""
        total, row = np.zeros(len(x)), np.arange(len(x))
        for t in range(len(self.weight)):
            node = np.zeros(len(x), np.int64)
            while True:
                inner = self.left[t, node] >= 0
                if not inner.any():
                    break
                goes_left = x[row, np.maximum(self.feature[t, node], 0)] <= self.threshold[t, node]
                node = np.where(inner, np.where(goes_left, self.left[t, node], self.right[t, node]), node)
            total = total + self.weight[t] * self.prediction[t, node]
            yield total


def prefix_counts(features: DataFrame, cols: Sequence[str], nodes: DataFrame, label: str = "is_match") -> DataFrame:
    """``(prefix, score, n_all, n_pos)``: pairs and matches per distinct score of every prefix (1 is the first tree alone)."""
    forest = Forest(nodes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(cols))])
            y = batch.column(len(cols)).to_numpy(zero_copy_only=False)
            for k, margin in enumerate(forest.margins(x), 1):
                score, own = np.unique(margin, return_inverse=True)
                n, pos = np.bincount(own, minlength=len(score)), np.bincount(own, y, len(score)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(score), k, np.int32)), pa.array(score), pa.array(n), pa.array(pos)],
                    names=["prefix", "score", "n_all", "n_pos"],
                )

    table = fill_missing(features, cols).select(*cols, F.col(label).cast("double").alias("_y"))
    parts = table.mapInArrow(count, "prefix int, score double, n_all long, n_pos long")
    return parts.groupBy("prefix", "score").agg(F.sum("n_all").alias("n_all"), F.sum("n_pos").alias("n_pos"))


def prefix_metrics(features: DataFrame, cols: Sequence[str], nodes: DataFrame, label: str = "is_match") -> DataFrame:
    """``(prefix, pr_auc)``, average precision of every prefix."""
    points = prefix_counts(features, cols, nodes, label).withColumn("_down", -F.col("score"))
    run = running_totals(points, ["prefix"], ["_down"], {"tp": "n_pos", "predicted": "n_all"})
    gain = F.when(F.col("tp_all") > 0, F.col("n_pos") / F.col("tp_all") * (F.col("tp") / F.col("predicted"))).otherwise(0.0)
    return run.groupBy("prefix").agg(F.sum(gain).alias("pr_auc"))


def best_prefix(metrics: DataFrame, patience: int = PATIENCE) -> DataFrame:
    """One row ``(best, pr_auc, stopped_at)``: the best prefix seen when training would have stopped; ties go to the shorter."""
    # As many rows as trees.
    order = Window.partitionBy(F.lit(0)).orderBy("prefix")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    record = F.col("pr_auc") > F.coalesce(F.max("pr_auc").over(before), F.lit(-1.0))
    seen = metrics.withColumn("_new", record).withColumn(
        "_last", F.max(F.when(F.col("_new"), F.col("prefix"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    stop = seen.agg(F.min(F.when(F.col("prefix") - F.col("_last") >= patience, F.col("prefix"))).alias("_s"), F.max("prefix").alias("_e"))
    at = stop.select(F.coalesce("_s", "_e").alias("stopped_at"))
    # Single rows.
    last = seen.join(F.broadcast(at), F.col("prefix") == F.col("stopped_at")).select("stopped_at", F.col("_last").alias("best"))
    return metrics.join(F.broadcast(last), F.col("prefix") == F.col("best")).select("best", "pr_auc", "stopped_at")


def first_trees(fitted: PipelineModel, n: int) -> PipelineModel:
    """The same pipeline with the first ``n`` trees only."""
    whole = fitted.stages[-1]
    java, gateway = whole._java_obj, SparkSession.active().sparkContext._gateway
    trees, weights = java.trees(), java.treeWeights()
    kept = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    kept_weights = gateway.new_array(gateway.jvm.double, n)
    for i in range(n):
        kept[i], kept_weights[i] = trees[i], float(weights[i])
    made = gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), kept, kept_weights)
    made.set(made.getParam("featuresCol"), java.getFeaturesCol())
    return PipelineModel([*fitted.stages[:-1], GBTClassificationModel(made)])


@dataclass
class Boosted:
    """Model of the best prefix, PR-AUC of all prefixes, and the row of ``best_prefix``."""

    fitted: PipelineModel
    metrics: DataFrame
    best: DataFrame


def fit_boosted(
    train: DataFrame, feature_cols: Sequence[str], val: DataFrame, label: str = "is_match", patience: int = PATIENCE, **gbt: float
) -> Boosted:
    """M1: boosted trees on ``train``, cut to the prefix with the best PR-AUC on ``val``."""
    whole = fit_gbt(train, feature_cols, label=label, **gbt)
    metrics = store(prefix_metrics(val, feature_cols_of(whole), stored_trees(whole), label), "prefixes")
    best = store(best_prefix(metrics, patience), "best-prefix")
    return Boosted(first_trees(whole, best.first()["best"]), metrics, best)
