"""Prefixes of an ensemble against Spark's own scores and plain Python, and the training flow."""

import math
import random

import pytest
from pyspark.sql import functions as F

from checks import inputs, queries, queries_pairs
from kinfold.config import DEFAULT_SCHEMA
from kinfold.operators import boosting, model
from kinfold.operators.refine import PUBLISHED
from kinfold.plans import inference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        a, b, c = rng.random(), rng.choice([None, 0.0, 1.0, 2.0]), rng.randrange(5)
        rows.append((f"p{i}", f"q{i}", a, b, float(c), int(a + (b or 0) / 3 + rng.random() * 0.6 > 1)))
    return spark.createDataFrame(rows, "profile_id_1 string, profile_id_2 string, a double, b double, c double, is_match int").repartition(3)


@pytest.fixture(scope="module")
def whole(table):
    return model.fit_gbt(table, ["a", "b", "c"], max_iter=8, depth=3)


def average_precision(pairs):
    """Ties count together; no interpolation."""
    positives, tp, n, out = sum(y for _, y in pairs), 0, 0, 0.0
    for s in sorted({s for s, _ in pairs}, reverse=True):
        hits = [y for x, y in pairs if x == s]
        tp, n = tp + sum(hits), n + len(hits)
        out += sum(hits) / positives * (tp / n)
    return out


def test_prefixes_score_as_the_cut_model_does(spark, table, whole):
    nodes = boosting.stored_trees(whole)
    metrics = {r["prefix"]: r["pr_auc"] for r in boosting.prefix_metrics(table, ["a", "b", "c"], nodes).collect()}
    assert sorted(metrics) == list(range(1, 9))
    forest = boosting.Forest(nodes)
    rows = model.fill_missing(table, ["a", "b", "c"]).collect()
    import numpy as np

    margins = list(forest.margins(np.array([[r["a"], r["b"], r["c"]] for r in rows])))
    for k in (1, 3, 8):
        cut = model.predict(boosting.first_trees(whole, k), table)
        got = {r["profile_id_1"]: r["prob_match"] for r in cut.collect()}
        for r, m in zip(rows, margins[k - 1]):
            assert math.isclose(got[r["profile_id_1"]], 1 / (1 + math.exp(-2 * m)), abs_tol=1e-9)
        assert math.isclose(metrics[k], average_precision([(m, r["is_match"]) for r, m in zip(rows, margins[k - 1])]), abs_tol=1e-9)
    full = {r["profile_id_1"]: r["prob_match"] for r in model.predict(whole, table).collect()}
    assert all(math.isclose(full[p], got[p], abs_tol=1e-12) for p in full)


@pytest.mark.parametrize(
    "values,patience,want",
    [([0.1, 0.3, 0.2, 0.3, 0.25, 0.9], 3, (2, 5)), ([0.1, 0.3, 0.2, 0.3, 0.25, 0.9], 50, (6, 6)), ([0.5, 0.4], 1, (1, 2)), ([0.0], 5, (1, 1))],
)
def test_best_prefix(spark, values, patience, want):
    metrics = spark.createDataFrame([(i + 1, v) for i, v in enumerate(values)], "prefix int, pr_auc double").repartition(2)
    row = boosting.best_prefix(metrics, patience).first()
    assert (row["best"], row["stopped_at"]) == want and row["pr_auc"] == values[want[0] - 1]


def test_training_run(spark):
    trained = inference.run_training(inputs.raw_events(spark, SF), PUBLISHED, max_iter=4, depth=3)
    row = trained.thresholds.first()
    assert 0 < row["auto_merge"] <= 1 and 0 < row["pr_auc"] <= 1 and row["blocking_recall"] >= 0.95
    scored = trained.validation.agg(F.min("prob_match"), F.max("prob_match"), F.count(F.lit(1))).first()
    assert 0 <= scored[0] <= scored[1] <= 1 and scored[2] > 0
    assert trained.prefixes.count() == 4
    result = inference.run_inference(inputs.raw_events(spark, SF), PUBLISHED, trained.fitted, row["auto_merge"], 0.0)
    assert result.clusters.count() == result.profiles.count()
    assert queries.fa_pairs(spark, SF).count() == result.pairs.count()


def test_the_registered_fit_keeps_the_best_prefix(spark, monkeypatch):
    monkeypatch.setattr(queries_pairs, "TREE_ROUNDS", 5)
    monkeypatch.setattr(queries, "_STORED", dict(queries._STORED))
    queries._STORED.pop(("trees", spark.sparkContext.applicationId, SF), None)
    found = queries_pairs.boosted(spark, SF)
    best = found.best.first()
    values = {r["prefix"]: r["pr_auc"] for r in found.metrics.collect()}
    assert best["pr_auc"] == max(values.values()) and best["best"] == min(k for k, v in values.items() if v == best["pr_auc"])
    assert found.fitted.stages[-1].getNumTrees == best["best"]
    assert len(model.feature_cols_of(found.fitted)) == len(DEFAULT_SCHEMA.feature_names)
