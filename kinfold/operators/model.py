"""Pair models: boosted trees, logistic regression, scoring, explanation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import AUTO_MERGE_THRESHOLD, REVIEW_THRESHOLD
from ..session import shared_dir
from .components import action

MISSING = -1.0
IDS = ("profile_id_1", "profile_id_2")


def fill_missing(features: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Numbers only; a missing difference becomes -1, below every real one."""
    return features.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in cols})


def balance_weights(df: DataFrame, label: str) -> DataFrame:
    """Weight of a class: size of the larger class over its own size."""
    # A single row.
    n = df.agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n"))
    own = F.when(F.col(label) == 1, F.col("_p")).otherwise(F.col("_n"))
    weight = F.greatest("_p", "_n") / F.greatest(own, F.lit(1))
    return df.join(F.broadcast(n)).withColumn("weight", weight).drop("_p", "_n")


def fit_gbt(
    train: DataFrame,
    feature_cols: Sequence[str],
    val: DataFrame | None = None,
    label: str = "is_match",
    max_iter: int = 500,
    step: float = 0.08,
    depth: int = 6,
    seed: int = 42,
) -> PipelineModel:
    """M1: boosted trees with balanced classes; ``val`` switches early stopping on."""
    shared_dir(train.sparkSession)
    data = balance_weights(train, label).withColumn("is_val", F.lit(False))
    trees = GBTClassifier(
        labelCol=label,
        featuresCol="features",
        weightCol="weight",
        maxIter=max_iter,
        stepSize=step,
        maxDepth=depth,
        seed=seed,
        cacheNodeIds=True,
        checkpointInterval=10,
    )
    if val is not None:
        data = data.unionByName(balance_weights(val, label).withColumn("is_val", F.lit(True)))
        trees = trees.setValidationIndicatorCol("is_val")
    return _fit(trees, data, feature_cols)


def fit_logistic(
    train: DataFrame, feature_cols: Sequence[str], label: str = "label", c: float = 1.0, max_iter: int = 1000
) -> PipelineModel:
    """M2: L2-penalised logistic regression with inverse strength ``c``."""
    n = train.count()
    model = LogisticRegression(
        labelCol=label,
        featuresCol="features",
        regParam=1.0 / (c * max(n, 1)),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=1e-9,
    )
    return _fit(model, train, feature_cols)


def _fit(estimator, data: DataFrame, feature_cols: Sequence[str]) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(feature_cols), outputCol="features")
    filled = fill_missing(data, feature_cols)
    return Pipeline(stages=[assembler, estimator]).fit(filled)


def feature_cols_of(model: PipelineModel) -> list[str]:
    return list(model.stages[0].getInputCols())


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """M3: adds ``prob_match``."""
    out = model.transform(fill_missing(features, feature_cols_of(model)))
    prob = vector_to_array("probability")[1]
    return out.withColumn("prob_match", prob).drop("features", "rawPrediction", "probability", "prediction")


def score(
    features: DataFrame,
    model: PipelineModel,
    auto: float = AUTO_MERGE_THRESHOLD,
    review: float = REVIEW_THRESHOLD,
) -> DataFrame:
    """M5, M6: probability and decision per pair, for batch and streaming tables."""
    return predict(model, features).select(
        *IDS, "prob_match", action(F.col("prob_match"), auto, review).alias("action")
    )


def score_maps(requests: DataFrame, model: PipelineModel, **thresholds: float) -> DataFrame:
    """M6: scoring of ready-made features given as ``features MAP<STRING,DOUBLE>``."""
    cols = feature_cols_of(model)
    flat = requests.select(*IDS, *[F.try_element_at("features", F.lit(c)).alias(c) for c in cols])
    return score(flat, model, **thresholds)


def importance(model: PipelineModel, spark) -> DataFrame:
    """Coefficients (or tree importances) by absolute size; one row per feature."""
    fitted = model.stages[-1]
    values = fitted.coefficients if hasattr(fitted, "coefficients") else fitted.featureImportances
    rows = [(n, float(v), abs(float(v))) for n, v in zip(feature_cols_of(model), values.toArray())]
    return spark.createDataFrame(rows, "feature string, coefficient double, abs_coefficient double")


def explain_pairs(features: DataFrame, model: PipelineModel, top_k: int = 12) -> DataFrame:
    """The ``top_k`` largest contributions coefficient * value of every pair, for linear models."""
    if not hasattr(model.stages[-1], "coefficients"):
        raise ValueError("contributions need a linear model; tree models have no coefficients")
    cols = feature_cols_of(model)
    weights = [float(v) for v in model.stages[-1].coefficients.toArray()]
    filled = fill_missing(features, cols)
    parts = F.array(
        *[
            F.struct(
                F.abs(F.col(c) * w).alias("size"),
                F.lit(c).alias("feature"),
                F.col(c).alias("value"),
                (F.col(c) * w).alias("contribution"),
            )
            for c, w in zip(cols, weights)
        ]
    )
    # The parts of one pair are as many as features, so they are sorted in place.
    top = F.slice(F.sort_array(parts, asc=False), 1, top_k)
    return filled.select(*IDS, F.posexplode(top).alias("rank", "part")).select(
        *IDS, (F.col("rank") + 1).alias("rank"), "part.feature", "part.value", "part.contribution"
    )


def compare_raw(both: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Raw values of both sides with ``=``, ``≠`` or ``·`` (a side is missing)."""

    def line(c: str):
        a, b = F.col(f"{c}_1").cast("string"), F.col(f"{c}_2").cast("string")
        mark = F.when(a.isNull() | b.isNull(), "·").when(a == b, "=").otherwise("≠")
        return F.struct(F.lit(c).alias("field"), a.alias("value_1"), b.alias("value_2"), mark.alias("mark"))

    return both.select(*IDS, F.inline(F.array(*[line(c) for c in cols])))


def rule_score(features: DataFrame, overlap: str = "overlap_fs_visited_365") -> DataFrame:
    """A score without a trained model: shared sites, then matching attributes, in tenths."""
    points = 2 * F.least(F.greatest(F.col(overlap), F.lit(0)), F.lit(3))
    for c in ("first_name", "rt_geoid", "sex", "email_domain"):
        points = points + F.greatest(F.col(f"match_{c}"), F.lit(0))
    return features.withColumn("prob_match", points / F.lit(10.0))


