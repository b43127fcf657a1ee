"""Events to duplicate clusters, and training."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import (
    AUTO_MERGE_THRESHOLD,
    DEFAULT_SCHEMA,
    REVIEW_THRESHOLD,
    ProfileSchema,
)
from ..operators import blocking, boosting, collapse, components, evaluate, features, model, splits
from ..operators.flatten import flatten
from ..operators.refine import BlockRule
from ..session import cut_lineage, store as store_table


#: A fitted model, or a function that adds ``prob_match`` to a feature table.
Scorer = PipelineModel | Callable[[DataFrame], DataFrame]


@dataclass
class Profiles:
    """Profile rows and the long table of their site tokens."""

    rows: DataFrame
    tokens: DataFrame


@dataclass
class Result:
    profiles: DataFrame
    pairs: DataFrame
    clusters: DataFrame
    summary: DataFrame
    dropped: DataFrame


def preprocess(raw: DataFrame, schema: ProfileSchema = DEFAULT_SCHEMA, store: bool = False) -> Profiles:
    """Events to profiles. ``store`` writes both tables once for the many later readers."""
    flat = flatten(raw, schema)
    tokens = collapse.site_tokens(flat, schema.site_sets)
    if store:
        tokens = store_table(tokens, "tokens")
    rows = collapse.collapse(flat, schema, tokens=tokens)
    return Profiles(store_table(rows, "profiles") if store else rows, tokens)


def candidates(
    profiles: Profiles,
    rule: BlockRule,
    labeled: bool = False,
    seed: int = 0,
) -> DataFrame:
    """Candidate pairs, labelled on request."""
    blocks = blocking.build_blocks(profiles.rows, profiles.tokens, rule, seed)
    return blocking.labelled_pairs_from_blocks(blocks, profiles.rows) if labeled else blocking.pairs_from_blocks(blocks)


def score_pairs(
    pairs: DataFrame,
    profiles: Profiles,
    fitted: Scorer,
    auto: float = AUTO_MERGE_THRESHOLD,
    review: float = REVIEW_THRESHOLD,
    schema: ProfileSchema = DEFAULT_SCHEMA,
) -> DataFrame:
    """M5: features, probability, decision, by a fitted model or a function that adds ``prob_match``."""
    table = features.pair_features(pairs, profiles.rows, schema, profiles.tokens)
    if isinstance(fitted, PipelineModel):
        return model.score(table, fitted, auto, review)
    return fitted(table).select(
        "profile_id_1",
        "profile_id_2",
        "prob_match",
        components.action(F.col("prob_match"), auto, review).alias("action"),
    )


def run_inference(
    raw: DataFrame,
    rule: BlockRule,
    fitted: Scorer,
    auto: float = AUTO_MERGE_THRESHOLD,
    review: float = REVIEW_THRESHOLD,
    min_action: str = components.AUTO_MERGE,
    schema: ProfileSchema = DEFAULT_SCHEMA,
) -> Result:
    """Batch inference. Profiles and scored pairs are stored once, being read several times.

    ``fitted`` is the model of ``run_training``, or ``model.rule_score`` where the rule is wanted.
    ``rule`` says what becomes of large blocks (``PUBLISHED``, ``REFINED`` or limits of one's own); ``dropped`` of the result tells what it costs.
    """
    profiles = preprocess(raw, schema, store=True)
    blocks, dropped = blocking.blocks_and_losses(profiles.rows, profiles.tokens, rule)
    pairs = blocking.pairs_from_blocks(blocks)
    scored = store_table(score_pairs(pairs, profiles, fitted, auto, review, schema), "scored")
    clusters = components.connected_components(
        components.accepted_edges(scored, min_action), profiles.rows
    )
    summary = components.inference_summary(profiles.rows, scored, clusters)
    return Result(profiles.rows, scored, clusters, summary, dropped)


@dataclass
class Training:
    """Model, scored validation pairs, threshold record, PR-AUC of every prefix of the ensemble."""

    fitted: PipelineModel
    validation: DataFrame
    thresholds: DataFrame
    prefixes: DataFrame


def run_training(
    raw: DataFrame,
    rule: BlockRule,
    val_fraction: float = 0.25,
    neg_ratio: int = 30,
    seed: int = 42,
    target_precision: float = evaluate.TARGET_PRECISION,
    schema: ProfileSchema = DEFAULT_SCHEMA,
    **gbt: float,
) -> Training:
    """Labelled candidates, split by entity, balanced training fold, fit, best prefix, calibrated thresholds."""
    profiles = preprocess(raw, schema, store=True)
    pairs = store_table(candidates(profiles, rule, labeled=True), "pairs")
    recall = blocking.blocking_recall(pairs, profiles.rows)
    folded = splits.split_pairs(pairs, splits.entity_split(profiles.rows, val_fraction, seed))
    train = splits.sample_negatives(folded.filter("fold = 'train'").drop("fold"), neg_ratio, seed)
    val = folded.filter("fold = 'val'").drop("fold")
    x_train = store_table(features.pair_features(train, profiles.rows, schema, profiles.tokens), "train")
    x_val = store_table(features.pair_features(val, profiles.rows, schema, profiles.tokens), "val")
    boosted = boosting.fit_boosted(x_train, schema.feature_names, x_val, seed=seed, **gbt)
    fitted = boosted.fitted
    predicted = store_table(
        model.predict(fitted, x_val).select("profile_id_1", "profile_id_2", "is_match", "prob_match"), "predicted"
    )
    curve = cut_lineage(evaluate.pr_curve(predicted, "prob_match", "is_match"))
    # Single rows.
    record = (
        evaluate.calibrate(curve, target_precision)
        .join(F.broadcast(evaluate.average_precision(curve)))
        .join(F.broadcast(recall.select(F.col("recall").alias("blocking_recall"))))
    )
    return Training(fitted, predicted, record, boosted.metrics)
