"""Folds and samples (L1-L4). Membership is a function of the id: no shuffle, no leak."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocking import attach_both
from .skew import hash_sample, hash_unit


def fold_of(entity: Column, fractions: dict[str, float], seed: int, stratum: Column | None = None) -> Column:
    """Fold whose share of the hash range the entity falls into."""
    unit = hash_unit(seed, *([stratum] if stratum is not None else []), entity)
    names = list(fractions)
    edge, out = 0.0, None
    for name in names[:-1]:
        edge += fractions[name]
        out = F.when(unit < edge, name) if out is None else out.when(unit < edge, name)
    return out.otherwise(names[-1])


def entity_split(profiles: DataFrame, val_fraction: float = 0.25, seed: int = 42) -> DataFrame:
    """L1: ``fold`` train or val for each profile, the same for all profiles of an entity."""
    folds = {"train": 1 - val_fraction, "val": val_fraction}
    return profiles.withColumn("fold", fold_of(F.col("entity_id"), folds, seed))


def split_pairs(pairs: DataFrame, folded: DataFrame) -> DataFrame:
    """L1, L4: pairs inside one fold; pairs across folds are left out."""
    return (
        attach_both(pairs, folded, ["fold"])
        .filter("fold_1 = fold_2")
        .select(*pairs.columns, F.col("fold_1").alias("fold"))
    )


def stratified_split(
    entities: DataFrame,
    fractions: Sequence[float] = (0.6, 0.2, 0.2),
    stratum: str = "entity_type",
    seed: int = 42,
) -> DataFrame:
    """L3: train / val / test inside each stratum."""
    folds = dict(zip(("train", "val", "test"), fractions))
    return entities.withColumn("fold", fold_of(F.col("entity_id"), folds, seed, F.col(stratum)))


def sample_negatives(pairs: DataFrame, ratio: int = 30, seed: int = 42) -> DataFrame:
    """L2: all matches and at most ``ratio`` times as many non-matches, an exact number."""
    # A single row.
    wanted = pairs.agg((F.coalesce(F.sum("is_match"), F.lit(0)) * ratio).alias("_wanted"))
    others = pairs.filter("is_match = 0").join(F.broadcast(wanted))
    kept = hash_sample(others, ["profile_id_1", "profile_id_2"], seed, F.col("_wanted"))
    return pairs.filter("is_match = 1").unionByName(kept.select(*pairs.columns))
