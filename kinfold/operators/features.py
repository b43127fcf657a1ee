"""Pair features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_SCHEMA, ProfileSchema
from ..functions import similarity as sim
from ..functions.normalize import display_name
from .blocking import attach_both, paired
from .collapse import set_sizes
from ..session import store
from .skew import hash_sample

IDS = ["profile_id_1", "profile_id_2"]


def _both(name: str) -> tuple[Column, Column]:
    return F.col(f"{name}_1"), F.col(f"{name}_2")


def _oversized_overlaps(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """Overlap and sizes of ``(pair, set_col)`` from the long token table."""
    side = {
        s: tokens.select(F.col("profile_id").alias(f"profile_id_{s}"), "set_col", "token") for s in "12"
    }
    shared = (
        pairs.join(side["1"], "profile_id_1")
        .join(side["2"], ["profile_id_2", "set_col", "token"])
        .groupBy(*IDS, "set_col")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    sizes = set_sizes(tokens)
    both = pairs.join(sizes.withColumnsRenamed({"profile_id": "profile_id_1", "set_size": "_s1"}), "profile_id_1")
    both = both.join(
        sizes.withColumnsRenamed({"profile_id": "profile_id_2", "set_size": "_s2"}), ["profile_id_2", "set_col"]
    )
    return both.join(shared, [*IDS, "set_col"], "left").select(
        *IDS, "set_col", F.coalesce("_n", F.lit(0)).alias("_n"), "_s1", "_s2"
    )


def pair_features(
    pairs: DataFrame,
    profiles: DataFrame,
    schema: ProfileSchema = DEFAULT_SCHEMA,
    tokens: DataFrame | None = None,
) -> DataFrame:
    """F1-F8. Give ``tokens`` when profiles may have sets too large to be inline."""
    scalars = [*schema.match, *schema.match_ids, "email_domain", *schema.diffs, "created_at"]
    m = attach_both(pairs, profiles, [*scalars, *schema.site_sets, "big_sets"])

    matches = [
        sim.tri_state(*_both(c)).alias(f"match_{c}")
        for c in (*schema.match, *schema.match_ids, "email_domain")
    ]
    gaps = [sim.number_gap(*_both(c)).alias(f"diff_{c}") for c in schema.diffs]
    days = sim.day_gap(*_both("created_at")).alias("diff_created_days")
    raw_overlaps = [sim.set_overlap(*_both(c)).alias(f"overlap_{c}") for c in schema.site_sets]
    sizes = [F.size(f"{c}_{s}").alias(f"_size_{c}_{s}") for c in schema.site_sets for s in "12"]
    has_big = (F.size("big_sets_1") > 0) | (F.size("big_sets_2") > 0)
    wide = m.select(
        *pairs.columns, *matches, *gaps, days, *raw_overlaps, *sizes, F.coalesce(has_big, F.lit(False)).alias("_big")
    )
    if tokens is not None:
        extra = _oversized_overlaps(wide.filter("_big").select(*IDS), tokens)
        extra = extra.groupBy(*IDS).agg(
            *[
                F.max(F.when(F.col("set_col") == c, F.col(v))).alias(f"_{v}_{c}")
                for c in schema.site_sets
                for v in ("_n", "_s1", "_s2")
            ]
        )
        joined = wide.join(extra, IDS, "left")
        fixed = {}
        for c in schema.site_sets:
            for name, v in ((f"overlap_{c}", "_n"), (f"_size_{c}_1", "_s1"), (f"_size_{c}_2", "_s2")):
                fixed[name] = F.coalesce(F.col(f"_{v}_{c}").cast("int"), F.col(name))
        wide = joined.withColumns(fixed)

    sets = []
    for c in schema.site_sets:
        o = F.col(f"overlap_{c}")
        sets += [sim.jaccard_of(o, F.col(f"_size_{c}_1"), F.col(f"_size_{c}_2")).alias(f"jaccard_{c}"), o]
    any_site = sum((F.greatest(F.col(f"overlap_{c}"), F.lit(0)) for c in schema.site_sets), F.lit(0))
    plain = [c for c in schema.feature_names if c.startswith(("match_", "diff_"))]
    return wide.select(*pairs.columns, *plain, *sets, any_site.alias("overlap_any_site"))


def union_overlap(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """shared tokens of the unions of all site sets."""
    all_tokens = tokens.select("profile_id", "token").distinct()
    side = {s: all_tokens.withColumnRenamed("profile_id", f"profile_id_{s}") for s in "12"}
    shared = (
        pairs.select(*IDS)
        .join(side["1"], "profile_id_1")
        .join(side["2"], ["profile_id_2", "token"])
        .groupBy(*IDS)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return pairs.join(shared, IDS, "left").select(*pairs.columns, F.coalesce("_n", F.lit(0)).alias("overlap_union"))


def name_pairs(
    keys: DataFrame,
    records: DataFrame,
    min_similarity: float = 0.6,
    max_positive: int | None = None,
    max_negative: int | None = None,
    seed: int = 42,
    null_text: str | None = None,
) -> DataFrame:
    """name pairs inside blocks: all true pairs, others from ``min_similarity`` on.

    All are kept unless a limit per class is given: then they are a md5-ordered sample (published balance:
    ``NAME_PAIRS_PER_CLASS``).
    """
    named = keys.join(
        records.select(
            "profile_id",
            "entity_id",
            sim.comparable_text(display_name(F.col("first_name"), F.col("last_name"), null_text)).alias("name"),
        ),
        "profile_id",
    )
    # Names are cleaned once, before the pairs.
    both = (
        paired(store(named, "names"))
        .select(
            *IDS,
            sim.edit_similarity(*_both("name")).alias("similarity"),
            F.coalesce((F.col("entity_id_1") == F.col("entity_id_2")).cast("int"), F.lit(0)).alias("label"),
        )
        .filter((F.col("label") == 1) | (F.col("similarity") >= min_similarity))
    )
    if max_positive is not None or max_negative is not None:
        # Read once for each class.
        both = store(both, "name-pairs")
    else:
        return both
    out = []
    for label, cap in ((1, max_positive), (0, max_negative)):
        part = both.filter(F.col("label") == label)
        out.append(part if cap is None else hash_sample(part, IDS, seed, cap))
    return out[0].unionByName(out[1])


def contact_features(pairs: DataFrame, records: DataFrame, null_text: str | None = None) -> DataFrame:
    """Domain, registration gap, city and country of both sides.

    ``records`` needs email_domain (N6), created_at, extracted_city, extracted_country.
    """
    m = attach_both(pairs, records, ["email_domain", "created_at", "extracted_city", "extracted_country"])
    return m.select(
        *pairs.columns,
        sim.same_domain(*_both("email_domain")).alias("email_domain_match"),
        sim.day_gap(*_both("created_at")).alias("registration_diff_days"),
        sim.same_place(*_both("extracted_city"), null_text).alias("city_match"),
        sim.same_place(*_both("extracted_country"), null_text).alias("country_match"),
    )


def standardize(df: DataFrame, col: str, new: str) -> DataFrame:
    """z-score with the population deviation; missing values stay missing."""
    # A single row, so the broadcast is bounded.
    fit = df.agg(F.avg(col).alias("_mean"), F.stddev_pop(col).alias("_std"))
    scale = F.when(F.col("_std") > 0, F.col("_std")).otherwise(1.0)
    return df.join(F.broadcast(fit)).select(*df.columns, ((F.col(col) - F.col("_mean")) / scale).alias(new))


def feature_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, sum, mean, population deviation, minimum and maximum per column."""
    values = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols]
    )
    return (
        df.select(F.inline(values))
        .groupBy("feature")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("value").alias("n_known"),
            F.sum("value").alias("total"),
            F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std"),
            F.min("value").alias("minimum"),
            F.max("value").alias("maximum"),
        )
    )


def drop_features(df: DataFrame, names: list[str]) -> DataFrame:
    """the table without the named columns."""
    return df.drop(*names)
