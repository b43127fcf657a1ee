"""Events to one row per profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_SCHEMA, ProfileSchema
from ..functions.normalize import email_domain

# A set with more distinct tokens than this is not stored inside the profile row.
INLINE_SET_LIMIT = 10_000


def last_known(flat: DataFrame, scalars: Sequence[str], order: str, tiebreak: str) -> DataFrame:
    """Last non-null value of each column on its own; a null time counts as latest."""
    rank = F.struct(F.col(order).isNull(), F.col(order), F.col(tiebreak))
    picks = [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_rank"))).alias(c) for c in scalars
    ]
    return (
        flat.filter(F.col("profile_id").isNotNull())
        .withColumn("_rank", rank)
        .groupBy("profile_id")
        .agg(F.max(order).alias(order), *picks)
    )


def _tagged(name: str, values: Column) -> Column:
    """The values of one set column as ``(set_col, token)`` entries."""
    return F.transform(
        F.coalesce(values, F.array().cast("array<string>")),
        lambda t: F.struct(F.lit(name).alias("set_col"), t.alias("token")),
    )


def site_entries(site_sets: Sequence[str]) -> Column:
    """The known site sets of a row as ``(set_col, text)``; a lone flag is no set."""

    def joined(name: str) -> Column:
        text = F.col(name)
        is_flag = F.array_contains("fs_lone_flags", name.removeprefix("fs_"))
        entry = F.struct(F.lit(name).alias("set_col"), text.alias("text"))
        return F.when(text.isNotNull() & (text != "") & ~is_flag, entry)

    return F.array_compact(F.array(*[joined(c) for c in site_sets]))


def site_tokens(flat: DataFrame, site_sets: Sequence[str] = DEFAULT_SCHEMA.site_sets) -> DataFrame:
    """C3 in long form: distinct ``(profile_id, set_col, token)``.

    A profile's tokens are spread over the shuffle, however many it has.
    """
    return (
        flat.filter(F.col("profile_id").isNotNull())
        .select("profile_id", F.explode(site_entries(site_sets)).alias("_e"))
        .select("profile_id", "_e.set_col", F.explode(F.split("_e.text", r"\|")).alias("token"))
        .distinct()
    )


def set_sizes(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("profile_id", "set_col").agg(F.count(F.lit(1)).alias("set_size"))


def inline_sets(
    tokens: DataFrame,
    site_sets: Sequence[str] = DEFAULT_SCHEMA.site_sets,
    limit: int = INLINE_SET_LIMIT,
) -> DataFrame:
    """One sorted array per set column; sets above ``limit`` are only named in ``big_sets``."""
    big = set_sizes(tokens).filter(F.col("set_size") > limit).select("profile_id", "set_col")
    small = tokens.join(big, ["profile_id", "set_col"], "left_anti").groupBy("profile_id").agg(
        *[
            F.sort_array(F.collect_set(F.when(F.col("set_col") == c, F.col("token")))).alias(c)
            for c in site_sets
        ]
    )
    # At most one entry per set column.
    named = big.groupBy("profile_id").agg(F.sort_array(F.collect_set("set_col")).alias("big_sets"))
    return small.join(named, "profile_id", "full").select(
        "profile_id",
        *[F.when(F.size(c) > 0, F.col(c)).alias(c) for c in site_sets],
        F.coalesce("big_sets", F.array().cast("array<string>")).alias("big_sets"),
    )


def collapse(
    flat: DataFrame,
    schema: ProfileSchema = DEFAULT_SCHEMA,
    order: str = "created_at",
    tiebreak: str = "event_id",
    inline_limit: int = INLINE_SET_LIMIT,
    tokens: DataFrame | None = None,
) -> DataFrame:
    """The profile table. ``tokens`` may pass in an already stored ``site_tokens``."""
    scalars = [c for c in (*schema.scalars, "entity_id") if c in flat.columns]
    if tokens is None:
        tokens = site_tokens(flat, schema.site_sets)
    rows = last_known(flat, scalars, order, tiebreak)
    sets = inline_sets(tokens, schema.site_sets, inline_limit)
    return (
        rows.join(sets, "profile_id", "left")
        .withColumn("big_sets", F.coalesce("big_sets", F.array().cast("array<string>")))
        .withColumn("email_domain", email_domain(F.col("email")))
    )


def repeated_ids(profiles: DataFrame) -> DataFrame:
    """Profile ids that occur more than once; empty for a sound table."""
    return (
        profiles.groupBy("profile_id")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter("n_rows > 1")
    )


def tokens_of(profiles: DataFrame, site_sets: Sequence[str] = DEFAULT_SCHEMA.site_sets) -> DataFrame:
    """Long form of the inline sets, for profile tables that were not made here."""
    entries = [_tagged(c, F.col(c)) for c in site_sets if c in profiles.columns]
    return profiles.select("profile_id", F.explode(F.concat(*entries)).alias("_e")).select(
        "profile_id", "_e.set_col", "_e.token"
    )
