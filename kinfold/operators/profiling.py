"""Exploratory aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import normalize as n
from .skew import hash_sample, range_split, running_totals

PII = ("first_name", "last_name", "email", "phone", "birthday", "sex")
FLAG_PII = ("first_name", "last_name", "email", "phone")
MICROS_PER_HOUR = 3_600_000_000


def _long(row: DataFrame, names: Sequence[str], values: dict[str, dict[str, Column]], key: str) -> DataFrame:
    """One wide row to one row per name."""
    items = [
        F.struct(F.lit(name).alias(key), *[c.alias(a) for a, c in values[name].items()]) for name in names
    ]
    return row.select(F.inline(F.array(*items)))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A1, A2: type, rows, known values, nulls and null share per column, in one pass."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(f"_{c}") for c in cols])
    values = {
        c: {
            "data_type": F.lit(types[c]),
            "n_rows": F.col("_n"),
            "n_known": F.col(f"_{c}"),
            "n_null": F.col("_n") - F.col(f"_{c}"),
            "null_share": F.when(F.col("_n") > 0, (F.col("_n") - F.col(f"_{c}")) / F.col("_n")),
        }
        for c in cols
    }
    return _long(row, cols, values, "column_name")


def table_shape(df: DataFrame) -> DataFrame:
    """A1: number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def entity_missing(df: DataFrame) -> DataFrame:
    """A3: missing contact fields per entity, with the two flags."""
    missing = df.filter(F.col("entity_id").isNotNull()).groupBy("entity_id").agg(
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in PII],
        F.count(F.lit(1)).alias("profile_count"),
    )
    everything, anything = F.lit(True), F.lit(False)
    for c in FLAG_PII:
        everything &= F.col(f"missing_{c}") == F.col("profile_count")
        anything |= F.col(f"missing_{c}") > 0
    return missing.withColumns({"all_missing": everything, "partial_missing": ~everything & anything})


def missing_summary(missing: DataFrame) -> DataFrame:
    """A3: entities with all or some key fields missing."""
    return missing.agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.count_if("all_missing").alias("n_all_missing"),
        F.count_if("partial_missing").alias("n_partial_missing"),
    )


def null_correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A4: correlation of null indicators; null where an indicator is constant."""
    pairs = [(a, b) for a in cols for b in cols]
    both = {(a, b): F.count_if(F.col(a).isNull() & F.col(b).isNull()) for a, b in pairs}
    row = df.agg(F.count(F.lit(1)).cast("double").alias("_n"), *[c.cast("double").alias(f"_{a}_{b}") for (a, b), c in both.items()])
    total = F.col("_n")

    def corr(a: str, b: str) -> Column:
        x, y, xy = F.col(f"_{a}_{a}"), F.col(f"_{b}_{b}"), F.col(f"_{a}_{b}")
        spread = x * (total - x) * y * (total - y)
        return F.when(spread > 0, (total * xy - x * y) / F.sqrt(spread))

    items = [F.struct(F.lit(a).alias("column_1"), F.lit(b).alias("column_2"), corr(a, b).alias("corr")) for a, b in pairs]
    return row.select(F.inline(F.array(*items)))


#: Precision of distinct-count sketches: 2^14 registers, one standard error of 0.8 %.
SKETCH_BITS = 14


def duplicate_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """A5: rows that repeat an earlier row in the subset; nulls are equal."""
    groups = df.groupBy(*subset).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"))


def distinct_counts(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct known values per column."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(f"n_{c}") for c in cols])


def distinct_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), bits: int = SKETCH_BITS) -> DataFrame:
    """A6, mergeable: one HLL sketch per column and group, e.g. per week; store them and add them up later."""
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), bits).alias(c) for c in cols])


def merged_distinct_counts(sketches: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """A6 from sketches of any groups: distinct values of all of them, off by about 1.04 / 2^(bits / 2) of the count (one standard error)."""
    return sketches.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(f"n_{c}") for c in cols])


def distinct_per_entity(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """Distinct known values per entity. Each value meets its entity once before counting."""
    return (
        df.filter(F.col("entity_id").isNotNull())
        .select("entity_id", *[c.alias(name) for name, c in cols.items()])
        .groupBy("entity_id")
        .agg(*[F.count_distinct(F.col(name)).alias(f"n_{name}") for name in cols])
    )


def names_per_entity_stats(df: DataFrame) -> DataFrame:
    """Mean, median, maximum and minimum of distinct full names per entity."""
    names = distinct_per_entity(df, {"names": n.full_name(F.col("first_name"), F.col("last_name"))})
    histogram = names.groupBy("n_names").agg(F.count(F.lit(1)).alias("_c"))
    return histogram.agg(
        (F.sum(F.col("n_names") * F.col("_c")) / F.sum("_c")).alias("mean"),
        F.percentile("n_names", F.lit(0.5), F.col("_c")).alias("median"),
        F.max("n_names").alias("maximum"),
        F.min("n_names").alias("minimum"),
    )


def domains_per_entity(df: DataFrame) -> DataFrame:
    """Rows per entity and e-mail domain, nulls left out."""
    return (
        df.filter(F.col("entity_id").isNotNull() & F.col("email_domain").isNotNull())
        .groupBy("entity_id", "email_domain")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def same_domain_entities(per_domain: DataFrame) -> DataFrame:
    """Entities with e-mail, and those with several rows in one domain."""
    per_entity = per_domain.groupBy("entity_id").agg(F.max("n_rows").alias("_m"))
    return per_entity.agg(
        F.count(F.lit(1)).alias("n_entities_with_email"),
        F.count_if(F.col("_m") > 1).alias("n_entities_same_domain"),
    )


def consistency(df: DataFrame) -> DataFrame:
    """Entities with more than one value, and the consistent share, per field."""
    fields = {
        "country_code": n.phone_country(F.col("phone")),
        "operator_code": n.phone_operator(F.col("phone")),
        "phone": F.col("phone"),
        "birthday": F.col("birthday"),
        "sex": F.col("sex"),
    }
    counts = distinct_per_entity(df, fields)
    row = counts.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(f"n_{f}") > 1).alias(f"_{f}") for f in fields]
    )
    values = {
        f: {
            "n_entities": F.col("_n"),
            "n_inconsistent": F.col(f"_{f}"),
            "consistent_share": F.when(F.col("_n") > 0, (F.col("_n") - F.col(f"_{f}")) / F.col("_n")),
        }
        for f in fields
    }
    return _long(row, list(fields), values, "field")


def distinct_histogram(df: DataFrame, value: Column) -> DataFrame:
    """A10: how many entities have 0, 1, 2 … distinct values."""
    return distinct_per_entity(df, {"v": value}).groupBy(F.col("n_v").alias("n_distinct")).agg(
        F.count(F.lit(1)).alias("n_entities")
    )


def values_in_inconsistent(df: DataFrame, col: str) -> DataFrame:
    """Value counts inside entities that have more than one value.

    Rows are counted per entity and value first, so no entity is large afterwards.
    """
    counts = df.filter(F.col("entity_id").isNotNull() & F.col(col).isNotNull()).groupBy("entity_id", col).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    many = counts.groupBy("entity_id").agg(F.count(F.lit(1)).alias("_k")).filter("_k > 1").select("entity_id")
    return counts.join(many, "entity_id", "left_semi")


def placeholder_birthdays(df: DataFrame) -> DataFrame:
    """Entities by number of rows with the 01.01 birthday."""
    rows = df.filter(n.is_new_year_birthday(F.col("birthday")) & F.col("entity_id").isNotNull())
    per_entity = rows.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return per_entity.groupBy("n_rows").agg(F.count(F.lit(1)).alias("n_entities"))


def entity_types(df: DataFrame, by: str = "profiles") -> DataFrame:
    """Single or multi, by distinct profiles (default) or by rows."""
    size = F.count_distinct("profile_id") if by == "profiles" else F.count(F.lit(1))
    grouped = df.filter(F.col("entity_id").isNotNull()).groupBy("entity_id").agg(size.alias("n_profiles"))
    kind = F.when(F.col("n_profiles") > 1, "multi_profile").otherwise("single_profile")
    return grouped.withColumn("entity_type", kind)


def entity_type_summary(types: DataFrame) -> DataFrame:
    """Entities and share per type."""
    counts = types.groupBy("entity_type").agg(F.count(F.lit(1)).alias("n_entities"))
    everything = Window.partitionBy(F.lit(0))  # two rows
    return counts.withColumn("share", F.col("n_entities") / F.sum("n_entities").over(everything))


def multi_entity_times(df: DataFrame) -> DataFrame:
    """Rows of multi-row entities per weekday (Monday 0) and per hour."""
    cells = (
        df.filter(F.col("entity_id").isNotNull() & F.col("created_at").isNotNull())
        .groupBy("entity_id", n.day_of_week(F.col("created_at")).alias("dow"), F.hour("created_at").alias("hour"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    multi = entity_types(df, by="rows").filter("n_profiles > 1").select("entity_id")
    kept = cells.join(multi, "entity_id", "left_semi")
    unit = F.inline(
        F.array(
            F.struct(F.lit("day_of_week").alias("unit"), F.col("dow").alias("value")),
            F.struct(F.lit("hour").alias("unit"), F.col("hour").alias("value")),
        )
    )
    return kept.groupBy("dow", "hour").agg(F.sum("_n").alias("_n")).select("_n", unit).groupBy("unit", "value").agg(
        F.sum("_n").alias("n_rows")
    )


def profiles_histogram(types: DataFrame) -> DataFrame:
    """Entities per number of profiles."""
    return types.groupBy("n_profiles").agg(F.count(F.lit(1)).alias("n_entities"))


def time_gaps(df: DataFrame, entity: str = "entity_id", time: str = "created_at") -> DataFrame:
    """Shortest, longest and mean gap in hours between an entity's rows, and its rows.

    Times are cut into sorted ranges; gaps inside a range and gaps between ranges are
    found apart, so one entity may hold any part of all rows.
    """
    known = df.filter(F.col(entity).isNotNull())
    rows = known.groupBy(entity).agg(F.count(F.lit(1)).alias("profile_count"))
    points = known.filter(F.col(time).isNotNull()).groupBy(entity, time).agg(F.count(F.lit(1)).alias("_c"))
    split = range_split(points, [entity], [time])

    def micros(later: Column, earlier: Column) -> Column:
        return F.timestamp_diff("MICROSECOND", earlier, later)

    before = F.lag(time).over(Window.partitionBy(entity, "_part").orderBy(time))
    inside = split.withColumn("_gap", micros(F.col(time), before))
    ranges = inside.groupBy(entity, "_part").agg(
        F.min(time).alias("_first"),
        F.max(time).alias("_last"),
        F.min("_gap").alias("_min"),
        F.max("_gap").alias("_max"),
        F.sum("_c").alias("_c"),
        F.max("_c").alias("_same"),
    )
    # One row per range of an entity.
    step = micros(F.col("_first"), F.lag("_last").over(Window.partitionBy(entity).orderBy("_part")))
    joined = ranges.withColumn("_step", step).groupBy(entity).agg(
        F.least(F.min("_min"), F.min("_step")).alias("_min"),
        F.greatest(F.max("_max"), F.max("_step")).alias("_max"),
        micros(F.max("_last"), F.min("_first")).alias("_span"),
        F.sum("_c").alias("_c"),
        F.max("_same").alias("_same"),
    )
    hours = lambda c: F.coalesce(c / F.lit(float(MICROS_PER_HOUR)), F.lit(0.0))
    shortest = F.when(F.col("_same") > 1, F.lit(0)).otherwise(F.col("_min"))
    mean = F.when(F.col("_c") > 1, F.col("_span") / (F.col("_c") - 1))
    return rows.join(joined, entity, "left").select(
        entity,
        hours(shortest).alias("min_gap_hours"),
        hours(F.col("_max")).alias("max_gap_hours"),
        hours(mean).alias("mean_gap_hours"),
        "profile_count",
    )


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles, maximum per column.

    Quartiles come from running totals over distinct values, not from one sorted list.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])
    long = df.select(F.inline(pairs)).filter(F.col("value").isNotNull())
    basic = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    values = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("_c"))
    run = running_totals(values, ["feature"], ["value"], {"_cum": "_c"})
    at = F.col("_cum")

    def quartile(q: float) -> Column:
        place = (F.col("_cum_all") - 1) * F.lit(q)
        low = F.min(F.when(at > F.floor(place), F.col("value")))
        high = F.min(F.when(at > F.ceil(place), F.col("value")))
        part = F.max(place - F.floor(place))
        return low + (high - low) * part

    quartiles = run.groupBy("feature").agg(
        *[quartile(q).alias(name) for q, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))]
    )
    return basic.join(quartiles, "feature").select(
        "feature", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def top_values(df: DataFrame, col: str, k: int = 8) -> DataFrame:
    """The k most frequent known values."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.orderBy(F.desc("n_rows"), col).limit(k)


def domains_of_multi(df: DataFrame) -> DataFrame:
    """Distinct domains per multi-profile entity."""
    return (
        df.filter(F.col("entity_id").isNotNull())
        .groupBy("entity_id")
        .agg(F.count_distinct("profile_id").alias("_p"), F.count_distinct("email_domain").alias("n_domains"))
        .filter("_p > 1")
        .drop("_p")
    )


def cross_domain_share(domains: DataFrame) -> DataFrame:
    """Share of multi-profile entities with more than one domain."""
    return domains.agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.avg((F.col("n_domains") > 1).cast("double")).alias("cross_domain_share"),
    )


def normalize_contacts(df: DataFrame) -> DataFrame:
    """N1-N3 as additional columns."""
    return df.withColumns(
        {
            "normalized_phone": n.normalize_phone(F.col("phone")),
            "normalized_first_name": n.normalize_name(F.col("first_name")),
            "normalized_last_name": n.normalize_name(F.col("last_name")),
            "normalized_email": n.normalize_email(F.col("email")),
        }
    )


def normalized_summary(df: DataFrame) -> DataFrame:
    """Known values after normalisation."""
    cols = ("normalized_phone", "normalized_email", "normalized_first_name", "normalized_last_name")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(f"n_{c}") for c in cols])


def phone_prefixes(df: DataFrame) -> DataFrame:
    """Rows per phone prefix, null included."""
    prefix = n.phone_country(F.col("normalized_phone"))
    return df.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n_rows"))


def email_changes(df: DataFrame) -> DataFrame:
    """Addresses changed by normalisation, in total and per provider. Null stays unchanged."""
    changed = ~F.col("email").eqNullSafe(F.col("normalized_email"))
    domain = n.email_domain(F.col("email"))
    return df.agg(
        F.count_if(changed).alias("n_changed"),
        F.count_if(changed & domain.contains("gmail")).alias("n_gmail"),
        F.count_if(changed & domain.isin(*n.MAIL_RU_FAMILY)).alias("n_mail_ru"),
        F.count_if(changed & domain.isin(*n.YANDEX_FAMILY)).alias("n_yandex"),
    )


def name_patterns(df: DataFrame, col: str = "first_name") -> DataFrame:
    """Names with a space, initials, Latin letters, Cyrillic letters."""
    c = F.col(col)
    return df.agg(
        F.count_if(c.contains(" ")).alias("full_name"),
        F.count_if(c.rlike(n.INITIALS_PATTERN)).alias("initials"),
        F.count_if(c.rlike(n.LATIN_PATTERN)).alias("translit"),
        F.count_if(c.rlike(n.CYRILLIC_PATTERN)).alias("cyrillic"),
    )


def phone_formats(df: DataFrame, col: str = "phone") -> DataFrame:
    """Rows per phone format."""
    return df.groupBy(n.phone_format(F.col(col)).alias("phone_format")).agg(F.count(F.lit(1)).alias("n_rows"))


def sample_rows(df: DataFrame, ids: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    """K rows for a look at the data, the same on every run."""
    return hash_sample(df, ids, seed, k)
