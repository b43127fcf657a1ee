"""Readers and writers."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT_FORMATS = {"csv": ",", "tsv": "\t"}

# Text files carry every nested field in its text form; times are parsed after reading.
EVENT_COLUMNS = (
    "created_at",
    "first_name",
    "last_name",
    "email",
    "phone",
    "birthday",
    "sex",
    "non_processing_features",
    "realtime_features",
    "fs_features",
    "profile_id",
    "entity_id",
)


def event_schema(extra: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in (*EVENT_COLUMNS, *extra)])


def format_of(path: str) -> str:
    """Format by suffix; unknown suffixes are refused."""
    suffix = PurePosixPath(path).suffix.lstrip(".")
    if suffix == "parquet" or suffix in TEXT_FORMATS:
        return suffix
    raise ValueError(f"unknown format: {path}")


def typed(df: DataFrame) -> DataFrame:
    """N16 on the time columns: bad text becomes null."""
    out = df
    if dict(df.dtypes)["created_at"] != "timestamp_ntz":
        out = out.withColumn("created_at", F.col("created_at").try_cast("timestamp_ntz"))
    if dict(df.dtypes)["birthday"] != "date":
        out = out.withColumn("birthday", F.col("birthday").try_cast("date"))
    return out


def read_events(
    spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """Events from parquet, csv or tsv. Text files are read with a declared schema.

    A quoted field may hold a quote written twice, as csv writers do.
    """
    fmt = fmt or format_of(path)
    if fmt == "parquet":
        return typed(spark.read.parquet(path))
    if fmt not in TEXT_FORMATS:
        raise ValueError(f"unknown format: {fmt}")
    reader = spark.read.schema(schema or event_schema()).options(
        sep=TEXT_FORMATS[fmt], header=True, quote='"', escape='"', multiLine=False
    )
    return typed(reader.csv(path))


def write_events(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Events as parquet, csv or tsv."""
    writer = df.write.mode(mode)
    if fmt == "parquet":
        writer.parquet(path)
    elif fmt in TEXT_FORMATS:
        # As text a time keeps its microseconds.
        times = [c for c, t in df.dtypes if t.startswith("timestamp")]
        plain = df.withColumns({c: F.col(c).cast("string") for c in times}) if times else df
        plain.write.mode(mode).options(sep=TEXT_FORMATS[fmt], header=True, quote='"', escape='"').csv(path)
    else:
        raise ValueError(f"unknown format: {fmt}")


def write_pairs(scored: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """Scored pairs, best first (range-sorted part files)."""
    ordered = scored.orderBy(F.desc("prob_match"), "profile_id_1", "profile_id_2")
    _table(ordered, path, fmt, mode)


def write_clusters(clusters: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """Cluster map."""
    _table(clusters, path, fmt, mode)


def _table(df: DataFrame, path: str, fmt: str, mode: str) -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.csv(path, header=True)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format: {fmt}")


THRESHOLD_SCHEMA = (
    "auto_merge double, review double, auto_precision double, review_precision double, "
    "review_recall double, review_f1 double, pr_auc double, blocking_recall double"
)


def save_thresholds(row: DataFrame, path: str) -> None:
    """The threshold record as JSON."""
    row.coalesce(1).write.mode("overwrite").json(path)


def load_thresholds(spark: SparkSession, path: str) -> DataFrame:
    """One row."""
    return spark.read.schema(THRESHOLD_SCHEMA).json(path)


def save_model(model, path: str) -> None:
    """A fitted model in the native format."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """S7."""
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)


def week_of(col):
    """Monday of the week, as text for a partition folder."""
    return F.date_format(F.date_trunc("week", col), "yyyy-MM-dd")


def write_weekly_snapshot(df: DataFrame, path: str, time_col: str = "created_at") -> None:
    """Profiles by week; writing a week again replaces only that week."""
    (
        df.withColumn("week", F.coalesce(week_of(F.col(time_col)), F.lit("unknown")))
        # Rows of a week meet, a large week in several files.
        .hint("rebalance", "week")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("week")
        .parquet(path)
    )


def read_week(spark: SparkSession, path: str, week: str) -> DataFrame:
    """One week; other folders are not opened."""
    return spark.read.parquet(path).filter(F.col("week") == week)


def append_decisions(log: DataFrame, path: str) -> None:
    """Append to the decision log, by day."""
    log.withColumn("day", F.to_date("ts")).hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(path)
