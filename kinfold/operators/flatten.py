"""Nested attribute fields to flat columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_SCHEMA, ProfileSchema
from ..functions import parsing as p

NESTED = ("non_processing_features", "realtime_features", "fs_features")


def _entries(df: DataFrame, name: str):
    is_array = isinstance(df.schema[name].dataType, T.ArrayType)
    return p.kv_entries(F.col(name), is_array)


def flatten(df: DataFrame, schema: ProfileSchema = DEFAULT_SCHEMA) -> DataFrame:
    """np_ (first value wins), rt_ (JSON) and fs_ (values joined) columns.

    ``fs_lone_flags`` lists the fs keys that occur once and without a value.
    """
    np_source, rt_source, fs_source = NESTED
    set_keys = [c.removeprefix("fs_") for c in schema.site_sets]
    parsed = df.select(
        *[c for c in df.columns if c not in NESTED],
        _entries(df, np_source).alias("_np"),
        p.json_map(F.col(rt_source)).alias("_rt"),
        _entries(df, fs_source).alias("_fs"),
    )
    maps = parsed.withColumns(
        {
            "_np_map": p.kv_first_map(F.col("_np")),
            "_fs_map": p.kv_joined_map(F.col("_fs")),
            "fs_lone_flags": p.kv_lone_flags(F.col("_fs")),
        }
    )
    np, rt, fs = F.col("_np_map"), F.col("_rt"), F.col("_fs_map")
    fs_keys = list(schema.fs_keys) + [k for k in set_keys if k not in schema.fs_keys]
    return maps.select(
        *[c for c in parsed.columns if c not in ("_np", "_rt", "_fs")],
        *[np[k].alias(f"np_{k}") for k in schema.np_keys],
        *[rt[k].alias(f"rt_{k}") for k in schema.rt_keys],
        *[
            p.json_nested(rt, k, inner).alias(f"rt_{k}.{inner}")
            for k, inners in schema.rt_nested
            for inner in inners
        ],
        *[fs[k].alias(f"fs_{k}") for k in fs_keys],
        "fs_lone_flags",
    )


def discover_keys(df: DataFrame) -> DataFrame:
    """The prefixed columns that the data would give, with their number of rows."""
    np_source, rt_source, fs_source = NESTED

    def keys(col, prefix):
        return F.transform(F.array_distinct(col), lambda k: F.concat(F.lit(prefix), k))

    np_keys = keys(F.transform(_entries(df, np_source), lambda e: e["k"]), "np_")
    rt_keys = keys(F.map_keys(p.json_map(F.col(rt_source))), "rt_")
    fs_keys = keys(F.transform(_entries(df, fs_source), lambda e: e["k"]), "fs_")
    return (
        df.select(F.explode(F.concat(np_keys, rt_keys, fs_keys)).alias("column_name"))
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def realtime_place(df: DataFrame) -> DataFrame:
    """City, country and geoname of the JSON field; bad JSON gives nulls."""
    place = F.from_json("realtime_features", "city string, country string, geoname string")
    return df.withColumn("_place", place).select(
        *df.columns,
        F.col("_place.city").alias("extracted_city"),
        F.col("_place.country").alias("extracted_country"),
        F.col("_place.geoname").alias("extracted_geoname"),
    )
