"""Streaming collapse and new-against-stored blocking."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_SCHEMA, ProfileSchema
from ..functions.normalize import email_domain
from ..operators.blocking import prune_blocks
from ..operators.collapse import last_known, site_tokens
from ..session import scratch_path


def read_stream(spark: SparkSession, folder: str, schema, files: str = "*.parquet", per_trigger: int = 1000) -> DataFrame:
    """Parquet files of a folder as a stream."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", files)
        .option("maxFilesPerTrigger", per_trigger)
        .parquet(folder)
    )


def drain(
    stream: DataFrame, out: str, checkpoint: str, mode: str = "update", after: Callable[[int], None] | None = None
) -> None:
    """Process what is available and append each micro-batch to ``out``.

    A batch writes its own folder, so a repeated batch replaces itself. ``after`` is called with the number of each written batch.
    """

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
        if after:
            after(number)

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(keep)
        .start()
    )
    query.awaitTermination()


def latest_rows(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """Last version of every key written by ``drain`` in update mode."""
    rows = spark.read.parquet(out)
    others = [c for c in rows.columns if c not in keys and c != "batch"]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch").alias("_v")).select(*keys, "_v.*")


def run_available(stream: DataFrame, keys: Sequence[str], mode: str = "update") -> DataFrame:
    """Drain a stream into a new folder and return its state."""
    spark = stream.sparkSession
    out = scratch_path(spark, "stream")
    drain(stream, out, scratch_path(spark, "stream-state"), mode)
    return latest_rows(spark, out, keys)


def score_stream(
    requests: DataFrame, scorer: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, after: Callable[[int], None] | None = None
) -> DataFrame:
    """M6: score requests as they come; returns the decisions written so far.

    ``scorer`` turns a table of requests into decisions, e.g. ``model.score_maps`` with a fitted model. Every decision is in ``out``
    exactly once: files read are in the checkpoint, and a batch that is repeated after a failure writes the same folder again.
    """
    drain(scorer(requests), out, checkpoint, "append", after)
    return requests.sparkSession.read.parquet(out).drop("batch")


def stream_profiles(flat: DataFrame, schema: ProfileSchema = DEFAULT_SCHEMA, tiebreak: str = "event_id") -> DataFrame:
    """Scalar columns of the profile table as a stream of changed profiles.

    The state holds one row per profile and lives in the state store.
    """
    scalars = [c for c in (*schema.scalars, "entity_id") if c in flat.columns]
    rows = last_known(flat, scalars, "created_at", tiebreak)
    return rows.withColumn("email_domain", email_domain(F.col("email")))


def stream_tokens(flat: DataFrame, schema: ProfileSchema = DEFAULT_SCHEMA) -> DataFrame:
    """New distinct site tokens as a stream."""
    return site_tokens(flat, schema.site_sets)


def new_pairs(
    changed_keys: DataFrame,
    stored_keys: DataFrame,
    max_block: int,
    stop_df: int,
    seed: int = 0,
) -> DataFrame:
    """Candidate pairs with at least one changed profile.

    Only blocks that a changed profile is in are pruned and paired.
    """
    changed = changed_keys.select("profile_id").distinct().withColumn("_new", F.lit(True))
    touched = changed_keys.select("block_key").distinct()
    old = stored_keys.join(touched, "block_key", "left_semi").join(changed, "profile_id", "left_anti")
    blocks = prune_blocks(old.unionByName(changed_keys), max_block, stop_df, seed)
    flagged = blocks.join(changed, "profile_id", "left").withColumn("_new", F.coalesce("_new", F.lit(False)))
    a = flagged.select("block_key", F.col("profile_id").alias("profile_id_1"), F.col("_new").alias("_n1"))
    b = flagged.select("block_key", F.col("profile_id").alias("profile_id_2"), F.col("_new").alias("_n2"))
    return (
        a.join(b, "block_key")
        .filter("profile_id_1 < profile_id_2 and (_n1 or _n2)")
        .select("profile_id_1", "profile_id_2")
        .distinct()
    )
