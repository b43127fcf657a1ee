"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "kinfold", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` overrides any of them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Pair features cost much per byte; small shuffles should still use all cores.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.checkpoint.compress": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="kinfold-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/kinfold/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str = "table", row_group: int | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    For tables with several readers: besides a short plan, the files give Spark the true
    size, by which it decides whether a join may broadcast. ``row_group``: bytes of a row group; a file of
    many can be read by several tasks.
    """
    path = scratch_path(df.sparkSession, name)
    (df.write if row_group is None else df.write.option("parquet.block.size", row_group)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise one step of a loop and forget how it was made.

    A written table, not ``checkpoint()``: a checkpointed plan keeps the constraints of
    its history, and planning time doubles with every round of a loop.
    """
    return store(df, "step")
