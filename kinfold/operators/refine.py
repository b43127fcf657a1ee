"""Blocks above a limit are split by further attributes before anything is sampled, and a ledger tells what is lost.

A block with more than ``max_block`` members becomes one block per value of the next attribute (a missing value is a value), and so on
down the list. Only a block that is still too large when the list is used up is sampled. Pairs that no longer meet in any part of their
block are counted in the ledger; they may meet in another block.

Sizes come from partial counts. Members look their block's size up with the keys of very large blocks spread (``lookup_join``), so a
key held by a third of all rows is split by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import MAX_BLOCK_PROFILES, SITE_STOP_DF
from ..session import store
from .skew import lookup_join

LEDGER = ("block_key", "rule", "size", "kept", "pairs_lost")


@dataclass(frozen=True)
class BlockRule:
    """How large blocks are treated. ``stop_df`` drops sites of more profiles, ``split_by`` splits blocks above ``max_block``."""

    max_block: int
    stop_df: int | None = None
    split_by: tuple[str, ...] = ()


#: The published limits: frequent sites go, large blocks are sampled.
PUBLISHED = BlockRule(MAX_BLOCK_PROFILES, SITE_STOP_DF)
#: The same size, reached by splitting.
REFINED = BlockRule(MAX_BLOCK_PROFILES, None, ("email_domain", "first_name", "rt_geoid"))


def pairs_of_size(n: Column) -> Column:
    return (n * (n - 1) / 2).cast("bigint")


def _sized(rows: DataFrame, name: str) -> DataFrame:
    """``(block_key, profile_id, n)`` with the size of the block; lone members are gone."""
    sizes = rows.groupBy("block_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return store(lookup_join(rows, store(sizes, "block-sizes"), "block_key", "profile_id", rows.count()), name)


def sample_members(rows: DataFrame, max_block: int, seed: int = 0) -> DataFrame:
    """``max_block`` members of each block by the order of a hash. The rank limit also runs before the shuffle."""
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), "block_key", "profile_id"))
    by_draw = Window.partitionBy("block_key").orderBy("_draw", "profile_id")
    ranked = rows.withColumn("_draw", draw).withColumn("_rank", F.row_number().over(by_draw))
    return ranked.filter(F.col("_rank") <= max_block).select("block_key", "profile_id")


def dropped_blocks(keys: DataFrame, max_block: int, stop_df: int) -> DataFrame:
    """Ledger of the published limits: sites above ``stop_df`` lose all pairs, other blocks keep a sample."""
    sizes = keys.groupBy("block_key").agg(F.count(F.lit(1)).alias("size"))
    stopped = F.col("block_key").startswith("site::") & (F.col("size") > stop_df)
    cut = sizes.filter(stopped | (F.col("size") > max_block))
    kept = F.when(stopped, 0).otherwise(max_block).cast("bigint")
    return cut.select(
        "block_key",
        F.when(stopped, "site_stop").otherwise("sample").alias("rule"),
        "size",
        kept.alias("kept"),
        (pairs_of_size(F.col("size")) - pairs_of_size(kept)).alias("pairs_lost"),
    )


def refine_blocks(
    keys: DataFrame, profiles: DataFrame, max_block: int, split_by: Sequence[str], seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Blocks ``(block_key, profile_id)`` of 2 to ``max_block`` members, and the ledger of lost pairs."""
    rows = _sized(keys, "blocks-0")
    n = F.col("n")
    done, ledger = [], []
    for i, name in enumerate(split_by, 1):
        done.append(rows.filter(n <= max_block).select("block_key", "profile_id"))
        large = rows.filter(n > max_block)
        value = F.col("_value").cast("string")
        part = F.concat("block_key", F.lit(f"|{name}"), F.when(value.isNull(), "").otherwise(F.concat(F.lit("="), value)))
        parts = large.join(profiles.select("profile_id", F.col(name).alias("_value")), "profile_id", "left").select(
            part.alias("_part"), "profile_id", "block_key", "n"
        )
        # Pairs left of a block: those inside its parts.
        per_part = parts.groupBy("_part", "block_key", "n").agg(F.count(F.lit(1)).alias("k"))
        per_block = per_part.groupBy("block_key", F.col("n").alias("size")).agg(
            F.sum(F.when(F.col("k") > 1, F.col("k")).otherwise(0)).cast("bigint").alias("kept"), F.sum(pairs_of_size(F.col("k"))).alias("_left")
        )
        lost = per_block.withColumn("pairs_lost", pairs_of_size(F.col("size")) - F.col("_left")).filter("pairs_lost > 0")
        ledger.append(lost.select("block_key", F.lit(f"split {name}").alias("rule"), "size", "kept", "pairs_lost"))
        rows = _sized(parts.select(F.col("_part").alias("block_key"), "profile_id"), f"blocks-{i}")
    done.append(rows.filter(n <= max_block).select("block_key", "profile_id"))
    large = rows.filter(n > max_block)
    done.append(sample_members(large.select("block_key", "profile_id"), max_block, seed))
    sizes = large.groupBy("block_key").agg(F.first("n").alias("size"))
    kept = F.lit(max_block).cast("bigint")
    ledger.append(
        sizes.select("block_key", F.lit("sample").alias("rule"), "size", kept.alias("kept"), (pairs_of_size(F.col("size")) - pairs_of_size(kept)).alias("pairs_lost"))
    )
    blocks, lost = done[0], ledger[0]
    for more in done[1:]:
        blocks = blocks.unionByName(more)
    for more in ledger[1:]:
        lost = lost.unionByName(more)
    return blocks, lost
