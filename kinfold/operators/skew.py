"""Building blocks that keep one hot key from landing in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, store

HOT_SHARE = 1000
SALTS = 32
# Below this many rows a hot key is no burden and finding it costs more than it saves.
SALT_FROM = 1_000_000
# Bits of the hash that orders a sample, bits read per refinement, rows ranked by one task.
HASH_BITS, STEP_BITS = 48, 12
RANKED_AT_ONCE = 100_000


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hash_unit(seed: int, *cols: Column | str) -> Column:
    """Uniform number in [0, 1) from md5, the same for equal inputs on every engine."""
    parts = [F.lit(str(seed))]
    for c in cols:
        parts.append((F.col(c) if isinstance(c, str) else c).cast("string"))
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def hot_keys(
    counts: DataFrame, key: str, n: str, share: int = HOT_SHARE, extra: Column | None = None
) -> DataFrame:
    """Keys that hold more than 1/share of all rows. There are fewer than ``share`` of them."""
    total = counts.agg(F.sum(n).alias("_total"))
    if extra is not None:
        counts = counts.filter(extra)
    return counts.join(F.broadcast(total), F.col(n) * share > F.col("_total")).select(key)


def salted_join(
    big: DataFrame,
    lookup: DataFrame,
    key: str,
    hot: DataFrame,
    spread_by: Column,
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join on ``key`` where rows of hot keys are spread over ``salts`` partitions.

    ``lookup`` has one row per key, so only the few hot ones are repeated.
    ``hot`` comes from ``hot_keys``, whose size is bounded, hence the broadcast.
    """
    flag = F.broadcast(hot.select(F.col(key).alias("_hot")))
    left = big.join(flag, F.col(key) == F.col("_hot"), "left").withColumn(
        "_salt",
        F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64(spread_by), F.lit(salts))).otherwise(0),
    ).drop("_hot")
    right = lookup.join(flag, F.col(key) == F.col("_hot"), "left").withColumn(
        "_salt",
        F.explode(
            F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
            .otherwise(F.array(F.lit(0).cast("bigint")))
        ),
    ).drop("_hot")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def lookup_join(
    big: DataFrame, lookup: DataFrame, key: str, spread_by: str, n_rows: int, how: str = "inner"
) -> DataFrame:
    """``salted_join`` when ``big`` has enough rows for a hot key to matter, else a plain one."""
    if n_rows < SALT_FROM:
        return big.join(lookup, key, how)
    counts = big.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    # Stored, because both sides of the join read it; ``big`` should be a stored table too.
    hot = cut_lineage(hot_keys(counts, key, "_n"))
    return salted_join(big, lookup, key, hot, F.col(spread_by), how)


def range_split(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Cut ``df`` into sorted ranges of even size and number them in ``_part``.

    A group larger than a range spans several of them. The numbers are stored with
    the rows, so recomputing a lost partition later cannot change them.
    """
    ranged = df.repartitionByRange(shuffle_width(df), *by, *order)
    return cut_lineage(ranged.withColumn("_part", F.spark_partition_id()))


def running_totals(
    df: DataFrame, by: Sequence[str], order: Sequence[str], sums: dict[str, str]
) -> DataFrame:
    """Add running totals ``{new: column}`` in ``order`` and group totals ``{new}_all``.

    ``(by, order)`` must be unique. Works without a window over a whole group: totals
    inside a range plus the totals of the ranges before it.
    """
    by = list(by)
    split = range_split(df, by, order)
    inside = Window.partitionBy(*by, "_part").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = split.select(
        "*", *[F.sum(c).over(inside).alias(f"_run_{new}") for new, c in sums.items()]
    )
    per_range = split.groupBy(*by, "_part").agg(
        *[F.sum(c).alias(f"_sum_{new}") for new, c in sums.items()]
    )
    # One row per range of a group, so at most as many rows as ranges.
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *by,
        "_part",
        *[
            F.coalesce(F.sum(f"_sum_{new}").over(before), F.lit(0)).alias(f"_off_{new}")
            for new in sums
        ],
        *[F.sum(f"_sum_{new}").over(group).alias(f"{new}_all") for new in sums],
    )
    # Without groups there are only as many offsets as ranges.
    joined = local.join(offsets if by else F.broadcast(offsets), [*by, "_part"])
    out = joined.select(
        *df.columns,
        *[(F.col(f"_run_{new}") + F.col(f"_off_{new}")).alias(new) for new in sums],
        *[F.col(f"{new}_all") for new in sums],
    )
    return out


def hash_sample(df: DataFrame, ids: Sequence[str], seed: int, n: Column | int, at_once: int = RANKED_AT_ONCE) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, those with the smallest md5 of (seed, ids).

    ``n`` may be a column that holds the same value on all rows. The input is stored once. Rows are counted in
    ranges of the hash; the range where the n-th row falls is counted again in finer ranges until at most ``at_once`` rows are left in it, and
    only these are ranked. Rows that agree in all bits are one range however many they are: they have the same ids.
    """
    number = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids])), 1, HASH_BITS // 4), 16, 10)
    limit = (n if isinstance(n, Column) else F.lit(n)).cast("bigint")
    keyed = store(df.withColumn("_h", number.cast("bigint")).withColumn("_n", limit), "hashed")
    need = keyed.agg(F.max("_n")).first()[0] or 0
    # The range [start, start + 2^bits) holds the n-th row; rows before it are all taken.
    start, bits, rows = 0, HASH_BITS, None
    while bits and (rows is None or rows > at_once):
        bits -= STEP_BITS
        inside = keyed.filter((F.col("_h") >= start) & (F.col("_h") < start + (1 << (bits + STEP_BITS))))
        # At most 2^STEP_BITS rows.
        counts = sorted(tuple(r) for r in inside.groupBy(F.shiftright("_h", bits).alias("b")).agg(F.count(F.lit(1)).alias("c")).collect())
        rows = 0
        for b, rows in counts:
            start = b << bits
            if need < rows:
                break
            need -= rows
        else:
            return keyed.select(*df.columns)
    whole = keyed.filter(F.col("_h") < start)
    edge = keyed.filter((F.col("_h") >= start) & (F.col("_h") < start + (1 << bits)))
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_h", *ids))
    cut = edge.withColumn("_r", rank).filter(F.col("_r") <= need)
    return whole.select(*df.columns).unionByName(cut.select(*df.columns))
