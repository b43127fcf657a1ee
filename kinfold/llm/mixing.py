"""Mixing sources to target weights by weighted sampling without replacement.

A document's key is -ln(u) / weight with u uniform from a hash of its id (Efraimidis and Spirakis): in
ascending order the keys are a weighted random order. Documents are sorted by key inside their source and
sizes are summed along that order. A source whose target is e times its size and a rest takes every
document e times, then the prefix that comes nearest to the rest.

A source may hold most rows, so the sort is by ranges of (source, key): sums inside a range plus totals of
the ranges before it. Nothing gathers a source in one task.

Defined results: null text has size 0, a null source is a source of its own and comes last, a null id is
hashed as such. Rows that repeat an id share a key and are ordered by text hash and size; rows equal in
these are interchangeable. Sources without words have target 0. An empty table gives an empty table.
Columns other than id, text and source are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import hash_unit, shuffle_width
from ..session import store
from .common import n_words_of, text_or_empty

SEED = 17
WEIGHTS = (5, 2, 1)
# Share of all sizes that the mix takes, as a fraction.
SHARE = (3, 2)
MOST_EPOCHS = 2
ROWS_PER_RANGE = 1_000_000


def quality_weight(text: Column, n_words: Column) -> Column:
    """In (0, 1]: words against words plus symbols, so that symbol-laden text comes late."""
    full = text_or_empty(text)
    symbols = F.length(full) - F.length(F.translate(full, "#*$%&|<>!", ""))
    return (n_words + 1) / (n_words + 1 + symbols).cast("double")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST_EPOCHS
) -> DataFrame:
    """``(no_source, source, source_size)`` plus ``target``; one row per source in, one out.

    Shares are by weight; a source that would pass ``most`` times its size stops there and its excess goes
    to the others by weight. Sorted by size / weight the stopped sources are a prefix, so the level is
    found with running sums and no loop.
    """
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("no_source", "source"))
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((rank - 1) % len(weights)) + 1)
    ranked = sizes.withColumn("w", w.cast("long")).withColumn("cap", F.col("source_size") * most)
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("w"), "no_source", "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    budget = F.sum("source_size").over(everything) * share[0] / F.lit(float(share[1]))
    rest = budget - F.coalesce(F.sum("cap").over(before), F.lit(0))
    left = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))
    tested = ranked.withColumn("rest", rest).withColumn("left", left).withColumn(
        "open", F.col("rest") * F.col("w") < F.col("cap") * F.col("left")
    )
    # The first open source fixes the level of all open ones.
    first = F.min_by(F.when(F.col("open"), F.struct("rest", "left")), F.when(F.col("open"), F.struct(F.col("cap") / F.col("w"), "no_source", "source"))).over(everything)
    level = tested.withColumn("level", first)
    return level.select(
        "no_source",
        "source",
        "source_size",
        F.when(F.col("open"), F.col("level.rest") * F.col("w") / F.col("level.left"))
        .otherwise(F.col("cap").cast("double"))
        .alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    most: int = MOST_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """Per document: id, text hash, source, size, source_size, target, times, taken."""
    n = n_words_of(text)
    slim = store(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("real_source"), n.alias("size"), F.col(text).alias("_text"))
        .select(
            "doc_id",
            "real_source",
            "size",
            F.col("real_source").isNull().alias("no_source"),
            F.coalesce("real_source", F.lit("")).alias("source"),
            (-F.ln(hash_unit(seed, "doc_id") + F.lit(2.0**-49)) / quality_weight(F.col("_text"), F.col("size"))).alias("key"),
            F.md5(text_or_empty("_text")).alias("tie"),
        ),
        "mix",
    )
    keys = ["no_source", "source"]
    order = ["key", "doc_id", "tie", "size"]
    ranges = max(shuffle_width(docs), slim.count() // ROWS_PER_RANGE + 1)
    ranged = store(
        slim.repartitionByRange(ranges, *keys, *order).withColumn("part", F.spark_partition_id()), "mix-ranges"
    )
    per_range = store(ranged.groupBy(*keys, "part").agg(F.sum("size").alias("range_size")), "mix-sums")
    targets = source_targets(per_range.groupBy(*keys).agg(F.sum("range_size").alias("source_size")), weights, share, most)
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.withColumn("before", F.coalesce(F.sum("range_size").over(before), F.lit(0))).join(targets, keys)
    inside = Window.partitionBy(*keys, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = local.join(offsets, [*keys, "part"])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    # The middle of a document decides, so the prefix ends where it comes nearest to the rest.
    chosen = F.col("before") + F.col("start") + F.col("size") / F.lit(2.0) <= rest
    times = F.col("epochs") + F.when(chosen, 1).otherwise(0)
    return placed.withColumn("epochs", epochs).select(
        "doc_id",
        "tie",
        F.col("real_source").alias("source"),
        "size",
        "source_size",
        "target",
        times.alias("times"),
        (F.col("size") * times).alias("taken"),
    )


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: none, once or several times each, all columns as they were.

    Rows equal in id, text and source share what was taken of them together, as evenly as it goes.
    """
    mix = mix_sources(docs, doc_id, text, source, **options)
    shares = store(
        mix.groupBy("doc_id", "tie", "source").agg(F.sum("times").alias("times"), F.count(F.lit(1)).alias("rows")).filter("times > 0"), "mix-times"
    )
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(doc_id).alias("_id"), F.md5(text_or_empty(text)).alias("_tie"), F.col(source).alias("_source"),
    )
    met = whole.join(
        shares, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_tie") == F.col("tie")) & F.col("_source").eqNullSafe(F.col("source"))
    )
    # Only rows that repeat are numbered.
    single = met.filter("rows = 1").withColumn("n", F.col("times"))
    place = F.row_number().over(Window.partitionBy("_id", "_tie", "_source").orderBy("_tie"))
    several = met.filter("rows > 1").withColumn("place", place).withColumn(
        "n", F.floor(F.col("times") / F.col("rows")) + F.when(F.col("place") <= F.col("times") % F.col("rows"), 1).otherwise(0)
    ).drop("place")
    taken = single.unionByName(several).filter("n > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n").cast("long")))).select("row.*")
