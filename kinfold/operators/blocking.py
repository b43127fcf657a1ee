"""Block keys, candidate pairs and blocking recall."""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import MAX_PAIRS_PER_BLOCK
from ..functions.normalize import day_of_week, has_name, name_block_key
from ..session import store
from .refine import BlockRule, dropped_blocks, refine_blocks
from .skew import hot_keys, running_totals

STRATEGIES = ("email_only", "combined_time", "hash_only", "priority")
HASH_FIELDS = (
    "email_domain",
    "sex",
    "non_processing_features",
    "realtime_features",
    "fs_features",
    "date",
    "hour",
    "day_of_week",
)
# Name blocks of other sizes are skipped (published rule).
NAME_BLOCK_MIN, NAME_BLOCK_MAX = 2, 2000
MERSENNE = (1 << 31) - 1
NO_LIMIT = (1 << 62)
# Pairs compared in one task, tasks at most, parts of a block.
PAIRS_PER_TASK, PAIR_TASKS, PAIR_SALTS = 500_000, 2000, 8
# Of candidate pairs fewer, as their features are made where they are read.
BLOCK_PAIRS_PER_TASK = 50_000


def _keys(df: DataFrame, keys: Column, id_col: str = "profile_id") -> DataFrame:
    return df.select(F.explode(F.array_compact(keys)).alias("block_key"), F.col(id_col))


# -- multi-key blocking ------------------------------------------------------------------


def attribute_keys(profiles: DataFrame, kinds: Sequence[str] = ("dom", "phone", "name")) -> DataFrame:
    """E-mail domain, phone, first name with place; nulls give no key."""
    made = {
        "dom": F.concat(F.lit("dom::"), "email_domain"),
        "phone": F.concat(F.lit("phone::"), "phone"),
        "name": F.concat(F.lit("name::"), "first_name", F.lit("::"), "rt_geoid"),
    }
    return _keys(profiles, F.array(*[made[k] for k in kinds]))


def site_keys(tokens: DataFrame) -> DataFrame:
    """One key per distinct token of all site sets of a profile."""
    return tokens.select(F.concat(F.lit("site::"), "token").alias("block_key"), "profile_id").distinct()


def block_keys(
    profiles: DataFrame,
    tokens: DataFrame,
    kinds: Sequence[str] = ("dom", "phone", "name", "site"),
) -> DataFrame:
    """B1-B4 together."""
    plain = [k for k in kinds if k != "site"]
    parts = [attribute_keys(profiles, plain)] if plain else []
    if "site" in kinds:
        parts.append(site_keys(tokens))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def prune_blocks(
    keys: DataFrame,
    max_block: int,
    stop_df: int,
    seed: int = 0,
) -> DataFrame:
    """Drop lone members and frequent sites, sample large blocks to ``max_block``.

    Ranking stops at the largest count any rule has to tell apart, which Spark applies
    before the shuffle as well, so a key held by a third of all rows sends only that
    many rows per input partition.
    """
    # Without a stop, only the block limit has to be told apart.
    need = (max_block if stop_df == NO_LIMIT else max(max_block, stop_df)) + 1
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), "block_key", "profile_id"))
    by_draw = Window.partitionBy("block_key").orderBy("_draw", "profile_id")
    ranked = (
        keys.withColumn("_draw", draw)
        .withColumn("_rank", F.row_number().over(by_draw))
        .filter(F.col("_rank") <= need)
    )
    sized = ranked.withColumn("_size", F.max("_rank").over(Window.partitionBy("block_key")))
    is_site = F.col("block_key").startswith("site::")
    return sized.filter(
        (F.col("_size") >= 2)
        & ~(is_site & (F.col("_size") > stop_df))
        & (F.col("_rank") <= max_block)
    ).select("block_key", "profile_id")


def build_blocks(
    profiles: DataFrame,
    tokens: DataFrame,
    rule: BlockRule,
    seed: int = 0,
    kinds: Sequence[str] = ("dom", "phone", "name", "site"),
) -> DataFrame:
    """Pruned or split blocks as ``(block_key, profile_id)``."""
    return blocks_and_losses(profiles, tokens, rule, seed, kinds)[0]


def blocks_and_losses(
    profiles: DataFrame,
    tokens: DataFrame,
    rule: BlockRule,
    seed: int = 0,
    kinds: Sequence[str] = ("dom", "phone", "name", "site"),
) -> tuple[DataFrame, DataFrame]:
    """B8 with the ledger of what the rule leaves unpaired."""
    keys = block_keys(profiles, tokens, kinds)
    if rule.split_by:
        if rule.stop_df is not None:
            keys = keys.join(dropped_blocks(keys, NO_LIMIT, rule.stop_df).select("block_key"), "block_key", "left_anti")
        return refine_blocks(keys, profiles, rule.max_block, rule.split_by, seed)
    stop_df = NO_LIMIT if rule.stop_df is None else rule.stop_df
    return prune_blocks(keys, rule.max_block, stop_df, seed), dropped_blocks(keys, rule.max_block, stop_df)


def pairs_from_blocks(blocks: DataFrame) -> DataFrame:
    """Unordered pairs inside blocks, each once. Blocks must be pruned or split before.

    Members know their earlier blocks, so a repeat is told where it is made and pairs are neither shuffled nor kept to find it.
    """
    return paired(store(_numbered_members(blocks), "members"), 1, BLOCK_PAIRS_PER_TASK).select("profile_id_1", "profile_id_2")


def labelled_pairs_from_blocks(blocks: DataFrame, profiles: DataFrame) -> DataFrame:
    """B9 and B10 together: members bring their entity along, so pairs need no join with the profiles."""
    members = _numbered_members(blocks).join(profiles.select("profile_id", "entity_id"), "profile_id", "left")
    pairs = paired(store(members, "members"), 1, BLOCK_PAIRS_PER_TASK)
    return pairs.select("profile_id_1", "profile_id_2", _same_entity().alias("is_match"))


def _numbered_members(blocks: DataFrame) -> DataFrame:
    """Members ``(block_key, profile_id, earlier)``, each once: blocks by number, and the profile's blocks of smaller numbers."""
    blocks = store(blocks.select("block_key", "profile_id").filter("block_key is not null and profile_id is not null"), "blocks")
    names = blocks.select("block_key").distinct().withColumn("_one", F.lit(1).cast("bigint"))
    numbers = running_totals(names, [], ["block_key"], {"_number": "_one"}).select("block_key", F.col("_number").cast("int"))
    keys = blocks.join(numbers, "block_key").groupBy("profile_id").agg(F.sort_array(F.collect_set("_number")).alias("_keys"))
    each = keys.select("profile_id", "_keys", F.posexplode("_keys").alias("_at", "block_key"))
    return each.select("block_key", "profile_id", F.slice("_keys", F.lit(1), F.col("_at")).alias("earlier"))


def block_members(blocks: DataFrame) -> DataFrame:
    """Members ``(block_key, profile_id, keys)``, each once, with all block keys of the profile in order."""
    keys = blocks.groupBy("profile_id").agg(F.sort_array(F.collect_set("block_key")).alias("keys"))
    return keys.select(F.explode("keys").alias("block_key"), "profile_id", "keys")


def paired(members: DataFrame, salts: int = PAIR_SALTS, per_task: int | None = None) -> DataFrame:
    """Members of the same block, ``profile_id_1`` before ``profile_id_2``, other columns suffixed _1 and _2.

    For blocks of few and costly rows: the pairs of a block are spread over tasks by one side, the other is repeated,
    and the number of tasks follows the number of pairs, not the small tables that make them (``salts``: parts of a block). With a column ``keys`` (``block_members``) or
    ``earlier`` (blocks before this one) a pair is made in the first block that both share; so it comes once, and pairs need no shuffle to find repeats.
    """
    counts = members.groupBy("block_key").agg(F.count(F.lit(1)).alias("_n"))
    n_pairs = counts.agg(F.sum((F.col("_n") * (F.col("_n") - 1) / 2).cast("bigint"))).first()[0] or 0
    width = max(2, min(PAIR_TASKS, n_pairs // (per_task or PAIRS_PER_TASK) + 1))
    others = [c for c in members.columns if c != "block_key"]
    side = {s: members.select("block_key", *[F.col(c).alias(f"{c}_{s}") for c in others]) for s in "12"}
    left = side["1"].withColumn("_salt", F.pmod(F.xxhash64("profile_id_1"), F.lit(salts)).cast("int"))
    right = side["2"].withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    by = ["block_key", "_salt"]
    out = left.repartition(width, *by).join(right.repartition(width, *by), by).filter("profile_id_1 < profile_id_2")
    if "keys" in others:
        once = (F.size("keys_1") == 1) | (F.size("keys_2") == 1) | (F.array_min(F.array_intersect("keys_1", "keys_2")) == F.col("block_key"))
        out = out.filter(once).drop("keys_1", "keys_2")
    if "earlier" in others:
        out = out.filter(~F.arrays_overlap("earlier_1", "earlier_2")).drop("earlier_1", "earlier_2")
    return out.drop("_salt")


# -- truth and recall --------------------------------------------------------------------


def attach_both(pairs: DataFrame, lookup: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns of a per-profile table for both sides of a pair, suffixed _1 and _2."""
    out = pairs
    for side in ("1", "2"):
        out = out.join(
            lookup.select(
                F.col("profile_id").alias(f"profile_id_{side}"),
                *[F.col(c).alias(f"{c}_{side}") for c in cols],
            ),
            f"profile_id_{side}",
            "left",
        )
    return out


def label_pairs(pairs: DataFrame, profiles: DataFrame) -> DataFrame:
    """``is_match`` by equal entity; a missing entity never matches."""
    return attach_both(pairs, profiles, ["entity_id"]).select(*pairs.columns, _same_entity().alias("is_match"))


def _same_entity() -> Column:
    return F.coalesce((F.col("entity_id_1") == F.col("entity_id_2")).cast("int"), F.lit(0))


def true_pair_groups(profiles: DataFrame) -> DataFrame:
    """The true pairs as groups: members and number of pairs of each entity.

    Writing the pairs out would be quadratic in the entity size; membership of a pair
    is ``label_pairs``.
    """
    n = F.col("n_profiles")
    return (
        profiles.filter(F.col("entity_id").isNotNull())
        .groupBy("entity_id")
        .agg(F.count(F.lit(1)).alias("n_profiles"))
        .select("entity_id", "n_profiles", (n * (n - 1) / 2).cast("bigint").alias("n_true_pairs"))
    )


def _recall(labelled: DataFrame, profiles: DataFrame, when_empty: float) -> DataFrame:
    total = true_pair_groups(profiles).agg(F.coalesce(F.sum("n_true_pairs"), F.lit(0)).alias("total"))
    found = labelled.agg(F.coalesce(F.sum("is_match"), F.lit(0)).cast("bigint").alias("captured"))
    # Both sides are single rows.
    return found.join(F.broadcast(total)).select(
        F.when(F.col("total") == 0, F.lit(when_empty))
        .otherwise(F.col("captured") / F.col("total"))
        .alias("recall"),
        "captured",
        "total",
    )


def blocking_recall(labelled: DataFrame, profiles: DataFrame) -> DataFrame:
    """Share of true pairs among the labelled candidates; 1.0 when there are none."""
    return _recall(labelled, profiles, 1.0)


def recall_found_missed(labelled: DataFrame, profiles: DataFrame) -> DataFrame:
    """Recall with found and missed counts; 0.0 when there are no true pairs."""
    return _recall(labelled, profiles, 0.0).select(
        "recall",
        "total",
        F.col("captured").alias("found"),
        (F.col("total") - F.col("captured")).alias("missed"),
    )


def recall_against(truth: DataFrame, pairs: DataFrame) -> DataFrame:
    """B19 for a given table of true pairs."""
    ids = ["profile_id_1", "profile_id_2"]
    hits = truth.select(*ids).distinct().join(
        pairs.select(*ids).distinct().withColumn("_hit", F.lit(1)), ids, "left"
    )
    return hits.agg(
        F.count(F.lit(1)).alias("total"), F.count("_hit").alias("found")
    ).select(
        F.when(F.col("total") == 0, F.lit(0.0)).otherwise(F.col("found") / F.col("total")).alias("recall"),
        "total",
        "found",
        (F.col("total") - F.col("found")).alias("missed"),
    )


def compare_strategies(
    profiles: DataFrame, tokens: DataFrame, variants: dict[str, Sequence[str]], rule: BlockRule
) -> DataFrame:
    """Pair count and recall of several key subsets."""
    rows = None
    for name, kinds in variants.items():
        labelled = label_pairs(pairs_from_blocks(build_blocks(profiles, tokens, rule, kinds=kinds)), profiles)
        counted = labelled.agg(
            F.count(F.lit(1)).alias("n_pairs"),
            F.coalesce(F.sum("is_match"), F.lit(0)).cast("bigint").alias("captured"),
        ).withColumn("strategy", F.lit(name))
        rows = counted if rows is None else rows.unionByName(counted)
    total = true_pair_groups(profiles).agg(F.coalesce(F.sum("n_true_pairs"), F.lit(0)).alias("total"))
    return rows.join(F.broadcast(total)).select(
        "strategy",
        "n_pairs",
        "captured",
        "total",
        F.when(F.col("total") == 0, F.lit(1.0)).otherwise(F.col("captured") / F.col("total")).alias("recall"),
    )


# -- strategies on records ---------------------------------------------------------------


def domain_keys(df: DataFrame, id_col: str = "profile_id") -> DataFrame:
    """Blocks by e-mail domain."""
    return _keys(df, F.array(F.concat(F.lit("dom::"), "email_domain")), id_col)


def time_keys(df: DataFrame, id_col: str = "profile_id", time_col: str = "created_at") -> DataFrame:
    """Blocks by date with hour, and by weekday."""
    t = F.col(time_col)
    stamp = F.concat(F.lit("time::"), F.date_format(t, "yyyy-MM-dd"), F.lit("_"), F.hour(t).cast("string"))
    day = F.concat(F.lit("day::day_"), day_of_week(t).cast("string"))
    return _keys(df, F.array(stamp, day), id_col)


def content_hash(df: DataFrame, fields: Sequence[str] = HASH_FIELDS) -> Column:
    """First eight hex digits of md5 over all sorted values."""
    parts = []
    for name in fields:
        if df.schema[name].dataType.typeName() == "array":
            values = F.transform(name, lambda x: x.cast("string"))
            parts.append(F.coalesce(F.array_compact(values), F.array().cast("array<string>")))
        else:
            value = F.col(name).cast("string")
            parts.append(F.array_compact(F.array(F.when(value != "", value))))
    everything = F.array_sort(F.concat(*parts))
    digest = F.substring(F.md5(F.array_join(everything, "_")), 1, 8)
    return F.when(F.size(everything) > 0, digest)


def hash_keys(df: DataFrame, id_col: str = "profile_id", fields: Sequence[str] = HASH_FIELDS) -> DataFrame:
    """Blocks of records with equal content."""
    return _keys(df, F.array(F.concat(F.lit("hash::"), content_hash(df, fields))), id_col)


def strategy_keys(df: DataFrame, strategy: str = "priority", id_col: str = "profile_id") -> DataFrame:
    """Keys of a named strategy."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}, expected one of {STRATEGIES}")
    if strategy == "email_only":
        return domain_keys(df, id_col)
    if strategy == "hash_only":
        return hash_keys(df, id_col)
    keys = domain_keys(df, id_col).unionByName(time_keys(df, id_col))
    if strategy == "priority":
        keys = keys.unionByName(hash_keys(df, id_col))
    return keys


def chunk_rows(max_pairs: int = MAX_PAIRS_PER_BLOCK) -> int:
    return isqrt(2 * max_pairs) + 1


def split_blocks(keys: DataFrame, max_pairs: int = MAX_PAIRS_PER_BLOCK, id_col: str = "profile_id") -> DataFrame:
    """Blocks with more than ``max_pairs`` pairs become sorted chunks.

    The position inside a block comes from sorted ranges, so a block that holds a
    large part of all rows is numbered by many tasks.
    """
    numbered = running_totals(
        keys.withColumn("_one", F.lit(1).cast("bigint")), ["block_key"], [id_col], {"_pos": "_one"}
    )
    n = F.col("_pos_all")
    chunk = F.when(
        n * (n - 1) / 2 > max_pairs, F.floor((F.col("_pos") - 1) / chunk_rows(max_pairs))
    ).otherwise(F.lit(0).cast("bigint"))
    return numbered.select(
        F.concat("block_key", F.lit("#"), chunk.cast("string")).alias("block_key"),
        id_col,
        F.col("block_key").alias("whole_key"),
        n.alias("whole_size"),
    )


def split_strategy_pairs(
    df: DataFrame, strategy: str = "priority", max_pairs: int = MAX_PAIRS_PER_BLOCK, id_col: str = "profile_id"
) -> DataFrame:
    """Candidate pairs of a strategy (B20 with ``email_only``), each once without a shuffle of pairs."""
    chunks = split_blocks(strategy_keys(df, strategy, id_col), max_pairs, id_col)
    members = store(block_members(chunks.select("block_key", F.col(id_col).alias("profile_id"))), "chunk-members")
    # Chunks are small, so none needs parts.
    return paired(members, salts=1).select("profile_id_1", "profile_id_2")


def block_statistics(chunks: DataFrame, max_pairs: int = MAX_PAIRS_PER_BLOCK) -> DataFrame:
    """Large blocks, chunks made from them, pairs before removing repeats."""
    n, w = F.col("n"), F.col("whole_size")
    large = w * (w - 1) / 2 > max_pairs
    per_chunk = chunks.groupBy("block_key", "whole_key").agg(
        F.count(F.lit(1)).alias("n"), F.max("whole_size").alias("whole_size")
    )
    per_block = per_chunk.groupBy("whole_key").agg(
        F.max(large.cast("int")).alias("is_large"),
        F.count(F.lit(1)).alias("n_chunks"),
        F.sum((n * (n - 1) / 2).cast("bigint")).alias("pairs"),
    )
    return per_block.agg(
        F.count(F.lit(1)).alias("n_blocks"),
        F.sum("is_large").cast("bigint").alias("large_blocks"),
        F.coalesce(F.sum(F.when(F.col("is_large") == 1, F.col("n_chunks"))), F.lit(0)).alias("sub_blocks"),
        F.sum("pairs").alias("n_pairs"),
    )


def name_prefix_keys(
    df: DataFrame, first: str = "first_name", last: str = "last_name", id_col: str = "profile_id"
) -> DataFrame:
    """Name-prefix blocks of 2 to 2000 records.

    The few keys that hold a large share of all rows are above the limit; they are
    removed by broadcast, before any shuffle of the rows.
    """
    named = df.filter(has_name(F.col(first), F.col(last)))
    keys = named.select(name_block_key(F.col(first), F.col(last)).alias("block_key"), F.col(id_col))
    counts = keys.groupBy("block_key").agg(F.count(F.lit(1)).alias("_n"))
    hot = hot_keys(counts, "block_key", "_n", extra=F.col("_n") > NAME_BLOCK_MAX)
    sizes = counts.filter(F.col("_n").between(NAME_BLOCK_MIN, NAME_BLOCK_MAX)).select("block_key")
    return keys.join(F.broadcast(hot), "block_key", "left_anti").join(sizes, "block_key", "left_semi")


# -- min-hash keys -----------------------------------------------------------------------


def _coefficients(n: int) -> list[tuple[int, int]]:
    """Multipliers and offsets of ``n`` hash functions, from a linear rule."""
    state, out = 12345, []
    for _ in range(n):
        pair = []
        for _ in range(2):
            state = (1103515245 * state + 12345) % (1 << 31)
            pair.append(state % (MERSENNE - 1) + 1)
        out.append((pair[0], pair[1]))
    return out


def minhash_keys(tokens: DataFrame, bands: int = 8, rows: int = 2) -> DataFrame:
    """One key per band of the min-hash signature of a profile's tokens.

    A minimum per hash function combines before the shuffle. Feed the keys to
    ``prune_blocks`` like any others.
    """
    x = F.conv(F.substring(F.md5("token"), 1, 7), 16, 10).cast("bigint")
    signature = (
        tokens.select("profile_id", x.alias("x"))
        .groupBy("profile_id")
        .agg(
            *[
                F.min((F.lit(a).cast("bigint") * F.col("x") + F.lit(b)) % MERSENNE).alias(f"h{i}")
                for i, (a, b) in enumerate(_coefficients(bands * rows))
            ]
        )
    )
    keys = [
        F.concat_ws("_", F.lit(f"lsh::{b}:"), *[F.col(f"h{b * rows + r}").cast("string") for r in range(rows)])
        for b in range(bands)
    ]
    return _keys(signature, F.array(*keys))
