"""Merkle manifest of a dataset as a nested-struct rollup.

A row's leaf is the hash of its fields. Leaves of a group (language) get ranks by id; the binary digits of the rank
become columns. Within a block of 2^``LEVELS`` ranks the digit columns are grouped away one after the other, lowest first: each
``groupBy`` nests the child structs under their parent's hash. One shuffle by (group, block) serves all these groupings, and
they keep the order of one sort. The blocks' hashes are the nodes of the next tier, until a group has one node, its
subroot; subroots of the groups are rolled up in the same way to the root.

Proofs go down: a nested ``transform`` walks a block's structs with the siblings met on the way, ``explode`` gives one row per
leaf. A block meets the siblings above it by a grouping on (group, block), one row of each kind; no join takes part.
Every row holds one block at most, whatever the size of the data.

Path entries run from the leaf up: side 0 (sibling to the right), 1 (to the left), 2 (none: the node was hashed alone).

Defined results: a null field counts as ``-``; a null group is a group of its own, before all others; null ids come first in their group;
rows with equal ids are ordered by leaf, and fully equal rows are leaves of their own with proofs of their own. Texts may be empty or
of any length. An empty table gives an empty table. Only the listed fields are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import shuffle_width
from ..session import store

LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RIGHT, LEFT, ALONE = 0, 1, 2
PATH = "array<struct<side:int,h:string>>"


def sha256(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field_code(value: Column) -> Column:
    """``-`` for null, else length in bytes, colon, value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return sha256(*[field_code(f) for f in fields])


def _group_key(group: Column) -> Column:
    """Never null, and in the order of UTF-8 bytes with null first."""
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group.cast("string")))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``rank`` within ``g`` (from 0, in ``order``, unique) and ``n``, the size of the group.

    Sorted ranges, numbered and stored; ranks inside a range, plus the ranges before it. A group of any size spans many ranges.
    """
    by = [F.col(c).asc_nulls_first() for c in order]
    split = store(rows.repartitionByRange(shuffle_width(rows), "g", *by).withColumn("_part", F.spark_partition_id()), "merkle-ranges")
    inside = split.withColumn("_r", F.row_number().over(Window.partitionBy("g", "_part").orderBy(*by)))
    # As many rows per group as it has ranges.
    sizes = split.groupBy("g", "_part").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy("g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "g", "_part", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"), F.sum("_c").over(Window.partitionBy("g")).alias("n")
    )
    return inside.join(offsets, ["g", "_part"]).withColumn("rank", F.col("_r") - 1 + F.col("_o")).drop("_part", "_r", "_o")


def _digit(i: int) -> str:
    return f"d{i}"


def rollup(nodes: DataFrame, levels: int) -> DataFrame:
    """``(g, rank, n, node)`` to ``(g, block, n, node)``: blocks with all their structs nested in ``node``."""
    digits = [F.getbit("rank", F.lit(i)).cast("int").alias(_digit(i)) for i in range(levels)]
    rows = nodes.select("g", F.shiftright("rank", levels).alias("block"), "n", *digits, "node").repartition("g", "block")
    for i in range(levels):
        left = [_digit(j) for j in range(levels - 1, i, -1)]
        child = [F.first(F.when(F.col(_digit(i)) == d, F.col("node")), ignorenulls=True) for d in (0, 1)]
        kids = F.array_compact(F.array(*child))
        # A level exists only while the tree has several nodes; above that a node is passed on.
        parent = F.when(F.col("n") > 2**i, sha256(F.array_join(F.transform("kids", lambda k: k["h"]), ""))).otherwise(F.get("kids", F.lit(0))["h"])
        grouped = rows.groupBy("g", "block", "n", *left).agg(kids.alias("kids"))
        rows = grouped.select("g", "block", "n", *left, F.struct(parent.alias("h"), "kids").alias("node"))
    return rows


def tiers(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Nested blocks of every tier and ``(g, h)``, the last hash of each group."""
    found = []
    while True:
        found.append(store(rollup(nodes, levels), "merkle-tier"))
        top = found[-1]
        most = top.agg(F.max("block")).first()[0]
        if not most:
            return found, top.select("g", F.col("node.h").alias("h"))
        blocks = F.shiftright(F.col("n") - 1, levels) + 1
        nodes = top.select("g", F.col("block").alias("rank"), blocks.alias("n"), F.struct(F.col("node.h").alias("h"), "block").alias("node"))


def _walk(node: Column, level: int, n: Column, above: Column) -> Column:
    """Leaves below ``node`` with their paths: the siblings of each level, then those ``above``."""
    if level == 0:
        return F.array(F.struct(node.alias("node"), above.alias("path")))

    def below(kid: Column, j: Column) -> Column:
        side = F.when(F.size(node["kids"]) == 1, ALONE).otherwise(j)
        sibling = F.get(node["kids"], 1 - j)["h"]
        entry = F.array(F.struct(side.cast("int").alias("side"), sibling.alias("h")))
        # ``above`` stands here once, or the expression would double with every level.
        own = F.when(n > 2 ** (level - 1), entry).otherwise(F.array().cast(PATH))
        return _walk(kid, level - 1, n, F.concat(own, above))

    return F.flatten(F.transform(node["kids"], below))


def proofs(found: list[DataFrame], above: DataFrame, levels: int) -> DataFrame:
    """``(node, path, tip)`` of every leaf.

    ``above`` has ``(g, path, tip)``, the path of each group's last hash and what else its leaves should carry.
    """
    upper = above.select("g", F.lit(0).cast("long").alias("block"), "path", "tip")
    for i in range(len(found) - 1, -1, -1):
        tier = found[i]
        nothing = [F.lit(None).cast(upper.schema[c].dataType).alias(c) for c in ("path", "tip")]
        empty = [F.lit(None).cast(tier.schema[c].dataType).alias(c) for c in ("n", "node")]
        both = tier.select("g", "block", "n", "node", *nothing).unionByName(upper.select("g", "block", *empty, "path", "tip"))
        met = both.groupBy("g", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "node", "path", "tip")])
        leaves = met.select("g", "tip", F.explode(_walk(F.col("node"), levels, F.col("n"), F.col("path"))).alias("leaf"))
        if i:
            upper = leaves.select("g", F.col("leaf.node.block").alias("block"), F.col("leaf.path").alias("path"), "tip")
    return leaves.select("leaf.node", "leaf.path", "tip")


def fold(leaf: Column, path: Column) -> Column:
    """Root that a leaf and its path lead to."""

    def step(h: Column, p: Column) -> Column:
        return F.when(p["side"] == RIGHT, sha256(h, p["h"])).when(p["side"] == LEFT, sha256(p["h"], h)).otherwise(sha256(h))

    return F.aggregate(path, leaf, step)


def manifest(docs: DataFrame, leaves: dict[str, Column], doc_id: str = "doc_id", group: str = "lang", levels: int = LEVELS) -> DataFrame:
    """Per row: doc_id, the columns of ``leaves`` (``leaf`` is the hash that counts), path, subroot, root.

    Other entries of ``leaves`` travel with the leaf, e.g. the hash of a changed row.
    """
    made = docs.select(
        _group_key(F.col(group)).alias("g"), F.col(doc_id).alias("id"), *[c.alias(k) for k, c in leaves.items()],
        F.monotonically_increasing_id().alias("tie"),
    )
    rows = ranked(store(made, "merkle-leaves"), ["id", "leaf", "tie"])
    node = F.struct(F.col("leaf").alias("h"), "id", *[k for k in leaves if k != "leaf"])
    found, subroots = tiers(rows.select("g", "rank", "n", node.alias("node")), levels)
    groups = ranked(subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), "h"), ["name"])
    top, roots = tiers(groups.select("g", "rank", "n", F.struct("h", "name").alias("node")), levels)
    start = roots.select("g", F.array().cast(PATH).alias("path"), F.col("h").alias("tip"))
    tops = proofs(top, start, levels)
    above = tops.select(
        F.col("node.name").alias("g"), "path", F.struct(F.col("node.h").alias("subroot"), F.col("tip").alias("root")).alias("tip")
    )
    return proofs(found, above, levels).select(
        F.col("node.id").alias("doc_id"), F.col("node.h").alias("leaf"), *[F.col(f"node.{k}").alias(k) for k in leaves if k != "leaf"],
        "path", "tip.subroot", "tip.root",
    )


def audited(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest checked against a copy in which every row whose id's checksum divides by 7 has one more in ``n_chars``."""
    fields = [F.col(c) for c in FIELDS]
    changed = [F.col(c).cast("decimal(20,0)") + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = manifest(docs, {"leaf": leaf_hash(fields), "tampered": F.when(hit, leaf_hash(changed))}, levels=levels)
    siblings = F.transform(F.filter("path", lambda p: p["side"] != ALONE), lambda p: p["h"])
    folded = found.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "path",
    )
