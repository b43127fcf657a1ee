"""Exact join of token sets by similarity (B9, F6): no word is left out, no pair at the threshold is lost.

Input is a long table ``(profile_id, token)``, distinct. Profiles with equal sets are one class; pairs are between the smallest
members of classes, so copies are told by membership and never written out as pairs.

1. Tokens get numbers, rarest first (``token_order``); tokens of one profile have no partner and need none. Copies take part in the
   counts, their sets go once the words are numbered and packed: leaving them out before would shuffle every token once more.
2. Sets, sorted by size, are dealt into chunks, and every two chunks whose sizes may match are one cell, compared in one task.
   Sets with Jaccard similarity of at least t share o tokens, o from their sizes, and k of these among the first ``size - o + k``
   of each (extended prefix filter). Prefix tokens meet in an inverted list and are counted inside the task (``setcells``): at a low
   threshold there are more meetings than pairs of sets, so they must not be shuffled.
3. Few pairs have k meetings, and only these compare their sets.

Chunks are packed and written once; a cell reads the two it needs, so what is shuffled and written grows with the input only. How often a
chunk is read, and the comparison itself, are quadratic by nature, bounded in memory and spread over the cells.

Empty sets belong to no class and link with nothing. Tokens that very many profiles hold get their numbers without a shuffle
(``OFTEN_BYTES``); in prefixes they stand last, so they rarely meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import jaccard_of
from ..session import scratch_path, store
from . import setcells
from .skew import lookup_join, running_totals

#: Chunks that the words are dealt into, and the least and most words of one; a set counts ``ROW_COST`` words more.
CHUNKS, CHUNK_LEAST, CHUNK_MOST, ROW_COST = 10, 1 << 18, 4_000_000, 16
#: Bytes of the frequent tokens that every task gets, and what a token counts besides its text.
OFTEN_BYTES, TOKEN_COST = 8 << 20, 32


def _set_key() -> Column:
    """Identity of the set of a group's tokens: sums of four 64-bit hashes, in halves that can't overflow. Partial sums leave the tokens where they are."""
    hashes = [F.when(F.col("token").isNotNull(), F.xxhash64(F.lit(seed), F.col("token"))) for seed in range(4)]
    halves = [F.sum(half) for h in hashes for half in (h.bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(h, 32))]
    return F.concat_ws(",", F.count("token").cast("string"), *[F.coalesce(x, F.lit(0)).cast("string") for x in halves])


def set_classes(tokens: DataFrame) -> DataFrame:
    """``(profile_id, class_id, size)``: the smallest profile with the same set."""
    sets = store(tokens.groupBy("profile_id").agg(_set_key().alias("_key"), F.count(F.lit(1)).alias("size")), "set-keys")
    first = sets.groupBy("_key").agg(F.min("profile_id").alias("class_id"))
    # Many profiles may have one set.
    return lookup_join(sets, store(first, "set-classes"), "_key", "profile_id", sets.count()).select("profile_id", "class_id", "size")


def token_order(tokens: DataFrame) -> DataFrame:
    """``(token, word, often)``: numbers from 1 in the order of frequency, then token; only tokens of two rows or more.

    ``often``: the most frequent ones, ``OFTEN_BYTES`` altogether.
    """
    counted = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    counted = counted.withColumns({"_one": F.lit(1).cast("bigint"), "_bytes": (F.octet_length("token") + TOKEN_COST).cast("bigint")})
    placed = running_totals(counted, [], ["df", "token"], {"word": "_one", "_upto": "_bytes"})
    often = F.col("_upto_all") - F.col("_upto") + F.col("_bytes") <= OFTEN_BYTES
    return placed.select("token", F.col("word").cast("int").alias("word"), often.alias("often"))


def numbered_sets(tokens: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(profile_id, size, words)`` of the profiles in ``sizes``: the shared words by number, rarest first.

    Most rows get their number where they are, from the frequent tokens; only rows of rarer ones are shuffled to find it.
    """
    tokens = tokens.select("profile_id", "token")
    order = store(token_order(tokens), "token-order")
    # A stated bound, whatever the vocabulary.
    often = F.broadcast(order.filter("often").select("token", "word"))
    seldom = order.filter("not often").select("token", "word")
    found = tokens.join(often, "token").unionByName(tokens.join(often, "token", "left_anti").join(seldom, "token"))
    words = found.groupBy("profile_id").agg(F.sort_array(F.collect_set("word")).alias("words"))
    # A set without shared words has no partner.
    return sizes.join(words, "profile_id").select("profile_id", "size", "words")


def _chunked(sets: DataFrame, threshold: float) -> DataFrame:
    """``sets`` with a ``chunk`` number in the order of size, by hash where sets of one size fill several. Chunks have much the same number of words."""
    # Fewer shared words than a partner must have in common: no partner.
    able = sets.filter(F.size("words") >= F.ceil(F.lit(threshold) * F.col("size") - 1e-9))
    # The sum of all sizes bounds how many sizes there are: with a billion words 45,000.
    costs = store(able.groupBy("size").agg(F.sum(F.size("words") + F.lit(ROW_COST)).alias("_cost")), "set-costs")
    total = costs.agg(F.sum("_cost")).first()[0] or 0
    most = min(CHUNK_MOST, max(CHUNK_LEAST, total // CHUNKS + 1))
    places = store(running_totals(costs, [], ["size"], {"_at": "_cost"}).select("size", "_cost", "_at"), "set-places")
    at = F.col("_at") - F.col("_cost") + F.pmod(F.xxhash64("profile_id"), F.col("_cost"))
    placed = able.join(F.broadcast(places), "size")
    return placed.select(F.floor(at / F.lit(most)).cast("int").alias("chunk"), "profile_id", "size", "words")


def _ints(values: np.ndarray, kind: type) -> pa.Scalar:
    return pa.scalar(pa.compress(values.astype(kind).tobytes(), "zstd", asbytes=True), pa.binary())


def _from_ints(data: pa.Scalar, n: int, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(data.as_buffer(), n * np.dtype(kind).itemsize, "zstd"), kind)


def _pack(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A chunk as one row, sets in the order of size; numbers of a set's words as steps from one to the next, which are small."""
    rows = pa.Table.from_batches(list(batches)).sort_by("size").combine_chunks()
    size, words = rows["size"].to_numpy(), rows["words"].combine_chunks()
    lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    steps = np.diff(words.flatten().to_numpy(), prepend=0).astype(np.int32)
    starts = (np.cumsum(lengths) - lengths)[lengths > 0]
    steps[starts] = words.flatten().to_numpy()[starts]
    ids = pa.array([rows["profile_id"].combine_chunks()], pa.list_(rows.schema.field("profile_id").type))
    made = {"chunk": pa.array([key[0]], pa.int32()), "least": pa.array(size[:1]), "most": pa.array(size[-1:]), "ids": ids}
    made |= {"n_words": pa.array([len(steps)], pa.int64())}
    made |= {name: pa.array([x]) for name, x in (("sizes", _ints(size, np.int64)), ("lengths", _ints(lengths, np.int64)), ("steps", _ints(steps, np.int32)))}
    yield pa.RecordBatch.from_pydict(made)


def _unpack(row: pa.RecordBatch, side: str) -> tuple[pa.Array, setcells.Chunk]:
    """The ids and sets of one side of a cell."""
    value = lambda name: row[f"{name}_{side}"][0]
    ids = value("ids").values
    size, lengths = (_from_ints(value(name), len(ids), np.int64) for name in ("sizes", "lengths"))
    steps = _from_ints(value("steps"), value("n_words").as_py(), np.int32)
    # Sums over all sets, less what stands before each set.
    total = np.concatenate([[0], np.cumsum(steps, dtype=np.int64)])
    before = total[np.cumsum(lengths) - lengths]
    return ids, setcells.Chunk(size, lengths, (total[1:] - np.repeat(before, lengths)).astype(np.int32))


def _packed(chunks: DataFrame) -> DataFrame:
    """Chunks as stored rows, a file each, so that cells can read the two they need."""
    n = (chunks.agg(F.max("chunk")).first()[0] or 0) + 1
    kind = chunks.schema["profile_id"].dataType.simpleString()
    schema = f"chunk int, least bigint, most bigint, ids array<{kind}>, n_words bigint, sizes binary, lengths binary, steps binary"
    packed = chunks.repartition(n, "chunk").groupBy("chunk").applyInArrow(_pack, schema)
    path = scratch_path(chunks.sparkSession, "set-chunks")
    packed.write.option("maxRecordsPerFile", 1).parquet(path)
    return chunks.sparkSession.read.schema(packed.schema).parquet(path)


def _cell_pairs(threshold: float):
    """Compares the two chunks of each cell."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids, left = _unpack(row, "a")
                same = row["chunk_a"][0] == row["chunk_b"][0]
                other, right = (ids, left) if same else _unpack(row, "b")
                for x, y, n in setcells.similar_rows(left, right, threshold, same):
                    p, q = ids.take(pa.array(x)), other.take(pa.array(y))
                    swap = pc.greater(p, q)
                    columns = [pc.if_else(swap, q, p), pc.if_else(swap, p, q), pa.array(n), pa.array(left.size[x]), pa.array(right.size[y])]
                    yield pa.RecordBatch.from_arrays(columns, ["profile_id_1", "profile_id_2", "n", "s1", "s2"])

    return compare


def close_sets(sets: DataFrame, threshold: float) -> DataFrame:
    """Steps 2 and 3: pairs ``(profile_id_1, profile_id_2, n, s1, s2)`` that reach the threshold, with overlap and sizes."""
    packed = _packed(_chunked(sets, threshold))
    a, b = (packed.select(*[F.col(c).alias(f"{c}_{side}") for c in packed.columns]) for side in "ab")
    # Each task reads its chunks from the files; neither a shuffle nor a broadcast copies them.
    cells = a.hint("shuffle_replicate_nl").join(b, (F.col("chunk_a") <= F.col("chunk_b")) & (F.col("most_a") >= F.lit(threshold) * F.col("least_b") - 1e-9))
    kind = sets.schema["profile_id"].dataType.simpleString()
    schema = f"profile_id_1 {kind}, profile_id_2 {kind}, n bigint, s1 bigint, s2 bigint"
    return cells.mapInArrow(_cell_pairs(threshold), schema)


def similar_sets(tokens: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Classes ``(profile_id, class_id, size)`` and pairs ``(profile_id_1, profile_id_2, n, similarity)`` between their first members.

    Pairs are all those with Jaccard similarity of at least ``threshold`` (above 0); ``n`` is the overlap.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie above 0 and not above 1")
    classes = store(set_classes(tokens), "classes")
    sizes = classes.filter(F.col("profile_id") == F.col("class_id")).select("profile_id", "size")
    sets = store(numbered_sets(tokens, sizes), "sets")
    scored = close_sets(sets, threshold)
    found = scored.select("profile_id_1", "profile_id_2", "n", jaccard_of(F.col("n"), F.col("s1"), F.col("s2")).alias("similarity"))
    return classes, found.filter(F.col("similarity") >= threshold)
