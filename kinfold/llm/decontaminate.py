"""Benchmark decontamination: which documents contain which test items.

Containment is the share of an item's distinct word shingles that a document has. A long document has a
tiny Jaccard similarity with a short item, so one signature length for all cannot work. Documents are
partitioned by size: one with n shingles keeps the smallest hash in each of about n / ``load`` hash ranges,
a MinHash signature that grows with the document. An item is signed once for every partition, with that
partition's ranges. One agreeing minimum makes a candidate; candidates are verified by exact containment
of the shingle texts.

With ``load`` 0.5 a shared shingle is the minimum of its range on both sides with a chance near 0.8, so an
item that shares 8 shingles is missed with a chance of 0.2^8. Items below ``SHORT`` shingles are searched
by all their hashes instead, so none is missed for being short.

Defined results: null and empty texts have no shingles and match nothing; a text shorter than a shingle is
one shingle of all its words. Rows with equal ids are different documents only for ``drop_contaminated``;
``find_leaks`` returns one row per (doc_id, item_id) pair with the largest overlap. Rows without an id can't
be reported by ``find_leaks`` and are dropped by it, but ``drop_contaminated`` judges them by their text.
Empty tables give empty tables. Other columns pass through ``drop_contaminated`` unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store
from .common import let, lower_ascii, shingle_hashes, text_or_empty, words_of

SHINGLE = 5
CONTAINED = (4, 5)
LOAD = 0.5
SHORT = 8


def _words(text: Column | str) -> Column:
    return words_of(lower_ascii(text_or_empty(text)))


def _grams(words: Column, k: int) -> Column:
    """Distinct shingles as text."""
    many = F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.array_join(F.slice(words, i + 1, k), " "))
    return F.array_distinct(
        F.when(F.size(words) >= k, many).when(F.size(words) > 0, F.array(F.array_join(words, " "))).otherwise(F.array().cast("array<string>"))
    )


def _hashes(text: Column, k: int) -> Column:
    return let(_words(text), lambda w: F.sort_array(F.array_distinct(shingle_hashes(w, k))))


def _bits(n: Column, load: float) -> Column:
    """Size partition: two to this power is the number of hash ranges."""
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(n, F.lit(1)) / F.lit(load)))).cast("int")


def _minima(sorted_hashes: Column, bits: Column) -> Column:
    """Of each hash range (by the leading bits) the smallest hash; the input is sorted."""

    def of(h: Column) -> Column:
        def leading(x: Column) -> Column:
            # Two shifts, since a shift by 64 is none.
            return F.call_function("shiftright", F.call_function("shiftright", x, F.lit(1)), F.lit(63) - bits)

        return F.filter(h, lambda x, i: (i == 0) | (leading(x) != leading(F.get(h, i - 1))))

    return let(sorted_hashes, of)


def sign_documents(docs: DataFrame, key: str, text: str, k: int, load: float, with_all: bool) -> DataFrame:
    """``(key, part, hash)``: minima under the document's partition, or every hash under part -1."""
    hashed = docs.select(key, _hashes(F.col(text), k).alias("h"))
    bits = _bits(F.size("h"), load)
    minima = F.transform(_minima(F.col("h"), bits), lambda x: F.struct(bits.alias("part"), x.alias("hash")))
    every = F.transform("h", lambda x: F.struct(F.lit(-1).alias("part"), x.alias("hash")))
    rows = F.concat(minima, every) if with_all else minima
    return hashed.select(key, F.inline(rows))


def sign_items(items: DataFrame, parts: int, load: float) -> DataFrame:
    """``(item, part, hash)`` for every size partition, or all hashes under part -1 for short items."""
    parted = items.select("item", "h", F.explode(F.sequence(F.lit(0), F.lit(parts))).alias("part"))
    long_rows = parted.filter(F.size("h") >= SHORT).select("item", "part", F.explode(_minima(F.col("h"), F.col("part"))).alias("hash"))
    short_rows = items.filter(F.size("h") < SHORT).select("item", F.lit(-1).alias("part"), F.explode("h").alias("hash"))
    return long_rows.unionByName(short_rows)


def find_contained(
    docs: DataFrame, items: DataFrame, key: str, text: str, k: int = SHINGLE, at_least: tuple[int, int] = CONTAINED, load: float = LOAD
) -> DataFrame:
    """``(key, item, n_shingles, n_shared)`` of verified pairs; ``items`` has ``item`` and ``text``."""
    item_sets = store(
        items.select("item", _words("text").alias("w")).select("item", _grams(F.col("w"), k).alias("grams"), F.sort_array(F.array_distinct(shingle_hashes(F.col("w"), k))).alias("h")).filter(F.size("grams") > 0),
        "items",
    )
    short = item_sets.filter(F.size("h") < SHORT).limit(1).count() > 0
    # A partition holds documents of up to load * 2^part shingles: 2^40 words is beyond any text.
    signed = store(sign_items(item_sets, 42, load), "item-signatures")
    candidates = store(
        sign_documents(docs, key, text, k, load, short)
        .join(signed, ["part", "hash"])
        .select(key, "item")
        .distinct(),
        "leak-candidates",
    )
    # Only documents with a candidate are cut into shingle texts. The item list of a document is bounded by
    # the items it has a shingle of.
    wanted = candidates.join(item_sets.select("item", "grams"), "item").groupBy(key).agg(
        F.collect_list(F.struct("item", "grams")).alias("_items")
    )
    checked = docs.select(key, F.col(text).alias("_text")).join(wanted, key).select(
        key, "_items", _words(F.col("_text")).alias("w")
    ).select(key, "_items", _grams(F.col("w"), k).alias("g"))
    pairs = checked.select(key, F.explode("_items").alias("i"), "g").select(
        key,
        F.col("i.item").alias("item"),
        F.size("i.grams").cast("long").alias("n_shingles"),
        F.size(F.array_intersect("g", "i.grams")).cast("long").alias("n_shared"),
    )
    return pairs.filter(F.col("n_shared") * at_least[1] >= F.col("n_shingles") * at_least[0])


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", **options) -> DataFrame:
    """``(doc_id, item_id, n_shingles, n_shared)``."""
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    tests = items.select(F.col(item_id).alias("item"), F.col(text).alias("text")).filter(F.col("item").isNotNull())
    found = find_contained(named, tests, "doc_id", "text", **options)
    return found.groupBy("doc_id", F.col("item").alias("item_id")).agg(
        F.max("n_shingles").alias("n_shingles"), F.max("n_shared").alias("n_shared")
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that contain no test item. Rows are told apart by the md5 of their text."""
    names = docs.columns
    keyed = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("_row"), F.md5(text_or_empty(text)).alias("_key"), F.col(text).alias("_t"))
    tests = items.select(F.xxhash64("text").alias("item"), F.col("text"))
    # Equal texts have equal keys and equal verdicts; one row of each would do, but a distinct would shuffle
    # texts, so all rows are signed and the candidates are made distinct.
    found = store(find_contained(keyed.select("_key", "_t"), tests, "_key", "_t", **options).select("_key").distinct(), "leaks")
    return keyed.join(found, "_key", "left_anti").select("_row.*")
