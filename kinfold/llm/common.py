"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space of the word rule.
SPACE = r"[\x20\x09-\x0D]+"
# End of fixed values.


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_or_empty(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only, so that every engine agrees."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column | str) -> Column:
    """Runs of characters other than space, tab, line ends, vertical tab and form feed."""
    return F.array_remove(F.split(text_or_empty(text), SPACE), "")


def n_words_of(text: Column | str) -> Column:
    return F.size(words_of(text)).cast("long")


def held_out(doc_id: Column | str) -> Column:
    """Fold by crc32 of the id as text; a null id is never held out."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def shingle_hashes(words: Column, k: int) -> Column:
    """64-bit hashes of the k-word windows; fewer words give one hash of all, no word none.

    ``words`` must be bound (a column or a ``let`` variable): it is read once per window.
    """
    window = F.transform(
        F.sequence(F.lit(0), F.size(words) - k),
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]),
    )
    short = F.array(F.xxhash64(F.array_join(words, " ")))
    return (
        F.when(F.size(words) >= k, window)
        .when(F.size(words) > 0, short)
        .otherwise(F.array().cast("array<bigint>"))
    )
