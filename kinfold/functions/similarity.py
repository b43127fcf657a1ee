"""Column expressions that compare two profiles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def tri_state(a: Column, b: Column) -> Column:
    """-1 when either side is missing, else equality."""
    return F.when(a.isNull() | b.isNull(), -1).otherwise((a == b).cast("int"))


def number_gap(a: Column, b: Column) -> Column:
    """absolute difference, null when either side is not a number."""
    return F.abs(a.try_cast("double") - b.try_cast("double"))


def day_gap(a: Column, b: Column) -> Column:
    """whole days, floored before the sign is dropped."""
    micros = F.timestamp_diff("MICROSECOND", b, a)
    return F.abs(F.floor(micros / F.lit(MICROS_PER_DAY)))


def _no_set(a: Column, b: Column) -> Column:
    return F.coalesce(F.size(a) < 1, F.lit(True)) | F.coalesce(F.size(b) < 1, F.lit(True))


def set_overlap(a: Column, b: Column) -> Column:
    """size of the intersection, -1 when either set is empty."""
    return F.when(_no_set(a, b), -1).otherwise(F.size(F.array_intersect(a, b)))


def jaccard_of(overlap: Column, size_a: Column, size_b: Column) -> Column:
    """from the overlap of F7 and the set sizes, so that the sets meet only once."""
    return F.when(overlap < 0, F.lit(-1.0)).otherwise(overlap / (size_a + size_b - overlap))


def comparable_text(a: Column) -> Column:
    """The trimmed text; null for missing, blank or ``nan`` text. Made once per record, not once per pair."""
    x = F.regexp_replace(a, r"(?U)^\s+|\s+$", "")
    return F.when((F.lower(a) != "nan") & (x != ""), x)


def edit_similarity(x: Column, y: Column) -> Column:
    """F11 of two ``comparable_text``."""
    return F.coalesce(1 - F.levenshtein(x, y) / F.greatest(F.length(x), F.length(y)), F.lit(0.0))


def levenshtein_similarity(a: Column, b: Column) -> Column:
    """1 - distance / longer length; 0 for missing, blank or ``nan`` text."""
    return edit_similarity(comparable_text(a), comparable_text(b))


def numbered_tokens(col: Column) -> Column:
    """Sorted tokens, each tagged with its occurrence number; null without tokens."""
    tokens = F.array_sort(F.filter(F.split(col, r"(?U)\s+"), lambda t: t != ""))
    tagged = F.transform(
        tokens, lambda t, i: F.concat(t, F.lit("#"), (i - F.array_position(tokens, t)).cast("string"))
    )
    return F.when(F.size(tokens) > 0, tagged)


def shared_tokens_similarity(x: Column, y: Column) -> Column:
    """F16 of two ``numbered_tokens``."""
    empty = x.isNull() | y.isNull()
    return F.when(empty, F.lit(0.0)).otherwise(2 * F.size(F.array_intersect(x, y)) / (F.size(x) + F.size(y)))


def token_sort_similarity(a: Column, b: Column) -> Column:
    """F16: twice the shared tokens over all tokens, repeated tokens counted."""
    return shared_tokens_similarity(numbered_tokens(a), numbered_tokens(b))


def same_domain(a: Column, b: Column) -> Column:
    """1 only for equal, non-empty domains."""
    return F.coalesce(((a == b) & (a != "")).cast("int"), F.lit(0))


def same_place(a: Column, b: Column, null_text: str | None = None) -> Column:
    """equality; missing never matches unless ``null_text`` stands in for it."""
    if null_text is not None:
        a, b = F.coalesce(a, F.lit(null_text)), F.coalesce(b, F.lit(null_text))
    return same_domain(a, b)
