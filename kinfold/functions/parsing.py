"""Column expressions that read the nested attribute fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators of the stored format.
QUOTED_TOKEN = "'[^']*'|\"[^\"]*\""
DUPLICATE_SEP = "|"
FLAG_TEXT = "True"
# End of fixed values.


def _unquoted(token: Column) -> Column:
    return F.substring(token, F.lit(2), F.length(token) - 2)


def _as_list(values: Column) -> Column:
    return F.coalesce(values, F.array().cast("array<string>"))


def _quoted_tokens(col: Column) -> Column:
    found = F.regexp_extract_all(col, F.lit(QUOTED_TOKEN), F.lit(0))
    return _as_list(F.when(col.rlike(r"(?U)^\s*\["), found))


def token_list(col: Column, is_array: bool = False) -> Column:
    """Tokens of an array column, or of its text form ``['a' 'b']``; never null."""
    if is_array:
        return _as_list(F.filter(col, lambda x: x.isNotNull()))
    return F.transform(_quoted_tokens(col), _unquoted)


def _entries(tokens: Column) -> Column:
    # Cut once: an expression inside a lambda is evaluated as often as it is named.
    cut = F.transform(tokens, lambda t: F.split(t, ":", 2))
    return F.transform(cut, lambda c: F.struct(c[0].alias("k"), F.get(c, F.lit(1)).alias("v")))


def kv_entries(col: Column, is_array: bool = False) -> Column:
    """``key:value`` tokens cut at the first colon; a bare flag has a null value."""
    return _entries(token_list(col, is_array))


def _text(entry: Column) -> Column:
    return F.coalesce(entry["v"], F.lit(FLAG_TEXT))


def _keyed(entries: Column, value) -> Column:
    """Map from each key to a value made of its entries, in token order."""
    keys = F.array_distinct(F.transform(entries, lambda e: e["k"]))

    def of_key(key: Column) -> Column:
        return value(F.filter(entries, lambda e: e["k"] == key))

    return F.map_from_arrays(keys, F.transform(keys, of_key))


def kv_first_map(entries: Column) -> Column:
    """The first value of every key."""
    return _keyed(entries, lambda hits: _text(hits[0]))


def kv_joined_map(entries: Column, sep: str = DUPLICATE_SEP) -> Column:
    """All values of every key, joined."""
    return _keyed(entries, lambda hits: F.array_join(F.transform(hits, _text), sep))


def kv_lone_flags(entries: Column) -> Column:
    """Keys that occur exactly once and without a value: flags, not text."""
    keys = F.transform(entries, lambda e: e["k"])
    bare = F.transform(F.filter(entries, lambda e: e["v"].isNull()), lambda e: e["k"])
    return F.filter(bare, lambda k: F.size(F.filter(keys, lambda x: x == k)) == 1)


def json_map(col: Column) -> Column:
    """JSON object as a map of texts; anything else gives an empty map."""
    return F.coalesce(
        F.from_json(col, "map<string,string>"),
        F.create_map().cast("map<string,string>"),
    )


def json_nested(fields: Column, key: str, inner: str) -> Column:
    """P5: value of a key inside a nested object."""
    return F.from_json(F.try_element_at(fields, F.lit(key)), "map<string,string>")[inner]


def geoname_or_unknown(entries: Column) -> Column:
    """Geoname id of a token list, ``unknown`` when absent."""
    return F.coalesce(F.try_element_at(kv_first_map(entries), F.lit("geoname_id")), F.lit("unknown"))
