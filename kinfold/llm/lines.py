"""Line deduplication with a log-template tree.

A line is parsed to a leaf of a tree of fixed depth: first by its number of tokens, then by its leading
tokens, in which fields that vary by nature (anything with a digit) stand as ``<*>``. A line that is mostly such
fields, as a table row is, keeps its own tokens: only equal rows are one line. Dropped are

1. lines that recur in ``min_docs`` or more documents, fields masked;
2. lines of a group that recurs in so many documents. A leaf holds several groups. Lines of a group have the same tokens at
   the positions that are frequent in the leaf (``min_docs`` documents or more; also 4, 16, ... times as many, so that slots with few values
   don't split a group), and these are at least half of a line's tokens;
3. lines that agree with the template of the leaf, if such lines recur in so many documents. The template has, at each position, the token that
   most documents have there, or ``<*>`` where none has the half. Half of a line's tokens must agree.

2 and 3 look at tokens behind the leading ones that aren't ``<*>``, as the leading ones agree in all lines of a leaf. They are also
done in deeper leaves, by the next leading and by the last tokens (which don't count there), so that unlike lines of a crowded leaf
don't hide a template. In a crowded leaf, odd variants that share neither of these with their template are kept.

Leaves and lines are counted by hash and document, so a line that fills a third of all documents is counted
in each input partition first. Only lines of leaves that recur often enough are looked at token by token.

Defined results: null text has no lines and stays null; lines without tokens are kept as they are; a
document may become the empty string. Rows with equal ids, and all rows without an id, count as one document
and are each cleaned. An empty table gives an empty table. ``drop_lines`` keeps all columns and adds one
struct of its own, so that no name of the input can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store
from .common import let, words_of

DEPTH = 4
MIN_DOCS = 10
FIXED_SHARE = 0.5
WILD = "<*>"


def masked_tokens(line: Column, fixed_share: float = FIXED_SHARE) -> Column:
    # Word by word: a pattern over the line would try words without a digit from each of their characters.
    mask = lambda words: F.transform(words, lambda word: F.when(word.rlike("[0-9]"), WILD).otherwise(word))
    fields = lambda tokens: F.size(F.filter(tokens, lambda t: t == WILD))
    chosen = let(
        words_of(line),
        lambda words: let(mask(words), lambda m: F.when(fields(m) > F.size(m) * F.lit(1 - fixed_share), words).otherwise(m)),
    )
    return F.when(line.rlike("[0-9]"), chosen).otherwise(words_of(line))


def _keys(tokens: Column, depth: int) -> Column:
    return F.struct(
        F.xxhash64(F.size(tokens), F.slice(tokens, 1, depth)).alias("leaf"),
        F.xxhash64(tokens).alias("line"),
    )


def _document(doc_id: str) -> Column:
    col = F.col(doc_id)
    return F.when(col.isNull(), F.lit("none")).otherwise(F.concat(F.lit("id "), col.cast("string")))


def _lines(docs: DataFrame, doc_id: str, text: str, depth: int, fixed_share: float) -> DataFrame:
    """``(doc, leaf, line, tokens)`` of lines with a token."""
    exploded = docs.select(_document(doc_id).alias("doc"), F.explode(F.split(F.col(text), "\n")).alias("raw"))
    # Tested on the line itself: a filter on tokens would move below them and make them twice.
    tokens = exploded.filter(F.col("raw").rlike(r"[^\x20\x09-\x0D]")).select(
        "doc", masked_tokens(F.col("raw"), fixed_share).alias("tokens")
    )
    return tokens.select("doc", _keys(F.col("tokens"), depth).alias("k"), "tokens").select("doc", "k.leaf", "k.line", "tokens")


def _cells(looked: DataFrame, depth: int) -> DataFrame:
    """``(leaf, line, n_docs, cell, body)``: the leaf of a line and its deeper leaves, with the tokens that their keys don't hold."""
    tokens, n = F.col("tokens"), F.size("tokens")
    rest = n - depth
    after, before_last = F.slice(tokens, depth * 2 + 1, F.greatest(rest - depth, F.lit(0))), F.slice(tokens, depth + 1, F.greatest(rest - depth, F.lit(0)))
    cells = F.array(
        F.struct(F.col("leaf").alias("cell"), F.slice(tokens, depth + 1, F.greatest(rest, F.lit(0))).alias("body")),
        F.struct(F.xxhash64(F.lit("next"), "leaf", F.slice(tokens, depth + 1, depth)).alias("cell"), after.alias("body")),
        F.struct(F.xxhash64(F.lit("last"), "leaf", F.slice(tokens, F.greatest(n - depth + 1, F.lit(1)), F.lit(depth))).alias("cell"), before_last.alias("body")),
    )
    with_rest = F.filter(cells, lambda c: F.size(c["body"]) > 0)
    return looked.select("leaf", "line", "n_docs", F.explode(with_rest).alias("c")).select("leaf", "line", "n_docs", "c.cell", "c.body")


def _often(counted: DataFrame, key: str, min_docs: int) -> DataFrame:
    """Keys that recur and have a line that doesn't recur alone."""
    return counted.groupBy(key).agg(F.sum("n_docs").alias("most"), F.min("n_docs").alias("least")).filter(
        (F.col("most") >= min_docs) & (F.col("least") < min_docs)
    ).select(key)


def _groups(cells: DataFrame, min_docs: int, fixed_share: float) -> DataFrame:
    """``(leaf, line, group)``: groups of 2 and 3 that a line may belong to."""
    entries = store(cells.select("leaf", "line", "n_docs", "cell", F.posexplode("body").alias("pos", "token")), "lines-tokens")
    # A token is weighed by the documents that have it at that position.
    weighed = store(entries.groupBy("cell", "pos", "token").agg(F.sum("n_docs").alias("n")), "lines-weighed")
    tops = weighed.groupBy("cell", "pos").agg(F.max(F.struct("n", "token")).alias("top"), F.sum("n").alias("all"))
    tops = tops.filter(F.col("top.n") * 2 >= F.col("all")).select("cell", "pos", F.col("top.token").alias("token"), F.lit(True).alias("top"))
    marks = store(
        weighed.join(tops, ["cell", "pos", "token"], "left").filter((F.col("n") >= min_docs) | F.col("top")), "lines-marks"
    )
    # 4**level * min_docs documents have it.
    level = F.when(F.col("n") >= min_docs, F.floor(F.log2(F.col("n") / F.lit(float(min_docs))) / 2)).otherwise(-1).cast("int")
    parts = F.struct("pos", "token", F.coalesce(level, F.lit(-1)).alias("level"), F.coalesce("top", F.lit(False)).alias("top"))
    # One row per position, so as many as a line has tokens.
    whole = (
        entries.join(marks, ["cell", "pos", "token"], "left")
        .groupBy("leaf", "line", "cell")
        .agg(F.sort_array(F.collect_list(parts)).alias("ps"))
    )
    counts = store(whole.withColumn("real", F.filter("ps", lambda p: p["token"] != WILD)).filter(F.size("real") > 0), "lines-parts")
    least = F.size("real") * F.lit(fixed_share)
    agree = counts.filter(F.size(F.filter("real", lambda p: p["top"])) >= least).select(
        "leaf", "line", F.xxhash64(F.lit("most"), "cell").alias("group")
    )
    levels = F.array_distinct(F.transform(F.filter("real", lambda p: p["level"] >= 0), lambda p: p["level"]))
    at = counts.select("leaf", "line", "cell", "ps", "real", F.explode(levels).alias("at")).filter(
        F.size(F.filter("real", lambda p: p["level"] >= F.col("at"))) >= least
    )
    fixed = F.transform("ps", lambda p: F.when(p["level"] >= F.col("at"), p["token"]).otherwise(WILD))
    equal = at.select("leaf", "line", F.xxhash64(F.lit("equal"), "cell", fixed).alias("group"))
    return agree.unionByName(equal).distinct()


def line_templates(
    docs: DataFrame, doc_id: str, text: str, min_docs: int = MIN_DOCS, depth: int = DEPTH, fixed_share: float = FIXED_SHARE
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Groups ``(leaf, group, n_docs)`` of unequal lines that recur, all lines ``(leaf, line)`` that recur or belong to one, and
    all ``(doc, leaf, line)``."""
    lines = _lines(docs, doc_id, text, depth, fixed_share)
    seen = store(lines.groupBy("doc", "leaf", "line").agg(F.count(F.lit(1)).alias("n")), "lines")
    per_line = store(seen.groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("n_docs")), "lines-counted")
    often = store(_often(per_line, "leaf", min_docs), "leaves")
    texts = (
        lines.select("leaf", "line", "tokens")
        .join(often, "leaf", "left_semi")
        .groupBy("leaf", "line")
        .agg(F.first("tokens").alias("tokens"))
    )
    cells = store(_cells(texts.join(per_line, ["leaf", "line"]), depth), "lines-cells")
    groups = _groups(cells.join(_often(cells, "cell", min_docs), "cell", "left_semi"), min_docs, fixed_share)
    # Lines of a group in one document count once; before that, the sum over lines is a bound.
    bounded = store(groups.join(per_line, ["leaf", "line"]), "lines-groups")
    enough = bounded.groupBy("leaf", "group").agg(F.sum("n_docs").alias("most")).filter(F.col("most") >= min_docs).select("leaf", "group")
    members = store(bounded.join(enough, ["leaf", "group"]).select("leaf", "group", "line"), "lines-members")
    found = store(
        seen.join(members, ["leaf", "line"])
        .groupBy("leaf", "group", "doc")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("leaf", "group")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .filter(F.col("n_docs") >= min_docs),
        "lines-recurring",
    )
    alone = per_line.filter(F.col("n_docs") >= min_docs).select("leaf", "line")
    bad = alone.unionByName(members.join(found, ["leaf", "group"], "left_semi").select("leaf", "line")).distinct()
    return found, bad, seen


def drop_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH, fixed_share: float = FIXED_SHARE, **options
) -> DataFrame:
    """All columns of ``docs`` as ``doc`` and ``cleaned``: text, n_lines, n_dropped."""
    _, bad, seen = line_templates(docs, doc_id, text, depth=depth, fixed_share=fixed_share, **options)
    # At most as many as a document has lines.
    marked = seen.join(bad, ["leaf", "line"]).groupBy("doc").agg(F.collect_set("line").alias("bad"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _document(doc_id).alias("doc"), F.col(text).alias("text"))
    joined = whole.join(marked, "doc", "left")
    lines = F.split("text", "\n")
    kept = F.when(
        F.col("bad").isNotNull(),
        F.filter(lines, lambda x: ~F.array_contains("bad", F.xxhash64(masked_tokens(x, fixed_share)))),
    ).otherwise(lines)
    cleaned = joined.select("row", lines.alias("lines"), kept.alias("kept"))
    return cleaned.select(
        F.col("row").alias("doc"),
        F.struct(
            F.array_join("kept", "\n").alias("text"),
            F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
            F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_dropped"),
        ).alias("cleaned"),
    )
