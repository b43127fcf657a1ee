"""Quality rules as weak supervision.

Every rule votes for a document (1), against it (-1) or abstains (0). Votes form a pattern, and a corpus
has at most 3^rules patterns, so expectation-maximisation runs on pattern counts: one row, built-in array
functions, no Python. It estimates one accuracy per rule and the share of good documents; the posterior
probability of a pattern decides, instead of a demand that all rules pass.

Defined results: null or empty text has no words, all counts are 0, the base rule rejects it. Repeated
rows are judged alike and count as often as they occur. An empty table gives an empty table. Other columns
of the input, whatever their names, pass through ``filter_quality`` untouched; ``judge_quality`` returns
the chosen id column and its own columns only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store
from .common import let, text_or_empty, words_of

ROUNDS = 30
KEEP_FROM = 0.5
# First posterior of the side that the votes are on.
START = 0.95
# Bounds of the estimates, and accuracies believed as much as this part of all documents. Rules are made to
# let good documents pass; without that bound votes on one kind of junk can't tell junk from a rule that
# errs often, and the model would call everything good.
ON_GOOD, ON_BAD, GOOD_SHARE = (0.995, 0.9995), (0.05, 0.95), (0.5, 0.9)
EXPECTED_ON_GOOD, EXPECTED_ON_BAD, BELIEF = 0.998, 0.2, 0.1
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct", "n_upper", "n_marks", "ends_well",
)


def _covered(grams: Column) -> Column:
    """Words inside three-word windows whose hash occurs twice or more."""

    def from_sorted(s: Column) -> Column:
        twice = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda k: (F.get(s, k)["h"] == F.get(s, k - 1)["h"]) | (F.get(s, k)["h"] == F.get(s, k + 1)["h"]),
        )
        starts = F.sort_array(F.transform(twice, lambda k: F.get(s, k)["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(
            starts,
            start,
            lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")),
        )["n"]

    numbered = F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    # Most texts repeat nothing; they are spared the sort.
    return F.when(F.size(F.array_distinct(grams)) < F.size(grams), let(F.sort_array(numbered), from_sorted)).otherwise(0)


def _measures(text: Column) -> Column:
    def of_words(w: Column) -> Column:
        grams = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        )
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            F.when(F.size(w) >= 3, let(grams, _covered)).otherwise(0).cast("long").alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    def without(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, "")).cast("long")

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    length = F.length(text).cast("long")
    return F.struct(
        let(words_of(text), of_words).alias("w"),
        let(lines, of_lines).alias("l"),
        (length - without(r"[#*$%&|<>]+")).alias("n_symbols"),
        (length - without(r"\p{Lu}+")).alias("n_upper"),
        (length - without(r"[!?]+")).alias("n_marks"),
        text.rlike(r"[.!?\"')»\]]\s*$").alias("ends_well"),
    )


def quality_counts(text: Column) -> Column:
    """One struct with the fields of ``COUNTS``."""

    def flat(m: Column) -> Column:
        where = {"n_words": "w", "word_chars": "w", "n_distinct": "w", "n_repeat_words": "w", "n_lines": "l", "n_dup_lines": "l"}
        return F.struct(*[(m[where[c]][c] if c in where else m[c]).alias(c) for c in COUNTS])

    return let(_measures(text_or_empty(text)), flat)


def rule_votes(c: Column) -> list[tuple[str, Column, Column]]:
    """(name, votes against, votes for); neither means the rule abstains.

    Measures that fail together (capitals and marks, kinds of repetition) are one rule: the
    model takes rules for independent given the document's quality.
    """
    n = c["n_words"]
    chars = c["word_chars"]
    shouts = (100 * c["n_upper"] > 30 * chars) | (100 * c["n_marks"] > 30 * n)
    calm = (100 * c["n_upper"] <= 12 * chars) & (100 * c["n_marks"] <= 10 * n)
    repeats = (
        (100 * c["n_dup_lines"] > 40 * c["n_lines"]) | (100 * c["n_repeat_words"] > 40 * n) | (100 * c["n_distinct"] < 10 * n)
    )
    varied = (c["n_dup_lines"] == 0) & (100 * c["n_repeat_words"] <= 8 * n) & (100 * c["n_distinct"] >= 25 * n)
    return [
        ("length", n < 20, n >= 60),
        ("word length", (chars > 14 * n) | (chars < 2 * n), (chars <= 10 * n) & (chars >= 3 * n)),
        ("symbols", 100 * c["n_symbols"] > 15 * n, 100 * c["n_symbols"] <= 5 * n),
        ("shouting", shouts, calm),
        ("repetition", repeats, varied),
        ("ending", F.lit(False), c["ends_well"]),
    ]


N_RULES = 6


def vote_pattern(c: Column) -> Column:
    """The votes as one number in base 3; at most 3^rules values."""
    code = F.lit(0)
    for _, against, support in rule_votes(c):
        code = code * 3 + F.when(against, 0).when(support, 2).otherwise(1)
    return code.cast("int")


def base_failed(c: Column) -> Column:
    return (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def pattern_posteriors(patterns: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``(pattern, n)`` to ``(pattern, posterior, prior, accuracies)``.

    A rule has two accuracies, the share of its votes that are right on good and on bad documents
    (Dawid and Skene's model with abstentions left out), since a rule for one kind of junk says little when it
    is content and much when it is not. The start takes documents that any rule votes against for bad. At most 3^rules rows, hence one array in
    one row.
    """
    votes = F.transform(
        F.sequence(F.lit(N_RULES - 1), F.lit(0), F.lit(-1)),
        lambda j: F.floor(F.col("pattern") / F.pow(F.lit(3), j)).cast("int") % 3 - 1,
    )
    table = patterns.select(F.struct("pattern", F.col("n").cast("double").alias("n"), votes.alias("v")).alias("p"))
    one = table.agg(F.sort_array(F.collect_list("p")).alias("ps"))

    def posterior(state: Column, p: Column) -> Column:
        def evidence(v: Column, a: Column) -> Column:
            return (
                F.when(v == 1, F.ln(a["good"] / (1 - a["bad"]))).when(v == -1, F.ln((1 - a["good"]) / a["bad"])).otherwise(0.0)
            )

        odds = F.aggregate(
            F.zip_with(p["v"], state["acc"], evidence), F.ln(state["prior"] / (1 - state["prior"])), lambda acc, x: acc + x
        )
        return 1 / (1 + F.exp(-odds))

    def total(rows: Column, value) -> Column:
        return F.aggregate(rows, F.lit(0.0), lambda acc, r: acc + value(r))

    def bounded(x: Column, bounds: tuple[float, float]) -> Column:
        return F.least(F.lit(bounds[1]), F.greatest(F.lit(bounds[0]), x))

    def estimates(rows: Column) -> Column:
        everything = total(rows, lambda r: r["n"])

        def fitted_to(belief: Column) -> Column:
            def right(j: Column, vote: int, expected: float, mass) -> Column:
                cast = total(rows, lambda r: F.when(F.get(r["v"], j) != 0, mass(r)).otherwise(0.0))
                hits = total(rows, lambda r: F.when(F.get(r["v"], j) == vote, mass(r)).otherwise(0.0))
                return (hits + expected * belief) / (cast + belief)

            def accuracy(j: Column) -> Column:
                return F.struct(
                    bounded(right(j, 1, EXPECTED_ON_GOOD, lambda r: r["n"] * r["q"]), ON_GOOD).alias("good"),
                    bounded(right(j, -1, EXPECTED_ON_BAD, lambda r: r["n"] * (1 - r["q"])), ON_BAD).alias("bad"),
                )

            good = total(rows, lambda r: r["n"] * r["q"])
            return F.struct(
                bounded(good / (everything + 1), GOOD_SHARE).alias("prior"),
                F.transform(F.sequence(F.lit(0), F.lit(N_RULES - 1)), accuracy).alias("acc"),
            )

        return let(everything * BELIEF + 1, fitted_to)

    def judged(ps: Column, q) -> Column:
        return F.transform(ps, lambda p: F.struct(p["n"].alias("n"), p["v"].alias("v"), q(p).alias("q")))

    def fit(ps: Column) -> Column:
        start = judged(ps, lambda p: F.when(F.array_contains(p["v"], F.lit(-1)), 1 - START).otherwise(START))
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(rounds)),
            let(start, estimates),
            lambda s, _: let(judged(ps, lambda p: posterior(s, p)), estimates),
        )

    fitted = one.select("ps", let(F.col("ps"), fit).alias("m"))
    rows = fitted.select(F.explode("ps").alias("p"), "m")
    return rows.select(
        F.col("p.pattern").alias("pattern"),
        posterior(F.col("m"), F.col("p")).alias("posterior"),
        F.col("m.prior").alias("prior"),
        F.col("m.acc").alias("accuracies"),
    )


def _patterns(measured: DataFrame, counts: str) -> DataFrame:
    """Patterns of the documents that the base rule leaves to the model."""
    return measured.filter(~base_failed(F.col(counts))).groupBy(vote_pattern(F.col(counts)).alias("pattern")).agg(F.count(F.lit(1)).alias("n"))


def pattern_of(text: Column) -> Column:
    """The vote pattern of a text, -1 where the base rule rejects it. Texts are measured once however often the counts are used."""
    pattern = let(quality_counts(text), lambda c: F.when(base_failed(c), -1).otherwise(vote_pattern(c)))
    # Never null: Spark adds no test for null keys, which would measure the text again below a join.
    return F.coalesce(pattern, F.lit(-1))


def judge_quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, counts, base_failed, posterior, kept. Texts are read once."""
    measured = store(docs.select(F.col(doc_id).alias("doc_id"), quality_counts(F.col(text)).alias("c")), "quality")
    model = store(pattern_posteriors(_patterns(measured, "c")), "quality-model")
    # At most 3^rules rows, which bounds the broadcast.
    joined = measured.withColumn("pattern", vote_pattern(F.col("c"))).join(
        F.broadcast(model.select("pattern", "posterior")), "pattern", "left"
    )
    failed = base_failed(F.col("c"))
    return joined.select(
        "doc_id",
        *[F.col(f"c.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"),
        (~failed & (F.col("posterior") >= KEEP_FROM)).alias("kept"),
        "posterior",
    )


def filter_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they were.

    Texts are measured twice, once for the pattern counts and once for the decision: that costs less
    than a shuffle of the texts, and needs no unique id.
    """
    # Stored before it is filtered: a filter on the pattern would be moved to the texts and measure them twice.
    counted = store(docs.select(pattern_of(F.col(text)).alias("pattern")).groupBy("pattern").agg(F.count(F.lit(1)).alias("n")), "quality-patterns")
    model = store(pattern_posteriors(counted.filter("pattern >= 0")), "quality-model")
    inner = docs.select(F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("_row"), pattern_of(F.col(text)).alias("_own"))
    good = model.filter(F.col("posterior") >= KEEP_FROM).select(F.col("pattern").alias("_pattern"))
    # At most 3^rules rows, which bounds the broadcast.
    return inner.join(F.broadcast(good), F.col("_own") == F.col("_pattern"), "left_semi").select("_row.*")
