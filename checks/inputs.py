"""Views that give the driver's tables the shapes of profile data (FIXTURES.md).

Nothing is left out of a table: every row is derived, and nulls come from the row's own
numbers. ``oracle.py`` states the same rules in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.config import ProfileSchema
from kinfold.functions.normalize import email_domain
from kinfold.operators.skew import shuffle_width

FIRST_NAMES = ["Анна", "Пётр", "Мария", "Иван", "Ольга", "Anna Maria", "И.", "Oleg", "Сергей", "Нина"]
LAST_NAMES = ["Орлов", "Smith", "Белов", "Жук", "Lee", "Зимин", "Котов"]
DOMAINS = ["gmail.com", "mail.ru", "yandex.ru", "bk.ru"]
BROWSERS = ["chrome", "safari", "firefox", "opera"]
DEVICES = ["pc", "tablet", "phone"]
SYSTEMS = ["android", "ios", "windows"]
REGIONS = ["MOW", "SPE", "TA", "CHE", "SVE"]
MESSY_EMAILS = [
    "' User.' || u || '@Gmail.com '",
    "'user.' || u || '@gmail.ru'",
    "'a.b' || u || '@gmai.com'",
    "'x' || u || '@bk.ru'",
    "'x' || u || '@list.ru'",
    "'y.y' || u || '@ya.ru'",
    "'z' || u || '@YANDEX.COM'",
    "'no-at-' || u",
    "'two@at@' || u || '.ru'",
    "'@mail.ru'",
    "'login@'",
    "repeat('l', 65) || '@mail.ru'",
    "'d@' || repeat('d', 256) || '.ru'",
    "'sp ace' || u || '@mail.ru'",
    "'ok' || u || '@other.org'",
    "'   '",
    "''",
    "cast(null as varchar(300))",
    "'q' || u || '@qmail.com'",
]
MESSY_PHONES = [
    "'8 (9' || lpad(cast(u % 100 as varchar(9)), 2, '0') || ') 123-45-67'",
    "'+7 9' || lpad(cast(u % 100 as varchar(9)), 2, '0') || ' 765 43 21'",
    "'79' || lpad(cast(u as varchar(9)), 9, '0')",
    "'123'",
    "'+8 900 000 00 00'",
    "'  '",
    "cast(null as varchar(300))",
    "'76' || lpad(cast(u as varchar(9)), 5, '0')",
    "'7+9001234567'",
    "'89' || lpad(cast(u as varchar(9)), 9, '0')",
    "'8-800'",
]
MESSY_NAMES = [
    "'  АННА   Мария '",
    "'Иван'",
    "''",
    "'  '",
    "cast(null as varchar(300))",
    "'o''Neil  Jr'",
    "'nan'",
    "'ЖАН-ПОЛЬ ' || u",
]

SCHEMA = ProfileSchema(rt_nested=(("place", ("city", "zone")),))
#: Document pairs are all pairs of different word sets from this similarity on.
DOC_SIMILAR_FROM = 0.3


#: An ensemble made by rule (F-G): every number is a multiple of a power of two, so sums are exact on both engines.
RULE_TREES = 24
RULE_DEPTH = 3
TREE_RULES = {
    "weight": "case when tree = 0 then 1.0D else 0.125D end",
    "feature": "(tree * 5 + node * 3) % {n}",
    "threshold": "((tree + node) % 4 - 1) / 2.0D",
    "prediction": "((tree * 13 + node * 7) % 33 - 16) / 32.0D",
}


def pick(values: list[str], index: str) -> str:
    """SQL that selects one of several texts by number."""
    arms = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"case {index} {arms} end"


def pick_sql(values: list[str], index: str) -> str:
    arms = " ".join(f"when {i} then {v}" for i, v in enumerate(values))
    return f"case {index} {arms} end"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# SQL that both engines read alike. u, g, d, e, k, ts are columns.
RAW_RULES = {
    "event_id": "e",
    "created_at": "case when e % 97 = 0 then null else ts end",
    "first_name": f"case when e % 5 < 3 then null else {pick(FIRST_NAMES, 'g % 10')} end",
    "last_name": f"case when u % 40 = 0 then {pick(LAST_NAMES, 'g % 7')} end",
    "email": f"case when e % 50 = 0 then null else 'u' || u || '@' || {pick(DOMAINS, 'd')} end",
    "phone": "case when g % 12 = 0 then '79' || lpad(cast(g * 7919 as varchar(12)), 9, '0') end",
    "sex": "case when e % 7 = 0 then 'unknown' when g % 2 = 0 then 'female' else 'male' end",
    "non_processing_features": (
        f"'[''browser:' || {pick(BROWSERS, 'k % 4')} || ''' ''device:' || {pick(DEVICES, 'k % 3')} || ''''"
        " || case when e % 11 = 0 then ' \"browser:second:choice\"' else '' end"
        f" || ' ''subdivision_1_iso_code:' || {pick(REGIONS, 'g % 5')} || ''''"
        " || ' ''geoname_id:' || (g % 50) || ''''"
        f" || ' ''osfamily:' || {pick(SYSTEMS, 'u % 3')} || ''']'"
    ),
    "realtime_features": (
        "case when e % 211 = 0 then '{broken' when e % 223 = 0 then '' when e % 227 = 0 then '[1,2]' else "
        "'{\"country\": \"RU\", \"is_million\": ' || case when g % 2 = 0 then 'true' else 'false' end"
        " || ', \"tz_offset\": ' || (g % 9 + 2) || ', \"geoname\": \"City' || (g % 6) || '\"'"
        " || case when k % 4 = 0 then '' else ', \"city\": \"Town' || (g % 6) || '\"' end"
        " || ', \"geoid\": ' || (g % 6) || ', \"local_hour\": ' || hour(ts) || ', \"day\": ' || (u % 7)"
        " || ', \"population\": ' || (g % 6 * 1000 + 500)"
        " || ', \"place\": {\"city\": \"P' || (g % 4) || '\", \"zone\": ' || (k % 3) || '}'"
        " || case when e % 13 = 0 then ', \"geoid\": ' || (g % 6) else '' end || '}' end"
    ),
    "fs_features": (
        "case when e % 229 = 0 then null when e % 233 = 0 then '[]' else "
        "'[''visited_365:' || (g * 7 + k % 5) || ''' ''has_account:' || u || ''' ''visited_30:n' || k || ''''"
        " || case when e % 6 = 0 then ' ''visited_365:' || (g * 7 + 5) || '''' else '' end"
        " || case when e % 17 = 0 then ' ''source_site_30''' else '' end"
        " || case when e % 23 = 0 then ' ''has_click_30'' ''has_click_30''' else '' end"
        " || case when d = 0 then ' ''is_gmail''' else '' end"
        " || case when g % 2 = 0 then ' ''is_woman''' else ' ''is_man''' end"
        " || case when k % 3 = 0 then ' ''postman_response_90:ok''' when k % 3 = 1 then ' ''postman_response_90:err''' else '' end"
        " || ']' end"
    ),
    "profile_id": "'p_' || lpad(cast(u as varchar(12)), 6, '0')",
    "entity_id": "'e_' || lpad(cast(g as varchar(12)), 6, '0')",
}
CONTACT_RULES = {
    "event_id": "e",
    "messy_email": pick_sql(MESSY_EMAILS, f"e % {len(MESSY_EMAILS)}"),
    "messy_phone": pick_sql(MESSY_PHONES, f"e % {len(MESSY_PHONES)}"),
    "messy_name": pick_sql(MESSY_NAMES, f"e % {len(MESSY_NAMES)}"),
}


def _numbered(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    # Parsing costs much per byte, and a file may have one row group: the narrow rows are dealt out before anything is made of them.
    dealt = table(spark, sf, "events").select("event_id", "ts", "user_id", "props")
    dealt = dealt.repartition(shuffle_width(dealt), "event_id", "ts", "user_id")
    base = dealt.select(
        F.col("event_id").alias("e"), "ts", F.col("user_id").alias("u"), F.expr("user_id div 3").alias("g"), k.alias("k")
    )
    return base.withColumn("d", F.expr("(g + case when u % 3 = 2 then 1 else 0 end) % 4"))


def raw_events(spark: SparkSession, sf: str) -> DataFrame:
    """F-A: three profiles per entity, one of them with another e-mail provider."""
    rules = [f"{rule} as {name}" for name, rule in RAW_RULES.items()]
    birthday = (
        "case when u % 20 = 0 then date_add(date'1970-01-01', "
        "case when g % 30 = 0 then 0 else cast(g * 17 % 9000 as int) end) end as birthday"
    )
    return _numbered(spark, sf).selectExpr(*rules, birthday)


def messy_contacts(spark: SparkSession, sf: str) -> DataFrame:
    """F-E: an e-mail, a phone and a name of every kind the normalisers tell apart."""
    return _numbered(spark, sf).selectExpr(*[f"{rule} as {name}" for name, rule in CONTACT_RULES.items()])


def records(spark: SparkSession, sf: str) -> DataFrame:
    """Events as records of their own, for the per-record strategies."""
    raw = raw_events(spark, sf)
    return raw.select(
        "*",
        F.concat(F.lit("r_"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("record_id"),
        email_domain(F.col("email")).alias("email_domain"),
        F.date_format("created_at", "yyyy-MM-dd").alias("date"),
        F.hour("created_at").alias("hour"),
        F.weekday("created_at").alias("day_of_week"),
    )


def doc_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """F-B: documents as profiles; equal texts are one entity."""
    return table(spark, sf, "documents").select(
        F.concat(F.lit("d_"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("profile_id"),
        F.md5("text").alias("entity_id"),
        F.col("source").alias("email_domain"),
        F.col("lang").alias("sex"),
        "n_chars",
        "text",
    )


def doc_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """F-B: distinct lower-case words of the whole text as the site set."""
    words = F.explode(F.array_distinct(F.split(F.lower("text"), r"\s+")))
    return (
        doc_profiles(spark, sf)
        .select("profile_id", F.lit("fs_visited_365").alias("set_col"), words.alias("token"))
        .filter("token <> ''")
    )


def scored_labels(spark: SparkSession, sf: str) -> DataFrame:
    """F-D: labelled documents with an exact decimal score."""
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return table(spark, sf, "labels").join(docs, "doc_id").select(
        "doc_id", ((F.col("n_chars") % 1000) / F.lit(1000.0)).alias("score"), F.col("quality").alias("y")
    )


def decision_log(spark: SparkSession, sf: str) -> DataFrame:
    """F-F: events as decisions of the scoring service."""
    return log_of(table(spark, sf, "events"))


def log_of(events: DataFrame) -> DataFrame:
    prob = F.get_json_object("props", "$.k").cast("bigint") / F.lit(99.0)
    return events.select(
        "event_id",
        "ts",
        F.when(F.col("user_id") % 10 == 0, "staging").otherwise("production").alias("stage"),
        F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("status"),
        (F.col("value") / F.lit(1000.0)).alias("latency_s"),
        prob.alias("prob_match"),
        F.when(prob >= 0.9, "AUTO_MERGE").when(prob >= 0.6, "REVIEW").otherwise("KEEP_SEPARATE").alias("action"),
    )


def rule_trees(spark: SparkSession, n_features: int) -> DataFrame:
    """F-G: complete trees of ``RULE_DEPTH`` in the shape of a stored node table."""
    inner = 2**RULE_DEPTH - 1
    nodes = spark.range(RULE_TREES).selectExpr("cast(id as int) as tree", f"explode(sequence(0, {2 * inner})) as node")
    rules = [f"{rule.format(n=n_features)} as {name}" for name, rule in TREE_RULES.items()]
    return nodes.selectExpr(
        "tree", "node", *rules, f"case when node < {inner} then 2 * node + 1 else -1 end as left",
        f"case when node < {inner} then 2 * node + 2 else -1 end as right",
    )
