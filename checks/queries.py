"""Registered queries: one Spark job per operator, next to its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold import config
from kinfold.functions import normalize as n
from kinfold.functions import parsing, similarity
from kinfold.operators import (
    blocking,
    collapse,
    components,
    evaluate,
    model,
    profiling,
    review,
    setjoin,
)
from kinfold.operators.refine import PUBLISHED
from kinfold.operators.flatten import discover_keys, flatten, realtime_place
from kinfold.plans import inference
from kinfold.session import store
from kinfold.sources import events as io

from . import inputs as I
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_STORED: dict[tuple, object] = {}


def query(sql: str | None = None, *needs: str):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = O.sql(sql, *needs)
        return fn

    return register


def stored(name: str, spark: SparkSession, sf: str, make: Callable[[], object]):
    """Tables that many queries read are written once per session and scale."""
    key = (name, spark.sparkContext.applicationId, sf)
    if key not in _STORED:
        _STORED[key] = make()
    return _STORED[key]


def forget() -> None:
    _STORED.clear()


def text_time(col: str) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def r6(col) -> Column:
    return F.round(col, 6)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: r6(F.col(c)) for c in cols})


def raw(spark, sf):
    return I.raw_events(spark, sf)


def flat(spark, sf):
    return flatten(raw(spark, sf), I.SCHEMA).withColumn("email_domain", n.email_domain(F.col("email")))


def people(spark, sf) -> inference.Profiles:
    return stored("people", spark, sf, lambda: inference.preprocess(raw(spark, sf), store=True))


def fa_pairs(spark, sf):
    return stored("pairs", spark, sf, lambda: store(inference.candidates(people(spark, sf), PUBLISHED), "pairs"))


def fa_scored(spark, sf):
    def make():
        return store(inference.score_pairs(fa_pairs(spark, sf), people(spark, sf), model.rule_score, 0.8, 0.6), "scored")

    return stored("scored", spark, sf, make)


def fa_clusters(spark, sf):
    def make():
        edges = components.accepted_edges(fa_scored(spark, sf))
        return store(components.connected_components(edges, people(spark, sf).rows), "clusters")

    return stored("clusters", spark, sf, make)


def doc_tokens(spark, sf):
    return stored("doc_tokens", spark, sf, lambda: store(I.doc_tokens(spark, sf), "doc_tokens"))


def doc_sets(spark, sf) -> tuple[DataFrame, DataFrame]:
    """F-B: classes of equal word sets, and all pairs of classes from ``DOC_SIMILAR_FROM`` on."""

    def make():
        classes, pairs = setjoin.similar_sets(doc_tokens(spark, sf), I.DOC_SIMILAR_FROM)
        # One cell may find most of the pairs, and its file must not be the work of one task.
        return classes, store(pairs, "doc_pairs", row_group=1 << 20)

    return stored("doc_sets", spark, sf, make)


def doc_pairs(spark, sf):
    """F-B pairs between the first documents of classes, with the Jaccard similarity of all their words."""
    return doc_sets(spark, sf)[1]


def doc_members(spark, sf):
    """``(profile_id, class_id)`` of all documents; one without words is alone."""
    every = I.doc_profiles(spark, sf).select("profile_id").distinct()
    found = doc_sets(spark, sf)[0].select("profile_id", "class_id")
    return every.join(found, "profile_id", "left").select("profile_id", F.coalesce("class_id", "profile_id").alias("class_id"))


def doc_ids(spark, sf):
    """First documents of all classes, paired or not."""
    return doc_members(spark, sf).select(F.col("class_id").alias("profile_id")).distinct()


def all_documents(spark, sf, clusters, *by):
    """Clusters of first documents to clusters of all documents."""
    found = clusters.select(*by, F.col("profile_id").alias("class_id"), "cluster_id")
    # A class may have very many documents.
    members = doc_members(spark, sf)
    return members.join(found, "class_id").select(*by, "profile_id", "cluster_id")


def doc_clusters(spark, sf):
    def make():
        edges = doc_pairs(spark, sf).filter("similarity >= 0.6").select("profile_id_1", "profile_id_2")
        return store(all_documents(spark, sf, components.connected_components(edges, doc_ids(spark, sf))), "doc_clusters")

    return stored("doc_clusters", spark, sf, make)


def level_clusters(spark, sf):
    """Components of the document pairs at several thresholds."""

    def make():
        levels = F.explode(F.array(*[F.lit(t) for t in O.SWEEP])).alias("t")
        node = lambda c: F.struct("t", F.col(c).alias("id"))
        edges = doc_pairs(spark, sf).select("*", levels).filter("similarity >= t")
        edges = edges.select(node("profile_id_1").alias("a"), node("profile_id_2").alias("b"))
        nodes = doc_ids(spark, sf).select("*", levels).select(node("profile_id").alias("profile_id"))
        found = components.connected_components(edges, nodes)
        plain = found.select(
            F.col("profile_id.t").alias("threshold"),
            F.col("profile_id.id").alias("profile_id"),
            F.col("cluster_id.id").alias("cluster_id"),
        )
        return store(all_documents(spark, sf, plain, "threshold"), "level_clusters")

    return stored("level_clusters", spark, sf, make)


def sweep(spark, sf):
    return stored("sweep", spark, sf, lambda: store(review.threshold_sweep(level_clusters(spark, sf), doc_pairs(spark, sf)), "sweep"))


def fd_curve(spark, sf):
    return evaluate.pr_curve(I.scored_labels(spark, sf))


# -- sources and sinks -------------------------------------------------------------------


@query(
    f"""select event_id, {O.ts('created_at')} as created_at, first_name, email, birthday::varchar as birthday,
    non_processing_features, case when realtime_features = '' then null else realtime_features end as realtime_features,
    fs_features, profile_id from raw""",
    "raw",
)
def csv_round_trip(spark, sf):
    """Events written as csv and read with the declared schema."""
    return _round_trip(spark, sf, "csv")


@query(ORACLES["csv_round_trip"])
def tsv_round_trip(spark, sf):
    """Events written as tsv and read with the declared schema."""
    return _round_trip(spark, sf, "tsv")


def _round_trip(spark, sf, fmt):
    path = io_path(spark, fmt)
    columns = [*io.EVENT_COLUMNS, "event_id"]
    io.write_events(raw(spark, sf).select(*columns), path, fmt)
    back = io.read_events(spark, path, fmt, io.event_schema(("event_id",)))
    return back.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        text_time("created_at").alias("created_at"),
        "first_name",
        "email",
        F.col("birthday").cast("string").alias("birthday"),
        "non_processing_features",
        "realtime_features",
        "fs_features",
        "profile_id",
    )


def io_path(spark, name):
    from kinfold.session import scratch_path

    return scratch_path(spark, name)


@query(
    "select profile_id, entity_id, event_id, email from raw", "raw"
)
def parquet_round_trip(spark, sf):
    """Events written and read as parquet."""
    path = io_path(spark, "parquet")
    io.write_events(raw(spark, sf), path)
    return io.read_events(spark, path, "parquet").select("profile_id", "entity_id", "event_id", "email")


@query("select profile_id_1, profile_id_2, prob_match, action from scored", "scored")
def pairs_csv(spark, sf):
    """Scored pairs written best first."""
    path = io_path(spark, "pairs-csv")
    io.write_pairs(fa_scored(spark, sf), path)
    return spark.read.schema("profile_id_1 string, profile_id_2 string, prob_match double, action string").csv(
        path, header=True
    )


@query("select profile_id, cluster_id from clusters", "clusters")
def clusters_csv(spark, sf):
    """Cluster map written as csv."""
    path = io_path(spark, "clusters-csv")
    io.write_clusters(fa_clusters(spark, sf), path)
    return spark.read.schema("profile_id string, cluster_id string").csv(path, header=True)


@query(
    """select coalesce(strftime(date_trunc('week', created_at), '%Y-%m-%d'), 'unknown') as week,
    count(*) as n_rows, count(distinct profile_id) as n_profiles from raw group by 1""",
    "raw",
)
def weekly_snapshot(spark, sf):
    """Events by week; one week is written a second time and replaces only itself."""
    path = io_path(spark, "weekly")
    rows = raw(spark, sf).select("created_at", "profile_id")
    io.write_weekly_snapshot(rows, path)
    io.write_weekly_snapshot(rows.filter(io.week_of(F.col("created_at")) == "2024-01-08"), path)
    back = spark.read.schema("created_at timestamp_ntz, profile_id string, week string").parquet(path)
    return back.groupBy("week").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("profile_id").alias("n_profiles")
    )


@query("select ts::date::varchar as day, action, count(*) as n from log group by 1, 2", "log")
def decision_log_append(spark, sf):
    """Decisions appended by day, in two runs."""
    path = io_path(spark, "decisions")
    log = I.decision_log(spark, sf)
    for part in (F.col("stage") == "staging", F.col("stage") == "production"):
        io.append_decisions(log.filter(part), path)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("day").cast("string").alias("day"), "action").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""select auto_merge, review, pr_auc from (select coalesce(min(score) filter (where precision >= 0.99), 0.99) as auto_merge,
    round(sum(n_pos / positives::double * precision), 6) as pr_auc from curve),
    (select arg_max(score, {{'f': 2 * precision * recall / (precision + recall + 1e-12), 's': -score}}) as review from curve)""",
    "curve",
)
def thresholds_round_trip(spark, sf):
    """Threshold record saved as JSON and loaded."""
    path = io_path(spark, "thresholds")
    curve = fd_curve(spark, sf)
    io.save_thresholds(evaluate.calibrate(curve).join(F.broadcast(evaluate.average_precision(curve))), path)
    return rounded(io.load_thresholds(spark, path).select("auto_merge", "review", "pr_auc"), "pr_auc")


# -- parsing -----------------------------------------------------------------------------


@query(
    """select event_id, coalesce(string_agg(k || coalesce(':' || v, ''), '|' order by i), '') as tokens
    from raw left join fsl on e = event_id group by event_id""",
    "raw", "fsl",
)
def token_lists(spark, sf):
    """Tokens of the text form of an array."""
    tokens = parsing.token_list(F.col("fs_features"))
    return raw(spark, sf).select("event_id", F.array_join(tokens, "|").alias("tokens"))


@query(
    f"""select event_id, {O.first_of('browser')} as browser, {O.first_of('geoname_id')} as geoname_id
    from raw left join npl on e = event_id group by event_id""",
    "raw", "npl",
)
def first_values(spark, sf):
    """The first value of a key wins."""
    m = parsing.kv_first_map(F.col("entries"))
    rows = raw(spark, sf).select("event_id", parsing.kv_entries(F.col("non_processing_features")).alias("entries"))
    return rows.select("event_id", m["browser"].alias("browser"), m["geoname_id"].alias("geoname_id"))


@query(
    f"""select event_id, {O.joined_of('visited_365')} as visited_365, {O.joined_of('has_click_30')} as has_click_30,
    {O.joined_of('source_site_30')} as source_site_30 from raw left join fsl on e = event_id group by event_id""",
    "raw", "fsl",
)
def joined_values(spark, sf):
    """Values of a repeated key are joined; a repeated flag becomes text."""
    m = parsing.kv_joined_map(F.col("entries"))
    rows = raw(spark, sf).select("event_id", parsing.kv_entries(F.col("fs_features")).alias("entries"))
    return rows.select("event_id", *[m[k].alias(k) for k in ("visited_365", "has_click_30", "source_site_30")])


@query(f"select event_id, {O.comma(f'rt_{k}' for k in config.RT_KEYS)} from flat", "flat")
def json_fields(spark, sf):
    """Values of the JSON field; bad JSON gives nothing."""
    m = raw(spark, sf).select("event_id", parsing.json_map(F.col("realtime_features")).alias("m"))
    return m.select("event_id", *[F.col("m")[k].alias(f"rt_{k}") for k in config.RT_KEYS])


@query(
    f"""select event_id, {O.ts('created_at')} as created_at, profile_id, entity_id, email,
    {O.comma(f'np_{k}' for k in config.NP_KEYS)}, {O.comma(f'rt_{k}' for k in config.RT_KEYS)},
    {O.comma(f'fs_{k}' for k in O.FS_KEYS)} from flat""",
    "flat",
)
def flatten_events(spark, sf):
    """All flat columns."""
    cols = [f"np_{k}" for k in config.NP_KEYS] + [f"rt_{k}" for k in config.RT_KEYS] + [f"fs_{k}" for k in O.FS_KEYS]
    return flat(spark, sf).select("event_id", text_time("created_at").alias("created_at"), "profile_id", "entity_id", "email", *cols)


@query("select event_id, place_city, place_zone from flat", "flat")
def nested_json(spark, sf):
    """P5: keys of a nested object."""
    return flat(spark, sf).select(
        "event_id", F.col("`rt_place.city`").alias("place_city"), F.col("`rt_place.zone`").alias("place_zone")
    )


@query(
    "select event_id, rt_city as extracted_city, rt_country as extracted_country, rt_geoname as extracted_geoname from flat",
    "flat",
)
def realtime_places(spark, sf):
    """City, country and geoname."""
    return realtime_place(raw(spark, sf)).select("event_id", "extracted_city", "extracted_country", "extracted_geoname")


@query("select coalesce(np_geoname_id, 'unknown') as geoname, count(*) as n_rows from flat group by 1", "flat")
def geoname_ids(spark, sf):
    """Geoname id or unknown."""
    rows = raw(spark, sf).select(parsing.kv_entries(F.col("non_processing_features")).alias("entries"))
    return rows.groupBy(parsing.geoname_or_unknown(F.col("entries")).alias("geoname")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    """select 'np_' || k as column_name, count(distinct e) as n_rows from npl group by 1
    union all select 'fs_' || k, count(distinct e) from fsl group by 1
    union all select 'rt_' || k, count(distinct event_id) from (
      select event_id, unnest(json_keys(j)) as k from (
        select event_id, try_cast(realtime_features as json) as j from raw) where json_type(j) = 'OBJECT') group by 1""",
    "raw", "npl", "fsl",
)
def key_discovery(spark, sf):
    """The columns the data would give."""
    return discover_keys(raw(spark, sf))


# -- normalisation -----------------------------------------------------------------------

PHONE_KEPT = """case when starts_with(x, '8') then '+7' || substr(x, 2) else x end"""


@query(
    f"""select event_id, case when messy_phone is null or trim(messy_phone) = '' then null
      when starts_with(c, '+7') and length(c) = 12 then c
      when starts_with(c, '7') and length(c) = 11 then '+' || c else 'invalid_phone_format' end as normalized_phone
    from (select *, {PHONE_KEPT} as c from (
      select *, regexp_replace(messy_phone, '[^0-9+]', '', 'g') as x from contacts))""",
    "contacts",
)
def normalize_phone(spark, sf):
    """N1."""
    return I.messy_contacts(spark, sf).select("event_id", n.normalize_phone(F.col("messy_phone")).alias("normalized_phone"))


@query(
    """select event_id, case when messy_name is null or messy_name = '' then null
      else regexp_replace(lower(trim(messy_name)), '\\s+', ' ', 'g') end as normalized_name from contacts""",
    "contacts",
)
def normalize_name(spark, sf):
    """N2."""
    return I.messy_contacts(spark, sf).select("event_id", n.normalize_name(F.col("messy_name")).alias("normalized_name"))


def _map(col: str, table: dict[str, str]) -> str:
    arms = " ".join(f"when '{k}' then '{v}'" for k, v in table.items())
    return f"case {col} {arms} else {col} end"


EMAIL_CASES = f"""case when m is null or m = '' then null when strpos(m, '@') = 0 then '{n.EMAIL_NO_AT}'
  when len(string_split(m, '@')) <> 2 then '{n.EMAIL_MULTIPLE_AT}'
  when l = '' then '{n.EMAIL_EMPTY_LOGIN}' when dom = '' then '{n.EMAIL_EMPTY_DOMAIN}'
  when length(l) > 64 then '{n.EMAIL_LOGIN_TOO_LONG}' when length(dom) > 255 then '{n.EMAIL_DOMAIN_TOO_LONG}'
  when not regexp_matches(m, '{n.EMAIL_PATTERN}') then '{n.EMAIL_SPECIAL_CHARS}'
  else case when canon = 'gmail.com' then replace(l, '.', '') else l end || '@' || canon end"""


def email_sql(source: str, col: str, keep: str) -> str:
    return f"""select {keep}, {EMAIL_CASES} as normalized_email from (
      select *, {_map('fixed', n.DOMAIN_ALIASES)} as canon from (select *, {_map('dom', n.DOMAIN_TYPOS)} as fixed from (
        select *, split_part(m, '@', 1) as l, split_part(m, '@', 2) as dom from (
          select *, lower(trim({col})) as m from {source}))))"""


@query(email_sql("contacts", "messy_email", "event_id"), "contacts")
def normalize_email(spark, sf):
    """N3."""
    return I.messy_contacts(spark, sf).select("event_id", n.normalize_email(F.col("messy_email")).alias("normalized_email"))


def _changed(condition: str) -> str:
    return f"count(*) filter (where messy_email is distinct from normalized_email and {condition})"


@query(
    f"""select {_changed('true')} as n_changed, {_changed("contains(split_part(messy_email, '@', -1), 'gmail')")} as n_gmail,
    {_changed("split_part(messy_email, '@', -1) in ('mail.ru', 'bk.ru', 'list.ru', 'inbox.ru', 'xmail.ru')")} as n_mail_ru,
    {_changed("split_part(messy_email, '@', -1) in ('yandex.ru', 'ya.ru', 'yandex.com', 'yandex.by')")} as n_yandex
    from ({email_sql('contacts', 'messy_email', 'event_id, messy_email')})""",
    "contacts",
)
def email_changes(spark, sf):
    """Addresses changed by normalisation."""
    rows = I.messy_contacts(spark, sf).select(F.col("messy_email").alias("email"))
    return profiling.email_changes(rows.withColumn("normalized_email", n.normalize_email(F.col("email"))))


@query(
    """select event_id, split_part(messy_email, '@', -1) as email_domain,
    coalesce(lower(split_part(messy_email, '@', -1)), '') as domain_or_empty from contacts""",
    "contacts",
)
def email_domains(spark, sf):
    """N5, N6."""
    c = F.col("messy_email")
    return I.messy_contacts(spark, sf).select(
        "event_id", n.email_domain(c).alias("email_domain"), n.email_domain_or_empty(c).alias("domain_or_empty")
    )


@query(
    """select event_id, first_name || ' ' || last_name as full_name, trim(concat_ws(' ', first_name, last_name)) as shown,
    trim(coalesce(first_name, 'None') || ' ' || coalesce(last_name, 'None')) as shown_with_null from raw""",
    "raw",
)
def full_names(spark, sf):
    """N7, N8."""
    a, b = F.col("first_name"), F.col("last_name")
    return raw(spark, sf).select(
        "event_id",
        n.full_name(a, b).alias("full_name"),
        n.display_name(a, b).alias("shown"),
        n.display_name(a, b, "None").alias("shown_with_null"),
    )


@query(
    """select count(*) filter (where contains(first_name, ' ')) as full_name,
    count(*) filter (where regexp_matches(first_name, '^[А-ЯA-Z]\\.$')) as initials,
    count(*) filter (where regexp_matches(first_name, '[a-zA-Z]')) as translit,
    count(*) filter (where regexp_matches(first_name, '[а-яА-Я]')) as cyrillic from raw""",
    "raw",
)
def name_patterns(spark, sf):
    """N9."""
    return profiling.name_patterns(raw(spark, sf))


@query(
    """select case when regexp_matches(p, '^7\\d{10}$') then '11_digits_7' when regexp_matches(p, '^8\\d{10}$') then '11_digits_8'
      when regexp_matches(p, '^\\d{7}$') then '7_digits_local' else 'other' end as phone_format, count(*) as n_rows
    from (select regexp_replace(coalesce(messy_phone, ''), '\\D', '', 'g') as p from contacts) group by 1""",
    "contacts",
)
def phone_formats(spark, sf):
    """N10."""
    return profiling.phone_formats(I.messy_contacts(spark, sf), "messy_phone")


@query("select event_id, substr(phone, 1, 2) as country_code, substr(phone, 3, 3) as operator_code from raw", "raw")
def phone_codes(spark, sf):
    """N11."""
    c = F.col("phone")
    return raw(spark, sf).select("event_id", n.phone_country(c).alias("country_code"), n.phone_operator(c).alias("operator_code"))


NAME_KEY = """case when {l} is null or lower({l}) = 'nan' or trim({l}) = '' then 'UNK' else upper(substr({l}, 1, 3)) end
  || '_' || case when {f} is null or lower({f}) = 'nan' or trim({f}) = '' then 'XX' else upper(substr({f}, 1, 2)) end"""


@query(
    f"select event_id, {NAME_KEY.format(f='messy_name', l='messy_email')} as block_key from contacts", "contacts"
)
def name_block_keys(spark, sf):
    """N12."""
    return I.messy_contacts(spark, sf).select(
        "event_id", n.name_block_key(F.col("messy_name"), F.col("messy_email")).alias("block_key")
    )


@query("select event_id, first_name, last_name from raw where first_name is not null or last_name is not null", "raw")
def named_rows(spark, sf):
    """N13."""
    return raw(spark, sf).filter(n.has_name(F.col("first_name"), F.col("last_name"))).select("event_id", "first_name", "last_name")


@query(
    """select event_id, strftime(created_at, '%Y-%m-%d') as date, hour(created_at) as hour,
    isodow(created_at) - 1 as day_of_week, strftime(birthday, '%d.%m') = '01.01' as placeholder from raw""",
    "raw",
)
def date_parts(spark, sf):
    """N14, N15."""
    t = F.col("created_at")
    return raw(spark, sf).select(
        "event_id",
        F.to_date(t).cast("string").alias("date"),
        F.hour(t).alias("hour"),
        n.day_of_week(t).alias("day_of_week"),
        n.is_new_year_birthday(F.col("birthday")).alias("placeholder"),
    )


@query(
    """select event_id, try_cast(props as double) as bad_number, try_cast(json_extract_string(props, '$.k') as double) as number,
    try_cast(event_type as timestamp)::varchar as bad_time, strftime(ts, '%Y-%m-%d %H:%M:%S') as time from events"""
)
def coercions(spark, sf):
    """Bad numbers and times become null."""
    rows = I.table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return rows.select(
        "event_id",
        n.to_number(F.col("props")).alias("bad_number"),
        n.to_number(k).alias("number"),
        n.to_timestamp(F.col("event_type")).cast("string").alias("bad_time"),
        F.date_format(n.to_timestamp(text), "yyyy-MM-dd HH:mm:ss").alias("time"),
    )


# -- collapse ----------------------------------------------------------------------------


@query(
    f"""select profile_id, {O.ts('created_at')} as created_at, birthday::varchar as birthday, email_domain,
    {O.comma(c for c in config.DEFAULT_SCHEMA.scalars if c != 'birthday')}, entity_id from prof""",
    "prof",
)
def collapse_profiles(spark, sf):
    """The last known value of every column."""
    rows = collapse.last_known(flat(spark, sf), [*config.DEFAULT_SCHEMA.scalars, "entity_id"], "created_at", "event_id")
    return rows.select(
        "profile_id",
        text_time("created_at").alias("created_at"),
        F.col("birthday").cast("string").alias("birthday"),
        n.email_domain(F.col("email")).alias("email_domain"),
        *[c for c in config.DEFAULT_SCHEMA.scalars if c != "birthday"],
        "entity_id",
    )


@query(
    f"""select profile_id, {O.comma(f"string_agg(token, ',' order by token) filter (where set_col = '{c}') as {c}" for c in O.SETS)}
    from tokens group by profile_id""",
    "tokens",
)
def collapse_sets(spark, sf):
    """Union of the site tokens of all events."""
    sets = collapse.inline_sets(collapse.site_tokens(flat(spark, sf)))
    return sets.select("profile_id", *[F.array_join(c, ",").alias(c) for c in O.SETS])


@query("select profile_id, count(*) as n_rows from prof group by 1 having count(*) > 1", "prof")
def repeated_profiles(spark, sf):
    """Empty for a sound profile table."""
    return collapse.repeated_ids(people(spark, sf).rows)


# -- profiling ---------------------------------------------------------------------------

PROFILED = ("created_at", "first_name", "last_name", "email", "phone", "birthday", "sex", "profile_id", "entity_id")


@query(
    " union all ".join(
        f"""select '{c}' as column_name, count(*) as n_rows, count({c}) as n_known, count(*) - count({c}) as n_null,
        round((count(*) - count({c})) / count(*)::double, 6) as null_share from raw"""
        for c in PROFILED
    ),
    "raw",
)
def null_profile(spark, sf):
    """A1, A2."""
    return rounded(profiling.null_profile(raw(spark, sf), PROFILED).drop("data_type"), "null_share")


@query("select count(*) as n_rows, 9 as n_columns from raw", "raw")
def table_shape(spark, sf):
    """A1."""
    return profiling.table_shape(raw(spark, sf).select(*PROFILED))


MISSING_SQL = f"""select *, {' and '.join(f'missing_{c} = profile_count' for c in profiling.FLAG_PII)} as all_missing,
  not ({' and '.join(f'missing_{c} = profile_count' for c in profiling.FLAG_PII)})
  and ({' or '.join(f'missing_{c} > 0' for c in profiling.FLAG_PII)}) as partial_missing from (
  select entity_id, {O.comma(f'count(*) filter (where {c} is null) as missing_{c}' for c in profiling.PII)},
  count(*) as profile_count from raw group by 1)"""


@query(MISSING_SQL, "raw")
def entity_missing(spark, sf):
    """A3."""
    return profiling.entity_missing(raw(spark, sf))


@query(
    f"""select count(*) as n_entities, count(*) filter (where all_missing) as n_all_missing,
    count(*) filter (where partial_missing) as n_partial_missing from ({MISSING_SQL})""",
    "raw",
)
def missing_summary(spark, sf):
    """A3."""
    return profiling.missing_summary(profiling.entity_missing(raw(spark, sf)))


NULL_COLS = ("first_name", "last_name", "phone", "birthday", "sex")


@query(
    " union all ".join(
        f"""select '{a}' as column_1, '{b}' as column_2, round(case when stddev_pop(({a} is null)::int) > 0
        and stddev_pop(({b} is null)::int) > 0 then corr(({a} is null)::int, ({b} is null)::int) end, 6) as corr from raw"""
        for a in NULL_COLS
        for b in NULL_COLS
    ),
    "raw",
)
def null_correlation(spark, sf):
    """A4."""
    return rounded(profiling.null_correlation(raw(spark, sf), NULL_COLS), "corr")


@query(
    """select (sum(c - 1))::bigint as n_duplicates from (select count(*) as c from raw
    group by profile_id, entity_id, first_name, last_name, email, phone, birthday, sex)""",
    "raw",
)
def duplicate_rows(spark, sf):
    """A5."""
    cols = ["profile_id", "entity_id", "first_name", "last_name", "email", "phone", "birthday", "sex"]
    return profiling.duplicate_rows(raw(spark, sf), cols)


@query("select count(distinct profile_id) as n_profile_id, count(distinct entity_id) as n_entity_id from raw", "raw")
def distinct_counts(spark, sf):
    """A6."""
    return profiling.distinct_counts(raw(spark, sf), ["profile_id", "entity_id"])


WEEK = "coalesce(strftime(date_trunc('week', created_at), '%Y-%m-%d'), 'unknown')"


@query(
    f"""select week, count(distinct profile_id) as n_exact, true as week_is_close, (select count(distinct profile_id) from raw) as n_exact_all,
    true as all_are_close from (select *, {WEEK} as week from raw) group by 1""",
    "raw",
)
def distinct_counts_by_week(spark, sf):
    """Sketches of the weekly snapshots, each week read on its own, and their union; close means within four standard errors."""
    path = io_path(spark, "weekly-profiles")
    io.write_weekly_snapshot(raw(spark, sf).select("created_at", "profile_id"), path)
    rows = spark.read.schema("created_at timestamp_ntz, profile_id string, week string").parquet(path)
    weeks = [r["week"] for r in rows.select("week").distinct().collect()]
    parts = None
    for week in weeks:
        one = profiling.distinct_sketches(io.read_week(spark, path, week), ["profile_id"]).withColumn("week", F.lit(week))
        parts = one if parts is None else parts.unionByName(one)
    kept = store(parts, "sketches")
    each = profiling.merged_distinct_counts(kept, ["profile_id"], ["week"])
    # Single rows.
    both = profiling.merged_distinct_counts(kept, ["profile_id"]).select(F.col("n_profile_id").alias("n_all"))
    exact_all = rows.agg(F.count_distinct("profile_id").alias("n_exact_all"))
    exact = rows.groupBy("week").agg(F.count_distinct("profile_id").alias("n_exact"))
    bound = 4 * 1.04 / 2 ** (profiling.SKETCH_BITS / 2)
    close = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.greatest(F.lit(1.0), F.col(b) * bound)
    return exact.join(each, "week").join(F.broadcast(exact_all)).join(F.broadcast(both)).select(
        "week", "n_exact", close("n_profile_id", "n_exact").alias("week_is_close"), "n_exact_all", close("n_all", "n_exact_all").alias("all_are_close")
    )


@query()
def distinct_counts_approx(spark, sf):
    """A6 with sketches."""
    return profiling.distinct_counts(raw(spark, sf), ["profile_id", "entity_id"], approximate=True)


@query(
    """select round(avg(c), 6) as mean, median(c) as median, max(c) as maximum, min(c) as minimum from (
    select count(distinct first_name || ' ' || last_name) as c from raw group by entity_id)""",
    "raw",
)
def names_per_entity(spark, sf):
    """A7."""
    return rounded(profiling.names_per_entity_stats(raw(spark, sf)), "mean")


@query(
    "select entity_id, email_domain, count(*) as n_rows from flat where email_domain is not null group by 1, 2", "flat"
)
def domains_per_entity(spark, sf):
    """A8."""
    return profiling.domains_per_entity(I.records(spark, sf))


@query(
    """select count(*) as n_entities_with_email, count(*) filter (where m > 1) as n_entities_same_domain from (
    select entity_id, max(c) as m from (select entity_id, email_domain, count(*) as c from flat
    where email_domain is not null group by 1, 2) group by 1)""",
    "flat",
)
def same_domain_entities(spark, sf):
    """A8."""
    return profiling.same_domain_entities(profiling.domains_per_entity(I.records(spark, sf)))


CONSISTENT = {
    "country_code": "substr(phone, 1, 2)",
    "operator_code": "substr(phone, 3, 3)",
    "phone": "phone",
    "birthday": "birthday",
    "sex": "sex",
}


@query(
    " union all ".join(
        f"""select '{f}' as field, count(*) as n_entities, count(*) filter (where c > 1) as n_inconsistent,
        round(count(*) filter (where c <= 1) / count(*)::double, 6) as consistent_share
        from (select count(distinct {e}) as c from raw group by entity_id)"""
        for f, e in CONSISTENT.items()
    ),
    "raw",
)
def consistency(spark, sf):
    """A9."""
    return rounded(profiling.consistency(raw(spark, sf)), "consistent_share")


@query(
    "select c as n_distinct, count(*) as n_entities from (select count(distinct phone) as c from raw group by entity_id) group by 1",
    "raw",
)
def phone_histogram(spark, sf):
    """A10."""
    return profiling.distinct_histogram(raw(spark, sf), F.col("phone"))


@query(
    """select entity_id, sex, count(*) as n_rows from raw where entity_id in (
    select entity_id from raw group by 1 having count(distinct sex) > 1) group by 1, 2""",
    "raw",
)
def sex_in_inconsistent(spark, sf):
    """A11."""
    return profiling.values_in_inconsistent(raw(spark, sf), "sex")


@query(
    """select c as n_rows, count(*) as n_entities from (select count(*) as c from raw
    where strftime(birthday, '%d.%m') = '01.01' group by entity_id) group by 1""",
    "raw",
)
def placeholder_birthdays(spark, sf):
    """A12."""
    return profiling.placeholder_birthdays(raw(spark, sf))


TYPES = """select entity_id, {0} as n_profiles,
  case when {0} > 1 then 'multi_profile' else 'single_profile' end as entity_type from raw group by 1"""


@query(TYPES.format("count(distinct profile_id)"), "raw")
def entity_types(spark, sf):
    """A13 by distinct profiles."""
    return profiling.entity_types(raw(spark, sf))


@query(
    f"""select entity_type, count(*) as n_entities, round(count(*) / (sum(count(*)) over ())::double, 6) as share
    from ({TYPES.format('count(*)')}) group by 1""",
    "raw",
)
def entity_type_summary(spark, sf):
    """A13 by rows."""
    return rounded(profiling.entity_type_summary(profiling.entity_types(raw(spark, sf), by="rows")), "share")


@query(
    """select 'day_of_week' as unit, isodow(created_at) - 1 as value, count(*) as n_rows from raw
      where created_at is not null and entity_id in (select entity_id from raw group by 1 having count(*) > 1) group by 2
    union all select 'hour', hour(created_at), count(*) from raw
      where created_at is not null and entity_id in (select entity_id from raw group by 1 having count(*) > 1) group by 2""",
    "raw",
)
def multi_entity_times(spark, sf):
    """A14."""
    return profiling.multi_entity_times(raw(spark, sf))


@query(f"select n_profiles, count(*) as n_entities from ({TYPES.format('count(distinct profile_id)')}) group by 1", "raw")
def profiles_histogram(spark, sf):
    """A15."""
    return profiling.profiles_histogram(profiling.entity_types(raw(spark, sf)))


def gap_sql(source: str, entity: str, time: str) -> str:
    return f"""select {entity}, round(coalesce(min(gap), 0) / 3600000000.0, 6) as min_gap_hours,
      round(coalesce(max(gap), 0) / 3600000000.0, 6) as max_gap_hours,
      round(coalesce(avg(gap), 0) / 3600000000.0, 6) as mean_gap_hours, count(*) as profile_count
    from (select {entity}, epoch_us({time}) - lag(epoch_us({time})) over (
      partition by {entity} order by {time} nulls last) as gap from {source}) group by 1"""


GAPS = ("min_gap_hours", "max_gap_hours", "mean_gap_hours")


@query(gap_sql("raw", "entity_id", "created_at"), "raw")
def time_gaps(spark, sf):
    """A16 on profile events."""
    return rounded(profiling.time_gaps(raw(spark, sf)), *GAPS)


@query(gap_sql("orders", "o_custkey", "o_orderdate"))
def order_gaps(spark, sf):
    """A16 on orders of a customer (several orders share a day)."""
    return rounded(profiling.time_gaps(I.table(spark, sf, "orders"), "o_custkey", "o_orderdate"), *GAPS)


def describe_sql(source: str, col: str) -> str:
    return f"""select '{col}' as feature, count({col}) as count, round(avg({col}), 6) as mean,
      round(stddev_samp({col}), 6) as std, min({col})::double as min, round(quantile_cont({col}, 0.25), 6) as q25,
      round(quantile_cont({col}, 0.5), 6) as q50, round(quantile_cont({col}, 0.75), 6) as q75,
      max({col})::double as max from {source}"""


STATS = ("mean", "std", "q25", "q50", "q75")


@query(
    " union all ".join(
        describe_sql(f"({gap_sql('orders', 'o_custkey', 'o_orderdate')})", c) for c in (*GAPS, "profile_count")
    )
)
def describe_gaps(spark, sf):
    """A17 on the gap table."""
    return rounded(profiling.describe(order_gaps(spark, sf), [*GAPS, "profile_count"]), *STATS)


@query(" union all ".join(describe_sql("lineitem", c) for c in ("l_quantity", "l_extendedprice", "l_discount")))
def describe_lines(spark, sf):
    """A17 on order lines."""
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    return rounded(profiling.describe(I.table(spark, sf, "lineitem"), cols), *STATS)


@query(
    """select source, count(*) as n_rows from documents where source is not null group by 1
    order by n_rows desc, source limit 8"""
)
def top_domains(spark, sf):
    """The eight most frequent values."""
    return profiling.top_values(I.table(spark, sf, "documents"), "source")


DOMAINS_OF_MULTI = """select entity_id, count(distinct email_domain) as n_domains from flat
  group by 1 having count(distinct profile_id) > 1"""


@query(DOMAINS_OF_MULTI, "flat")
def domains_of_multi(spark, sf):
    """A19."""
    return profiling.domains_of_multi(I.records(spark, sf))


@query(
    f"""select count(*) as n_entities, round(avg((n_domains > 1)::int), 6) as cross_domain_share from ({DOMAINS_OF_MULTI})""",
    "flat",
)
def cross_domain_share(spark, sf):
    """A19."""
    return rounded(profiling.cross_domain_share(profiling.domains_of_multi(I.records(spark, sf))), "cross_domain_share")


@query(
    f"""select count(*) as n_rows, count(phone) as n_normalized_phone, count(normalized_email) as n_normalized_email,
    count(first_name) as n_normalized_first_name, count(last_name) as n_normalized_last_name
    from ({email_sql('raw', 'email', 'phone, first_name, last_name')})""",
    "raw",
)
def normalized_summary(spark, sf):
    """A20."""
    return profiling.normalized_summary(profiling.normalize_contacts(raw(spark, sf)))


@query("select substr('+' || phone, 1, 2) as prefix, count(*) as n_rows from raw group by 1", "raw")
def phone_prefixes(spark, sf):
    """Null prefix included."""
    return profiling.phone_prefixes(profiling.normalize_contacts(raw(spark, sf)))


SIMILARITY_EDGES = [0.0, 0.6, 0.8, 0.9, 0.95, 0.99, 1.0]


@query(
    """select case when similarity > 0.0 and similarity <= 0.6 then '0.0-0.6' when similarity > 0.6 and similarity <= 0.8 then '0.6-0.8'
      when similarity > 0.8 and similarity <= 0.9 then '0.8-0.9' when similarity > 0.9 and similarity <= 0.95 then '0.9-0.95'
      when similarity > 0.95 and similarity <= 0.99 then '0.95-0.99' when similarity > 0.99 and similarity <= 1.0 then '0.99-1.0' end as bin,
    count(*) as n from dsim group by 1""",
    "dsim",
)
def similarity_ranges(spark, sf):
    """Right-closed bins."""
    return evaluate.range_histogram(doc_pairs(spark, sf), "similarity", SIMILARITY_EDGES)


@query(
    f"""select event_id, profile_id from raw order by {O.unit(42, 'event_id')}, event_id limit 100""", "raw"
)
def sample_rows(spark, sf):
    """100 rows to look at, the same on every run."""
    return profiling.sample_rows(raw(spark, sf), ["event_id"], 100).select("event_id", "profile_id")
