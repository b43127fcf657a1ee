"""Registered queries on pairs, models, clusters and the decision log."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from kinfold import config
from kinfold.functions import similarity
from kinfold.functions import normalize as n
from kinfold.operators import (
    blocking,
    boosting,
    collapse,
    components,
    evaluate,
    features,
    linkage,
    model,
    profiling,
    review,
    setjoin,
    splits,
)
from kinfold.operators.refine import PUBLISHED, REFINED, BlockRule
from kinfold.plans import inference
from kinfold.session import store
from kinfold.sources import events as io
from kinfold.streaming import incremental, monitor

from . import inputs as I
from . import oracle as O
from .queries import (
    all_documents,
    doc_clusters,
    doc_ids,
    doc_pairs,
    doc_sets,
    doc_tokens,
    fa_clusters,
    fa_pairs,
    fa_scored,
    fd_curve,
    io_path,
    people,
    query,
    r6,
    raw,
    rounded,
    stored,
    sweep,
    text_time,
)

IDS = ["profile_id_1", "profile_id_2"]


def fa_labelled(spark, sf):
    return blocking.label_pairs(fa_pairs(spark, sf), people(spark, sf).rows)


def fa_features(spark, sf):
    def make():
        p = people(spark, sf)
        return store(features.pair_features(fa_labelled(spark, sf), p.rows, tokens=p.tokens), "features")

    return stored("features", spark, sf, make)


# -- blocking ----------------------------------------------------------------------------


@query("select block_key, profile_id from keys", "keys")
def block_keys(spark, sf):
    """B1-B4."""
    p = people(spark, sf)
    return blocking.block_keys(p.rows, p.tokens)


@query("select block_key, profile_id from blocks", "blocks")
def blocks_default(spark, sf):
    """B5-B8 with the published limits."""
    p = people(spark, sf)
    return blocking.build_blocks(p.rows, p.tokens, PUBLISHED)


@query("select block_key, profile_id from blocks_small", "blocks_small")
def blocks_small_limits(spark, sf):
    """B5-B8 with limits that bite at any scale."""
    p = people(spark, sf)
    return blocking.build_blocks(p.rows, p.tokens, BlockRule(20, 60))


def losses_sql(keys: str, max_block: int, stop: int) -> str:
    """What the published limits leave unpaired."""
    return f"""select block_key, rule, size, kept::bigint as kept, (size * (size - 1) // 2 - kept * (kept - 1) // 2)::bigint as pairs_lost from (
      select block_key, count(*) as size,
        case when starts_with(block_key, 'site::') and count(*) > {stop} then 'site_stop' else 'sample' end as rule,
        case when starts_with(block_key, 'site::') and count(*) > {stop} then 0 else {max_block} end as kept
      from {keys} group by 1 having count(*) > {max_block} or starts_with(block_key, 'site::') and count(*) > {stop})"""


@query(losses_sql("keys", 300, 150), "keys")
def blocks_dropped(spark, sf):
    """What the published limits leave unpaired, block by block."""
    p = people(spark, sf)
    return blocking.blocks_and_losses(p.rows, p.tokens, PUBLISHED)[1]


@query(losses_sql("keys", 20, 60), "keys")
def blocks_dropped_small(spark, sf):
    """The same for limits that bite at any scale."""
    p = people(spark, sf)
    return blocking.blocks_and_losses(p.rows, p.tokens, BlockRule(20, 60))[1]


def refined_ctes(name: str, rule: BlockRule) -> None:
    """Blocks above the limit split value by value, as nested queries; and their ledger."""
    top, losses, blocks = rule.max_block, [], []
    O.CTE[f"{name}_0"] = (["keys"], "select * from (select *, count(*) over (partition by block_key) as n from keys) where n > 1")
    for i, c in enumerate(rule.split_by, 1):
        before = f"{name}_{i - 1}"
        blocks.append(f"select block_key, profile_id from {before} where n <= {top}")
        O.CTE[f"{name}_parts_{i}"] = (
            [before, "prof"],
            f"""select b.block_key || '|{c}' || coalesce('=' || p.{c}::varchar, '') as part, b.profile_id, b.block_key, b.n
            from {before} b left join prof p on p.profile_id = b.profile_id where b.n > {top}""",
        )
        O.CTE[f"{name}_{i}"] = (
            [f"{name}_parts_{i}"],
            f"""select * from (select part as block_key, profile_id, count(*) over (partition by part) as n
            from {name}_parts_{i}) where n > 1""",
        )
        losses.append(
            f"""select block_key, 'split {c}' as rule, n as size, sum(case when k > 1 then k else 0 end)::bigint as kept,
            (n * (n - 1) // 2 - sum(k * (k - 1) // 2))::bigint as pairs_lost
            from (select block_key, part, n, count(*) as k from {name}_parts_{i} group by all) group by block_key, n
            having n * (n - 1) // 2 > sum(k * (k - 1) // 2)"""
        )
    last = f"{name}_{len(rule.split_by)}"
    blocks.append(f"select block_key, profile_id from {last} where n <= {top}")
    blocks.append(
        f"""select block_key, profile_id from (select *, row_number() over (partition by block_key
        order by md5('0|' || block_key || '|' || profile_id), profile_id) as r from {last} where n > {top}) where r <= {top}"""
    )
    losses.append(
        f"""select block_key, 'sample', n, {top}::bigint, (n * (n - 1) // 2 - {top * (top - 1) // 2})::bigint
        from {last} where n > {top} group by block_key, n"""
    )
    needs = [f"{name}_{i}" for i in range(len(rule.split_by) + 1)]
    O.CTE[f"{name}_blocks"] = (needs, " union all ".join(blocks))
    O.CTE[f"{name}_losses"] = ([*needs, *[f"{name}_parts_{i}" for i in range(1, len(rule.split_by) + 1)]], " union all ".join(losses))


SMALL = BlockRule(12, None, ("email_domain", "first_name", "rt_geoid"))
refined_ctes("fine", REFINED)
refined_ctes("small", SMALL)


@query("select block_key, profile_id from fine_blocks", "fine_blocks")
def blocks_refined(spark, sf):
    """B6-B8 adaptive: blocks above 300 are split by domain, first name and place before any is sampled."""
    p = people(spark, sf)
    return blocking.build_blocks(p.rows, p.tokens, REFINED)


@query("select block_key, profile_id from small_blocks", "small_blocks")
def blocks_refined_small(spark, sf):
    """B6-B8 adaptive with a limit that bites at any scale."""
    p = people(spark, sf)
    return blocking.build_blocks(p.rows, p.tokens, SMALL)


@query("select block_key, rule, size, kept, pairs_lost from fine_losses", "fine_losses")
def blocks_refined_dropped(spark, sf):
    """B6-B8 adaptive: what splitting and sampling leave unpaired."""
    p = people(spark, sf)
    return blocking.blocks_and_losses(p.rows, p.tokens, REFINED)[1]


@query("select block_key, rule, size, kept, pairs_lost from small_losses", "small_losses")
def blocks_refined_small_dropped(spark, sf):
    """B6-B8 adaptive: the same for a limit that bites at any scale."""
    p = people(spark, sf)
    return blocking.blocks_and_losses(p.rows, p.tokens, SMALL)[1]


O.CTE["fine_pairs"] = (["fine_blocks"], O.pairs_of("fine_blocks"))
O.CTE["fine_labels"] = (["fine_pairs", "prof"], O.labelled("fine_pairs", "prof"))


@query("""select round(case when t = 0 then 1.0 else c / t::double end, 6) as recall, c as captured, t as total from
  (select coalesce(sum(is_match), 0)::bigint as c from fine_labels), (select coalesce(sum(n_true_pairs), 0)::bigint as t from truth)""",
  "fine_labels", "truth")
def refined_recall(spark, sf):
    """B11 of split blocks."""
    p = people(spark, sf)
    labelled = inference.candidates(p, REFINED, labeled=True)
    return rounded(blocking.blocking_recall(labelled, p.rows), "recall")


@query("select profile_id_1, profile_id_2 from pairs", "pairs")
def candidate_pairs(spark, sf):
    """B9."""
    return inference.candidates(people(spark, sf), PUBLISHED)


@query("select profile_id_1, profile_id_2 from dsim", "dsim")
def document_pairs(spark, sf):
    """B9 on documents: all pairs of different word sets from a similarity of 0.3 on; no word is left out."""
    return doc_pairs(spark, sf).select(*IDS)


@query("select profile_id, class_id, size from dcls", "dcls")
def document_classes(spark, sf):
    """Documents with equal word sets are told by membership, not by pairs."""
    return doc_sets(spark, sf)[0]


O.CTE["site_sets"] = (["tokens"], "select distinct profile_id, token from tokens")
O.CTE["site_classes"] = (["site_sets"], O.set_classes("site_sets"))


@query("select profile_id_1, profile_id_2, n, similarity from (" + O.similar_sets("site_sets", "site_classes", 0.3) + ")", "site_sets", "site_classes")
def site_set_pairs(spark, sf):
    """B9, F6 on profiles: pairs of different site sets that are alike to 0.3 or more, whatever the size of a site."""
    tokens = people(spark, sf).tokens.select("profile_id", "token").distinct()
    return setjoin.similar_sets(store(tokens, "site-sets"), 0.3)[1]


@query("select profile_id_1, profile_id_2, is_match from labels_fa", "labels_fa")
def label_pairs(spark, sf):
    """B10."""
    return fa_labelled(spark, sf)


RECALL = """select {0} as recall, c as captured, t as total from
  (select coalesce(sum(is_match), 0)::bigint as c from {1}), (select coalesce(sum(n_true_pairs), 0)::bigint as t from {2})"""


@query(RECALL.format("round(case when t = 0 then 1.0 else c / t::double end, 6)", "labels_fa", "truth"), "labels_fa", "truth")
def blocking_recall(spark, sf):
    """B11."""
    return rounded(blocking.blocking_recall(fa_labelled(spark, sf), people(spark, sf).rows), "recall")


@query("select entity_id, n_profiles, n_true_pairs from truth", "truth")
def true_pair_groups(spark, sf):
    """B12."""
    return blocking.true_pair_groups(people(spark, sf).rows)


O.CTE["dom_blocks"] = (["keys"], O.kiloblocks("(select * from keys where starts_with(block_key, 'dom::'))", 300, 150))
O.CTE["dom_pairs"] = (["dom_blocks"], O.pairs_of("dom_blocks"))
O.CTE["dom_labels"] = (["dom_pairs", "prof"], O.labelled("dom_pairs", "prof"))


@query(
    " union all ".join(
        f"""select '{name}' as strategy, count(*) as n_pairs, coalesce(sum(is_match), 0)::bigint as captured,
        (select sum(n_true_pairs)::bigint from truth) as total,
        round(coalesce(sum(is_match), 0) / (select sum(n_true_pairs) from truth)::double, 6) as recall from {table}"""
        for name, table in (("domain", "dom_labels"), ("all_keys", "labels_fa"))
    ),
    "dom_labels", "labels_fa", "truth",
)
def compare_strategies(spark, sf):
    """Domain blocks alone against all keys."""
    p = people(spark, sf)
    variants = {"domain": ["dom"], "all_keys": ["dom", "phone", "name", "site"]}
    return rounded(blocking.compare_strategies(p.rows, p.tokens, variants, PUBLISHED), "recall")


@query("select block_key, record_id from domain_keys", "domain_keys")
def email_only_keys(spark, sf):
    """B14."""
    return blocking.strategy_keys(I.records(spark, sf), "email_only", "record_id")


@query("select * from domain_keys union all select * from time_keys", "domain_keys", "time_keys")
def combined_time_keys(spark, sf):
    """B15, B17."""
    return blocking.strategy_keys(I.records(spark, sf), "combined_time", "record_id")


@query("select block_key, record_id from hash_keys", "hash_keys")
def hash_only_keys(spark, sf):
    """B16."""
    return blocking.strategy_keys(I.records(spark, sf), "hash_only", "record_id")


@query("select block_key, record_id, whole_key, whole_size from chunks", "chunks")
def priority_chunks(spark, sf):
    """All keys, large blocks cut into sorted chunks."""
    keys = blocking.strategy_keys(I.records(spark, sf), "priority", "record_id")
    return blocking.split_blocks(keys, id_col="record_id")


@query(
    """select distinct x.record_id as profile_id_1, y.record_id as profile_id_2
    from (select * from chunks where starts_with(whole_key, 'dom::')) x
    join chunks y on x.block_key = y.block_key and x.record_id < y.record_id""",
    "chunks",
)
def domain_truth_pairs(spark, sf):
    """Pairs of the same provider inside chunks; a source of pairs, not a measure."""
    return blocking.split_strategy_pairs(I.records(spark, sf), "email_only", id_col="record_id")


@query(
    """select case when t = 0 then 0.0 else round(c / t::double, 6) end as recall, t as total, c as found, t - c as missed
    from (select coalesce(sum(is_match), 0)::bigint as c from dom_labels), (select sum(n_true_pairs)::bigint as t from truth)""",
    "dom_labels", "truth",
)
def recall_found_missed(spark, sf):
    """What domain blocks find of the true pairs."""
    p = people(spark, sf)
    pairs = blocking.pairs_from_blocks(blocking.build_blocks(p.rows, p.tokens, PUBLISHED, kinds=["dom"]))
    return rounded(blocking.recall_found_missed(blocking.label_pairs(pairs, p.rows), p.rows), "recall")


@query(
    """select round(count(b.profile_id_1) / count(*)::double, 6) as recall, count(*) as total,
    count(b.profile_id_1) as found, count(*) - count(b.profile_id_1) as missed
    from pairs a left join dom_pairs b on a.profile_id_1 = b.profile_id_1 and a.profile_id_2 = b.profile_id_2""",
    "pairs", "dom_pairs",
)
def recall_against(spark, sf):
    """B19 for a given table of pairs."""
    p = people(spark, sf)
    pairs = blocking.pairs_from_blocks(blocking.build_blocks(p.rows, p.tokens, PUBLISHED, kinds=["dom"]))
    return rounded(blocking.recall_against(fa_pairs(spark, sf), pairs), "recall")


@query(
    """select n_blocks, large_blocks, sub_blocks, n_pairs from (
    select count(*) as n_blocks, sum(l)::bigint as large_blocks, coalesce(sum(c) filter (where l = 1), 0)::bigint as sub_blocks,
      sum(p)::bigint as n_pairs from (
      select whole_key, max((whole_size * (whole_size - 1) / 2 > 10000)::int) as l, count(*) as c, sum(m * (m - 1) // 2) as p
      from (select whole_key, block_key, max(whole_size) as whole_size, count(*) as m from chunks group by 1, 2) group by 1))""",
    "chunks",
)
def block_statistics(spark, sf):
    """B22."""
    keys = blocking.strategy_keys(I.records(spark, sf), "priority", "record_id")
    return blocking.block_statistics(blocking.split_blocks(keys, id_col="record_id"))


NAME_KEY = """case when {l} is null then 'UNK' else upper(substr({l}, 1, 3)) end
  || '_' || case when {f} is null then 'XX' else upper(substr({f}, 1, 2)) end"""
O.CTE["part_names"] = (
    [],
    """select 'n_' || lpad(p_partkey::varchar, 9, '0') as profile_id, p_brand as entity_id,
    split_part(p_name, ' ', 1) as first_name, split_part(p_name, ' ', 2) || ' ' || (p_partkey // 50) as last_name from part""",
)
O.CTE["name_keys"] = (
    ["part_names"],
    f"""select * from (select *, count(*) over (partition by block_key) as c from (
    select {NAME_KEY.format(f='first_name', l='last_name')} as block_key, * from part_names)) where c between 2 and 2000""",
)
O.CTE["name_pairs"] = (
    ["name_keys"],
    """select profile_id_1, profile_id_2, label,
      1 - levenshtein(a, b) / greatest(length(a), length(b))::double as similarity from (
      select x.profile_id as profile_id_1, y.profile_id as profile_id_2, (x.entity_id = y.entity_id)::int as label,
        x.first_name || ' ' || x.last_name as a, y.first_name || ' ' || y.last_name as b
      from name_keys x join name_keys y on x.block_key = y.block_key and x.profile_id < y.profile_id)""",
)


def part_names(spark, sf):
    """F-C: part names as people, brands as entities."""
    words = F.split("p_name", " ")
    suffix = F.expr("p_partkey div 50").cast("string")
    return I.table(spark, sf, "part").select(
        F.concat(F.lit("n_"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("profile_id"),
        F.col("p_brand").alias("entity_id"),
        words[0].alias("first_name"),
        F.concat_ws(" ", words[1], suffix).alias("last_name"),
    )


@query("select block_key, profile_id from name_keys", "name_keys")
def name_prefix_keys(spark, sf):
    """B21."""
    return blocking.name_prefix_keys(part_names(spark, sf))


HASHES = blocking._coefficients(16)
O.CTE["lsh"] = (
    ["tokens"],
    "select profile_id, "
    + O.comma(f"min(({a} * x + {b}) % 2147483647) as h{i}" for i, (a, b) in enumerate(HASHES))
    + " from (select profile_id, ('0x' || substr(md5(token), 1, 7))::bigint as x from tokens) group by 1",
)


@query(
    " union all ".join(
        f"select 'lsh::{b}:_' || h{2 * b} || '_' || h{2 * b + 1} as block_key, profile_id from lsh" for b in range(8)
    ),
    "lsh",
)
def minhash_keys(spark, sf):
    """B23."""
    return blocking.minhash_keys(people(spark, sf).tokens)


@query()
def minhash_document_pairs(spark, sf):
    """B23 on documents: keys pruned and paired like any others."""
    keys = blocking.minhash_keys(doc_tokens(spark, sf))
    return blocking.pairs_from_blocks(blocking.prune_blocks(keys, config.MAX_BLOCK_PROFILES, config.SITE_STOP_DF))


# -- features ----------------------------------------------------------------------------

FEATURES = config.DEFAULT_SCHEMA.feature_names
FEATURE_SQL = "select profile_id_1, profile_id_2, {} from feats".format(
    O.comma(FEATURES)
)


@query(FEATURE_SQL, "feats")
def pair_features(spark, sf):
    """F1-F8, F10."""
    return features.pair_features(fa_pairs(spark, sf), people(spark, sf).rows)


@query(FEATURE_SQL, "feats")
def pair_features_large_sets(spark, sf):
    """F1-F8 when sets above three tokens are kept out of the profile row."""
    p = people(spark, sf)
    small = p.rows.drop(*config.SITE_SET_COLS, "big_sets").join(
        collapse.inline_sets(p.tokens, limit=3), "profile_id", "left"
    )
    return features.pair_features(fa_pairs(spark, sf), small, tokens=p.tokens)


@query(
    """select p.profile_id_1, p.profile_id_2, count(distinct x.token) as overlap_union from pairs p
    left join (select a.profile_id as i, b.profile_id as j, a.token from
      (select distinct profile_id, token from tokens) a join (select distinct profile_id, token from tokens) b
      on a.token = b.token) x on x.i = profile_id_1 and x.j = profile_id_2 group by 1, 2""",
    "pairs", "tokens",
)
def union_overlap(spark, sf):
    """F9."""
    return features.union_overlap(fa_pairs(spark, sf), people(spark, sf).tokens)


@query(
    "select profile_id_1, profile_id_2, n, similarity from dsim", "dsim"
)
def document_similarity(spark, sf):
    """F6, F7 on all words of the documents."""
    return doc_pairs(spark, sf)


O.CTE["name_sim"] = (
    ["name_keys"],
    """select x.profile_id as profile_id_1, y.profile_id as profile_id_2,
      x.last_name || ' ' || x.first_name as a, y.first_name || ' ' || y.last_name as b
    from name_keys x join name_keys y on x.block_key = y.block_key and x.profile_id < y.profile_id""",
)


@query(
    """select s.profile_id_1, s.profile_id_2,
      round(1 - levenshtein(a, b) / greatest(length(a), length(b))::double, 6) as name_levenshtein,
      round(2 * t.c / (len(string_split(a, ' ')) + len(string_split(b, ' ')))::double, 6) as name_token_sort
    from name_sim s join (
      select i.profile_id_1, i.profile_id_2, sum(least(m, coalesce(k, 0))) as c from
        (select profile_id_1, profile_id_2, w, count(*) as m from (
          select profile_id_1, profile_id_2, unnest(string_split(a, ' ')) as w from name_sim) group by all) i
        left join (select profile_id_1, profile_id_2, w, count(*) as k from (
          select profile_id_1, profile_id_2, unnest(string_split(b, ' ')) as w from name_sim) group by all) j
        on i.profile_id_1 = j.profile_id_1 and i.profile_id_2 = j.profile_id_2 and i.w = j.w group by 1, 2) t
    on s.profile_id_1 = t.profile_id_1 and s.profile_id_2 = t.profile_id_2""",
    "name_sim",
)
def name_similarity(spark, sf):
    """F11, F16 inside name blocks, one side with its words swapped."""
    people_ = part_names(spark, sf)
    keys = blocking.name_prefix_keys(people_)
    swapped, plain = F.concat_ws(" ", "last_name", "first_name"), F.concat_ws(" ", "first_name", "last_name")
    made = {"at": similarity.comparable_text(swapped), "bt": similarity.comparable_text(plain)}
    made |= {"aw": similarity.numbered_tokens(swapped), "bw": similarity.numbered_tokens(plain)}
    texts = people_.select("profile_id", *[c.alias(name) for name, c in made.items()])
    both = blocking.paired(store(blocking.block_members(keys).join(texts, "profile_id"), "names"))
    return both.select(
        *IDS,
        r6(similarity.edit_similarity(F.col("at_1"), F.col("bt_2"))).alias("name_levenshtein"),
        r6(similarity.shared_tokens_similarity(F.col("aw_1"), F.col("bw_2"))).alias("name_token_sort"),
    )


@query(
    """select profile_id_1, profile_id_2, round(similarity, 6) as similarity, label from name_pairs
    where label = 1 or similarity >= 0.6""",
    "name_pairs",
)
def name_pairs(spark, sf):
    """F12 without the balance caps."""
    people_ = part_names(spark, sf)
    out = features.name_pairs(blocking.name_prefix_keys(people_), people_, max_positive=None, max_negative=None)
    return rounded(out, "similarity")


def _capped(label: int, cap: int) -> str:
    return f"""(select * from name_pairs where label = {label} and (label = 1 or similarity >= 0.6)
      order by {O.unit(42, "profile_id_1 || '|' || profile_id_2")}, profile_id_1, profile_id_2 limit {cap})"""


@query(
    f"""select profile_id_1, profile_id_2, round(similarity, 6) as similarity, label from (
    {_capped(1, 300)} union all {_capped(0, 300)})""",
    "name_pairs",
)
def name_pairs_balanced(spark, sf):
    """F12 with a balance of 300 pairs per class."""
    people_ = part_names(spark, sf)
    out = features.name_pairs(blocking.name_prefix_keys(people_), people_, max_positive=300, max_negative=300)
    return rounded(out, "similarity")


O.CTE["contact_pairs"] = (
    ["pairs", "prof"],
    """select p.profile_id_1, p.profile_id_2,
      case when lower(a.email_domain) = lower(b.email_domain) then 1 else 0 end as email_domain_match,
      abs(floor((epoch_us(a.created_at) - epoch_us(b.created_at)) / 86400000000.0))::bigint as registration_diff_days,
      case when a.rt_geoname = b.rt_geoname then 1 else 0 end as city_match,
      case when a.rt_country = b.rt_country then 1 else 0 end as country_match
    from pairs p left join prof a on a.profile_id = profile_id_1 left join prof b on b.profile_id = profile_id_2""",
)


def contact_pairs(spark, sf):
    records = people(spark, sf).rows.select(
        "profile_id",
        n.email_domain_or_empty(F.col("email")).alias("email_domain"),
        "created_at",
        F.col("rt_geoname").alias("extracted_city"),
        F.col("rt_country").alias("extracted_country"),
    )
    return features.contact_features(fa_pairs(spark, sf), records)


@query(
    """select *, round(case when s > 0 then (registration_diff_days - m) / s else registration_diff_days - m end, 6)
      as registration_diff_standardized from contact_pairs,
    (select avg(registration_diff_days) as m, stddev_pop(registration_diff_days) as s from contact_pairs)""".replace(
        "select *,",
        "select profile_id_1, profile_id_2, email_domain_match, registration_diff_days, city_match, country_match,",
        1,
    ),
    "contact_pairs",
)
def contact_features(spark, sf):
    """F13-F15 with the z-score."""
    out = features.standardize(contact_pairs(spark, sf), "registration_diff_days", "registration_diff_standardized")
    return rounded(out, "registration_diff_standardized")


SUMMED = ["email_domain_match", "registration_diff_days", "city_match", "country_match"]


@query(
    " union all ".join(
        f"""select '{c}' as feature, count(*) as n_rows, count({c}) as n_known, sum({c})::double as total,
        round(avg({c}), 6) as mean, round(stddev_pop({c}), 6) as std, min({c})::double as minimum, max({c})::double as maximum
        from contact_pairs"""
        for c in SUMMED
    ),
    "contact_pairs",
)
def feature_summary(spark, sf):
    """F17, F18."""
    table = contact_pairs(spark, sf).withColumn("unused", F.lit(1))
    pairs = features.drop_features(table, ["unused"])
    if "unused" in pairs.columns:
        raise AssertionError("a dropped feature is still there")
    return rounded(features.feature_summary(pairs, SUMMED), "mean", "std")


# -- splits ------------------------------------------------------------------------------

FOLD = f"case when {O.unit(42, 'entity_id')} < 0.75 then 'train' else 'val' end"


@query(f"select profile_id, entity_id, {FOLD} as fold from prof", "prof")
def entity_split(spark, sf):
    """L1."""
    return splits.entity_split(people(spark, sf).rows).select("profile_id", "entity_id", "fold")


O.CTE["folded"] = (
    ["labels_fa", "prof"],
    f"""select p.*, a.fold from labels_fa p join (select profile_id, {FOLD} as fold from prof) a on a.profile_id = profile_id_1
    join (select profile_id, {FOLD} as fold from prof) b on b.profile_id = profile_id_2 and a.fold = b.fold""",
)


def fa_folded(spark, sf):
    return splits.split_pairs(fa_labelled(spark, sf), splits.entity_split(people(spark, sf).rows))


@query("select profile_id_1, profile_id_2, is_match, fold from folded", "folded")
def split_pairs(spark, sf):
    """L1, L4: pairs inside one fold."""
    return fa_folded(spark, sf)


@query(
    f"""select profile_id_1, profile_id_2, is_match from labels_fa where is_match = 1 union all
    select profile_id_1, profile_id_2, is_match from (select *, row_number() over (
      order by {O.unit(42, "profile_id_1 || '|' || profile_id_2")}, profile_id_1, profile_id_2) as r
      from labels_fa where is_match = 0) where r <= (select 30 * sum(is_match) from labels_fa)""",
    "labels_fa",
)
def sample_negatives(spark, sf):
    """L2: an exact number of non-matches."""
    return splits.sample_negatives(fa_labelled(spark, sf))


STRATUM = O.unit(42, "entity_type || '|' || entity_id")


@query(
    f"""select *, case when {STRATUM} < 0.6 then 'train' when {STRATUM} < 0.8 then 'val' else 'test' end as fold from (
    select md5(text) as entity_id, count(*) as n_profiles,
      case when count(*) > 1 then 'multi_profile' else 'single_profile' end as entity_type from documents group by 1)"""
)
def stratified_split(spark, sf):
    """L3 on documents: copies of a text are one entity."""
    return splits.stratified_split(profiling.entity_types(I.doc_profiles(spark, sf)))


# -- curves and quality ------------------------------------------------------------------


@query(
    """select score, n_pos, tp::bigint as tp, predicted::bigint as predicted, positives::bigint as positives,
    round(precision, 6) as precision, round(recall, 6) as recall from curve""",
    "curve",
)
def pr_curve(spark, sf):
    """M7."""
    return rounded(fd_curve(spark, sf), "precision", "recall")


@query("select round(sum(n_pos / positives::double * precision), 6) as pr_auc from curve", "curve")
def average_precision(spark, sf):
    """M13."""
    return rounded(evaluate.average_precision(fd_curve(spark, sf)), "pr_auc")


CALIBRATED = """select coalesce(min(score) filter (where precision >= {0}), 0.99) as auto_merge,
  arg_max(score, k) as review, round(coalesce(arg_min(precision, score) filter (where precision >= {0}), 1.0), 6) as auto_precision,
  round(arg_max(precision, k), 6) as review_precision, round(arg_max(recall, k), 6) as review_recall,
  round(max(f), 6) as review_f1 from (select *, {{'f': f, 's': -score}} as k from (
    select *, 2 * precision * recall / (precision + recall + 1e-12) as f from {1}))"""
CAL_NUMBERS = ("auto_precision", "review_precision", "review_recall", "review_f1")


@query(CALIBRATED.format("0.99", "curve"), "curve")
def calibrate(spark, sf):
    """M8, M9, M12."""
    return rounded(evaluate.calibrate(fd_curve(spark, sf)), *CAL_NUMBERS)


@query(CALIBRATED.format("0.6", "curve"), "curve")
def calibrate_low_target(spark, sf):
    """M8 with a target that the curve reaches."""
    return rounded(evaluate.calibrate(fd_curve(spark, sf), 0.6), *CAL_NUMBERS)


def grid_sql(grid) -> str:
    return f"""select t as threshold, tp, predicted, positives,
      case when predicted > 0 then tp / predicted::double else 0.0 end as precision,
      case when positives > 0 then tp / positives::double else 0.0 end as recall,
      case when predicted + positives > 0 then 2 * tp / (predicted + positives)::double else 0.0 end as f1
    from (select t, sum(case when score >= t then y else 0 end)::bigint as tp, count(*) filter (where score >= t) as predicted,
      sum(y)::bigint as positives from ls, (select unnest([{O.comma(f'{t!r}::double' for t in grid)}]) as t) group by t)"""


PRF = ("precision", "recall", "f1")


def best_sql(grid, tie: str) -> str:
    key = f"{{'f': f1, 't': {tie}}}"
    return f"""select round(max(f1), 6) as f1, arg_max(threshold, {key}) as threshold,
    arg_max(precision, {key}) as precision, arg_max(recall, {key}) as recall from ({grid_sql(grid)})"""


@query(best_sql(evaluate.REVIEW_GRID, "threshold"), "ls")
def review_grid(spark, sf):
    """Best F1 on the review grid, highest threshold on ties."""
    metrics = evaluate.grid_metrics(I.scored_labels(spark, sf), evaluate.REVIEW_GRID)
    return rounded(evaluate.best_of_grid(metrics, highest=True), "f1")


@query(
    f"select threshold, tp, predicted, positives, {O.comma(f'round({c}, 6) as {c}' for c in PRF)} from ({grid_sql(evaluate.SWEEP_GRID)})",
    "ls",
)
def f1_sweep(spark, sf):
    """All thresholds."""
    return rounded(evaluate.grid_metrics(I.scored_labels(spark, sf), evaluate.SWEEP_GRID), *PRF)


@query(best_sql(evaluate.SWEEP_GRID, "-threshold"), "ls")
def f1_sweep_best(spark, sf):
    """Best F1, lowest threshold on ties."""
    metrics = evaluate.grid_metrics(I.scored_labels(spark, sf), evaluate.SWEEP_GRID)
    return rounded(evaluate.best_of_grid(metrics, highest=False), "f1")


CUT = 0.3
O.CTE["cut"] = (["ls"], f"select doc_id, score, y, (score >= {CUT})::int as p from ls")


@query(
    """select round(avg((y = p)::int), 6) as accuracy, round(sum(y * p) / sum(p)::double, 6) as precision,
    round(sum(y * p) / sum(y)::double, 6) as recall, round(2 * sum(y * p) / (sum(p) + sum(y))::double, 6) as f1 from cut""",
    "cut",
)
def pair_metrics(spark, sf):
    """M14."""
    return rounded(evaluate.pair_metrics(I.scored_labels(spark, sf), CUT), "accuracy", *PRF)


O.CTE["per_class"] = (
    ["cut"],
    " union all ".join(
        f"""select '{c}' as name, count(*) filter (where y = {c} and p = {c}) / count(*) filter (where p = {c})::double as precision,
        count(*) filter (where y = {c} and p = {c}) / count(*) filter (where y = {c})::double as recall,
        2 * count(*) filter (where y = {c} and p = {c}) / (count(*) filter (where p = {c}) + count(*) filter (where y = {c}))::double as f1,
        count(*) filter (where y = {c}) as support from cut"""
        for c in (0, 1)
    ),
)


@query(
    f"""select name, {O.comma(f'round({c}, 6) as {c}' for c in PRF)}, support from (
    select * from per_class union all
    select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::bigint from per_class union all
    select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
      sum(f1 * support) / sum(support), sum(support)::bigint from per_class)""",
    "per_class",
)
def classification_report(spark, sf):
    """M15."""
    return rounded(evaluate.classification_report(I.scored_labels(spark, sf), CUT), *PRF)


@query(
    """select a.v as actual, b.v as predicted, count(c.y) as n from (select unnest([0, 1]) as v) a
    join (select unnest([0, 1]) as v) b on true left join cut c on c.y = a.v and c.p = b.v group by 1, 2""",
    "cut",
)
def confusion(spark, sf):
    """M16."""
    return evaluate.confusion(I.scored_labels(spark, sf), CUT)


@query(
    """select doc_id, score, y, case when p = 1 then 'FP' else 'FN' end as error from cut where y <> p""", "cut"
)
def errors(spark, sf):
    """M19."""
    return evaluate.errors(I.scored_labels(spark, sf), CUT)


@query("select y, least(floor(score * 20), 19)::int as bin, count(*) as n from ls group by 1, 2", "ls")
def score_histogram(spark, sf):
    """Scores per class."""
    return evaluate.score_histogram(I.scored_labels(spark, sf))


O.CTE["missed"] = (
    ["scored", "labels_fa"],
    """select s.profile_id_1, s.profile_id_2 from scored s join labels_fa l on l.profile_id_1 = s.profile_id_1
    and l.profile_id_2 = s.profile_id_2 where l.is_match = 1 and prob_match < 0.95""",
)


@query(
    """select overlap, count(*) as n from (select m.profile_id_1, m.profile_id_2, count(distinct x.token) as overlap from missed m
    left join tokens x on x.profile_id = m.profile_id_1
      and x.token in (select token from tokens y where y.profile_id = m.profile_id_2) group by 1, 2) group by 1""",
    "missed", "tokens",
)
def missed_overlaps(spark, sf):
    """Shared sites of missed pairs."""
    scored = fa_scored(spark, sf).join(fa_labelled(spark, sf), IDS)
    missed = evaluate.errors(scored, 0.95, "prob_match", "is_match").filter("error = 'FN'")
    return evaluate.missed_overlap_histogram(features.union_overlap(missed.select(*IDS), people(spark, sf).tokens))


O.CTE["cells"] = (
    ["dclusters", "docs"],
    "select cluster_id, entity_id, count(*) as n from dclusters join docs using (profile_id) group by 1, 2",
)
O.CTE["bcubed"] = (
    ["cells"],
    """select p as bcubed_precision, r as bcubed_recall, 2 * p * r / (p + r) as bcubed_f1 from (
      select sum(s) / sum(c) as p from (select sum(n * n) / sum(n)::double as s, sum(n) as c from cells group by cluster_id)),
      (select sum(s) / sum(c) as r from (select sum(n * n) / sum(n)::double as s, sum(n) as c from cells group by entity_id))""",
)
B3 = ("bcubed_precision", "bcubed_recall", "bcubed_f1")


@query(f"select {O.comma(f'round({c}, 6) as {c}' for c in B3)} from bcubed", "bcubed")
def bcubed(spark, sf):
    """M23 on document clusters; exact copies are the truth."""
    return rounded(evaluate.bcubed(doc_clusters(spark, sf), I.doc_profiles(spark, sf)), *B3)


def quality_gate_of(spark, sf):
    ap = evaluate.average_precision(fd_curve(spark, sf))
    b3 = evaluate.bcubed(doc_clusters(spark, sf), I.doc_profiles(spark, sf)).select(F.col("bcubed_f1").alias("bcubed_f1_review"))
    recall = blocking.blocking_recall(fa_labelled(spark, sf), people(spark, sf).rows).select(F.col("recall").alias("blocking_recall"))
    row = ap.join(F.broadcast(b3)).join(F.broadcast(recall)).withColumn("pr_auc_drop", F.lit(1.0) - F.col("pr_auc"))
    return evaluate.quality_gate(row)


O.CTE["gate_metrics"] = (
    ["curve", "bcubed", "labels_fa", "truth"],
    """select ap, bcubed_f1 as f, c / t::double as r from
      (select sum(n_pos / positives::double * precision) as ap from curve), bcubed,
      (select sum(is_match) as c from labels_fa), (select sum(n_true_pairs) as t from truth)""",
)


@query(
    """select rule, round(value, 6) as value, bound::double as bound from (
      select 'pr_auc' as rule, ap as value, 0.7 as bound, ap < 0.7 as failed from gate_metrics union all
      select 'bcubed_f1_review', f, 0.9, f < 0.9 from gate_metrics union all
      select 'blocking_recall', r, 0.95, r < 0.95 from gate_metrics union all
      select 'pr_auc_drop', 1.0 - ap, 0.05, 1.0 - ap > 0.05 from gate_metrics) where failed""",
    "gate_metrics",
)
def quality_gate(spark, sf):
    """The gates that the measured values break."""
    return rounded(quality_gate_of(spark, sf), "value")


@query(
    """select round(c, 6) as candidate_pr_auc, round(p, 6) as production_pr_auc, cl as candidate_p95, pl as production_p95,
      case when c < p - 0.02 or cl > pl * 1.5 then 'rollback' else 'canary' end as decision
    from (select max(ap) filter (where stage = 'staging') as c, max(ap) filter (where stage = 'production') as p from (
        select stage, sum(n_pos / positives::double * tp / predicted) as ap from (
          select stage, n_pos, sum(n_pos) over w as tp, sum(n) over w as predicted, sum(n_pos) over (partition by stage) as positives
          from (select stage, prob_match, count(*) filter (where status = 'ok') as n_pos, count(*) as n from log group by 1, 2)
          window w as (partition by stage order by prob_match desc rows unbounded preceding)) group by stage)),
      (select quantile_disc(latency_s, 0.95) filter (where stage = 'staging') as cl,
        quantile_disc(latency_s, 0.95) filter (where stage = 'production') as pl from log)""",
    "log",
)
def shadow_comparison(spark, sf):
    """Staging against production on the decision log; an ok answer counts as a match."""
    log = I.decision_log(spark, sf).withColumn("y", (F.col("status") == "ok").cast("int"))
    rows = None
    for stage in ("staging", "production"):
        curve = evaluate.pr_curve(log.filter(F.col("stage") == stage), "prob_match")
        one = evaluate.average_precision(curve).withColumn("stage", F.lit(stage))
        rows = one if rows is None else rows.unionByName(one)
    latency = log.groupBy("stage").agg(F.percentile_approx("latency_s", 0.95, 1_000_000).alias("p95"))
    out = evaluate.shadow_comparison(rows, latency, "staging", "production")
    return rounded(out, "candidate_pr_auc", "production_pr_auc")


# -- models ------------------------------------------------------------------------------

LINEAR = ["similarity", "registration_diff_days", "city_match", "country_match", "email_domain_match"]


def linear_table(spark, sf):
    """The five published features on labelled pairs; the site overlap stands for the name."""
    base = fa_features(spark, sf).select(*IDS, F.col("is_match").alias("label"), F.col("jaccard_fs_visited_365").alias("similarity"))
    return base.join(contact_pairs(spark, sf), IDS)


def logistic(spark, sf):
    return stored("logistic", spark, sf, lambda: model.fit_logistic(linear_table(spark, sf), LINEAR))


#: Rounds of the registered fit; depth, step and patience are the published ones.
TREE_ROUNDS = 60
FLOW_ROUNDS = 20


def boosted(spark, sf) -> boosting.Boosted:
    def make():
        folded = splits.split_pairs(fa_features(spark, sf), splits.entity_split(people(spark, sf).rows))
        train = store(folded.filter("fold = 'train'").drop("fold"), "train")
        val = store(folded.filter("fold = 'val'").drop("fold"), "val")
        return boosting.fit_boosted(train, FEATURES, val, max_iter=TREE_ROUNDS)

    return stored("trees", spark, sf, make)


def trees(spark, sf):
    return boosted(spark, sf).fitted


def _rule(name: str, node: str) -> str:
    """A rule of the made ensemble at a node, in SQL."""
    return re.sub(r"\bnode\b", node, I.TREE_RULES[name].format(n=len(FEATURES)).replace("D", "::double"))


def _walk(node: str) -> str:
    goes_left = f"x[{_rule('feature', node)} + 1] <= {_rule('threshold', node)}"
    return f"case when {goes_left} then 2 * {node} + 1 else 2 * {node} + 2 end"


O.CTE["prefix_scores"] = (
    ["feats", "labels_fa"],
    f"""select profile_id_1, profile_id_2, is_match, tree + 1 as prefix,
      sum({_rule('weight', 'node')} * {_rule('prediction', 'node')}) over (partition by profile_id_1, profile_id_2 order by tree) as score
    from (select *, {_walk('n2')} as node from (select *, {_walk('n1')} as n2 from (select *, {_walk('0')} as n1 from (
      select f.profile_id_1, f.profile_id_2, is_match, tree, [{O.comma(f'coalesce({c}::double, -1.0)' for c in FEATURES)}] as x
      from feats f join labels_fa l on l.profile_id_1 = f.profile_id_1 and l.profile_id_2 = f.profile_id_2,
        (select unnest(range({I.RULE_TREES}))::integer as tree)))))""",
)
O.CTE["prefix_ap"] = (
    ["prefix_scores"],
    """select prefix, coalesce(sum(case when positives > 0 then n_pos / positives::double * (tp / predicted::double) end), 0.0) as pr_auc from (
      select prefix, n_pos, sum(n_pos) over w as tp, sum(n) over w as predicted, sum(n_pos) over (partition by prefix) as positives from (
        select prefix, score, count(*) as n, sum(is_match) as n_pos from prefix_scores group by 1, 2)
      window w as (partition by prefix order by score desc rows unbounded preceding)) group by prefix""",
)


def prefix_ap(spark, sf):
    def make():
        nodes = I.rule_trees(spark, len(FEATURES))
        return store(boosting.prefix_metrics(fa_features(spark, sf), FEATURES, nodes), "prefix-ap")

    return stored("prefix_ap", spark, sf, make)


O.CTE["seen"] = (
    ["prefix_ap"],
    """select prefix, max(case when is_new then prefix end) over (order by prefix rows unbounded preceding) as last from (
      select prefix, pr_auc > coalesce(max(pr_auc) over (order by prefix rows between unbounded preceding and 1 preceding), -1.0) as is_new
      from prefix_ap)""",
)


@query("select prefix, round(pr_auc, 6) as pr_auc from prefix_ap", "prefix_ap")
def boosting_prefixes(spark, sf):
    """M1: PR-AUC of every prefix of an ensemble, from its node table."""
    return rounded(prefix_ap(spark, sf), "pr_auc")


@query(
    """select best, round(pr_auc, 6) as pr_auc, stopped_at from (
      select coalesce(min(case when prefix - last >= 5 then prefix end), max(prefix)) as stopped_at from seen)
    join (select prefix, last as best from seen) s on s.prefix = stopped_at
    join (select prefix as p, pr_auc from prefix_ap) on p = best""",
    "prefix_ap", "seen",
)
def boosting_best_prefix(spark, sf):
    """M1: the prefix that stays, with a patience of five trees."""
    return rounded(boosting.best_prefix(prefix_ap(spark, sf), 5), "pr_auc")


@query()
def train_logistic(spark, sf):
    """Coefficients by size."""
    return model.importance(logistic(spark, sf), spark)


@query()
def train_trees(spark, sf):
    """Boosted trees, cut to the prefix with the best PR-AUC on the validation fold."""
    return model.importance(trees(spark, sf), spark)


@query()
def trained_inference(spark, sf):
    """Training run on the events, then inference with that model at the thresholds it calibrated."""
    trained = inference.run_training(raw(spark, sf), PUBLISHED, max_iter=FLOW_ROUNDS)
    at = trained.thresholds.first()
    result = inference.run_inference(
        raw(spark, sf), PUBLISHED, trained.fitted, at["auto_merge"], min(at["review"], at["auto_merge"]), components.REVIEW
    )
    return result.summary.join(F.broadcast(trained.thresholds))


@query()
def score_with_trees(spark, sf):
    """M3, M5: probability and decision of all candidate pairs."""
    return model.score(fa_features(spark, sf), trees(spark, sf))


@query()
def score_requests(spark, sf):
    """M6: requests with ready-made feature maps, scored by a saved and loaded model."""
    path = io_path(spark, "model")
    io.save_model(trees(spark, sf), path)
    fitted = io.load_model(path)
    pairs = F.create_map(*[x for c in FEATURES for x in (F.lit(c), F.col(c).cast("double"))])
    return model.score_maps(fa_features(spark, sf).select(*IDS, pairs.alias("features")), fitted, auto=0.9, review=0.5)


@query("select profile_id_1, profile_id_2, prob_match, action from scored", "scored")
def scoring_stream(spark, sf):
    """M6: the same decisions from a stream of ready-made features, file by file, each written once."""
    folder = io_path(spark, "requests")
    fa_features(spark, sf).repartition(4, *IDS).write.parquet(folder)
    requests = incremental.read_stream(spark, folder, fa_features(spark, sf).schema, per_trigger=1)

    def decide(table):
        scored = model.rule_score(table)
        return scored.select(*IDS, "prob_match", components.action(F.col("prob_match"), 0.8, 0.6).alias("action"))

    return incremental.score_stream(requests, decide, io_path(spark, "decisions"), io_path(spark, "decisions-state"))


@query()
def explain_pairs(spark, sf):
    """Largest contributions per pair."""
    return model.explain_pairs(linear_table(spark, sf), logistic(spark, sf), 3)


COMPARED = ["email_domain", "first_name", "sex", "np_device", "np_browser", "rt_geoname", "rt_tz_offset"]


@query(
    " union all ".join(
        f"""select profile_id_1, profile_id_2, '{c}' as field, a.{c} as value_1, b.{c} as value_2,
        case when a.{c} is null or b.{c} is null then '·' when a.{c} = b.{c} then '=' else '≠' end as mark
        from pairs left join prof a on a.profile_id = profile_id_1 left join prof b on b.profile_id = profile_id_2"""
        for c in COMPARED
    ),
    "pairs", "prof",
)
def compare_raw_values(spark, sf):
    """Raw values side by side."""
    return model.compare_raw(blocking.attach_both(fa_pairs(spark, sf), people(spark, sf).rows, COMPARED), COMPARED)


@query("select profile_id_1, profile_id_2, prob_match, action from scored", "scored")
def rule_scores(spark, sf):
    """M4, M5 with the rule score."""
    return inference.score_pairs(fa_pairs(spark, sf), people(spark, sf), model.rule_score, 0.8, 0.6)


# -- clusters ----------------------------------------------------------------------------


@query("select a as profile_id_1, b as profile_id_2 from auto_edges", "auto_edges")
def accepted_edges(spark, sf):
    """G1."""
    return components.accepted_edges(fa_scored(spark, sf))


@query("select profile_id, cluster_id from clusters", "clusters")
def connected_components(spark, sf):
    """G2 on profiles."""
    edges = components.accepted_edges(fa_scored(spark, sf))
    return components.connected_components(edges, people(spark, sf).rows)


@query("select profile_id, cluster_id from dclusters", "dclusters")
def document_components(spark, sf):
    """G2 on near-equal documents."""
    edges = doc_pairs(spark, sf).filter("similarity >= 0.6").select(*IDS)
    return all_documents(spark, sf, components.connected_components(edges, doc_ids(spark, sf)))


@query("select cluster_id, count(*) as size from clusters group by 1", "clusters")
def cluster_sizes(spark, sf):
    """G3."""
    return components.cluster_sizes(fa_clusters(spark, sf))


@query(
    """select (select count(*) from prof) as n_profiles, (select count(*) from scored) as n_pairs,
    (select count(*) from scored where action = 'AUTO_MERGE') as n_auto,
    (select count(*) from scored where action = 'REVIEW') as n_review,
    (select count(*) from (select cluster_id from clusters group by 1 having count(*) > 1)) as n_clusters_with_dups""",
    "prof", "scored", "clusters",
)
def inference_summary(spark, sf):
    """The whole flow from events to the summary row."""
    return inference.run_inference(raw(spark, sf), PUBLISHED, model.rule_score, auto=0.8, review=0.6).summary


O.CTE["half"] = ([], "select 0.5::double as t")
O.CTE["published_levels"] = ([], f"select unnest([{O.comma(f'{t}::double' for t in config.SWEEP_THRESHOLDS)}]) as t")
O.CTE |= O.average_linkage("dsim", "dnodes", "half", "lk")
O.CTE |= O.average_linkage("dsim", "dnodes", "published_levels", "lks")
O.CTE["linkage_sweep"] = (["lks_documents", "dsim"], O.CTE["sweep"][1].replace("tclusters", "lks_documents"))


@query("select threshold, profile_id, cluster_id from lk_documents", "lk_documents")
def average_linkage(spark, sf):
    """G5 at threshold 0.5."""
    found = linkage.average_linkage(doc_pairs(spark, sf), [0.5], doc_ids(spark, sf))
    return all_documents(spark, sf, found, "threshold")


@query(
    """select threshold, clusters, records_in_clusters, avg_cluster_size, max_cluster_size, fp_count, total_pairs,
    round(fp_rate, 6) as fp_rate from linkage_sweep""",
    "linkage_sweep",
)
def linkage_sweep(spark, sf):
    """Average linkage for all published thresholds at once."""
    pairs = doc_pairs(spark, sf)
    found = linkage.average_linkage(pairs, config.SWEEP_THRESHOLDS, doc_ids(spark, sf))
    return rounded(review.threshold_sweep(all_documents(spark, sf, found, "threshold"), pairs), "fp_rate")


@query(
    """select count(*) filter (where similarity < 0.6 * 0.7) as fp_count, count(*) as total_pairs,
    round(count(*) filter (where similarity < 0.6 * 0.7) / count(*)::double, 6) as fp_rate from dsim
    join dclusters a on a.profile_id = profile_id_1 join dclusters b on b.profile_id = profile_id_2
    and a.cluster_id = b.cluster_id""",
    "dsim", "dclusters",
)
def cluster_quality(spark, sf):
    """G6."""
    return rounded(review.cluster_quality(doc_clusters(spark, sf), doc_pairs(spark, sf), 0.6), "fp_rate")


SWEEP_COLS = (
    "threshold, clusters, records_in_clusters, avg_cluster_size, max_cluster_size, fp_count, total_pairs, "
    "round(fp_rate, 6) as fp_rate"
)


@query(f"select {SWEEP_COLS} from sweep", "sweep")
def threshold_sweep(spark, sf):
    """G7 on components."""
    return rounded(sweep(spark, sf), "fp_rate")


@query(
    f"""select case when any_ok then 'optimal' else 'nearest' end as kind, {SWEEP_COLS} from (
      select *, bool_or(fp_rate < 0.3) over () as any_ok,
        row_number() over (order by (fp_rate < 0.3) desc, clusters, threshold desc) as best,
        row_number() over (order by fp_rate, clusters, threshold) as near from sweep)
    where (any_ok and best = 1) or (not any_ok and near <= 3)""",
    "sweep",
)
def choose_threshold(spark, sf):
    """G8."""
    return rounded(review.choose_threshold(sweep(spark, sf)), "fp_rate")


@query(
    """select threshold, fp_rate > 0.3 as high_fp_rate, max_cluster_size > 50 as large_cluster from sweep
    where fp_rate > 0.3 or max_cluster_size > 50""",
    "sweep",
)
def threshold_flags(spark, sf):
    """G9."""
    return review.threshold_flags(sweep(spark, sf))


@query(
    f"""select kind, {SWEEP_COLS} from (
      select 'optimal' as kind, * from (select * from v where max_cluster_size < 40 and fp_rate < 0.3
        order by clusters, threshold limit 1) union all
      select 'smallest_max_size', * from (select * from v where not exists (
        select 1 from v where max_cluster_size < 40 and fp_rate < 0.3) order by max_cluster_size, threshold limit 1) union all
      select 'smallest_fp_rate', * from (select * from v where not exists (
        select 1 from v where max_cluster_size < 40 and fp_rate < 0.3) order by fp_rate, threshold limit 1))""".replace(
        " v ", " (select * from sweep where threshold in (0.4, 0.5, 0.6, 0.7, 0.8, 0.9)) "
    ),
    "sweep",
)
def second_choice(spark, sf):
    """G10."""
    return rounded(review.second_choice(sweep(spark, sf)), "fp_rate")


RULES = (0.6, 0.25, 2.0, 0.1)


@query(
    """select cluster_id, size, round(fp_rate, 6) as fp_rate, median_size, auto_merged, reason, profile_id_1, profile_id_2,
    similarity from rules""",
    "rules",
)
def review_rules(spark, sf):
    """Decision and reason per cluster."""
    return rounded(review.review_rules(doc_clusters(spark, sf), doc_pairs(spark, sf), *RULES), "fp_rate")


@query(
    """select count(*) as total_clusters, count(*) filter (where auto_merged) as automatically_merged_count,
    count(reason) as manual_review_count, max(median_size) as median_cluster_size, 0.6::double as optimal_threshold,
    0.25::double as fp_rate_threshold, 2.0::double as size_multiplier, 0.1::double as borderline_margin from rules""",
    "rules",
)
def review_summary(spark, sf):
    """Summary."""
    rules = review.review_rules(doc_clusters(spark, sf), doc_pairs(spark, sf), *RULES)
    return review.review_summary(rules, *RULES)


@query(
    """select cluster_id, size, round(fp_rate, 6) as fp_rate, min_similarity, max_similarity from dfacts where size > 2""",
    "dfacts",
)
def large_cluster_detail(spark, sf):
    """G12 with a size limit that documents reach."""
    out = review.large_cluster_detail(doc_clusters(spark, sf), doc_pairs(spark, sf), 0.6, 2)
    return rounded(out, "fp_rate")


@query(
    """select n_clusters, n_records, round(avg_size, 6) as avg_size, max_size, min_size, n_review, round(fp_rate, 6) as fp_rate,
      0.6::double as threshold from (
      select count(*) as n_clusters, sum(size)::bigint as n_records, avg(size) as avg_size, max(size) as max_size,
        min(size) as min_size, count(*) filter (where size > 2) as n_review,
        sum(fp_rate * total_pairs) / sum(total_pairs) as fp_rate from dfacts)""",
    "dfacts",
)
def final_report(spark, sf):
    """G13."""
    return rounded(review.final_report(doc_clusters(spark, sf), doc_pairs(spark, sf), 0.6, 2), "avg_size", "fp_rate")


@query(
    """select coalesce(a.size, b.size) as size, coalesce(n_true, 0) as n_true, coalesce(n_predicted, 0) as n_predicted from
      (select c as size, count(*) as n_true from (select count(*) as c from docs group by entity_id) where c > 1 group by 1) a
      full join (select c as size, count(*) as n_predicted from (select count(*) as c from dclusters group by cluster_id)
        where c > 1 group by 1) b on a.size = b.size""",
    "docs", "dclusters",
)
def size_truth_vs_predicted(spark, sf):
    """G14."""
    return components.size_truth_vs_predicted(I.doc_profiles(spark, sf), doc_clusters(spark, sf))


@query(
    """select s.*, a.email as email_1, b.email as email_2, a.phone as phone_1, b.phone as phone_2,
      a.first_name as first_name_1, b.first_name as first_name_2
    from (select * from scored where action in ('AUTO_MERGE', 'KEEP_SEPARATE') and prob_match >= 0.3
      order by prob_match desc, profile_id_1, profile_id_2 limit 500) s
    left join prof a on a.profile_id = profile_id_1 left join prof b on b.profile_id = profile_id_2""",
    "scored", "prof",
)
def browse_pairs(spark, sf):
    """G15."""
    return components.browse_pairs(fa_scored(spark, sf), people(spark, sf).rows, ["AUTO_MERGE", "KEEP_SEPARATE"], 0.3)


O.CTE["big50"] = (
    ["clusters"],
    """select cluster_id, count(*) as size from clusters group by 1 having count(*) > 1
    order by size desc, cluster_id limit 50""",
)


@query(
    """select c.cluster_id, p.profile_id, p.email, p.first_name, p.sex from clusters c join big50 using (cluster_id)
    join prof p on p.profile_id = c.profile_id""",
    "big50", "prof",
)
def browse_members(spark, sf):
    """Members of the fifty largest clusters."""
    clusters = fa_clusters(spark, sf)
    out = components.cluster_members(clusters, people(spark, sf).rows, components.largest_clusters(clusters))
    return out.select("cluster_id", "profile_id", "email", "first_name", "sex")


@query(
    """select s.*, a.cluster_id from scored s join clusters a on a.profile_id = profile_id_1
    join clusters b on b.profile_id = profile_id_2 and a.cluster_id = b.cluster_id""",
    "scored", "clusters",
)
def browse_inner_pairs(spark, sf):
    """Pairs inside clusters."""
    return components.pairs_in_clusters(fa_scored(spark, sf), fa_clusters(spark, sf))


@query("select profile_id, cluster_id from dclusters", "dclusters")
def incremental_components(spark, sf):
    """The close pairs first, the others added later."""
    pairs = doc_pairs(spark, sf).filter("similarity >= 0.6")
    first = components.connected_components(pairs.filter("similarity >= 0.9").select(*IDS), doc_ids(spark, sf))
    extended = components.extend_components(first, pairs.filter("similarity < 0.9").select(*IDS))
    return all_documents(spark, sf, extended)


# -- monitoring --------------------------------------------------------------------------


def sliding(minutes: int) -> str:
    """Every 30-second window of the given length that holds a row."""
    n_ = minutes * 2
    return f"""(select *, make_timestamp((epoch_us(ts) // 30000000 - i) * 30000000) as w
      from log, (select unnest(range({n_})) as i))"""


def shown(df, *cols):
    return df.select(*[text_time(c).alias(c) for c in ("window_start", "window_end")], *cols)


def spans(minutes: int) -> str:
    return f"{O.ts('w')} as window_start, {O.ts(f'w + interval {minutes} minute')} as window_end"


@query(
    f"""select {spans(5)}, stage, p95, p95 > 0.1 as breach from (
    select w, stage, quantile_disc(latency_s, 0.95) as p95 from {sliding(5)} group by 1, 2)""",
    "log",
)
def latency_p95(spark, sf):
    """T1."""
    return shown(monitor.latency_p95(I.decision_log(spark, sf)), "stage", "p95", "breach")


AVAIL = f"""select w, n_ok, n_all, round(n_ok / n_all::double, 6) as availability, n_ok / n_all::double < 0.999 as breach from (
  select w, count(*) filter (where status = 'ok') as n_ok, count(*) as n_all from {sliding(5)} group by 1)"""


@query(f"select {spans(5)}, n_ok, n_all, availability, breach from ({AVAIL})", "log")
def availability(spark, sf):
    """T2."""
    out = monitor.availability(I.decision_log(spark, sf))
    return rounded(shown(out, "n_ok", "n_all", "availability", "breach"), "availability")


@query(
    f"""select {O.ts('make_timestamp(((bucket + 300) * 1000000)::bigint)')} as at, round(h, 6) as mean_1h, round(d, 6) as mean_7d,
      round(abs(h - d), 6) as drift, coalesce(abs(h - d) > 0.05, false) as breach from (
      select bucket, sum(s) over hour / sum(n) over hour as h, sum(s) over week / sum(n) over week as d from (
        select epoch_us(ts) // 300000000 * 300 as bucket, sum(prob_match) as s, count(*) as n from log group by 1)
      window hour as (order by bucket range between 3300 preceding and 0 following),
        week as (order by bucket range between 608100 preceding and 3600 preceding))""",
    "log",
)
def probability_drift(spark, sf):
    """T3."""
    out = monitor.probability_drift(I.decision_log(spark, sf))
    return rounded(out.withColumn("at", text_time("at")), "mean_1h", "mean_7d", "drift")


@query(
    f"""select {spans(10)}, n_review, n_all, round(n_review / n_all::double, 6) as review_share,
      n_review / n_all::double > 0.3 as breach from (
      select w, count(*) filter (where action = 'REVIEW') as n_review, count(*) as n_all from {sliding(10)} group by 1)""",
    "log",
)
def review_share(spark, sf):
    """T4."""
    out = monitor.review_share(I.decision_log(spark, sf))
    return rounded(shown(out, "n_review", "n_all", "review_share", "breach"), "review_share")


@query(
    f"""select {O.ts("a + interval 5 minute")} as first_at, {O.ts("b + interval 5 minute")} as last_at, n_ticks from (
      select min(w) as a, max(w) as b, count(*) as n_ticks from (
        select w, epoch_us(w) // 30000000 - row_number() over (order by w) as island from ({AVAIL}) where breach)
      group by island) where (n_ticks - 1) * 30 >= 300""",
    "log",
)
def sustained_unavailability(spark, sf):
    """T5 on T2."""
    out = monitor.sustained(monitor.availability(I.decision_log(spark, sf)), monitor.AVAILABILITY_HOLD_S)
    return out.select(text_time("first_at").alias("first_at"), text_time("last_at").alias("last_at"), "n_ticks")


@query(
    f"""select {O.ts("make_timestamp((a * 60000000)::bigint)")} as first_at, {O.ts("make_timestamp((b * 60000000)::bigint)")} as until,
      ((b - a) * 60)::bigint as seconds from (select m + 1 as a, lead(m) over (order by m) as b from (
        select distinct epoch_us(ts) // 60000000 as m from log)) where (b - a) * 60 >= 120""",
    "log",
)
def absence(spark, sf):
    """T6."""
    out = monitor.absence(I.decision_log(spark, sf))
    return out.select(text_time("first_at").alias("first_at"), text_time("until").alias("until"), "seconds")


TUMBLING = f"""select {O.ts('w')} as window_start, {O.ts('w + interval 5 minute')} as window_end, action, count(*) as n,
  round(avg(prob_match), 6) as mean_prob from (
  select *, make_timestamp(epoch_us(ts) // 300000000 * 300000000) as w from log) group by w, action"""


@query(TUMBLING, "log")
def action_counts(spark, sf):
    """T7."""
    return rounded(shown(monitor.action_counts(I.decision_log(spark, sf)), "action", "n", "mean_prob"), "mean_prob")


def event_stream(spark, sf):
    schema = I.table(spark, sf, "events").schema
    return incremental.read_stream(spark, sf, schema, "events.parquet")


@query(TUMBLING, "log")
def action_counts_stream(spark, sf):
    """T7 as a stream, drained."""
    out = incremental.run_available(
        monitor.action_counts(I.log_of(event_stream(spark, sf))), ["window_start", "window_end", "action"]
    )
    return rounded(shown(out, "action", "n", "mean_prob"), "mean_prob")


@query(
    f"""select user_id, {O.ts('max(ts)')} as created_at, arg_max(event_type, {{'t': ts, 'e': event_id}}) as sex
    from events group by 1"""
)
def profile_stream(spark, sf):
    """Streaming collapse, drained: last known value per profile."""
    rows = event_stream(spark, sf).select(
        F.col("user_id").alias("profile_id"), F.col("ts").alias("created_at"), F.col("event_type").alias("sex"), "event_id"
    )
    state = collapse.last_known(rows, ["sex"], "created_at", "event_id")
    out = incremental.run_available(state, ["profile_id"])
    return out.select(F.col("profile_id").alias("user_id"), text_time("created_at").alias("created_at"), "sex")


O.CTE["recent"] = (
    ["prof"],
    """select profile_id from prof
    where created_at >= (select max(created_at) from prof) - interval 2 hour""",
)
O.CTE["recent_pairs"] = (
    ["blocks", "recent"],
    """select distinct x.profile_id as profile_id_1, y.profile_id as profile_id_2 from blocks x
    join blocks y on x.block_key = y.block_key and x.profile_id < y.profile_id
    where x.profile_id in (from recent) or y.profile_id in (from recent)""",
)


@query("select profile_id_1, profile_id_2 from recent_pairs", "recent_pairs")
def new_against_stored(spark, sf):
    """Profiles seen in the last two hours, taken as changed, against all profiles."""
    p = people(spark, sf)
    last = p.rows.agg((F.max("created_at") - F.expr("interval 2 hours")).alias("since"))
    recent = p.rows.join(F.broadcast(last), F.col("created_at") >= F.col("since")).select("profile_id")
    keys = blocking.block_keys(p.rows, p.tokens)
    return incremental.new_pairs(
        keys.join(recent, "profile_id", "left_semi"), keys, config.MAX_BLOCK_PROFILES, config.SITE_STOP_DF
    )


DRIFTED = ("first_name", "email", "phone", "birthday")


@query(
    " union all ".join(
        f"""select '{c}' as field, round(avg(({c} is null)::int) filter (where d < 15), 6) as baseline,
        round(avg(({c} is null)::int) filter (where d >= 15), 6) as current,
        round(avg(({c} is null)::int) filter (where d >= 15) - avg(({c} is null)::int) filter (where d < 15), 6) as change
        from (select *, day(created_at) as d from raw)"""
        for c in DRIFTED
    ),
    "raw",
)
def null_share_drift(spark, sf):
    """First half of the month against the second."""
    rows = raw(spark, sf)
    day = F.dayofmonth("created_at")
    out = monitor.null_share_drift(rows.filter(day < 15), rows.filter(day >= 15), DRIFTED)
    return rounded(out, "baseline", "current", "change")


@query(
    """select overlap, round(coalesce(count(*) filter (where is_match = 0) / max(t0), 0), 6) as baseline,
      round(coalesce(count(*) filter (where is_match = 1) / max(t1), 0), 6) as current from (
      select f.overlap_any_site as overlap, l.is_match from feats f join labels_fa l
        on l.profile_id_1 = f.profile_id_1 and l.profile_id_2 = f.profile_id_2),
      (select count(*) filter (where is_match = 0)::double as t0, count(*) filter (where is_match = 1)::double as t1 from labels_fa)
    group by overlap""",
    "feats", "labels_fa",
)
def overlap_drift(spark, sf):
    """Overlap distribution of two sets of pairs."""
    pairs = fa_features(spark, sf)
    out = monitor.overlap_drift(pairs.filter("is_match = 0"), pairs.filter("is_match = 1"))
    return rounded(out, "baseline", "current")


@query(
    """select split_part(messy_email, '@', -1) as email_domain, count(*) as n_rows from contacts
    where messy_email is not null and split_part(messy_email, '@', -1) not in (
      select email_domain from flat where email_domain is not null) group by 1""",
    "contacts", "flat",
)
def unseen_domains(spark, sf):
    """Domains of the raw contact strings that the profile events do not have."""
    current = I.messy_contacts(spark, sf).select(n.email_domain(F.col("messy_email")).alias("email_domain"))
    return monitor.unseen_domains(I.records(spark, sf), current)
