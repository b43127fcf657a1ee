"""The same results in DuckDB SQL, written independently of the Spark jobs.

Nested fields are taken apart by unnesting and grouping, set sizes by joins of the
long token table, components by a recursive query.
"""

from __future__ import annotations

from kinfold.config import DEFAULT_SCHEMA as S
from kinfold.functions import normalize as n

from .inputs import CONTACT_RULES, DOC_SIMILAR_FROM, RAW_RULES

SETS = S.site_sets
FS_KEYS = list(S.fs_keys) + [c.removeprefix("fs_") for c in SETS]
SWEEP = (0.05, 0.1, 0.2, 0.4, 0.6, 0.8, 0.9)


def comma(items) -> str:
    return ", ".join(items)


def ts(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f')"


def long_tokens(source: str, col: str) -> str:
    quoted = "'''[^'']*''|\"[^\"]*\"'"
    return f"""select e, i, case when strpos(t, ':') > 0 then split_part(t, ':', 1) else t end as k,
      case when strpos(t, ':') > 0 then substr(t, strpos(t, ':') + 1) end as v
    from (select e, substr(q, 2, length(q) - 2) as t, i
          from (select event_id as e, unnest(l) as q, generate_subscripts(l, 1) as i
                from (select event_id, regexp_extract_all({col}, {quoted}) as l from {source}
                      where regexp_matches({col}, '^\\s*\\['))))"""


def first_of(key: str) -> str:
    return f"arg_min(coalesce(v, 'True'), i) filter (where k = '{key}')"


def joined_of(key: str) -> str:
    return f"string_agg(coalesce(v, 'True'), '|' order by i) filter (where k = '{key}')"


def components(edges: str, nodes: str, name: str) -> dict[str, tuple[list[str], str]]:
    """Label propagation over ``edges(a, b)``: the smallest reachable node."""
    return {
        f"{name}_bi": ([edges], f"select a, b from {edges} union all select b, a from {edges}"),
        f"{name}": (
            [f"{name}_bi", nodes],
            f"""(select id, id as lab from {nodes}
            union
            select x.id, x.lab from (
              select e.b as id, min(c.lab) as lab from {name} c join {name}_bi e on e.a = c.id
              join recurring.{name} r on r.id = e.b group by e.b, r.lab having min(c.lab) < r.lab) x)""",
        ),
    }


def average_linkage(pairs: str, nodes: str, levels: str, name: str) -> dict[str, tuple[list[str], str]]:
    """One merge at a time: the pair of clusters with the highest mean similarity, of equal ones the smallest; states follow each other."""
    unit = 1 << 30
    mean = "w / (na * nb)::double"
    best = f"""(select t, a, b, na + nb as n from (
        select *, row_number() over (partition by t order by {mean} desc, a, b) as r from {name} where kind = 'e')
      where r = 1 and {mean} > floor(t * {unit} + 0.5))"""
    return {
        f"{name}_nodes": ([nodes, levels], f"select t, id from {nodes}, {levels}"),
        name: (
            [pairs, levels],
            f"""select 'e' as kind, t, profile_id_1 as a, profile_id_2 as b, floor(similarity * {unit} + 0.5)::bigint as w,
              1::bigint as na, 1::bigint as nb from {pairs} join {levels} on similarity >= t
            union all
            select * from (
              select 'e' as kind, t, least(p, q) as a, greatest(p, q) as b, sum(w)::bigint as w,
                max(case when p < q then np else nq end)::bigint as na, max(case when p < q then nq else np end)::bigint as nb
              from (select e.t, case when e.a = m.b then m.a else e.a end as p, case when e.b = m.b then m.a else e.b end as q, e.w,
                  case when e.a = m.a or e.a = m.b then m.n else e.na end as np,
                  case when e.b = m.a or e.b = m.b then m.n else e.nb end as nq
                from {name} e join {best} m on m.t = e.t where e.kind = 'e' and not (e.a = m.a and e.b = m.b))
              group by t, least(p, q), greatest(p, q)
              union all select 'm', t, a, b, 0::bigint, 0::bigint, 0::bigint from {best})""",
        ),
        f"{name}_chain": (
            [name, f"{name}_nodes"],
            f"""select t, id, id as lab from {name}_nodes union all
            select c.t, c.id, m.a from {name}_chain c join {name} m on m.kind = 'm' and m.t = c.t and m.b = c.lab""",
        ),
        f"{name}_clusters": (
            [f"{name}_chain"],
            f"select t as threshold, id as profile_id, min(lab) as cluster_id from {name}_chain group by 1, 2",
        ),
        f"{name}_documents": (
            [f"{name}_clusters", "dmember"],
            f"select threshold, m.profile_id, cluster_id from {name}_clusters c join dmember m on m.class_id = c.profile_id",
        ),
    }


def kiloblocks(keys: str, max_block: int, stop: int) -> str:
    return f"""select block_key, profile_id from (
      select *, count(*) over (partition by block_key) as s,
        row_number() over (partition by block_key
          order by md5('0|' || block_key || '|' || profile_id), profile_id) as r from {keys})
    where s >= 2 and not (starts_with(block_key, 'site::') and s > {stop}) and r <= {max_block}"""


def pairs_of(blocks: str) -> str:
    return f"""select distinct x.profile_id as profile_id_1, y.profile_id as profile_id_2
    from {blocks} x join {blocks} y on x.block_key = y.block_key and x.profile_id < y.profile_id"""


def set_classes(sets: str) -> str:
    """Profiles with equal token sets, and the smallest of them."""
    return f"""select profile_id, min(profile_id) over (partition by k) as class_id, size from (
      select profile_id, string_agg(length(token) || ':' || token, '' order by token) as k, count(*) as size
      from {sets} group by profile_id)"""


def similar_sets(sets: str, classes: str, least: float) -> str:
    """All pairs of classes that share any token, from a similarity on: brute force, no blocking."""
    first = f"(select profile_id, size, token from {sets} join {classes} using (profile_id) where profile_id = class_id)"
    return f"""select * from (
      select x.profile_id as profile_id_1, y.profile_id as profile_id_2, count(*) as n,
        count(*) / (any_value(x.size) + any_value(y.size) - count(*))::double as similarity
      from {first} x join {first} y on x.token = y.token and x.profile_id < y.profile_id group by 1, 2)
    where similarity >= {least}"""


def features_sql(pairs: str) -> str:
    cols = ["q.profile_id_1", "q.profile_id_2"]
    for c in S.match + S.match_ids + ("email_domain",):
        cols.append(
            f"case when a.{c} is null or b.{c} is null then -1 when a.{c} = b.{c} then 1 else 0 end as match_{c}"
        )
    for c in S.diffs:
        cols.append(f"abs(try_cast(a.{c} as double) - try_cast(b.{c} as double)) as diff_{c}")
    cols.append(
        "abs(floor((epoch_us(a.created_at) - epoch_us(b.created_at)) / 86400000000.0))::bigint as diff_created_days"
    )
    any_site = []
    for c in SETS:
        has = f"za.{c} is not null and zb.{c} is not null"
        cols.append(
            f"case when {has} then coalesce(o.{c}, 0) / (za.{c} + zb.{c} - coalesce(o.{c}, 0))::double else -1.0 end"
            f" as jaccard_{c}"
        )
        cols.append(f"case when {has} then coalesce(o.{c}, 0) else -1 end as overlap_{c}")
        any_site.append(f"coalesce(o.{c}, 0)")
    cols.append("(" + " + ".join(any_site) + ")::bigint as overlap_any_site")
    sums = comma(f"max(s) filter (where set_col = '{c}') as {c}" for c in SETS)
    return f"""with z as (select profile_id, {sums} from (
        select profile_id, set_col, count(*) as s from tokens group by all) group by profile_id),
      o as (select profile_id_1, profile_id_2, {sums} from (
        select p.profile_id_1, p.profile_id_2, x.set_col, count(*) as s from {pairs} p
        join tokens x on x.profile_id = p.profile_id_1
        join tokens y on y.profile_id = p.profile_id_2 and y.set_col = x.set_col and y.token = x.token
        group by all) group by all)
    select {comma(cols)} from {pairs} q
      left join prof a on a.profile_id = q.profile_id_1 left join prof b on b.profile_id = q.profile_id_2
      left join z za on za.profile_id = q.profile_id_1 left join z zb on zb.profile_id = q.profile_id_2
      left join o on o.profile_id_1 = q.profile_id_1 and o.profile_id_2 = q.profile_id_2"""


def action(p: str, auto: float, review: float) -> str:
    return f"case when {p} >= {auto} then 'AUTO_MERGE' when {p} >= {review} then 'REVIEW' else 'KEEP_SEPARATE' end"


def labelled(pairs: str, people: str) -> str:
    return f"""select p.*, case when a.entity_id = b.entity_id then 1 else 0 end as is_match from {pairs} p
    left join {people} a on a.profile_id = profile_id_1 left join {people} b on b.profile_id = profile_id_2"""


def unit(seed: int, expr: str) -> str:
    return f"(('0x' || substr(md5('{seed}|' || {expr}), 1, 12))::bigint::double / {float(16**12)!r})"


CTE: dict[str, tuple[list[str], str]] = {
    "num": (
        [],
        """select event_id as e, ts, user_id as u, user_id // 3 as g,
        json_extract_string(props, '$.k')::bigint as k,
        (user_id // 3 + case when user_id % 3 = 2 then 1 else 0 end) % 4 as d from events""",
    ),
    "raw": (
        ["num"],
        f"""select {comma(f'{rule} as {name}' for name, rule in RAW_RULES.items())},
        case when u % 20 = 0 then date '1970-01-01'
          + (case when g % 30 = 0 then 0 else g * 17 % 9000 end)::integer end as birthday from num""",
    ),
    "contacts": (["num"], f"select {comma(f'{rule} as {name}' for name, rule in CONTACT_RULES.items())} from num"),
    "npl": (["raw"], long_tokens("raw", "non_processing_features")),
    "fsl": (["raw"], long_tokens("raw", "fs_features")),
    "np": (["npl"], f"select e, {comma(f'{first_of(k)} as np_{k}' for k in S.np_keys)} from npl group by e"),
    "fs": (["fsl"], f"select e, {comma(f'{joined_of(k)} as fs_{k}' for k in FS_KEYS)} from fsl group by e"),
    "rt": (
        ["raw"],
        "select event_id as e, "
        + comma(f"json_extract_string(j, '$.{k}') as rt_{k}" for k in S.rt_keys)
        + ", json_extract_string(j, '$.place.city') as place_city, json_extract_string(j, '$.place.zone') as place_zone"
        + ", json_extract_string(j, '$.city') as rt_city"
        + " from (select event_id, try_cast(realtime_features as json) as j from raw)",
    ),
    "flat": (
        ["raw", "np", "rt", "fs"],
        """select raw.* exclude (non_processing_features, realtime_features, fs_features),
        np.* exclude (e), rt.* exclude (e), fs.* exclude (e),
        split_part(raw.email, '@', -1) as email_domain
        from raw left join np on np.e = event_id left join rt on rt.e = event_id left join fs on fs.e = event_id""",
    ),
    "tokens": (
        ["fsl", "raw"],
        f"""select distinct profile_id, set_col, token from (
          select e, 'fs_' || k as set_col, unnest(string_split(t, '|')) as token from (
            select e, k, string_agg(coalesce(v, 'True'), '|' order by i) as t,
              count(*) as c, count(v) as cv from fsl
            where 'fs_' || k in ({comma(f"'{c}'" for c in SETS)}) group by e, k)
          where t <> '' and not (c = 1 and cv = 0)) join raw on event_id = e""",
    ),
    "ordered": (
        ["flat"],
        """select *, epoch_us(coalesce(created_at, timestamp '9999-01-01'))::hugeint * 1000000000 + event_id as o
        from flat""",
    ),
    "prof": (
        ["ordered"],
        f"""select profile_id, max(created_at) as created_at,
        {comma(f'arg_max({c}, o) filter (where {c} is not null) as {c}' for c in S.scalars + ('entity_id',))},
        split_part(arg_max(email, o) filter (where email is not null), '@', -1) as email_domain
        from ordered group by profile_id""",
    ),
    "keys": (
        ["prof", "tokens"],
        """select 'dom::' || email_domain as block_key, profile_id from prof where email_domain is not null
        union all select 'phone::' || phone, profile_id from prof where phone is not null
        union all select 'name::' || first_name || '::' || rt_geoid, profile_id from prof
          where first_name is not null and rt_geoid is not null
        union all select distinct 'site::' || token, profile_id from tokens""",
    ),
    "blocks": (["keys"], kiloblocks("keys", 300, 150)),
    "blocks_small": (["keys"], kiloblocks("keys", 20, 60)),
    "pairs": (["blocks"], pairs_of("blocks")),
    "labels_fa": (["pairs", "prof"], labelled("pairs", "prof")),
    "truth": (
        ["prof"],
        """select entity_id, count(*) as n_profiles, (count(*) * (count(*) - 1) // 2)::bigint as n_true_pairs
        from prof where entity_id is not null group by entity_id""",
    ),
    "feats": (["pairs", "prof", "tokens"], features_sql("pairs")),
    "scored": (
        ["feats"],
        f"""select *, {action('prob_match', 0.8, 0.6)} as action from (
        select profile_id_1, profile_id_2, (2 * least(greatest(overlap_fs_visited_365, 0), 3)
        + greatest(match_first_name, 0) + greatest(match_rt_geoid, 0) + greatest(match_sex, 0)
        + greatest(match_email_domain, 0)) / 10.0::double as prob_match from feats)""",
    ),
    "auto_edges": (["scored"], "select profile_id_1 as a, profile_id_2 as b from scored where action = 'AUTO_MERGE'"),
    "fa_nodes": (["prof"], "select profile_id as id from prof"),
    **components("auto_edges", "fa_nodes", "cc"),
    "clusters": (["cc"], "select id as profile_id, lab as cluster_id from cc"),
    "records": (
        ["raw"],
        """select *, 'r_' || lpad(event_id::varchar, 9, '0') as record_id, split_part(email, '@', -1) as email_domain,
        strftime(created_at, '%Y-%m-%d') as date, hour(created_at) as hour, isodow(created_at) - 1 as day_of_week
        from raw""",
    ),
    "time_keys": (
        ["records"],
        """select 'time::' || date || '_' || hour as block_key, record_id from records where created_at is not null
        union all select 'day::day_' || day_of_week, record_id from records where created_at is not null""",
    ),
    "hash_keys": (
        ["records"],
        """select 'hash::' || substr(md5(list_aggregate(list_sort(list_filter([email_domain, sex,
          non_processing_features, realtime_features, fs_features, date, hour::varchar, day_of_week::varchar],
          lambda x: x is not null and x <> '')), 'string_agg', '_')), 1, 8) as block_key, record_id from records""",
    ),
    "domain_keys": (
        ["records"],
        "select 'dom::' || email_domain as block_key, record_id from records where email_domain is not null",
    ),
    "priority_keys": (
        ["time_keys", "hash_keys", "domain_keys"],
        "select * from domain_keys union all select * from time_keys union all select * from hash_keys",
    ),
    "chunks": (
        ["priority_keys"],
        """select block_key as whole_key, record_id, n as whole_size,
          block_key || '#' || (case when n * (n - 1) / 2 > 10000 then (r - 1) // 142 else 0 end) as block_key
        from (select *, count(*) over (partition by block_key) as n,
          row_number() over (partition by block_key order by record_id) as r from priority_keys)""",
    ),
    "docs": (
        [],
        """select 'd_' || lpad(doc_id::varchar, 9, '0') as profile_id, md5(text) as entity_id,
        source as email_domain, lang as sex, n_chars, text from documents""",
    ),
    "dtok": (
        ["docs"],
        """select distinct profile_id, token from (
        select profile_id, unnest(string_split_regex(lower(text), '\\s+')) as token from docs) where token <> ''""",
    ),
    "dcls": (["dtok"], set_classes("dtok")),
    "dmember": (
        ["docs", "dcls"],
        """select profile_id, coalesce(class_id, profile_id) as class_id
        from (select distinct profile_id from docs) left join dcls using (profile_id)""",
    ),
    "dsim": (["dtok", "dcls"], similar_sets("dtok", "dcls", DOC_SIMILAR_FROM)),
    "dnodes": (["dmember"], "select distinct class_id as id from dmember"),
    "dedges": (["dsim"], "select profile_id_1 as a, profile_id_2 as b from dsim where similarity >= 0.6"),
    **components("dedges", "dnodes", "dcc"),
    "dclusters": (["dcc", "dmember"], "select profile_id, lab as cluster_id from dmember join dcc on id = class_id"),
    "levels": ([], f"select unnest([{comma(f'{t}::double' for t in SWEEP)}]) as t"),
    "tnodes": (["dnodes", "levels"], "select {'t': t, 'id': id} as id from dnodes, levels"),
    "tedges": (
        ["dsim", "levels"],
        "select {'t': t, 'id': profile_id_1} as a, {'t': t, 'id': profile_id_2} as b from dsim join levels on similarity >= t",
    ),
    **components("tedges", "tnodes", "tcc"),
    "tclusters": (
        ["tcc", "dmember"],
        "select id.t as threshold, profile_id, lab.id as cluster_id from tcc join dmember on id.id = class_id",
    ),
    "sweep": (
        ["tclusters", "dsim"],
        """select s.threshold, clusters, records_in_clusters, avg_cluster_size, max_cluster_size,
          coalesce(fp_count, 0) as fp_count, coalesce(total_pairs, 0) as total_pairs,
          case when total_pairs > 0 then fp_count / total_pairs::double else 0.0 end as fp_rate
        from (select threshold, count(*) as clusters, sum(c)::bigint as records_in_clusters,
            round_even(avg(c), 1) as avg_cluster_size, max(c) as max_cluster_size
          from (select threshold, cluster_id, count(*) as c from tclusters group by all) group by 1) s
        left join (select a.threshold, count(*) filter (where similarity < a.threshold * 0.7) as fp_count,
            count(*) as total_pairs from dsim join tclusters a on a.profile_id = profile_id_1
            join tclusters b on b.profile_id = profile_id_2 and b.threshold = a.threshold
              and b.cluster_id = a.cluster_id group by 1) q on q.threshold = s.threshold""",
    ),
    "dfacts": (
        ["dclusters", "dsim"],
        """select s.cluster_id, s.size, coalesce(total_pairs, 0) as total_pairs, min_similarity, max_similarity,
          case when total_pairs > 0 then fp_count / total_pairs::double else 0.0 end as fp_rate, border_pair
        from (select cluster_id, count(*) as size from dclusters group by 1) s left join (
          select a.cluster_id, count(*) as total_pairs, count(*) filter (where similarity < 0.6 * 0.7) as fp_count,
            min(similarity) as min_similarity, max(similarity) as max_similarity,
            arg_min({'a': profile_id_1, 'b': profile_id_2, 's': similarity}, profile_id_1 || profile_id_2)
              filter (where similarity >= 0.6 - 0.1 and similarity < 0.6) as border_pair
          from dsim join dclusters a on a.profile_id = profile_id_1
          join dclusters b on b.profile_id = profile_id_2 and b.cluster_id = a.cluster_id group by 1) f
        on f.cluster_id = s.cluster_id""",
    ),
    "rules": (
        ["dfacts"],
        """select cluster_id, size, fp_rate, m as median_size, auto_merged, reason,
          case when reason = 'borderline_similarity' then border_pair.a end as profile_id_1,
          case when reason = 'borderline_similarity' then border_pair.b end as profile_id_2,
          case when reason = 'borderline_similarity' then border_pair.s end as similarity
        from (select *, case when not auto_merged then 'high_fp_rate_or_large_size'
            when border_pair is not null and size > 1 then 'borderline_similarity' end as reason
          from (select *, size < 2 or (fp_rate < 0.25 and size <= 2.0 * m) as auto_merged
            from dfacts, (select median(size) as m from dfacts)))""",
    ),
    "ls": (
        [],
        "select doc_id, (n_chars % 1000) / 1000.0::double as score, quality as y from labels join documents using (doc_id)",
    ),
    "curve": (
        ["ls"],
        """select score, n_pos, tp, predicted, positives, tp / predicted::double as precision,
          case when positives > 0 then tp / positives::double else 1.0 end as recall
        from (select score, n_pos, sum(n_pos) over w as tp, sum(n) over w as predicted, sum(n_pos) over () as positives
          from (select score, sum(y)::bigint as n_pos, count(*) as n from ls group by score)
          window w as (order by score desc rows unbounded preceding))""",
    ),
    "log": (
        [],
        f"""select event_id, ts, case when user_id % 10 = 0 then 'staging' else 'production' end as stage,
        case when event_type = 'error' then 'error' else 'ok' end as status, value / 1000.0::double as latency_s,
        p as prob_match, {action('p', 0.9, 0.6)} as action
        from (select *, json_extract_string(props, '$.k')::bigint / 99.0::double as p from events)""",
    ),
}


def resolve(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(name: str) -> None:
        if name in out:
            return
        for dep in CTE[name][0]:
            visit(dep)
        out.append(name)

    for name in names:
        visit(name)
    return out


def sql(final: str, *names: str) -> str:
    parts = []
    for name in resolve(list(names)):
        body = CTE[name][1]
        keyed = " using key (id)" if "recurring." in body else ""
        head = f"{name}(id, lab)" if keyed else name
        hint = "" if keyed else "materialized "
        parts.append(f"{head}{keyed} as {hint}({body})")
    return ("with recursive " + ",\n".join(parts) + "\n" if parts else "") + final
