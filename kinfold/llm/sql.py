"""DuckDB SQL of the operators that SQL can express, written from their definitions."""

MIX_SQL = r"""
with d as (
  select doc_id, source is null as no_source, coalesce(source, '') as source, md5(coalesce(text, '')) as tie,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
         length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>!]', '', 'g')) as symbols,
         (cast('0x' || substr(md5('17' || coalesce('|' || cast(doc_id as varchar), '')), 1, 12) as bigint) / 281474976710656.0
          + 1.0 / 562949953421312.0) as u
  from documents),
keyed as (
  select *, -ln(u) / ((size + 1) / cast(size + 1 + symbols as double)) as key from d),
sizes as (select no_source, source, cast(sum(size) as bigint) as source_size from d group by 1, 2),
ranked as (
  select *, [5, 2, 1][cast((row_number() over (order by no_source, source) - 1) % 3 as integer) + 1] as w, 2 * source_size as cap
  from sizes),
summed as (
  select *, sum(source_size) over () * 1.5
           - coalesce(sum(cap) over (order by cap / w, no_source, source rows between unbounded preceding and 1 preceding), 0) as rest,
         sum(w) over () - coalesce(sum(w) over (order by cap / w, no_source, source rows between unbounded preceding and 1 preceding), 0) as remaining,
         row_number() over (order by cap / w, no_source, source) as place
  from ranked),
opened as (select min(place) as place from summed where rest * w < cap * remaining),
level as (select s.rest, s.remaining, s.place from summed s join opened o on s.place = o.place),
targets as (
  select s.no_source, s.source, s.source_size,
         case when l.place is not null then l.rest * s.w / l.remaining else cast(s.cap as double) end as target
  from summed s left join level l on s.place >= l.place),
placed as (
  select k.*, t.source_size, t.target,
         case when t.source_size > 0 then cast(floor(t.target / t.source_size) as bigint) else 0 end as epochs,
         coalesce(sum(k.size) over (partition by k.no_source, k.source order by k.key, k.doc_id, k.tie, k.size
                                    rows between unbounded preceding and 1 preceding), 0) as start
  from keyed k join targets t on k.no_source = t.no_source and k.source = t.source)
select doc_id, size, source_size, target,
       cast(size * (epochs + case when start + size / 2.0 <= target - epochs * source_size then 1 else 0 end) as bigint) as taken
from placed
"""

LEAK_SQL = r"""
with words as (
  select 'd' as kind, doc_id as id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
  union all
  select 'b', item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')
  from benchmark),
starts as (
  select kind, id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from words where len(w) > 0),
grams as (
  select distinct kind, id, array_to_string(w[i : i + 4], ' ') as g from starts),
sizes as (select id, count(*) as n_shingles from grams where kind = 'b' group by id)
select d.id as doc_id, b.id as item_id, s.n_shingles, count(*) as n_shared
from grams d join grams b on d.g = b.g and d.kind = 'd' and b.kind = 'b' join sizes s on s.id = b.id
group by d.id, b.id, s.n_shingles
having count(*) * 5 >= s.n_shingles * 4
"""

LINES_SQL = r"""
with raw as (
  select row_number() over () as row, coalesce('id ' || doc_id, 'none') as doc, doc_id, text from documents),
split as (
  select row, doc, unnest(string_split(text, chr(10))) as raw, generate_subscripts(string_split(text, chr(10)), 1) as no from raw),
words as (select *, regexp_extract_all(raw, '[^\x20\x09-\x0D]+') as w from split),
masked as (
  select *, list_transform(w, lambda x: case when regexp_matches(x, '[0-9]') then '<*>' else x end) as m from words),
lines as (
  select row, doc, no, raw, case when len(list_filter(m, lambda x: x = '<*>')) > len(m) * 0.5 then w else m end as tokens from masked),
keyed as (select *, cast(len(tokens) as varchar) || ' ' || array_to_string(tokens[1:4], ' ') as leaf, array_to_string(tokens, ' ') as line from lines),
per_line as (
  select leaf, line, any_value(tokens) as tokens, count(distinct doc) as n_docs from keyed where len(tokens) > 0 group by leaf, line),
often as (select leaf from per_line group by leaf having sum(n_docs) >= 10 and min(n_docs) < 10),
looked as (select * from per_line where leaf in (select leaf from often)),
cells as (
  select leaf, line, n_docs, 'leaf ' || leaf as cell, tokens[5:] as body from looked where len(tokens) > 4
  union all
  select leaf, line, n_docs, 'next ' || leaf || chr(10) || array_to_string(tokens[5:8], ' '), tokens[9:] from looked where len(tokens) > 8
  union all
  select leaf, line, n_docs, 'last ' || leaf || chr(10) || array_to_string(tokens[-4:], ' '), tokens[5:len(tokens) - 4] from looked where len(tokens) > 8),
crowded as (select cell from cells group by cell having sum(n_docs) >= 10 and min(n_docs) < 10),
entries as (
  select leaf, line, n_docs, cell, unnest(body) as token, generate_subscripts(body, 1) as pos
  from cells where cell in (select cell from crowded)),
weighed as (select cell, pos, token, sum(n_docs) as n from entries group by cell, pos, token),
ranked as (
  select *, sum(n) over (partition by cell, pos) as all_n, row_number() over (partition by cell, pos order by n desc, token desc) as r from weighed),
marks as (
  select cell, pos, token, r = 1 and n * 2 >= all_n as top,
         case when n >= 10 then cast(floor(log2(n / 10.0::double) / 2) as integer) else -1 end as level
  from ranked),
parts as (
  select e.leaf, e.line, e.cell, e.pos, e.token, m.top, m.level, e.token <> '<*>' as is_real
  from entries e join marks m on e.cell = m.cell and e.pos = m.pos and e.token = m.token),
sized as (
  select leaf, line, cell, count(*) filter (where is_real) as n_real, count(*) filter (where is_real and top) as n_top
  from parts group by leaf, line, cell having count(*) filter (where is_real) > 0),
levels as (select distinct leaf, line, cell, level as at from parts where is_real and level >= 0),
fixed as (
  select p.leaf, p.line, p.cell, l.at,
         count(*) filter (where p.is_real and p.level >= l.at) as n_fixed,
         string_agg(case when p.level >= l.at then p.token else '<*>' end, ' ' order by p.pos) as shape
  from parts p join levels l on p.leaf = l.leaf and p.line = l.line and p.cell = l.cell group by p.leaf, p.line, p.cell, l.at),
groups as (
  select leaf, line, 'most ' || cell as grp from sized where n_top >= n_real * 0.5
  union
  select f.leaf, f.line, 'equal ' || f.cell || chr(10) || chr(10) || f.shape
  from fixed f join sized s on s.leaf = f.leaf and s.line = f.line and s.cell = f.cell where f.n_fixed >= s.n_real * 0.5),
recurring as (
  select g.leaf, g.grp from groups g join keyed k on k.leaf = g.leaf and k.line = g.line
  group by g.leaf, g.grp having count(distinct k.doc) >= 10),
bad as (
  select leaf, line from per_line where n_docs >= 10
  union
  select g.leaf, g.line from groups g join recurring r on r.leaf = g.leaf and r.grp = g.grp),
flagged as (
  select k.row, k.no, k.raw, b.line is not null as dropped from keyed k left join bad b on k.leaf = b.leaf and k.line = b.line),
cleaned as (
  select row, count(*) as n_lines, cast(count(*) filter (where dropped) as bigint) as n_dropped,
         md5(coalesce(string_agg(case when dropped then null else raw end, chr(10) order by no), '')) as kept_md5
  from flagged group by row)
select r.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_dropped, 0) as n_dropped, kept_md5 from raw r left join cleaned c on c.row = r.row
"""

MERKLE_SQL = r"""
with recursive d as (
  select doc_id, lang, n_chars,
         case when doc_id is null then '-' else strlen(cast(doc_id as varchar)) || ':' || doc_id end
         || case when source is null then '-' else strlen(source) || ':' || source end
         || case when lang is null then '-' else strlen(lang) || ':' || lang end as head,
         case when text is null then '-' else strlen(text) || ':' || text end as tail,
         list_reduce(
           list_concat([4294967295::bigint], list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint))),
           lambda a, b: list_reduce(list_concat([xor(a, b)], cast([0, 0, 0, 0, 0, 0, 0, 0] as bigint[])),
                                 lambda x, y: case when x % 2 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end)) as crc
  from documents),
hashed as (
  select doc_id, lang,
         sha256(head || case when n_chars is null then '-' else strlen(cast(n_chars as varchar)) || ':' || n_chars end || tail) as leaf,
         sha256(head || case when n_chars is null then '-' else strlen(cast(n_chars + 1 as varchar)) || ':' || (n_chars + 1) end || tail) as changed,
         xor(crc, 4294967295::bigint) % 7 = 0 as hit
  from d),
leaves as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by lang) as n
  from hashed),
low as (
  select coalesce('=' || lang, '') as g, 0 as level, cast(pos as bigint) as pos, leaf as h, cast(n as bigint) as n from leaves
  union all
  select g, level + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (n + 1) // 2 from low where n > 1 group by g, level, pos // 2, n),
subroots as (
  select g, h, row_number() over (order by g) - 1 as pos, count(*) over () as n from low where n = 1),
high as (
  select 0 as level, cast(pos as bigint) as pos, h, cast(n as bigint) as n from subroots
  union all
  select level + 1, pos // 2, sha256(string_agg(h, '' order by pos)), (n + 1) // 2 from high where n > 1 group by level, pos // 2, n),
steps as (
  select l.doc_id, l.leaf, l.lang, l.pos, l.changed, l.hit, x.level, l.pos >> x.level & 1 as side, y.h as sibling
  from leaves l
  join (select g, level, max(n) as n from low group by g, level) x on x.g = coalesce('=' || l.lang, '') and x.n > 1
  left join low y on y.g = x.g and y.level = x.level and y.pos = xor(l.pos >> x.level, 1)
  union all
  select l.doc_id, l.leaf, l.lang, l.pos, l.changed, l.hit, 1000 + x.level, s.pos >> x.level & 1, y.h
  from leaves l
  join subroots s on s.g = coalesce('=' || l.lang, '')
  join (select level, max(n) as n from high group by level) x on x.n > 1
  left join high y on y.level = x.level and y.pos = xor(s.pos >> x.level, 1)),
paths as (
  select lang, pos, string_agg(sibling, '' order by level) as siblings,
         list(case when sibling is null then '2' when side = 1 then '1' || sibling else '0' || sibling end order by level) as path
  from steps group by lang, pos),
folded as (
  select l.doc_id, l.leaf, s.h as subroot, r.h as root, sha256(coalesce(p.siblings, '')) as proof_sha256,
         list_reduce(list_concat([case when l.hit then l.changed else l.leaf end], coalesce(p.path, cast([] as varchar[]))),
                     lambda h, e: case e[1] when '0' then sha256(h || e[2:]) when '1' then sha256(e[2:] || h) else sha256(h) end) as folded_root
  from leaves l join subroots s on s.g = coalesce('=' || l.lang, '')
  join high r on r.n = 1
  left join paths p on p.lang is not distinct from l.lang and p.pos = l.pos)
select *, folded_root = root as verified from folded
"""
