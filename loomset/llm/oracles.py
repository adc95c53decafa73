"""DuckDB SQL for the numbered queries that SQL can express."""

from __future__ import annotations

_WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"

OP6 = rf"""
with docs as (
  select doc_id, source, {_WORDS} as size,
         md5('mix:' || coalesce(cast(doc_id as varchar), '-')) as key
  from documents),
totals as (select source, cast(sum(size) as bigint) as source_size from docs group by source),
weighted as (
  select source, source_size, source_size * 2.0::double as cap,
         (row_number() over (order by source nulls last) - 1) % 3 as turn,
         (sum(source_size) over ()) * 1.5::double as budget from totals),
ranked as (
  select *, case turn when 0 then 3 when 1 then 1 else 2 end as weight,
         row_number() over (order by source nulls last) as nr from weighted),
levels as (
  select *, (budget - coalesce(sum(cap) over (order by cap / weight, nr rows between unbounded preceding and 1 preceding), 0))
            / sum(weight) over (order by cap / weight, nr rows between current row and unbounded following) as level
  from ranked),
plan as (
  select source, source_size,
         least(cap, coalesce(max(case when level <= cap / weight then level end) over (), 0) * weight) as target
  from levels),
running as (
  select d.doc_id, d.size, p.source_size, p.target, cast(floor(p.target + 0.5) as bigint) as budget,
         cast(sum(d.size) over (partition by d.source order by d.key, d.size
              rows between unbounded preceding and current row) as bigint) - d.size as start
  from docs d join plan p on d.source is not distinct from p.source),
rounds as (
  select *, case when source_size > 0 then budget // source_size else 0 end as n from running)
select doc_id, cast(size as bigint) as size, source_size, cast(target as double) as target,
       cast(n * size + greatest(0, least(size, budget - n * source_size - start)) as bigint) as taken
from rounds
"""

OP8 = """
with docs as (select doc_id, coalesce(text, '') as text from documents)
select doc_id, max(doc_id) over (partition by text) as keep_id,
       count(*) over (partition by text) as group_size,
       doc_id = max(doc_id) over (partition by text) as kept,
       sha256(text) as text_sha256
from docs
"""

OP11 = r"""
with pieces as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w, row_number() over () as p
  from (select coalesce(lang, 'und') as lang,
               unnest(regexp_split_to_array(
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[.,;:!?\x0A-\x0D]')) as piece
        from documents)),
words as (select lang, p, unnest(w) as word, generate_subscripts(w, 1) as i from pieces),
suffixes as (
  select lang, word as w1, lead(word, 1) over piece as w2, lead(word, 2) over piece as w3
  from words window piece as (partition by p order by i)),
counts as (
  select lang, w1 as phrase, 1 as size, count(*) as f from suffixes group by all
  union all
  select lang, w1 || ' ' || w2, 2, count(*) from suffixes where w2 is not null group by all
  union all
  select lang, w1 || ' ' || w2 || ' ' || w3, 3, count(*) from suffixes where w3 is not null group by all),
candidates as (
  select lang, phrase, size, f as a, string_split(phrase, ' ') as w from counts where size > 1 and f >= 10),
cuts as (
  select lang, phrase, size, a, 1 as k, w[1] as first, array_to_string(w[2:], ' ') as rest from candidates
  union all
  select lang, phrase, size, a, 2, w[1] || ' ' || w[2], w[3] from candidates where size = 3),
scored as (
  select c.lang, c.phrase, c.a, c.k, x.f as l, y.f as r,
         (1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f) as score
  from cuts c join counts x on x.lang = c.lang and x.phrase = c.first
              join counts y on y.lang = c.lang and y.phrase = c.rest),
weakest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
longer as (
  select lang, w[1] || ' ' || w[2] as phrase, a from candidates where size = 3
  union all
  select lang, w[2] || ' ' || w[3], a from candidates where size = 3),
kept as (
  select * from weakest s
  where not exists (select 1 from longer o where o.lang = s.lang and o.phrase = s.phrase and 100 * o.a >= 50 * s.a)),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r,
       (select cast(sum(c.f) as bigint) from counts c where c.size = 1 and c.lang = ranked.lang) as n,
       cast(score as bigint) as score
from ranked where rank <= 2000
"""

ORACLES: dict[str, str] = {"op6_mix_sources": OP6, "op8_exact_dedup": OP8, "op11_collocations": OP11}
