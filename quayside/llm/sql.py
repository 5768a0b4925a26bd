"""DuckDB SQL for the queries of the training-data operators that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_verdicts(rules, tracking) -> str:
    """Aliases by canonical form only: the given pages declare no links."""
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    names = ", ".join(f"'{t}'" for t in tracking)
    return rf"""
with rules(rh, rp, said) as (values {values}),
base as (
  select page_id, url,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), '{UPPER}', '{LOWER}') as host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*[^?#]*(\?[^#]*)', 1, 's'), '') as query from pages),
numbered as (
  select *, row_number() over () as rid, case when host <> '' then host || regexp_replace(path, '/+$', '') ||
    case when len(list_filter(string_split(query[2:], '&'), lambda q: q <> '' and split_part(q, '=', 1) not in ({names}))) > 0
      then '?' || array_to_string(list_sort(list_filter(string_split(query[2:], '&'),
        lambda q: q <> '' and split_part(q, '=', 1) not in ({names}))), '&') else '' end end as form from base),
ruled as (
  select rid, arg_max(rh || rp, (length(rh) + length(rp), length(rh), said = 'block')) as rule,
    arg_max(said, (length(rh) + length(rp), length(rh), said = 'block')) as said
  from numbered join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by rid),
judged as (select n.*, rule, said from numbered n left join ruled using (rid)),
heard as (select form, min(said) as heard from judged where said is not null group by form)
select page_id, host, path, rule, coalesce(said, heard, 'allow') as verdict,
  said is null and heard is not null as inherited
from judged left join heard using (form)"""


def quality_measures(rules) -> str:
    phrases = " or ".join(f"contains(lower(line), '{p}')" for p in rules.BOILERPLATE)
    symbols = r"len(regexp_extract_all({}, '[#*$%&|<>]'))"
    return rf"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as text, {WORDS} as words from documents),
w as (select rid, unnest(words) as word, unnest(range(len(words))) as i, len(words) as n, words from d),
t as (select rid, i, array_to_string(words[i + 1:i + 3], ' ') as tri from w where i + 3 <= n),
twice as (select rid, tri from t group by all having count(*) > 1),
hits as (select rid, count(distinct i + k) as n_repeat_words from t join twice using (rid, tri), range(3) r(k) group by rid),
l as (select rid, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as pos from d),
full_lines as (select rid, pos, line, {WORDS.replace("coalesce(text, '')", "line")} as own,
  row_number() over (partition by rid, line order by pos) as turn from l where regexp_matches(line, '[^\x20\x09-\x0D]')),
judged as (select *, ({phrases}
  or 100 * len(list_filter(own, lambda x: x in ('|', '>'))) >= {rules.SEPARATOR_SHARE} * len(own)
  or ({symbols.format('line')} >= 3 and 100 * {symbols.format('line')} > {rules.SYMBOL_SHARE} * len(own))
  or (len(regexp_extract_all(line, '[A-Z]')) >= 5
      and len(regexp_extract_all(line, '[A-Z]')) > len(regexp_extract_all(line, '[a-z]')))
  or (len(own) < 3 and not regexp_matches(own[-1], '[.!?:;")\x27\]]$'))) as failed,
  length(array_to_string(own, '')) as chars from full_lines),
lines as (select rid, count(*) as n_lines, count(*) filter (failed) as n_failed_lines,
  coalesce(sum(chars) filter (failed), 0)::bigint as lost_chars, count(*) filter (turn > 1) as n_dup_lines
  from judged group by rid),
m as (select doc_id, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
  {symbols.format('text')} as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
  coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_lines, 0) as n_lines,
  coalesce(n_failed_lines, 0) as n_failed_lines, coalesce(lost_chars, 0) as lost_chars
  from d left join lines using (rid) left join hits using (rid)),
f as (select *, n_words < {rules.MIN_WORDS} or 100 * n_repeat_words > {rules.MAX_REPEATED} * n_words as base_failed from m)
select *, not base_failed and 100 * lost_chars <= {rules.MAX_LOST} * word_chars as kept from f"""


NEAR = rf"""
with recursive d as (select doc_id, {WORDS.replace("coalesce(text, '')", f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} as w
  from documents),
s as (select distinct doc_id, case when len(w) < 5 then array_to_string(w, ' ')
    else array_to_string(w[i + 1:i + 5], ' ') end as g
  from d, range(greatest(len(w) - 4, 1)) r(i) where len(w) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as shared from s a join s b using (g) where a.doc_id <> b.doc_id group by all),
links as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b
  where 100 * shared >= 75 * (x.n + y.n - shared)),
reach(a, b) as (select doc_id, doc_id from n union select r.a, l.b from reach r join links l on l.a = r.b),
c as (select a as doc_id, min(b) as component_id from reach group by a)
select doc_id, coalesce(n, 0) as n_shingles, coalesce(component_id, doc_id) as component_id,
  doc_id = coalesce(component_id, doc_id) as kept
from documents left join n using (doc_id) left join c using (doc_id)"""

PHRASES = rf"""
with d as (select doc_id, {WORDS} as w from documents),
x as (select doc_id, i, array_to_string(w[i + 1:i + 13], ' ') as p from d, range(greatest(len(w) - 12, 0)) r(i)),
least_ as (select p, min(doc_id) as first from x group by p),
gone as (select distinct doc_id, i + k as i from x join least_ using (p), range(13) r(k) where first < doc_id),
words as (select doc_id, unnest(w) as word, unnest(range(len(w))) as i from d),
kept as (select doc_id, string_agg(word, ' ' order by i) as text from words anti join gone using (doc_id, i) group by doc_id),
removed as (select doc_id, count(*) as n_removed from gone group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(text, '')) as kept_sha256
from d left join removed using (doc_id) left join kept using (doc_id)"""


FILTER_AUDIT = rf"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, {WORDS} as w from documents),
first as (select t, min(doc_id) as least from d group by t),
m as (select doc_id, part, case when len(w) < 100 then 'A' else '' end
    || case when 100 * len(list_distinct(w)) < 80 * len(w) then 'B' else '' end
    || case when 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) then 'C' else '' end
    || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
    || case when doc_id > least then 'E' else '' end as fails
  from d join first using (t)),
l as (select doc_id, coalesce(max(quality = 1), false) as good, coalesce(max(toxic = 1), false) as toxic from labels group by doc_id),
c as (select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
  from m left join l using (doc_id) group by all),
f(x) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
o as (select a.x || b.x || c.x || d.x || e.x as filter_order from f a, f b, f c, f d, f e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s as (select filter_order, step, substr(filter_order, step, 1) as own, substr(filter_order, 1, step - 1) as before
  from o, (select unnest(range(1, 6))::int as step)),
x as (select *, contains(fails, own) as failed, translate(before, fails, '') = before as reached from c, s)
select part, filter_order, step,
  coalesce(sum(n) filter (reached and not failed), 0)::bigint as kept,
  coalesce(sum(n) filter (reached and failed), 0)::bigint as removed,
  coalesce(sum(n) filter (failed and not reached), 0)::bigint as redundant,
  coalesce(sum(n) filter (fails = own), 0)::bigint as unique_fails,
  coalesce(sum(good) filter (reached and failed), 0)::bigint as good_lost,
  coalesce(sum(toxic) filter (reached and failed), 0)::bigint as toxic_lost,
  coalesce(sum(n * 120 // greatest(length(fails), 1)) filter (failed), 0)::bigint as shapley
from x group by all"""


NEAR_EMBEDDINGS = """
with recursive v as (select row_number() over () as rid, vec_id, label, embedding::double[] as e from embeddings),
good as (select * from v where label is not null and vec_id is not null and len(e) > 0
  and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
half as (select a.rid as a, b.rid as b from good a join good b on a.label = b.label and a.rid < b.rid and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.98),
links as (select a, b from half union all select b, a from half),
n as (select a as rid, count(*) as n_links from links group by a),
reach(a, b) as (select rid, rid from v union select r.a, l.b from reach r join links l on l.a = r.b),
c as (select a as rid, min(vec_id) as component_id from reach join v on v.rid = b group by a)
select vec_id, coalesce(n_links, 0)::bigint as n_links, component_id, vec_id is null or vec_id = component_id as kept
from v join c using (rid) left join n using (rid)"""


def _weight(path: list[str], weights) -> str:
    out = "1"
    for names, value in weights.items():
        if len(names) <= len(path):
            cols = path[len(path) - len(names):]
            test = " and ".join(f"{c} = '{n}'" for c, n in zip(cols, names))
            out = f"case when {test} then {value} else {out} end"
    return out


def _divide(nodes: str, parent: list[str], name: str) -> str:
    """Water-filling by order of room for each unit of weight; ``nodes`` has cap, w and budget."""
    family = f"partition by {', '.join(parent)}" if parent else ""
    before = f"({family} order by ratio, {name} rows between unbounded preceding and 1 preceding)"
    whole = f"({family})"
    return f"""
(select * exclude (uw, ratio, filled, rest, open_, share),
   least(cap, share + case when uw > 0 and not filled and sum(case when uw > 0 and not filled then 1 else 0 end)
     over ({family} order by {name} rows unbounded preceding)
     <= rest - coalesce(sum(case when uw > 0 and not filled then share end) over {whole}, 0) then 1 else 0 end)::bigint as quota
 from (select *, case when filled then cap when uw > 0 then (rest::hugeint * uw) // open_ else 0 end as share
 from (select *, greatest(budget - coalesce(sum(case when filled then cap end) over {whole}, 0), 0) as rest,
   coalesce(sum(case when not filled then uw end) over {whole}, 0) as open_
 from (select *, uw > 0 and cap::hugeint * (sum(uw) over {whole} - coalesce(sum(uw) over {before}, 0))
     <= greatest(budget - coalesce(sum(case when uw > 0 then cap end) over {before}, 0), 0)::hugeint * uw as filled
 from (select *, case when uw > 0 then (cap::hugeint * 1000000) // uw end as ratio
 from (select *, case when cap > 0 then w else 0 end as uw from {nodes}))))))"""


def mixing(weights, share_percent: int, max_epochs: int, seed: int) -> str:
    top = f"(select *, {_weight(['domain'], weights)} as w from tops, (select sum(tokens) * {share_percent} // 100 as budget from leaves))"
    mid = f"(select m.*, q.quota as budget, {_weight(['m.domain', 'language'], weights)} as w from mids m join t1 q using (domain))"
    low = (f"(select l.*, q.quota as budget, {_weight(['l.domain', 'l.language', 'leaf'], weights)} as w "
           "from leaves l join t2 q using (domain, language))")
    return rf"""
with base as (select doc_id, coalesce('d' || (ascii(right(source, 1)) % 4), '(none)') as domain,
    coalesce(lang, '(none)') as language, coalesce(source, '(none)') as leaf, lang, source, len({WORDS}) as n from documents),
leaves as (select domain, language, leaf, sum(n)::bigint as tokens, (sum(n) * {max_epochs})::bigint as cap from base group by all),
mids as (select domain, language, sum(cap)::bigint as cap from leaves group by all),
tops as (select domain, sum(cap)::bigint as cap from mids group by all),
t1 as {_divide(top, [], 'domain')},
t2 as {_divide(mid, ['domain'], 'language')},
t3 as {_divide(low, ['domain', 'language'], 'leaf')},
ordered as (select b.*, quota, tokens, quota // tokens as whole, quota - quota // tokens * tokens as rest,
    sum(n) over (partition by domain, language, leaf order by
      md5('{seed}:' || (quota // tokens + 1) || ':' || doc_id)) as used
  from base b join t3 using (domain, language, leaf) where n > 0 and tokens > 0)
select doc_id, domain, lang, source, n as n_tokens, quota as leaf_quota,
  (whole + case when used <= rest then 1 else 0 end)::bigint as epochs
from ordered where whole + case when used <= rest then 1 else 0 end > 0"""
