"""The queries of the corpus operators over the whole tables of a folder, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontamination, language_id, line_dedup, mixing, ngram_join, quality_gam, quality_rules, suffix_lm, toxicity, url_filter
from .common import table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked(table(spark, sf_dir, "documents"), width=3, num=90, den=100)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(table(spark, sf_dir, "documents"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mixed(docs, mixing.WEIGHTS, mixing.OTHER)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judged(pages, url_filter.labels_of_pages(pages, table(spark, sf_dir, "labels")))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "doc_pos", "n_aligned", "n_equal")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_gam.scored(docs, quality_gam.fit(docs, table(spark, sf_dir, "labels")))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_lm.scored(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # which rule rejected first depends on the measured order, so it is no part of the result
    return quality_rules.apply(table(spark, sf_dir, "documents")).drop("rejected_by")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.deduplicated(docs, counts=("n_lines", "n_removed"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_ngram_jaccard_join, op2_language_id, op3_source_mixing, op4_url_filter, op5_decontamination, op6_toxicity, op7_quality_classifier, op8_lm_scoring, op9_quality_rules, op10_line_dedup)
}

#: DuckDB SQL with the same columns, where SQL can express the operator.
ORACLE_SQL: dict[str, str] = {}

_WORDS = r"""regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"""
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

#: All links, by a join on shingles; then all reachable documents.
ORACLE_SQL["op1_ngram_jaccard_join"] = rf"""with recursive
w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) < 3 then [array_to_string(ws, ' ')] else list_transform(range(1, len(ws) - 1), lambda i: ws[i]||' '||ws[i+1]||' '||ws[i+2]) end) as sh from w),
e as (select doc_id, unnest(sh) as g from s),
n as (select doc_id, len(sh) as n, md5(array_to_string(list_sort(sh), chr(10))) as same from s),
p as (select x.doc_id as a, y.doc_id as b, count(*) as c from e x join e y on x.g = y.g and x.doc_id <> y.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 90 * (x.n + y.n - c)),
r(d, c) as (select doc_id, doc_id from n union select r.d, l.b from r join l on l.a = r.c),
m as (select d, min(c) as component_id from r group by d),
k as (select same, count(*) as n_copies from n where n > 0 group by same)
select n.doc_id, n.n as n_shingles, m.component_id, coalesce(k.n_copies, 1) as n_copies from n join m on m.d = n.doc_id left join k on k.same = n.same and n.n > 0"""

ORACLE_SQL["op9_quality_rules"] = rf"""with
w as (select doc_id, coalesce(text, '') as text, {_WORDS} as ws from documents),
g as (select doc_id, i, ws[i]||' '||ws[i+1]||' '||ws[i+2] as g from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w)),
often as (select doc_id, g from g group by 1, 2 having count(*) > 1),
covered as (select doc_id, count(distinct place) as n from (select doc_id, unnest([i, i + 1, i + 2]) as place from g join often using (doc_id, g)) group by 1),
lines as (select doc_id, count(*) - count(distinct line) as n from (select doc_id, unnest(string_split(text, chr(10))) as line from w) where regexp_matches(line, '[^\x20\x09-\x0D]') group by 1),
c as (select w.doc_id, cast(len(ws) as bigint) as n_words, cast(length(array_to_string(ws, '')) as bigint) as word_chars, cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
  cast(coalesce(lines.n, 0) as bigint) as n_dup_lines, cast(coalesce(covered.n, 0) as bigint) as n_repeat_words,
  length(regexp_replace(text, '[^!?]', '', 'g')) as shouts, length(regexp_replace(text, '[^A-Z]', '', 'g')) as upper_case, length(regexp_replace(text, '[^a-z]', '', 'g')) as lower_case, length(regexp_replace(text, '[^0-9]', '', 'g')) as digits
 from w left join covered using (doc_id) left join lines using (doc_id)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from c)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 not (base_failed or 10 * n_symbols > n_words or word_chars > 15 * n_words or word_chars < 2 * n_words or 10 * n_repeat_words > 3 * n_words or 4 * shouts > n_words or upper_case > lower_case or 5 * digits > word_chars) as kept from b"""

_URL_RULES = ", ".join(f"('{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{r}', '{v}')" for r, v in url_filter.RULES)
#: All subsets of the tokens of every labelled url, instead of a pattern tree; then the same tests and pruning.
ORACLE_SQL["op4_url_filter"] = rf"""with
u as (select page_id, url, case when url like '%://%' then translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), {_LOWER}) else '' end as host,
  case when url like '%://%' then regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) else '' end as path from pages),
k as (select *, case when host = '' then [] else list_distinct(
   list_transform(list_filter(regexp_split_to_array(regexp_replace(host, '[.]?[^.]*$', ''), '[.-]'), lambda x: x <> ''), lambda x: 'h:' || x)
   || list_transform(list_filter([regexp_extract(host, '([^.]*)$', 1)], lambda x: x <> ''), lambda x: 't:' || x)
   || list_transform(list_filter(regexp_split_to_array(lower(path), '[^a-z0-9\x{{80}}-\x{{10FFFF}}]+'), lambda x: not regexp_full_match(x, '[0-9]*')), lambda x: 'p:' || x)
   || list_transform(list_filter(regexp_extract_all(url, '[?&]([^=&#]+)=', 1), lambda x: x <> ''), lambda x: 'q:' || x)
   || list_transform(list_filter([regexp_extract(path, '\.([A-Za-z]{{1,5}})$', 1)], lambda x: x <> ''), lambda x: 'e:' || x)
   || list_transform(list_filter([regexp_extract(url, '^([A-Za-z]+)://', 1)], lambda x: x <> ''), lambda x: 's:' || x)) end as tokens,
  try_cast(regexp_extract(url, '/(\d{{1,18}})[^/]*/?$', 1) as bigint) as doc from u),
marks as (select doc_id as doc, max(case when toxic = 1 or quality = 0 then 1 else 0 end) as mark from labels where doc_id is not null group by 1),
b as (select list_sort(tokens) as tokens, mark = 1 as bad from k join marks using (doc) where len(tokens) > 0 or mark = 1),
n as (select count(*) as total, count(*) filter (bad) as n_bad from b),
sub as (select bad, list_filter(tokens, lambda x, i: (mask >> (i - 1)) & 1 = 1) as items from (select bad, tokens, unnest(range(1, 1 << len(tokens))) as mask from b)),
f as (select items, count(*) as freq, count(*) filter (bad) as bad_freq from sub group by 1),
r as (select items, bad_freq / freq as confidence from f, n where bad_freq >= {url_filter.MIN_COUNT} and bad_freq >= ceil({url_filter.MIN_SUPPORT}::double * total) and bad_freq / freq >= {url_filter.MIN_CONFIDENCE}
  and bad_freq - freq * (n_bad / total) >= {url_filter.SIGMAS}::double * sqrt(freq * (n_bad / total) * (1 - n_bad / total))),
rules as (select * from r where not exists (select 1 from r as q where len(q.items) < len(r.items) and list_has_all(r.items, q.items) and q.confidence >= r.confidence)),
hits as (select k.url, count(*) as n_rules, max(confidence) as confidence from (select distinct url, tokens from k where url is not null) k join rules on list_has_all(k.tokens, rules.items) group by 1),
fixed(name, start, rule, verdict) as (values {_URL_RULES}),
fit as (select page_id, url, max_by(rule, len(rule)) as rule, max_by(verdict, len(rule)) as verdict from (select distinct page_id, url, host, path from u) u join fixed on (host = name or ends_with(host, '.' || name)) and starts_with(path, start) group by 1, 2)
select u.page_id, u.host, u.path, fit.rule, coalesce(fit.verdict, case when hits.n_rules > 0 then 'block' else 'allow' end) as verdict, coalesce(hits.n_rules, 0) as n_rules, hits.confidence
 from u left join fit on fit.page_id is not distinct from u.page_id and fit.url is not distinct from u.url left join hits on hits.url = u.url"""

_BLANKS = r"""' '||chr(9)||chr(13)||chr(11)||chr(12)"""
ORACLE_SQL["op10_line_dedup"] = f"""with
raw as (select doc_id, text, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents where text is not null),
t as (select doc_id, pos, trim(line, {_BLANKS}) as line from raw),
n as (select *, len(list_filter(string_split(line, ' '), lambda x: x <> '')) as n from t where line <> ''),
o as (select doc_id, pos as lo, line, n, lead(line) over d as b, lead(n) over d as n2, lead(pos) over d as mid, lead(line, 2) over d as c, lead(pos, 2) over d as hi from n window d as (partition by doc_id order by pos)),
win as (select doc_id, lo, hi, line||chr(10)||b||chr(10)||c as what from o where hi is not null
 union all select doc_id, lo, mid, line||chr(10)||b from o where mid is not null and n + n2 > 50
 union all select doc_id, lo, lo, line from o where n > 50),
later as (select doc_id, lo, hi from (select *, row_number() over (partition by what order by doc_id, lo) as nth from win) where nth > 1),
cut as (select distinct doc_id, unnest(range(lo, hi + 1)) as pos from later),
left_over as (select r.doc_id, string_agg(r.line, chr(10) order by r.pos) filter (c.pos is null) as kept, count(*) as n_lines, count(c.pos) as n_removed from raw r left join cut c on c.doc_id = r.doc_id and c.pos = r.pos group by r.doc_id)
select d.doc_id, case when d.text is null then null else coalesce(l.kept, '') end as text, coalesce(l.n_lines, 0) as n_lines, coalesce(l.n_removed, 0) as n_removed from documents d left join left_over l using (doc_id)"""


def _mixing_sql(weights: dict[str, int], other: int, block: int, seed: int) -> str:
    names = sorted(weights)
    parts = [weights[x] for x in names] + [other]
    period, groups = sum(parts), len(parts)
    listed = "[" + ", ".join(map(str, parts)) + "]"
    named = ", ".join(f"({g}, '{name}', {n})" for g, (name, n) in enumerate(zip([*names, "other"], parts, strict=True)))
    return f"""with recursive
g(grp, name, n) as (values {named}),
s(t, done, pick) as (
 select 0, list_transform({listed}, lambda x: 0), -1
 union all select t + 1, list_transform(done, lambda d, i: d + case when i - 1 = p then 1 else 0 end), p from (
  select t, done, list_sort(list_filter(list_transform(range(0, {groups}), lambda k: {{'due': ((done[k + 1] + 1) * {period} + {listed}[k + 1] - 1) // {listed}[k + 1], 'k': k, 'ok': done[k + 1] < {listed}[k + 1] and done[k + 1] * {period} // {listed}[k + 1] <= t}}), lambda x: x.ok))[1].k as p
  from s where t < {period})),
slots as (select t - 1 as slot, pick as grp, done[pick + 1] - 1 as nth from s where t > 0),
d as (select doc_id, source, grp, n, name, row_number() over (partition by grp order by md5('{seed}:' || coalesce(cast(doc_id as varchar), '')), doc_id) - 1 as rank
 from documents join g on g.name = case when source in ({", ".join(f"'{x}'" for x in names)}) then source else 'other' end),
b as (select *, rank // {block} as k from d),
p as (select doc_id, source, name, rank, k, k * {period} // n as release, ((k + 1) * {period} + n - 1) // n as deadline, (k // n) * {period} + slots.slot as slot from b join slots on slots.grp = b.grp and slots.nth = k % n)
select doc_id, source, name as mix_group, k as mix_block, release as mix_release, deadline as mix_deadline, slot as mix_slot, row_number() over (order by slot, rank) - 1 as mix_pos from p"""


#: Earliest deadline first as a recursion over the slots of a period.
ORACLE_SQL["op3_source_mixing"] = _mixing_sql(mixing.WEIGHTS, mixing.OTHER, mixing.BLOCK_ROWS, 7)
