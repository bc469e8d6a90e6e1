"""DuckDB SQL for the corpus queries that SQL expresses.

The others (language ID, token counts, fingerprints, the classifier, sharding,
packing) rest on hashes, trained models or tokenizers that SQL does not have;
the tests hold them against brute force, round trips or held-out accuracy.
"""

from __future__ import annotations

DECONTAMINATION = r"""
with doc as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
item as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
win as (
    select distinct item_id, least(len(w), 10) as size, array_to_string(w[i:i + 9], ' ') as phrase
    from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from item where len(w) > 0)),
sizes as (select distinct size from win),
spot as (
    select doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') as phrase
    from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i from doc, sizes where len(w) >= size)),
met as (select distinct doc_id, i, spot.size, item_id from spot join win using (size, phrase)),
hit as (select doc_id, count(distinct pos) as n_hit
        from (select doc_id, unnest(range(i, i + size)) as pos from met) group by doc_id),
items as (select doc_id, count(distinct item_id) as n_items,
                 sha256(string_agg(distinct item_id::varchar, ',' order by item_id::varchar)) as sha
          from met group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       coalesce(sha, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join hit using (doc_id) left join items using (doc_id)"""

SUBSTRING_DEDUP = r"""
with doc as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (
    select doc_id, i, array_to_string(w[i:i + 12], ' ') as phrase
    from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from doc where len(w) >= 13)),
first as (select phrase, min(doc_id) as least_id from win group by phrase having count(*) > 1),
gone as (
    select doc_id, list(distinct pos) as places
    from (select doc_id, unnest(range(i, i + 13)) as pos from win join first using (phrase) where doc_id > least_id)
    group by doc_id),
kept as (
    select doc_id, list(w[i] order by i) as words, count(*) as n
    from (select doc_id, w, unnest(range(1, len(w) + 1)) as i from doc) s
    where not exists (select 1 from (select doc_id, unnest(places) as pos from gone) g
                      where g.doc_id = s.doc_id and g.pos = s.i)
    group by doc_id)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed,
       sha256(coalesce(array_to_string(words, ' '), '')) as kept_sha256
from doc left join kept using (doc_id)"""

QUALITY_RULES = r"""
with doc as (
    select doc_id, coalesce(lang, 'none') as stratum, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
    from documents),
win as (
    select doc_id, i, array_to_string(w[i:i + 7], ' ') as phrase
    from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from doc where len(w) >= 8)),
twice as (select doc_id, phrase from win group by all having count(*) > 1),
again as (
    select doc_id, count(distinct pos) as n
    from (select doc_id, unnest(range(i, i + 8)) as pos from win join twice using (doc_id, phrase)) group by doc_id),
measure as (
    select doc_id, stratum, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, len(lines) as n_lines,
           (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words
    from doc left join again using (doc_id)),
judged as (
    select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from measure),
ratios as (
    select doc_id, stratum, base_failed, rule, ratio from (
        select doc_id, stratum, base_failed, 1 as rule, coalesce(n_repeat_words / nullif(n_words, 0), 0) as ratio from judged
        union all select doc_id, stratum, base_failed, 2, coalesce(n_dup_lines / nullif(n_lines, 0), 0) from judged
        union all select doc_id, stratum, base_failed, 3, coalesce(n_symbols / nullif(word_chars, 0), 0) from judged
        union all select doc_id, stratum, base_failed, 4, coalesce(word_chars / nullif(n_words, 0), 0) from judged)),
grid as (
    select 1 as rule, 0.02::double * i as cutoff from range(1, 16) t(i)
    union all select 2, 0.05::double * i from range(1, 13) t(i)
    union all select 3, 0.005::double * i from range(1, 21) t(i)
    union all select 4, 6.0::double + 0.5::double * i from range(0, 25) t(i)),
good as (
    select r.* from ratios r where not base_failed
    and doc_id in (select doc_id from labels group by doc_id having min(quality) = 1)),
test as (
    select stratum, rule, cutoff, count(*) as n, count(*) filter (where ratio > cutoff) as k
    from good join grid using (rule) group by all),
tail as (
    select *, case when k >= n * 0.01 then 1.0 else list_sum(list_transform(range(0, k + 1), lambda i:
        exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.01) + (n - i) * ln(0.99)))) end as p
    from test),
cut as (
    select stratum, rule, min(cutoff) as cutoff from tail
    where p <= 0.05 / ((select count(distinct stratum) from test) * 72) group by all),
broken as (
    select doc_id, string_agg(['repeats', 'dup_lines', 'symbols', 'word_length'][rule], ',' order by rule) as rules
    from ratios join cut using (stratum, rule) where ratio > cutoff group by doc_id)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and rules is null as kept, coalesce(rules, '') as broken_rules
from judged left join broken using (doc_id)"""

WARC = r"""
with page as (
    select page_id, coalesce(html, '') as payload from pages),
bits as (
    select page_id, payload, min(page_id) over (partition by payload) as first,
           array_to_string(list_transform(range(1, 41), lambda i:
               ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100',
                '1101', '1110', '1111'][strpos('0123456789abcdef', sha1(payload)[i])]), '') as b
    from page)
select page_id, strlen(payload)::bigint as payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
           1 + 16 * b[5 * i + 1]::int + 8 * b[5 * i + 2]::int + 4 * b[5 * i + 3]::int + 2 * b[5 * i + 4]::int
             + b[5 * i + 5]::int]), '') as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to
from bits"""

# Edges of the forms that SQL can resolve: whole URLs and paths from the root.
URL_FILTER = r"""
with recursive rules(verdict, host, path) as (
    values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
page as (
    select row_number() over () as n, page_id, url, html, case when strpos(url, '://') > 0
           then substr(url, strpos(url, '://') + 3) end as rest from pages),
part as (
    select *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path,
           regexp_extract(rest, '^[^/?#]*([^#]*)', 1) as tail from page),
tag as (
    select n, url, unnest(regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>', ' ', 'g'),
                                             '(?is)<(?:link|meta)\b[^>]*>')) as tag from page where rest is not null),
target as (
    select url, case when regexp_matches(tag, '(?is)^<link.*\brel\s*=\s*["'']?canonical')
                     then regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
                     when regexp_matches(tag, '(?is)^<meta.*\bhttp-equiv\s*=\s*["'']?refresh')
                     then regexp_extract(tag, '(?is);\s*url\s*=\s*["'']?([^"''\s>]+)', 1) end as target from tag),
whole as (
    select url, case when strpos(target, '://') > 0 then target
                     when starts_with(target, '/') then regexp_extract(url, '^.*?://[^/?#]*') || target end as target
    from target where target <> ''),
side as (select url as u, target as v from whole union all select target, url from whole),
ends as (
    select translate(regexp_extract(u, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
             || regexp_extract(u, '://[^/?#]*([^#]*)', 1) as a,
           translate(regexp_extract(v, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
             || regexp_extract(v, '://[^/?#]*([^#]*)', 1) as b
    from side where v is not null and u is not null),
fits as (
    select a, max_by(verdict, length(r.host || r.path)) as verdict
    from (select distinct a from ends) e join rules r
      on ('.' || regexp_extract(a, '^[^/?]*')) like ('%.' || r.host) and starts_with(regexp_extract(a, '^[^/?]*([^?]*)', 1), r.path)
    group by a),
reached as (
    select a from fits where verdict = 'block'
    union select ends.b from reached join ends on reached.a = ends.a),
own as (
    select n, max_by(r.host || r.path, length(r.host || r.path)) as rule, max_by(verdict, length(r.host || r.path)) as verdict
    from part join rules r on ('.' || part.host) like ('%.' || r.host) and starts_with(part.path, r.path) group by n)
select page_id, coalesce(host, '') as host, coalesce(path, '') as path, rule,
       coalesce(verdict, case when reached.a is not null then 'block' else 'allow' end) as verdict,
       rule is null and reached.a is not null as propagated
from part left join own using (n) left join reached on part.host || part.tail = reached.a"""

LEXICAL_SEARCH = r"""
with doc as (
    select row_number() over () as d, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
item as (
    select row_number() over () as i, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
query as (select i, t, count(*) as r from (select i, unnest(w) as t from item) group by all),
whole as (select count(*) filter (where len(w) > 0) as docs, sum(len(w))::bigint as words from doc),
tf as (select d, t, count(*) as tf from (select d, unnest(w) as t from doc) where t in (select t from query) group by all),
weight as (
    select t, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as wt
    from tf, whole group by t, docs),
part as (
    select d, t, wt * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(doc.w) * docs) // words))) as s
    from tf join weight using (t) join doc using (d), whole),
score as (select i, d, sum(r * s)::bigint as score from query join part using (t) group by all),
ranked as (
    select item_id, row_number() over (partition by i order by score desc, doc_id) as rank, doc_id, score
    from score join item using (i) join doc using (d) where score > 0)
select item_id, rank::integer as rank, doc_id, score from ranked where rank <= 10"""

HARD_NEGATIVES = r"""
with vec as (
    select row_number() over () as n, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
    from embeddings
    where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pair as (
    select a.n as a, a.vec_id as anchor_id, b.n as b, b.vec_id as other_id, a.label = b.label as same,
           list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::bigint as score
    from vec a join vec b on a.vec_id % 100 = 0 and a.vec_id is distinct from b.vec_id),
positive as (
    select * from (select *, row_number() over (partition by a order by score desc, other_id) as p from pair where same)
    where p <= 5),
negative as (
    select p.anchor_id, p.other_id as positive_id, p.score as positive_score, n.other_id as negative_id,
           n.score as negative_score, row_number() over (partition by p.a, p.p order by n.score desc, n.other_id) as rank
    from positive p join pair n on p.a = n.a and not n.same
    where 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score)
select anchor_id, positive_id, rank::integer as rank, negative_id, positive_score, negative_score
from negative where rank <= 5"""

ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": DECONTAMINATION,
    "op2_substring_dedup": SUBSTRING_DEDUP,
    "op3_quality_rules": QUALITY_RULES,
    "op4_warc_dictionary": WARC,
    "op11_url_filter": URL_FILTER,
    "op12_lexical_search": LEXICAL_SEARCH,
    "op13_hard_negatives": HARD_NEGATIVES,
}
