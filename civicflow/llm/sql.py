"""DuckDB SQL of the queries whose whole result it can express."""

URL_FILTERS = r"""
with parts as (
  select page_id, url, regexp_extract(rest, '^[^/?#]*') as raw_host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from (select page_id, url, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages)),
named as (select page_id, url, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path from parts),
keyed as (
  select *, case when host <> '' then regexp_replace(host, '^(www|m)\.', '') || regexp_replace(regexp_replace(path, '/+$', ''), '(/index)?\.html?$', '')
    || case when len(kept) > 0 then '?' || array_to_string(list_sort(kept), '&') else '' end end as canon
  from (select *, list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '' and not regexp_matches(x, '^(utm_|ref=)')) as kept from named)),
listed as (
  select distinct canon from keyed where try_cast(regexp_extract(url, '^[^?#]*/(\d{1,18})[^/]*/?$', 1) as bigint) in (select doc_id from labels where toxic = 1) and canon is not null),
rules(rule, kind) as (values ('org/', 'allow'), ('example.org/es/', 'block'), ('example.org/en/1', 'block'), ('com/fr/', 'allow'), ('com/de/', 'block')),
fitting as (
  select page_id, arg_max((rule, kind), length(rule)) as best from keyed join rules
  on (host = split_part(rule, '/', 1) or ends_with(host, '.' || split_part(rule, '/', 1))) and starts_with(path, substr(rule, instr(rule, '/'))) group by page_id)
select k.page_id, host, path, best[1] as rule, coalesce(best[2], case when l.canon is not null then 'block' else 'allow' end) as verdict
from keyed k left join fitting f on f.page_id = k.page_id left join listed l on l.canon = k.canon
"""
QUALITY_RULES = r"""
with texts as (select doc_id, source, coalesce(text, '') as t from documents),
split as (select doc_id, source, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from texts),
windows as (select doc_id, i, w[i : i + 2] as g from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from split)),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as c from windows) where c > 1),
repeated as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from twice) group by 1),
lines as (select doc_id, count(*) - count(distinct l) as n from (select doc_id, unnest(string_split(t, chr(10))) as l from texts) where regexp_matches(l, '[^\x20\x09-\x0D]') group by 1),
measured as (
  select s.doc_id, source, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(l.n, 0) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words
  from split s left join lines l on l.doc_id = s.doc_id left join repeated r on r.doc_id = s.doc_id),
failing as (
  select *, n_symbols * 10 > n_words as f1, n_dup_lines >= 3 as f2, word_chars < 2 * n_words or word_chars > 15 * n_words as f3, 100 * n_repeat_words > 30 * n_words as f4 from measured),
hosts as (select source, count(*) as n, unnest([1, 2, 3, 4]) as r, unnest([count(*) filter (f1), count(*) filter (f2), count(*) filter (f3), count(*) filter (f4)]) as f from failing where source is not null group by source),
moments as (select r, avg(1.0 / n) as inv, avg(f / n) as m, var_pop(f / n) as v from hosts group by r),
priors as (select r, m, case when greatest(v - m * (1 - m) * inv, m * (1 - m) * 1e-3) > 0 then m * (1 - m) / greatest(v - m * (1 - m) * inv, m * (1 - m) * 1e-3) - 1 else 1e6 end as s from moments),
bad as (select source, r from hosts join priors using (r) where (f + m * greatest(2.0, s)) / (n + greatest(2.0, s)) >= 0.5),
verdicts as (select source, list(r) as rs from bad group by 1)
select doc_id, n_words, cast(word_chars as bigint) as word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and not coalesce((f1 and list_contains(rs, 1)) or (f2 and list_contains(rs, 2)) or (f3 and list_contains(rs, 3)) or (f4 and list_contains(rs, 4)), false) as kept
from failing left join verdicts using (source)
"""

ORACLE_SQL: dict[str, str] = {"op3_url_filters": URL_FILTERS, "op9_quality_rules": QUALITY_RULES}


def _product_code_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Codebooks round by round: distances of all vectors to all entries, nearest entries, floors of their means."""
    steps = [
        "kept as (select vec_id, label, list_transform(embedding, lambda x: cast(floor(4096 * cast(x as double)) as bigint)) as v from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)",
        f"c as (select vec_id, d, d // (len(v) // {parts}) as p, v[d + 1] as x from kept, unnest(range(len(v))) as t(d))",
        f"b0 as (select p, r - 1 as e, d, x from c join (select vec_id, row_number() over (order by vec_id) as r from kept) using (vec_id) where r <= {entries})",
    ]
    for k in range(rounds + 1):
        steps.append(f"n{k} as (select vec_id, p, e, t from (select c.vec_id, c.p, b.e, sum((c.x - b.x) * (c.x - b.x)) as t from c join b{k} b on c.p = b.p and c.d = b.d group by 1, 2, 3) qualify row_number() over (partition by vec_id, p order by t, e) = 1)")
        if k < rounds:
            steps.append(f"m{k} as (select c.p, n.e, c.d, sum(c.x) as s, count(*) as n from c join n{k} n using (vec_id, p) group by 1, 2, 3)")
            steps.append(f"b{k + 1} as (select b.p, b.e, b.d, cast(case when n is null then b.x else (s - ((s % n) + n) % n) // n end as bigint) as x from b{k} b left join m{k} using (p, e, d))")
    steps.append(f"coded as (select vec_id, string_agg(format('{{:02x}}', e), '' order by p) as code, cast(sum(t) as bigint) as error from n{rounds} group by 1)")
    return f"""with {", ".join(steps)}
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, (select sha256(string_agg(cast(x as varchar), ',' order by p, e, d)) from b{rounds}) as codebooks_sha256, label from coded join kept using (vec_id)"""


ORACLE_SQL["op12_vector_codes"] = _product_code_sql()
