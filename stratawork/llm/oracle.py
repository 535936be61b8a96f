"""SQL (DuckDB) for the queries here that SQL can express."""

from __future__ import annotations

from stratawork.llm.quality_rules import STOP_FORMS, SYMBOLS, THRESHOLDS

_WORD = r"[^\x20\x09-\x0D]+"

OP1 = """with d as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
m as (select *, payload_bytes >= 100 and page_id <> min(page_id) over (partition by payload_digest) as again, min(page_id) over (partition by payload_digest) as first from d)
select page_id, payload_bytes, payload_digest, case when again then 'revisit' else 'response' end as record_type, case when again then first end as refers_to from m"""

OP5 = """with recursive v as (select vec_id, label, cast(embedding as double[]) as e from embeddings where embedding is not null and label is not null),
l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.93),
r as (select a, b from l union select r.a, l.b from r join l on r.b = l.a),
c as (select e.vec_id, coalesce(n, 0) as n_links, least(e.vec_id, coalesce(m, e.vec_id)) as component_id from embeddings e left join (select a, count(*) as n from l group by a) on a = e.vec_id left join (select a as k, min(b) as m from r group by a) on k = e.vec_id)
select vec_id, n_links, component_id, vec_id = component_id as kept from c"""

OP8 = rf"""with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as w from documents),
p as (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from w where len(w) > 0),
s as (select distinct doc_id, array_to_string(list_slice(w, i, i + 4), ' ') as g from p),
n as (select doc_id, count(*) as n from s group by 1),
b as (select x.doc_id as a, y.doc_id as b, count(*) as shared from s x join s y on x.g = y.g and x.doc_id <> y.doc_id group by 1, 2),
l as (select a, b from b join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= 75 * (x.n + y.n - shared)),
r as (select a, b from l union select r.a, l.b from r join l on r.b = l.a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) as component_id from documents d left join n on n.doc_id = d.doc_id left join (select a, min(b) as m from r group by 1) on a = d.doc_id"""


def _verdict() -> str:
    parts = [f"{t.measure} >= {t.low}" for t in THRESHOLDS if t.low is not None] + [f"{t.measure} <= {t.high}" for t in THRESHOLDS if t.high is not None]
    return " and ".join(parts)


_STOPS = ", ".join(f"'{w}'" for w in STOP_FORMS)
OP10 = rf"""with t as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, regexp_extract_all(t, '{_WORD}') as w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as ls from t),
g as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from w where len(w) >= 3)),
h as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from g) where n > 1),
c as (select doc_id, count(distinct i + k) as n_repeat_words from h cross join (values (0), (1), (2)) o(k) group by 1),
m as (select w.doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars, length(regexp_replace(t, '[^{SYMBOLS}]+', '', 'g')) as n_symbols, len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
len(ls) as n_lines, len(list_filter(w, lambda x: x in ({_STOPS}))) as n_stop, length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) as n_upper, length(regexp_replace(t, '\P{{L}}+', '', 'g')) as n_letters from w left join c on c.doc_id = w.doc_id),
q as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, case when n_words > 0 then word_chars / n_words else 0.0 end as mean_word_length, case when n_words > 0 then n_symbols / n_words else 0.0 end as symbols_per_word, case when n_words > 0 then n_stop / n_words else 0.0 end as stop_word_ratio,
case when word_chars > 0 then n_letters / word_chars else 0.0 end as letter_ratio, case when n_letters > 0 then n_upper / n_letters else 0.0 end as upper_ratio, case when n_lines > 0 then n_dup_lines / n_lines else 0.0 end as dup_line_ratio, case when n_words > 0 then n_repeat_words / n_words else 0.0 end as repeat_word_ratio from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and {_verdict()} as kept, mean_word_length, symbols_per_word, stop_word_ratio, letter_ratio, upper_ratio, dup_line_ratio from q"""


def _clusters(k: int = 40, rounds: int = 5) -> str:
    near = lambda c: f"select v.id, v.nth, v.q, arg_min(c.c, [list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), c.c]) as c from v cross join {c} c group by v.id, v.nth, v.q"
    parts = [f"""a{n} as materialized ({near(f"c{n}")}),
s{n} as (select c, list(s order by i) as q from (select c, i, cast(floor(sum(x) // count(*)) - case when sum(x) % count(*) < 0 then 1 else 0 end as bigint) as s from (select c, unnest(q) as x, generate_subscripts(q, 1) as i from a{n}) group by c, i) group by c),
c{n + 1} as materialized (select c, coalesce(s.q, b.q) as q from c{n} b left join s{n} s using (c))""" for n in range(rounds)]
    return f"""with v as materialized (select vec_id as id, row_number() over () as nth, list_transform(cast(embedding as double[]), lambda x: cast(floor(256 * x) as bigint)) as q from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
c0 as materialized (select row_number() over (order by sha256('2:' || cast(id as varchar)), q) - 1 as c, q from v where id is not null qualify c < {k}),
{(","+chr(10)).join(parts)},
f as ({near(f"c{rounds}")}),
d as materialized (select f.id, f.c, list_sum(list_transform(list_zip(f.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as distance, sha256(array_to_string(c.q, ',')) as s from f join c{rounds} c using (c))
select id as vec_id, cast(c as int) as cluster, cast(distance as bigint) as distance, cast(sum(distance) over (partition by c) as bigint) as cluster_inertia, cast(sum(distance) over () as bigint) as inertia, s as centroid_sha256 from d"""


OP13 = """with d as (select doc_id, encode(coalesce(text, '')) as b, hex(encode(coalesce(text, ''))) as x from documents),
w as (select doc_id, p, array_slice(b, p + 1, p + 100) as s from (select doc_id, b, unnest(range(0, octet_length(b) - 99)) as p from d where octet_length(b) >= 100)),
r as (select doc_id, p from (select doc_id, p, row_number() over (partition by s order by doc_id, p) as nth from w) where nth > 1),
g as (select doc_id, p, lag(p) over (partition by doc_id order by p) as before, lead(p) over (partition by doc_id order by p) as after from r),
e as (select doc_id, p, before is null or p > before + 100 as opens, after is null or after > p + 100 as closes from g),
o as (select doc_id, p as s, row_number() over (partition by doc_id order by p) as k from e where opens),
c as (select doc_id, p + 100 as e, row_number() over (partition by doc_id order by p) as k from e where closes),
t as (select doc_id, s, e, k, coalesce(lag(e) over (partition by doc_id order by k), 0) as kept_from from o join c using (doc_id, k)),
a as (select doc_id, sum(e - s) as n_removed, count(*) as n_spans, max(e) as last, string_agg(substr(x, 2 * kept_from + 1, 2 * (s - kept_from)), '' order by k) as x from t join d using (doc_id) group by doc_id)
select d.doc_id, octet_length(b) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(a.x, '') || substr(d.x, 2 * coalesce(last, 0) + 1))) as kept_sha256 from d left join a using (doc_id)"""


def _tree(table: str, key: str, levels: int) -> str:
    """Common table expressions ``{table}1`` and so on: the nodes of each level over ``{table}0`` (key, i, h, m) with their preimage; what is alone stays as it is."""
    return ",\n".join(
        f"{table}{n + 1} as materialized (select {key}, i // 16 as i, case when any_value(m) > 1 then sha256(string_agg(h, '' order by i)) else any_value(h) end as h, any_value(m) > 1 as grown, string_agg(h, '' order by i) as pre, (any_value(m) + 15) // 16 as m from {table}{n} group by {key}, i // 16)"
        for n in range(levels)
    )


def _merkle(levels: int = 6, upper: int = 4) -> str:
    part = lambda c: f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"
    head = " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars"))
    crc = "xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::bigint)), lambda a, b: list_reduce(list_prepend(xor(a, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"
    steps = [f"p{n} as (select p.* exclude (proof, folded), p.proof || case when u.grown then substr(u.pre, 1, 64 * slot) || substr(u.pre, 64 * slot + 65) else '' end as proof, case when u.grown then sha256(substr(u.pre, 1, 64 * slot) || folded || substr(u.pre, 64 * slot + 65)) else folded end as folded from (select *, {slot} as slot, {at} as up from p{n - 1}) p join {t} u on {on})".replace("p.* exclude (proof, folded)", "p.* exclude (proof, folded, slot, up)") for n, (t, slot, at, on) in enumerate(
        [(f"n{k + 1}", f"(i // {16**k}) % 16", f"i // {16 ** (k + 1)}", "u.s = p.s and u.i = p.up") for k in range(levels)] + [(f"r{k + 1}", f"(s // {16**k}) % 16", f"s // {16 ** (k + 1)}", "u.z = 0 and u.i = p.up") for k in range(upper)], 1)]
    return f"""with d as (select *, {crc} % 5 = 0 as fifth, dense_rank() over (order by source nulls first) - 1 as s from documents),
l as materialized (select doc_id, s, sha256({head} || {part("text")}) as h, case when fifth then sha256({head} || {part("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) end as changed from d),
n0 as materialized (select *, row_number() over (partition by s order by doc_id nulls first, h) - 1 as i, count(*) over (partition by s) as m from l),
{_tree("n", "s", levels)},
r0 as materialized (select 0 as z, s as i, h, count(*) over () as m from n{levels}),
{_tree("r", "z", upper)},
p0 as (select doc_id, s, i, h, '' as proof, coalesce(changed, h) as folded from n0),
{(","+chr(10)).join(steps)}
select p.doc_id, p.h as leaf, b.h as subroot, t.h as root, sha256(p.proof) as proof_sha256, p.folded as folded_root, p.folded = t.h as verified from p{levels + upper} p join r0 b on b.i = p.s cross join r{upper} t"""


def statements() -> dict[str, str]:
    return {"op1_warc_revisits": OP1, "op5_pq_near_vectors": OP5, "op8_jaccard_join": OP8, "op10_quality_rules": OP10, "op11_elkan_clusters": _clusters(), "op12_merkle_paths": _merkle(), "op13_suffix_repeats": OP13}
