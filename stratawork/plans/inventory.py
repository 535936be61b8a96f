"""Queries of file inventories: paths, roll-up, skip rules, types, triage and column comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratawork.functions import columns as C
from stratawork.operators import joins, mail, profile, rollup, rules, windows
from stratawork.plans.registry import MARKED_SQL, marked, registrar

QUERIES, query = registrar()

_EXT = "case doc_id % 8 when 0 then '.pdf' when 1 then '.csv' when 2 then '.jpg' when 3 then '.exe' when 4 then '.tmp' when 5 then '.eml' when 6 then '' else '.docx' end"
_NAME = f"(case when doc_id % 19 = 0 then '~$' when doc_id % 23 = 0 then '.' else '' end || 'f' || doc_id || {_EXT})"
_DIR = "('root/' || lang || case when doc_id % 4 > 0 then '/' || source else '' end || case when doc_id % 4 > 1 then '/d' || (doc_id % 5) else '' end)"
_FILES = f"(select doc_id, n_chars, {_DIR} as dir, {_NAME} as name from documents)"
_FAMILY = "case doc_id % 8 when 0 then 'document' when 7 then 'document' when 1 then 'spreadsheet' when 2 then 'image' when 5 then 'email' when 3 then 'executable' else 'other' end"


def _files(documents):
    return documents.select("doc_id", "n_chars", F.expr(_DIR).alias("dir"), F.expr(_NAME).alias("name"))


@query("""with p as (select page_id, regexp_replace(url, '^[a-z]+://', '') as path from pages) select page_id, path from p where not exists (select 1 from (values ('m.'), ('www.')) e(x) where false)
and not exists (select 1 from (select distinct split_part(regexp_replace(url, '^[a-z]+://', ''), '/', 1) as h from pages where page_id % 10 = 0) where lower(path) = lower(h) or starts_with(lower(path), lower(h) || '/'))""")
def path_exclusion(pages):
    p = pages.select("page_id", F.regexp_replace("url", "^[a-z]+://", "").alias("path"))
    hosts = p.filter("page_id % 10 = 0").select(F.split("path", "/")[0].alias("path"))
    return joins.exclude_paths(p, "path", hosts).select("page_id", "path")


@query(f"""select doc_id, case when doc_id % 8 = 3 then 'family:executable' when doc_id % 19 = 0 then 'lock_file' when doc_id % 23 = 0 then 'hidden' when doc_id % 8 = 4 then 'system' else '' end as reason from {_FILES}""")
def skip_reason(documents):
    f = _files(documents)
    return f.select("doc_id", rules.skip_reason(F.concat("dir", F.lit("/"), F.col("name"))).alias("reason"))


@query(f"select doc_id, {_FAMILY} as family, case when {_EXT} = '' then '(none)' else substr({_EXT}, 2) end as extension from documents")
def family_lookup(documents):
    p = _files(documents).select("doc_id", F.concat("dir", F.lit("/"), F.col("name")).alias("p"))
    return p.select("doc_id", rules.family(F.col("p")).alias("family"), C.extension(F.col("p"), dot=False).alias("extension"))


@query(f"select family, count(*) as n, string_agg(distinct ext, ';' order by ext) as extensions from (select {_FAMILY} as family, {_EXT} as ext from documents) where ext <> '' group by 1")
def family_counts(documents):
    p = _files(documents).select(F.concat("dir", F.lit("/"), F.col("name")).alias("p"))
    g = p.select(rules.family(F.col("p")).alias("family"), C.extension(F.col("p")).alias("ext")).filter("ext <> ''")
    return g.groupBy("family").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("ext")), ";").alias("extensions"))


@query(f"""with f as (select dir, count(*) as c, sum(n_chars) as s from {_FILES} group by 1), a as (select array_to_string(list_slice(string_split(dir, '/'), 1, i), '/') as d, dir, c, s from (select *, unnest(range(1, len(string_split(dir, '/')) + 1)) as i from f))
select d as path, case when contains(d, '/') then regexp_replace(d, '/[^/]*$', '') else '' end as parent, len(string_split(d, '/')) - 1 as depth, cast(sum(case when d = dir then c else 0 end) as bigint) as direct_count, cast(sum(case when d = dir then s else 0 end) as bigint) as direct_size,
cast(sum(c) as bigint) as total_count, cast(sum(s) as bigint) as total_size from a group by 1, 2, 3""")
def tree_rollup(documents):
    f = _files(documents)
    dirs = f.select(F.explode(C.ancestors(F.col("dir"))).alias("path")).distinct()
    t = rollup.tree(dirs, f, "dir", "n_chars")
    return t.withColumn("depth", F.col("depth").cast("bigint"))


@query("select doc_id, case when n_chars < 1024 then printf('%.1f B', cast(n_chars as double)) else printf('%.1f KB', floor(n_chars / 1024.0 * 10 + 0.5) / 10) end as size, round(n_chars / 1048576.0, 6) as size_mb from documents")
def human_size(documents):
    return documents.select("doc_id", C.human_size(F.col("n_chars")).alias("size"), F.round(F.col("n_chars") / F.lit(1048576.0), 6).alias("size_mb"))


_TYPED = "(text || case doc_id % 10 when 0 then ' Invoice' when 1 then ' claim for long-term care' when 2 then ' coverage CLAIM' when 3 then ' restatement' when 4 then ' trust and trustee' when 5 then ' a trust' when 6 then ' premium' when 7 then ' policy, long-term care' when 8 then ' claim' else '' end)"
_HITS = "(case when doc_id % 10 = 8 then 'LTC;x' when doc_id % 17 = 0 then 'invoice' else '' end)"


@query(f"""select doc_id, case when contains(l, 'invoice') then 'Invoice' when contains(l, 'claim') and (contains(l, 'long-term care') or contains(l, 'ltc')) then 'LTC_Claim' when (contains(l, 'benefit') or contains(l, 'coverage')) and contains(l, 'claim') then 'LTC_Claim'
when contains(l, 'amendment') or contains(l, 'restatement') then 'Trust_Document' when contains(l, 'trust') then 'Trust_Document' when contains(l, 'premium') or (contains(l, 'policy') and contains(l, 'long-term care')) then 'Insurance_Policy' else '' end as doc_type,
case when contains(l, 'invoice') or (contains(l, 'claim') and (contains(l, 'long-term care') or contains(l, 'ltc'))) then '' when (contains(l, 'benefit') or contains(l, 'coverage')) and contains(l, 'claim') then '' when contains(l, 'amendment') or contains(l, 'restatement') then 'Amendment' else '' end as subtype,
case when contains(l, 'invoice') then 'medium' when contains(l, 'claim') and (contains(l, 'long-term care') or contains(l, 'ltc')) then 'medium' when (contains(l, 'benefit') or contains(l, 'coverage')) and contains(l, 'claim') then 'low' when contains(l, 'amendment') or contains(l, 'restatement') then 'medium'
when contains(l, 'trust') and (contains(l, 'trustee') or contains(l, 'beneficiary') or contains(l, 'fiduciary')) then 'medium' when contains(l, 'trust') then 'low' when contains(l, 'premium') or (contains(l, 'policy') and contains(l, 'long-term care')) then 'low' else '' end as confidence from (select doc_id, lower({_TYPED}) || ' ' || lower({_HITS}) as l from documents)""")
def doc_type_rules(documents):
    d = documents.select("doc_id", rules.doc_type(F.expr(_TYPED), F.expr(_HITS)).alias("t"))
    return d.select("doc_id", "t.doc_type", "t.subtype", "t.confidence")


_SIGNALS = f"""(select doc_id, case when contains(lower(t), 'license') or contains(lower(t), 'copyright') then 'Trust_Document' else '' end as dt, case when doc_id % 7 = 0 then 'Y' else 'N' end as money, case when doc_id % 11 = 0 then 'Y' else 'N' end as dated,
case when contains(lower(t), ' the ') then 'Y' else 'N' end as kw, case when doc_id % 6 = 0 then 'Y' else 'N' end as ocr from (select doc_id, {MARKED_SQL} as t from documents))"""
_SCORE = "(case when dt = 'Trust_Document' then 25 else 0 end + case when money = 'Y' then 20 else 0 end + case when dated = 'Y' then 10 else 0 end + case when kw = 'Y' then 15 else 0 end + case when ocr = 'Y' then 5 else 0 end)"


@query(f"""select doc_id, score, band, case when band = 'Medium' and ocr = 'Y' then 'OCR then review' when band = 'High' then 'Review now' when band = 'Medium' then 'Review' when band = 'Low' then 'Sample' else 'Archive' end as next_step, reasons from (select doc_id, ocr, {_SCORE} as score,
case when {_SCORE} >= 60 then 'High' when {_SCORE} >= 35 then 'Medium' when {_SCORE} >= 10 then 'Low' else 'Skip' end as band, concat_ws(';', case when dt = 'Trust_Document' then 'DocType=Trust_Document' end, case when money = 'Y' then 'Money=Y' end, case when dated = 'Y' then 'Date=Y' end, case when kw = 'Y' then 'Keyword=Y' end, case when ocr = 'Y' then 'OCR=Y' end) as reasons from {_SIGNALS})""")
def triage_band(documents):
    low = F.lower(marked())
    yes = lambda c: F.when(c, "Y").otherwise("N")
    d = documents.select(
        "doc_id", F.when(low.contains("license") | low.contains("copyright"), "Trust_Document").otherwise("").alias("dt"), yes(F.col("doc_id") % 7 == 0).alias("money"),
        yes(F.col("doc_id") % 11 == 0).alias("dated"), yes(low.contains(" the ")).alias("kw"), yes(F.col("doc_id") % 6 == 0).alias("ocr"),
    )
    s = {"DocType": F.col("dt"), "Money": F.col("money"), "Date": F.col("dated"), "Keyword": F.col("kw"), "OCR": F.col("ocr")}
    d = d.withColumn("score", rules.triage_score(s)).withColumn("reasons", rules.reasons(s)).withColumn("band", joins.band_of(F.col("score"), rules.BANDS))
    return d.select("doc_id", "score", "band", rules.next_step(F.col("band"), F.col("ocr")).alias("next_step"), "reasons")


@query("""select doc_id, min(doc_id) over () as first_blank from documents where doc_id < (select coalesce(min(doc_id), 9223372036854775807) from documents where doc_id % 97 = 96 and 2 * doc_id > (select max(doc_id) from documents)) and doc_id % 3 <> 0""")
def stage_gate(documents):
    """A blank cell in the second half of the table ends the stage."""
    top = F.broadcast(documents.agg(F.max("doc_id").alias("top")))  # one row, as below
    blank = documents.select("doc_id").crossJoin(top).filter("doc_id % 97 = 96 and 2 * doc_id > top")
    stop = blank.agg(F.coalesce(F.min("doc_id"), F.lit(2**63 - 1)).alias("stop"))
    d = documents.select("doc_id").crossJoin(F.broadcast(stop)).filter("doc_id < stop and doc_id % 3 <> 0").select("doc_id")
    return d.crossJoin(F.broadcast(d.agg(F.min("doc_id").alias("first_blank"))))


@query("""select conv_id, case when bool_and(length(text) >= 50) then 'N' when bool_or(length(text) >= 50) then 'PARTIAL' else 'Y' end as needs_ocr from conversations group by 1""")
def page_density(conversations):
    return rules.page_density(conversations.select("conv_id", F.length("text").alias("n")), "conv_id", "n")


@query("select conv_id, coalesce(sum(case when turn < 5 then length(text) end), 0) >= 100 as has_text_layer, min(case when length(text) < 100 then turn end) as first_low_page from conversations group by 1")
def text_layer(conversations):
    n = F.length("text")
    return conversations.groupBy("conv_id").agg((F.coalesce(F.sum(F.when(F.col("turn") < 5, n)), F.lit(0)) >= 100).alias("has_text_layer"), F.min(F.when(n < 100, F.col("turn"))).alias("first_low_page"))


_ORIGINAL = "(?i)\\n-----Original Message-----"
_COLS = f"""(select doc_id, text as c1, t as c2, case when doc_id % 3 = 0 then '' else regexp_replace(string_split_regex(chr(10) || t, '{_ORIGINAL}')[1], '^\\s+|\\s+$', '', 'g') end as c3, regexp_replace(t, '^\\s+|\\s+$', '', 'g') as c4 from (select *, {MARKED_SQL} as t from documents))"""


def _compared(documents):
    """The text, the marked text, its cut body (none for some) and the marked text trimmed, each whole."""
    d = documents.select("doc_id", F.col("text").alias("c1"), marked().alias("c2"))
    return d.select("*", F.when(F.col("doc_id") % 3 == 0, "").otherwise(mail.cut(F.col("c2"), mail.ORIGINAL)).alias("c3"), F.regexp_replace("c2", mail.ENDS, "").alias("c4"))


_CODE = f"""(select doc_id, m, concat(case when c1 = '' then 'E' when c1 = m then 'Y' else 'N' end, case when c2 = '' then 'E' when c2 = m then 'Y' else 'N' end, case when c3 = '' then 'E' when c3 = m then 'Y' else 'N' end, case when c4 = '' then 'E' when c4 = m then 'Y' else 'N' end) as code from
(select c.*, (select v from (select v, count(*) as n, min(p) as p from (select unnest([c1, c2, c3, c4]) as v, unnest([1, 2, 3, 4]) as p) where v <> '' group by v) order by n desc, p limit 1) as m from {_COLS} c))"""


@query(f"select doc_id, m as majority, code, case when not contains(code, 'N') and not contains(code, 'E') then 'ALL_MATCH' when not contains(code, 'N') then 'MATCH (some empty)' when length(replace(replace(code, 'N', ''), 'E', '')) <= 1 then 'NONE_MATCH' else 'PARTIAL' end as flag from {_CODE}")
def majority_vote(documents):
    c = ["c1", "c2", "c3", "c4"]
    d = _compared(documents).select("doc_id", profile.voted(c).alias("v")).select("doc_id", "v.majority", "v.code")
    return d.withColumn("flag", profile.flag(F.col("code")))


@query(f"select code, count(*) as n from {_CODE} group by 1")
def match_code(documents):
    return _compared(documents).groupBy(profile.code(["c1", "c2", "c3", "c4"]).alias("code")).agg(F.count("*").alias("n"))


@query(f"""select col, count(*) filter (where len = lo) as shortest, count(*) filter (where len = hi) as longest, round(avg(len), 4) as average from (select *, min(len) over (partition by doc_id) as lo, max(len) over (partition by doc_id) as hi from
(select doc_id, unnest(['c1', 'c2', 'c3', 'c4']) as col, nullif(length(unnest([c1, c2, c3, c4])), 0) as len from {_COLS}) where len is not null) group by 1""")
def shortest_longest(documents):
    n = {c: F.nullif(F.length(c), F.lit(0)) for c in ("c1", "c2", "c3", "c4")}
    lo, hi = F.least(*n.values()), F.greatest(*n.values())
    long = _compared(documents).select(lo.alias("lo"), hi.alias("hi"), F.explode(F.array(*(F.struct(F.lit(c).alias("col"), v.alias("len")) for c, v in n.items()))).alias("x")).select("lo", "hi", "x.col", "x.len").filter("len is not null")
    return long.groupBy("col").agg(F.count_if(F.col("len") == F.col("lo")).alias("shortest"), F.count_if(F.col("len") == F.col("hi")).alias("longest"), F.round(F.avg("len"), 4).alias("average"))


@query("""select user_id, level from (select user_id, max(case event_type when 'click' then 1 when 'view' then 2 when 'purchase' then 3 else 0 end) as level from events group by 1) where level >= 2""")
def level_coverage(events):
    level = F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "view", 2).when(F.col("event_type") == "purchase", 3).otherwise(0)
    return events.groupBy("user_id").agg(F.max(level).alias("level")).filter("level >= 2")


@query("select doc_id, sha256(text) as sha, dense_rank() over (order by sha256(text)) as g, count(*) over (partition by sha256(text)) as copies from documents")
def exact_groups(documents):
    h = documents.select("doc_id", F.sha2("text", 256).alias("sha"))
    keys = h.groupBy("sha").agg(F.count("*").alias("copies"))
    return h.join(windows.numbered(keys, ["sha"], "g"), "sha").select("doc_id", "sha", "g", "copies")
