"""Queries of scans, projections, filters, joins, aggregates, set operations and upserts."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratawork.functions import columns as C
from stratawork.operators import dedup, joins, windows
from stratawork.operators import keyed_table as T
from stratawork.operators import upsert as U
from stratawork.plans.registry import registrar
from stratawork.session import own_folder
from stratawork.sources import sinks

QUERIES, query = registrar()


@query("""select content_key, doc_id, source, n_chars, copies from (select sha256(text) as content_key, doc_id, source, n_chars,
row_number() over (partition by sha256(text) order by source desc, n_chars desc, doc_id) as rn, count(*) over (partition by sha256(text)) as copies from documents) where rn = 1""")
def dedup_winner(documents):
    # the winner as the greatest (source, n_chars, -doc_id): one aggregate with partial sums, no sort of whole groups
    best = F.max(F.struct("source", "n_chars", (-F.col("doc_id")).alias("o")))
    d = documents.select(F.sha2("text", 256).alias("content_key"), "doc_id", "source", "n_chars")
    g = d.groupBy("content_key").agg(best.alias("b"), F.count("*").alias("copies"))
    return g.select("content_key", (-F.col("b.o")).alias("doc_id"), "b.source", "b.n_chars", "copies")


@query("""with k as (select case when doc_id % 3 = 0 then 'first' when doc_id % 3 = 1 then 'second' else 'none' end as key_type,
case when doc_id % 3 = 0 then sha256(text) when doc_id % 3 = 1 then '<' || (doc_id % 40) || '@x.org>' else cast(doc_id as varchar) end as key, doc_id, source, n_chars from documents),
r as (select *, row_number() over (partition by key_type, key order by source desc, n_chars desc, doc_id) rn, count(*) over (partition by key_type, key) n from k)
select key_type, doc_id, source, n as group_size from r where rn = 1""")
def dedup_two_keys(documents):
    sha, mid = F.when(F.col("doc_id") % 3 == 0, F.sha2("text", 256)), F.when(F.col("doc_id") % 3 == 1, F.concat(F.lit("<"), F.col("doc_id") % 40, F.lit("@x.org>")))
    d = dedup.two_key(documents, sha, mid, F.col("doc_id")).select("key_type", "key", "doc_id", "source", "n_chars")
    g = d.groupBy("key_type", "key").agg(F.max(F.struct("source", "n_chars", (-F.col("doc_id")).alias("o"))).alias("b"), F.count("*").alias("group_size"))
    return g.select("key_type", (-F.col("b.o")).alias("doc_id"), "b.source", "group_size")


@query("""select sha256(text) as content_key, count(*) as n, min(doc_id) as winner, string_agg(distinct source, ';' order by source) as sources from documents group by 1 having count(*) > 1""")
def dedup_report(documents):
    d = documents.select(F.sha2("text", 256).alias("content_key"), "doc_id", "source")
    return dedup.groups(d, ["content_key"], F.min("doc_id"), ["source"])


@query("select content_key, winner, doc_id as loser from (select sha256(text) as content_key, doc_id, min(doc_id) over (partition by text) as winner from documents where text is not null) where doc_id <> winner")
def dedup_losers(documents):
    """Each document that a copy with a smaller id beat, and which."""
    d = documents.select(F.sha2("text", 256).alias("content_key"), "doc_id")
    return dedup.losers(d, ["content_key"], F.min("doc_id"), "doc_id")


@query("select lower(p_name) as name_key, min(p_partkey) as p_partkey from part group by 1")
def first_wins_distinct(part):
    return dedup.first_wins(part.select("p_name", "p_partkey"), F.lower("p_name"), "p_partkey").select(F.lower("p_name").alias("name_key"), "p_partkey")


@query("select p_partkey, p_name from (select *, row_number() over (partition by lower(p_name) order by p_partkey desc) rn from part) where rn = 1")
def last_spelling_wins(part):
    return part.groupBy(F.lower("p_name")).agg(F.max(F.struct("p_partkey", "p_name")).alias("b")).select("b.p_partkey", "b.p_name")


@query("""select event_id, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k, cast(trunc(try_cast(case when event_id % 4 = 0 then '' when event_id % 4 = 1 then 'abc' else cast(value as varchar) end as double)) as bigint) as v_long from events""")
def coerce_columns(events):
    raw = F.when(F.col("event_id") % 4 == 0, "").when(F.col("event_id") % 4 == 1, "abc").otherwise(F.col("value").cast("string"))
    return events.select("event_id", F.regexp_extract("props", "([0-9]+)", 1).cast("bigint").alias("k"), C.to_long(raw).alias("v_long"))


_HEADER = """(p_brand || ' (' || p_size || ') ' || p_type || case p_partkey % 4 when 0 then '?!' when 1 then ' =x_' when 2 then ' - "y" & z.' else '' end)"""


@query(rf"""select p_partkey, regexp_replace(regexp_replace(regexp_replace(lower({_HEADER}), '[?!@#+''"&]', '', 'g'), '[\s.\-()=_]+', '_', 'g'), '^_|_$', '', 'g') as name from part""")
def snake_case_names(part):
    return part.select("p_partkey", C.snake_case(F.expr(_HEADER)).alias("name"))


@query("""select p_partkey, k, v from (select p_partkey, unnest(['p_brand', 'p_type']) as k, unnest([case when p_size % 2 = 0 then p_brand end, p_type]) as v from part) where v is not null""")
def extended_map(part):
    m = F.create_map(F.lit("p_brand"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")), F.lit("p_type"), F.col("p_type"))
    return part.select("p_partkey", F.explode(F.map_filter(m, lambda k, v: v.isNotNull())).alias("k", "v"))


@query("""select c_custkey as id, c_name as name, c_acctbal as balance, c_mktsegment as segment, 'customer' as label from customer union all select s_suppkey, s_name, s_acctbal, null, 'supplier' from supplier""")
def union_by_name(customer, supplier):
    c = customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("label"))
    s = supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("label"))
    return sinks.union_all([c, s])


@query("select c_custkey, c_name, c_mktsegment from customer where c_name ilike '%00001%' or c_mktsegment ilike '%auto%' order by c_custkey desc limit 10")
def filter_ilike_topk(customer):
    return customer.filter(F.col("c_name").ilike("%00001%") | F.col("c_mktsegment").ilike("%auto%")).select("c_custkey", "c_name", "c_mktsegment").orderBy(F.desc("c_custkey")).limit(10)


@query("select o_orderkey, o_orderstatus from orders where o_orderstatus <> 'F' and o_totalprice between 1000 and 100000 and o_orderdate >= timestamp '1995-01-01' and o_orderpriority is not null")
def rest_predicates(orders):
    return orders.filter((F.col("o_orderstatus") != "F") & F.col("o_totalprice").between(1000, 100000) & (F.col("o_orderdate") >= F.lit("1995-01-01").cast("timestamp_ntz")) & F.col("o_orderpriority").isNotNull()).select("o_orderkey", "o_orderstatus")


@query("""select o_orderkey, o_orderdate from (select *, max(case when o_totalprice < 5000 then 1 else 0 end) over (partition by o_custkey order by o_orderdate desc, o_orderkey) as stop from orders) where stop = 0""")
def take_until_cutoff(orders):
    w = W.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), "o_orderkey")
    return orders.withColumn("stop", F.max((F.col("o_totalprice") < 5000).cast("int")).over(w)).filter("stop = 0").select("o_orderkey", "o_orderdate")


@query("""select d.doc_id, case when l.doc_id is null then 'pending_orphan' else 'done' end as status from documents d left join labels l on d.doc_id = l.doc_id""")
def orphan_flag(documents, labels):
    return joins.orphan_status(documents.select("doc_id"), labels, "doc_id", F.lit("done")).select("doc_id", "status")


@query("select o_orderkey, o_custkey from orders where o_orderkey not in (select l_orderkey from lineitem)")
def missing_files(orders, lineitem):
    return orders.join(lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti").select("o_orderkey", "o_custkey")


@query("select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')")
def orphan_files(customer, orders):
    return customer.join(orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("select p_partkey, p_name from part where p_partkey in (select l_partkey from lineitem where l_quantity > 45)")
def embedded_semi(part, lineitem):
    return part.join(lineitem.filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_semi").select("p_partkey", "p_name")


@query("""select o_orderkey, n_lines, declared, n_lines - declared as delta from (select o_orderkey, coalesce(n, 0) as n_lines, declared from (select o_orderkey, cast(nullif(o_orderkey % 7, 0) as bigint) as declared from orders)
full join (select l_orderkey as k, count(*) as n from lineitem group by 1) on o_orderkey = k) where declared is not null and n_lines <> declared""")
def count_reconcile(orders, lineitem):
    # a declared 0 counts as not declared
    right = orders.select("o_orderkey", F.nullif(F.col("o_orderkey") % 7, F.lit(0)).cast("bigint").alias("declared"))
    left = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_lines"))
    return joins.reconcile(left, right, "o_orderkey", "n_lines", "declared")


@query("""select n_nationkey, n_name, coalesce(r_name, '') as region, coalesce(string_agg(s_name, '; ' order by s_name), '') as suppliers from nation left join region on n_regionkey = r_regionkey
left join supplier on s_nationkey = n_nationkey group by all""")
def xlookup_index(nation, region, supplier):
    sup = supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.array_join(F.array_sort(F.collect_list("s_name")), "; ").alias("suppliers"))
    j = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left").join(sup, "n_nationkey", "left")
    return j.select("n_nationkey", "n_name", C.text(F.col("r_name")).alias("region"), C.text(F.col("suppliers")).alias("suppliers"))


@query("""select o_custkey, coalesce(string_agg(cast(o_orderkey as varchar), '; ' order by cast(o_orderkey as varchar)) filter (where o_orderstatus = 'F'), '') as f, coalesce(string_agg(cast(o_orderkey as varchar), '; ' order by cast(o_orderkey as varchar)) filter (where o_orderstatus = 'O'), '') as o,
coalesce(string_agg(cast(o_orderkey as varchar), '; ' order by cast(o_orderkey as varchar)) filter (where o_orderstatus = 'P'), '') as p from orders group by 1""")
def textjoin_pivot(orders):
    rows = orders.select("o_custkey", F.lower("o_orderstatus").alias("kind"), F.col("o_orderkey").cast("string").alias("v"))
    return joins.text_join(rows, "o_custkey", "kind", "v", ["f", "o", "p"])


@query("""select n_name, seg as segment, count(c_custkey) as n from nation cross join (values ('AUTOMOBILE'), ('BUILDING'), ('FURNITURE'), ('HOUSEHOLD'), ('MACHINERY')) s(seg) left join customer on c_nationkey = n_nationkey and c_mktsegment = seg group by all""")
def zero_filled_grid(spark, nation, customer):
    segments = spark.createDataFrame([(x,) for x in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")], "segment string")
    counts = customer.groupBy(F.col("c_nationkey").alias("n_nationkey"), F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("n"))
    return nation.crossJoin(F.broadcast(segments)).join(counts, ["n_nationkey", "segment"], "left").select("n_name", "segment", F.coalesce("n", F.lit(0)).alias("n"))


@query("select o_orderstatus, o_orderpriority, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 4) as pct from orders group by 1, 2")
def status_breakdown(orders):
    g = orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    return g.select("o_orderstatus", "o_orderpriority", "n", F.round(100.0 * F.try_divide(F.col("n"), F.sum("n").over(W.partitionBy())), 4).alias("pct"))  # over a row a group


@query("""select p_name, count(distinct p_brand) as n_brands, array_to_string(list_slice(list_sort(list(distinct p_brand)), 1, 5), '; ') as sample from part group by 1 having count(distinct p_brand) > 1""")
def name_collisions(part):
    g = part.groupBy("p_name").agg(F.array_sort(F.collect_set("p_brand")).alias("b"))
    return g.filter(F.size("b") > 1).select("p_name", F.size("b").cast("bigint").alias("n_brands"), F.array_join(F.slice("b", 1, 5), "; ").alias("sample"))


@query("select p_partkey, p_name, n from (select p_partkey, p_name, count(*) over (partition by p_name) as n from part) where n > 1")
def duplicate_basenames(part):
    many = part.groupBy("p_name").agg(F.count("*").alias("n")).filter("n > 1")
    return part.join(many, "p_name").select("p_partkey", "p_name", "n")


@query("""select metric, value from (select (select count(*) from orders) as indexed_rows, (select count(distinct o_custkey) from orders) as indexed_keys, (select count(*) from customer) as disk_files, (select count(*) from supplier) as embedded_files, (select count(*) from lineitem) as records,
(select count(*) from orders where o_custkey not in (select c_custkey from customer)) as missing, (select count(*) from customer where c_custkey not in (select o_custkey from orders)) as orphans, (select count(*) from supplier where s_suppkey in (select o_custkey from orders)) as embedded_matches,
(select count(*) from (select o_orderkey, count(l_orderkey) as n from orders left join lineitem on o_orderkey = l_orderkey group by 1) where n <> o_orderkey % 7) as count_mismatches, (select count(*) from part where p_name in (select p_name from part group by 1 having count(*) > 1)) as duplicate_names,
(select count(*) from (select p_name from part group by 1 having count(distinct p_brand) > 1)) as collisions) unpivot (value for metric in (indexed_rows, indexed_keys, disk_files, embedded_files, records, missing, orphans, embedded_matches, count_mismatches, duplicate_names, collisions))""")
def metric_summary(orders, customer, supplier, lineitem, part):
    """The eleven counts of an audit, each one aggregate of its own relation."""
    keys = orders.select(F.col("o_custkey").alias("k")).distinct()
    lines = lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    declared = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left").filter(F.coalesce("n", F.lit(0)) != F.col("o_orderkey") % 7)
    names = part.groupBy("p_name").agg(F.count("*").alias("n"), F.countDistinct("p_brand").alias("brands"))
    counts = {
        "indexed_rows": orders, "indexed_keys": keys, "disk_files": customer, "embedded_files": supplier, "records": lineitem,
        "missing": orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left_anti"), "orphans": customer.join(keys, customer["c_custkey"] == keys["k"], "left_anti"),
        "embedded_matches": supplier.join(keys, supplier["s_suppkey"] == keys["k"], "left_semi"), "count_mismatches": declared,
    }
    out = [df.agg(F.count("*").alias("value")).select(F.lit(name).alias("metric"), "value") for name, df in counts.items()]
    out.append(names.filter("n > 1").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("value")).select(F.lit("duplicate_names").alias("metric"), "value"))
    out.append(names.agg(F.count_if(F.col("brands") > 1).alias("value")).select(F.lit("collisions").alias("metric"), "value"))
    return sinks.union_all(out)


@query("""select field, "1-URGENT" as urgent, "5-LOW" as low from (select field, o_orderpriority, v from (select o_orderpriority, cast(count(*) as double) as n, round(sum(o_totalprice), 2) as total from orders group by 1) unpivot (v for field in (n, total)))
pivot (first(v) for o_orderpriority in ('1-URGENT', '5-LOW') group by field)""")
def unpivot_pivot(orders):
    g = orders.groupBy("o_orderpriority").agg(F.count("*").cast("double").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    long = g.unpivot(["o_orderpriority"], ["n", "total"], "field", "v")
    return long.groupBy("field").pivot("o_orderpriority", ["1-URGENT", "5-LOW"]).agg(F.first("v")).select("field", F.col("1-URGENT").alias("urgent"), F.col("5-LOW").alias("low"))


@query("select o_orderkey, o_totalprice from orders order by o_orderkey limit 50 offset 100")
def page_offset(orders):
    return orders.select("o_orderkey", "o_totalprice").orderBy("o_orderkey").offset(100).limit(50)


@query("""with s as (select o_orderkey, o_orderstatus, case when o_orderkey % 4 = 0 then '' else 'src' end as o_orderpriority, o_totalprice + 1 as o_totalprice from orders where o_orderkey % 3 = 0 union all select o_orderkey + 10000000, 'N', 'new', 5.0 from orders where o_orderkey % 50 = 0)
select coalesce(t.o_orderkey, s.o_orderkey) as o_orderkey, case when t.o_orderkey is null then s.o_orderstatus else t.o_orderstatus end as o_orderstatus,
case when t.o_orderkey is null then s.o_orderpriority when s.o_orderkey is not null and s.o_orderpriority <> '' then s.o_orderpriority else t.o_orderpriority end as o_orderpriority,
case when s.o_orderkey is not null then s.o_totalprice else t.o_totalprice end as o_totalprice from orders t full join s on t.o_orderkey = s.o_orderkey""")
def upsert_policy(orders):
    t = orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    s = t.filter("o_orderkey % 3 = 0").select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 4 == 0, "").otherwise("src").alias("o_orderpriority"), (F.col("o_totalprice") + 1).alias("o_totalprice"))
    n = t.filter("o_orderkey % 50 = 0").select((F.col("o_orderkey") + 10000000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), F.lit("new").alias("o_orderpriority"), F.lit(5.0).alias("o_totalprice"))
    return U.upsert(t, s.union(n), "o_orderkey", {"o_orderstatus": U.KEEP_FILLED, "o_orderpriority": U.IF_FILLED, "o_totalprice": U.OVERWRITE})


@query("""with t as (select 'F' || lpad(cast(page_id as varchar), 5, '0') as file_id, 'D:/' || page_id || '/A' as path, strlen(url) as size, case when page_id % 5 = 0 then '' else 'seen' end as review, 'old' as note, page_id from pages where page_id % 3 <> 0),
s as (select page_id, 'd:' || chr(92) || page_id || chr(92) || 'a' as path, strlen(url) + 1 as size, 'new' as review, case when page_id % 4 = 0 then '' else 'src' end as note from pages where page_id % 2 = 0),
n as (select s.*, row_number() over (order by page_id) as k, (select max(page_id) from t) as top from s where page_id % 3 = 0)
select t.file_id, t.path, coalesce(s.size, t.size) as size, case when t.review = '' and s.page_id is not null then s.review else t.review end as review, case when s.note <> '' then s.note else t.note end as note from t left join s using (page_id)
union all select 'F' || lpad(cast(k + top as varchar), cast(greatest(5, length(cast(k + top as varchar))) as int), '0'), path, size, review, note from n""")
def upsert_bucketed(spark, pages):
    """An inventory in hash buckets after an upsert by normalised paths: repeats settled by order, new ids, filled columns kept."""
    target = own_folder(spark, "inventory")
    path = lambda slash, head, tail: F.concat(F.lit(head + slash), F.col("page_id").cast("string"), F.lit(slash + tail))
    t = pages.filter("page_id % 3 <> 0").select(F.format_string("F%05d", F.col("page_id")).alias("file_id"), path("/", "D:", "A").alias("path"), F.octet_length("url").cast("bigint").alias("size"), F.when(F.col("page_id") % 5 == 0, "").otherwise("seen").alias("review"), F.lit("old").alias("note"))
    T.create(t, target, "path", 64)
    s = pages.filter("page_id % 2 = 0").select(path("\\", "d:", "a").alias("path"), (F.octet_length("url") + 1).cast("bigint").alias("size"), F.lit("new").alias("review"), F.when(F.col("page_id") % 4 == 0, "").otherwise("src").alias("note"), F.col("page_id").alias("at"))
    stale = s.select(F.upper("path").alias("path"), F.lit(0).cast("bigint").alias("size"), F.lit("stale").alias("review"), F.lit("stale").alias("note"), (F.col("at") - 1000000).alias("at"))
    T.upsert_into(spark, target, s.union(stale), "path", {"size": U.OVERWRITE, "review": U.KEEP_FILLED, "note": U.IF_FILLED}, "at", id_col="file_id", buckets=64)
    return T.read(spark, target)


@query("select doc_id, n_chars from documents where doc_id not in (select doc_id from labels)")
def incremental_new_only(documents, labels):
    return U.incremental(labels.select("doc_id"), documents.select("doc_id", "n_chars"), "doc_id", "incremental")


@query("select doc_id from labels union select doc_id from documents")
def incremental_accumulate(documents, labels):
    return U.incremental(labels.select("doc_id"), documents.select("doc_id"), "doc_id", "accumulate")


@query("select c_custkey, c_name from customer where c_custkey % 2 = 0 union all select c_custkey, c_name || '!' from customer where c_custkey % 3 = 0 and c_custkey % 2 <> 0")
def insert_ignore(customer):
    t = customer.filter("c_custkey % 2 = 0").select("c_custkey", "c_name")
    return dedup.insert_or_ignore(t, customer.filter("c_custkey % 3 = 0").select("c_custkey", F.concat("c_name", F.lit("!")).alias("c_name")), "c_custkey")


@query("select c_custkey, c_name || '!' as c_name from customer where c_custkey % 3 = 0 union all select c_custkey, c_name from customer where c_custkey % 2 = 0 and c_custkey % 3 <> 0")
def insert_replace(customer):
    t = customer.filter("c_custkey % 2 = 0").select("c_custkey", "c_name")
    return dedup.insert_or_replace(t, customer.filter("c_custkey % 3 = 0").select("c_custkey", F.concat("c_name", F.lit("!")).alias("c_name")), "c_custkey")


@query("select 'F' || lpad(cast(row_number() over (order by s_suppkey) + (select max(s_suppkey) from supplier) as varchar), 5, '0') as file_id, s_suppkey from supplier")
def next_file_ids(supplier):
    top = supplier.agg(F.max("s_suppkey").alias("m"))
    n = windows.numbered(supplier.select("s_suppkey"), ["s_suppkey"])
    return n.crossJoin(F.broadcast(top)).select(F.format_string("F%05d", F.col("rn") + F.col("m")).alias("file_id"), "s_suppkey")


@query("""select n_name, count(*) as suppliers, round(avg(s_acctbal), 4) as avg_balance, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey where l_shipdate >= timestamp '1996-01-01' group by 1""")
def joined_revenue(lineitem, supplier, nation):
    li = lineitem.filter(F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz")).select("l_suppkey", "l_extendedprice", "l_discount")
    j = li.join(supplier, li["l_suppkey"] == supplier["s_suppkey"]).join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
    return j.groupBy("n_name").agg(F.count("*").alias("suppliers"), F.round(F.avg("s_acctbal"), 4).alias("avg_balance"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))
