"""Queries of smaller operators: configuration, numbering, text fields, sorts and statistics."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratawork.functions import columns as C
from stratawork.operators import config, joins, rollup, upsert, windows
from stratawork.plans.registry import registrar

QUERIES, query = registrar()


@query("""with e as (select p_brand as family, min(p_partkey) over (partition by p_brand) as o, '.' || replace(lower(p_type), ' ', '_') as extension from part) select arg_min(family, o) as family, extension, case when min(o) % 2 = 0 then 'Y' else 'N' end as should_skip from e group by 2""")
def family_config(part):
    """Families of extensions joined by ';', some with spaces, without dots or in capitals; the first family of an extension wins."""
    ext = F.translate("p_type", " ", "_")
    token = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" ."), F.lower(ext))).when(F.col("p_partkey") % 3 == 1, F.upper(ext)).otherwise(F.concat(F.lit("."), ext, F.lit(" ")))
    conf = part.groupBy(F.col("p_brand").alias("family")).agg(F.concat_ws(";", F.collect_list(token), F.lit("")).alias("extensions"), F.min("p_partkey").alias("ordinal"))
    return config.families(conf.withColumn("should_skip", F.when(F.col("ordinal") % 2 == 0, " y ")))


@query("""select p_brand as signal_type, p_type as signal_value, arg_max(case when p_partkey % 5 = 0 then 0 else p_size end, p_partkey) as points from part where p_partkey % 7 <> 0 group by 1, 2""")
def weight_config(part):
    """Weights whose repeats the last wins, some blank or no numbers."""
    d = part.select(F.col("p_partkey").alias("ordinal"), F.when(F.col("p_partkey") % 14 == 7, " ").otherwise(F.col("p_brand")).alias("signal_type"), F.when(F.col("p_partkey") % 14 != 0, F.col("p_type")).alias("signal_value"), F.when(F.col("p_partkey") % 5 == 0, "x").otherwise(F.col("p_size").cast("string")).alias("score_points"))
    return config.weights(d)


@query("""select o_custkey, max(case o_orderstatus when 'O' then 1 when 'P' then 2 when 'F' then 3 end) as rank_, arg_max(o_orderstatus, case o_orderstatus when 'O' then 1 when 'P' then 2 when 'F' then 3 end) as o_orderstatus from orders group by 1 having max(case o_orderstatus when 'O' then 1 when 'P' then 2 when 'F' then 3 end) >= 2""")
def highest_level(orders):
    c = config.covered(orders, "o_custkey", "o_orderstatus", ["N", "O", "P", "F"], "P")
    return c.select("o_custkey", F.when(F.col("o_orderstatus") == "P", 2).otherwise(3).alias("rank_"), "o_orderstatus")


@query("select min(n) as n from (select p_size + 1 as n from part union select 1) where n not in (select p_size from part)")
def first_unused_number(part):
    return config.smallest_unused(part.select(F.concat(F.lit("Inventory"), "p_size").alias("t")), "t", "Inventory")


@query("""select count(*) as posts, count(*) filter (where event_type = 'click') as clicks, count(distinct user_id) as users, arg_max(event_id, value * 1000000 - event_id) as top_event from events""")
def post_statistics(events):
    top = F.max(F.struct("value", (-F.col("event_id")).alias("o")))
    return events.agg(F.count("*").alias("posts"), F.count_if(F.col("event_type") == "click").alias("clicks"), F.countDistinct("user_id").alias("users"), top.alias("t")).select("posts", "clicks", "users", (-F.col("t.o")).alias("top_event"))


@query("select regexp_extract(url, '^[a-z]+://([^/]+)', 1) as host, max(try_cast(nullif(regexp_extract(url, 'page=([0-9]+)', 1), '') as int)) as last_page from pages group by 1")
def last_page_offset(pages):
    host = F.regexp_extract("url", "^[a-z]+://([^/]+)", 1)
    return pages.groupBy(host.alias("host")).agg(F.max(F.regexp_extract("url", "page=([0-9]+)", 1).try_cast("int")).alias("last_page"))


@query("""select page_id, case page_id % 3 when 1 then page_id when 2 then 1 else 0 end as likes, url as title from pages""")
def likes_and_titles(pages):
    said = F.when(F.col("page_id") % 3 == 1, F.concat("page_id", F.lit(" People  like this"))).when(F.col("page_id") % 3 == 2, "1 person likes this").otherwise("I like this")
    title = F.concat(F.when(F.col("page_id") % 2 == 0, "Re: Re:").otherwise(""), "url")
    return pages.select("page_id", C.likes(said).cast("bigint").alias("likes"), C.plain_title(title).alias("title"))


@query("select user_id, bool_or(event_type = 'purchase') as any_purchase, bool_and(value > 1) as all_above from events group by 1")
def any_and_all(events):
    return events.groupBy("user_id").agg(F.some(F.col("event_type") == "purchase").alias("any_purchase"), F.every(F.col("value") > 1).alias("all_above"))


@query("select c_custkey, c_name, row_number() over (order by lower(c_mktsegment), lower(c_name), c_custkey) as rn from customer")
def name_sort(customer):
    named = customer.select("c_custkey", "c_name", F.lower("c_mktsegment").alias("segment"), F.lower("c_name").alias("name"))
    return windows.numbered(named, ["segment", "name", "c_custkey"]).select("c_custkey", "c_name", "rn")


@query("select s_suppkey, cast(regexp_extract(s_name, '([0-9]+)$', 1) as bigint) as n from supplier")
def numeric_suffix_sort(supplier):
    return supplier.select("s_suppkey", F.regexp_extract("s_name", "([0-9]+)$", 1).cast("bigint").alias("n")).orderBy(F.desc("n"))


@query("""with p as (select label as profile, arg_min(embedding, vec_id)::double[] as pv from embeddings group by 1), m as (select e.vec_id, e.label, p.profile, round(coalesce(list_cosine_similarity(e.embedding::double[], p.pv), 0), 12) as s from embeddings e cross join p),
b as (select distinct label, profile from (select *, row_number() over (partition by vec_id, label order by s desc, profile) as rn from m where s >= 0.3 - 1e-9) where rn = 1)
select cast(profile as varchar) as profile, count(*) as n, string_agg(cast(label as varchar), ', ' order by cast(label as varchar)) as labels from b group by 1 having count(*) > 1""")
def profile_conflicts(embeddings):
    first = embeddings.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("pv"))
    profiles = first.select(F.col("label").cast("string").alias("profile"), F.col("label").alias("ordinal"), "pv")
    d = embeddings.select(F.struct("vec_id", "label").alias("k"), "embedding")
    matched = joins.nearest_profile(d, "k", "embedding", profiles, 0.3).filter("profile <> 'Unknown'").select("profile", F.col("k.label").cast("string").alias("label")).distinct()
    labels = F.array_sort(F.collect_list("label"))
    return matched.groupBy("profile").agg(F.count("*").alias("n"), F.array_join(labels, ", ").alias("labels")).filter("n > 1")


@query("select doc_id, sha256(text) || case when length(text) > 2000 then '_partial' else '' end as hash from (select doc_id, left(text, 2000) as text0, text from documents) where length(text) <= 2000 union all select doc_id, sha256(left(text, 2000)) || '_partial' from documents where length(text) > 2000")
def capped_hash(documents):
    long = F.length("text") > 2000
    return documents.select("doc_id", F.concat(F.sha2(F.left("text", F.lit(2000)), 256), F.when(long, "_partial").otherwise("")).alias("hash"))


@query("""select event_id, strftime(ts, 'RUN_%Y%m%d_%H%M%S') as run_id, strftime(ts, '%Y-%m-%d') as day from events""")
def run_ids(events):
    return events.select("event_id", C.run_id("RUN", F.col("ts")).alias("run_id"), F.date_format("ts", "yyyy-MM-dd").alias("day"))


@query("select user_id, event_id, case when rn = 1 then total else 0 end as total from (select user_id, event_id, row_number() over (partition by user_id order by event_id) as rn, count(*) over (partition by user_id) as total from events)")
def coverage_rows(events):
    n = F.count("*").over(W.partitionBy("user_id"))
    return events.withColumn("t", n).select("user_id", "event_id", config.first_row_totals(F.col("t"), ["user_id"], [F.asc("event_id")]).alias("total"))


@query("select lower(source) as dir, count(*) as direct_count, sum(n_chars) as direct_size from documents group by 1")
def direct_stats(documents):
    return rollup.direct(documents, "source", "n_chars")


@query("select o_orderkey, case when o_orderkey % 5 = 4 then null else strftime(o_orderdate, '%Y-%m-%d') end as iso from orders")
def any_dates(orders):
    raw = F.lit("soon")
    for k, f in enumerate(("M/d/yy", "yyyy-MM-dd", "MMMM d, yyyy", " MM/dd/yyyy ")):
        raw = F.when(F.col("o_orderkey") % 5 == k, F.date_format("o_orderdate", f)).otherwise(raw)
    return orders.select("o_orderkey", F.date_format(C.any_date(raw), "yyyy-MM-dd").alias("iso"))


@query("select o_orderkey, case when o_orderkey % 4 < 3 then round(o_totalprice, 2) end as value from orders")
def currencies(orders):
    n = F.format_number("o_totalprice", 2)
    raw = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit(" $"), n)).when(F.col("o_orderkey") % 4 == 1, n).when(F.col("o_orderkey") % 4 == 2, F.format_string("%.2f", "o_totalprice")).otherwise("n/a")
    return orders.select("o_orderkey", C.currency(raw).alias("value"))


@query("select p_partkey, p_brand || '|' || p_type as x from part")
def keyword_lists(part):
    raw = F.concat(F.lit(" '"), "p_brand", F.lit("' , \""), "p_type", F.lit('",,'))
    return part.select("p_partkey", F.array_join(C.keyword_list(raw), "|").alias("x"))


@query("select '<k' || l.doc_id || '@x>' as message_id, case when n > 0 then 'Found' else 'Missing' end as found, coalesce(n, 0) as match_count from labels l left join (select doc_id, count(*) as n from documents where doc_id % 5 <> 0 group by 1) d on d.doc_id = l.doc_id")
def message_id_gate(labels, documents):
    """Wanted ids (of labels) among those of messages (documents), both in several spellings."""
    wanted = labels.select(C.message_id_filter(F.concat(F.lit(" K"), "doc_id", F.lit("@X "))).alias("message_id")).distinct()
    raw = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("Message-ID: k"), "doc_id", F.lit("@x"))).otherwise(F.concat(F.lit("<K"), "doc_id", F.lit("@X>")))
    n = documents.filter("doc_id % 5 <> 0").select(C.message_id_filter(raw).alias("message_id")).groupBy("message_id").agg(F.count("*").alias("n"))
    j = wanted.join(n, "message_id", "left")
    return j.select("message_id", F.when(F.col("n") > 0, "Found").otherwise("Missing").alias("found"), F.coalesce("n", F.lit(0)).alias("match_count"))


@query("select o_orderstatus, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_orderstatus order by o_totalprice desc, o_orderkey) as rn from orders) where rn <= 3")
def top_per_status(orders):
    return joins.best_of(orders, ["o_orderstatus"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).select("o_orderstatus", "o_orderkey", "o_totalprice")


@query("""select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey, case when a.o_orderkey is null then 'new' when b.o_orderkey is null then 'gone' when a.o_totalprice is distinct from b.price or a.o_orderstatus is distinct from b.o_orderstatus then 'changed' else 'unchanged' end as state
from (select * from orders where o_orderkey % 7 <> 0) a full join (select o_orderkey, o_orderstatus, case when o_orderkey % 3 = 0 then o_totalprice + 1 else o_totalprice end as price from orders where o_orderkey % 5 <> 0) b on a.o_orderkey = b.o_orderkey""")
def snapshot_diff(orders):
    """Two snapshots of a table, compared by a full outer join of keys and hashes of the other columns."""
    before = orders.filter("o_orderkey % 7 <> 0").select("o_orderkey", "o_orderstatus", "o_totalprice")
    after = orders.filter("o_orderkey % 5 <> 0").select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"))
    return upsert.snapshot_diff(before, after, "o_orderkey")


@query("select distinct user_id, event_type from events")
def stream_first_seen(spark, sf_dir):
    """Repeated keys of a stream are dropped by its state, which the watermark bounds."""
    from stratawork.session import own_folder, read_table
    from stratawork.streaming.ingest import first_seen, run_to_end

    root = own_folder(spark, "stream")
    schema = read_table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")
    keyed = stream.select(F.concat_ws("|", "user_id", "event_type").alias("k"), "user_id", "event_type", F.col("ts").cast("timestamp").alias("at"))
    run_to_end(first_seen(keyed, "k", "at", "10000 days"), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").select("user_id", "event_type")
