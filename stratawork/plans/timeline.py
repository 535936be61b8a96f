"""Queries of ordered rows: threads, blocks, overlaps, vectors, rollover and streams."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratawork.functions import columns as C
from stratawork.operators import joins, windows
from stratawork.plans.registry import registrar
from stratawork.session import own_folder, read_table

QUERIES, query = registrar()


@query("""select event_id, user_id, row_number() over w as position, date_sub('second', lag(ts) over w, ts) as lag_seconds from events window w as (partition by user_id order by ts, event_id)""")
def thread_position_lag(events):
    return windows.positions(events, ["user_id"], ["ts", "event_id"], "ts").select("event_id", "user_id", F.col("position").cast("bigint").alias("position"), "lag_seconds")


@query("""with x as (select *, cast(floor(value / 20) as bigint) as spk from events), p as (select *, lag(spk) over w as ps, lag(ts) over w as pt from x window w as (partition by user_id order by ts, event_id)),
r as (select *, case when pt is null then 'start' when ps <> spk then 'speaker' when date_sub('second', pt, ts) >= 3600 then 'pause' end as reason from p),
b as (select *, sum(case when reason is not null then 1 else 0 end) over (partition by user_id order by ts, event_id) as block from r)
select user_id, cast(block as bigint) as block, min(event_id) as first_event, count(*) as n, max(reason) as reason from b group by 1, 2""")
def gap_blocks(events):
    e = events.select("event_id", "user_id", "ts", F.floor(F.col("value") / 20).cast("bigint").alias("spk"))
    b = windows.gap_blocks(e, ["user_id"], ["ts", "event_id"], "spk", F.timestamp_diff("SECOND", F.col("__prev.ts"), F.col("ts")), 3600)
    return b.groupBy("user_id", "block").agg(F.min("event_id").alias("first_event"), F.count("*").alias("n"), F.max("reason").alias("reason"))


@query("""select event_id, coalesce(nt <> event_type and ns - (event_id % 1000 + value) < 0.2, false) as interrupted from (select *, lead(event_type) over w as nt, lead(event_id % 1000) over w as ns from events window w as (partition by user_id order by event_id))""")
def interruptions(events):
    e = events.select("event_id", "user_id", "event_type", (F.col("event_id") % 1000).alias("s")).join(events.select("event_id", "value"), "event_id").withColumn("e", F.col("s") + F.col("value"))
    return windows.interruptions(e, ["user_id"], ["event_id"], "event_type", "s", "e", 0.2).select("event_id", "interrupted")


_IV = "(select event_id, user_id, event_type, epoch_ms(ts) / 1000.0 as s, epoch_ms(ts) / 1000.0 + value * 20 as e from events)"


def _intervals(events):
    s = (F.unix_millis(F.col("ts").cast("timestamp")) / 1000).alias("s")
    return events.select("event_id", "user_id", "event_type", s, F.col("value")).withColumn("e", F.col("s") + F.col("value") * 20)


@query(f"select a.event_id, b.event_id as event_id2 from {_IV} a join {_IV} b on a.event_id < b.event_id and a.s < b.e and b.s < a.e and a.event_type <> b.event_type and a.user_id = b.user_id")
def interval_overlap(events):
    return joins.overlapping(_intervals(events), "event_id", "s", "e", "event_type", 3600.0, ["user_id"], empty=True)


@query(f"""select o.event_id as oid, arg_max(i.event_id, i.s * 100000 + i.event_id / 100000.0) as last_id from (select event_id, user_id, s, s + 7200 as e from {_IV} where event_type = 'purchase') o join {_IV} i on i.user_id = o.user_id and i.s >= o.s and i.e <= o.e group by 1""")
def range_contains_last(events):
    i = _intervals(events)
    outer = i.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("oid"), F.col("s").alias("ostart"), (F.col("s") + 7200).alias("oend"))
    return joins.last_contained(outer, i.select("user_id", F.col("event_id").alias("id"), F.col("s").alias("start"), F.col("e").alias("end")), "user_id", 7200.0)


@query("""with p as (select label as profile, embedding as pv from (select *, row_number() over (partition by label order by vec_id) rn from embeddings) where rn = 1),
s as (select vec_id, profile, list_cosine_similarity(cast(embedding as double[]), cast(pv as double[])) as s from embeddings cross join p)
select vec_id, case when max(s) >= 0.3 - 1e-9 then cast(arg_max(profile, s) as varchar) else 'Unknown' end as profile, case when max(s) >= 0.3 - 1e-9 then round(max(s), 6) else 0.0 end as similarity from s group by 1""")
def nearest_profile(embeddings):
    first = embeddings.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("pv"))
    profiles = first.select(F.col("label").cast("string").alias("profile"), F.col("label").alias("ordinal"), "pv")
    return joins.nearest_profile(embeddings, "vec_id", "embedding", profiles, 0.3).withColumn("similarity", F.round("similarity", 6))


@query("select user_id, arg_max(event_id, value * 1000000 - event_id / 1000.0) as longest from events group by 1")
def longest_per_speaker(events):
    return events.groupBy("user_id").agg(F.max(F.struct("value", (-F.col("event_id")).alias("o"))).alias("b")).select("user_id", (-F.col("b.o")).alias("longest"))


@query("""select event_id, printf('%02d:%02d:%02d,%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) as srt, case when value <= 20 then '[inaudible]' when value <= 50 then '[phonetic: ' || event_type || ']' else event_type end as word from (select *, event_id * 8101 as ms from events)""")
def srt_times(events):
    conf = F.col("value")
    word = F.when(conf <= 20, "[inaudible]").when(conf <= 50, F.concat(F.lit("[phonetic: "), "event_type", F.lit("]"))).otherwise(F.col("event_type"))
    return events.select("event_id", C.srt_time(F.col("event_id") * 8101).alias("srt"), word.alias("word"))


@query("""with b as (select user_id, date_trunc('day', ts) as day, string_agg(event_type, ' ' order by ts, event_id) as words, min(ts) as t from events group by 1, 2)
select user_id, md5(string_agg(n || chr(10) || words, chr(10) || chr(10) order by n)) as srt_hash, count(*) as blocks from (select *, row_number() over (partition by user_id order by day) as n from b) group by 1""")
def srt_render(events):
    day = F.date_trunc("day", F.col("ts"))
    words = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type"))), lambda x: x["event_type"]), " ")
    b = events.groupBy("user_id", day.alias("day")).agg(words.alias("words"))
    b = b.withColumn("n", F.row_number().over(W.partitionBy("user_id").orderBy("day")))
    blocks = F.transform(F.array_sort(F.collect_list(F.struct("n", "words"))), lambda x: F.concat(x["n"].cast("string"), F.lit("\n"), x["words"]))
    return b.groupBy("user_id").agg(F.md5(F.array_join(blocks, "\n\n")).alias("srt_hash"), F.count("*").alias("blocks"))


@query("""select doc_id, source, cast(coalesce(sum(n_chars // 1000 + 1) over (partition by source order by doc_id rows between unbounded preceding and 1 preceding), 0) + 2 as bigint) as page_start from documents""")
def running_page_start(documents):
    d = documents.select("doc_id", "source", F.floor(F.col("n_chars") / 1000 + 1).alias("pages"))
    return windows.page_starts(d, ["source"], ["doc_id"], "pages").select("doc_id", "source", F.col("page_start").cast("bigint").alias("page_start"))


@query("select doc_id, text, source, (rn + 137) // 700 + 1 as tab, (rn + 137) % 700 + 1 as row_in_tab from (select doc_id, text, source, row_number() over (order by doc_id) - 1 as rn from documents)")
def sink_rollover(documents):
    return windows.rollover(documents.select("doc_id", "text", "source"), ["doc_id"], 700, 137)


@query("select event_id, event_type, case when event_type <> coalesce(lag(event_type) over (partition by user_id order by event_id), '') then 'DIR' else '' end as marker from events")
def first_of_run(events):
    w = W.partitionBy("user_id").orderBy("event_id")
    return events.select("event_id", "event_type", F.when(F.col("event_type") != F.coalesce(F.lag("event_type").over(w), F.lit("")), "DIR").otherwise("").alias("marker"))


@query("""select event_id, case event_id % 4 when 0 then event_id % 60 * 60 + 5 when 1 then event_id % 24 * 3600 + 61 end as seconds from events""")
def clock_seconds(events):
    raw = F.when(F.col("event_id") % 4 == 0, F.format_string("%02d:05", F.col("event_id") % 60)).when(F.col("event_id") % 4 == 1, F.format_string("%d:01:01", F.col("event_id") % 24)).when(F.col("event_id") % 4 == 2, "1:2:3:4").otherwise("x")
    return events.select("event_id", C.clock_seconds(raw).cast("bigint").alias("seconds"))


@query("select event_id, event_type, value from events")
def stream_append(spark, sf_dir):
    from stratawork.streaming.ingest import run_to_end

    root = own_folder(spark, "stream")
    stream = spark.readStream.schema(read_table(spark, sf_dir, "events").schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*").select("event_id", "event_type", "value")
    run_to_end(stream, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


@query("select doc_id, text, rn // 3000 + 1 as tab from (select doc_id, text, row_number() over (order by doc_id) - 1 as rn from documents)")
def stream_tabs(spark, sf_dir):
    from stratawork.streaming.ingest import append_tabs

    root = own_folder(spark, "stream")
    stream = spark.readStream.schema(read_table(spark, sf_dir, "documents").schema).parquet(f"{sf_dir}/documents.parquet*").select("doc_id", "text")
    append_tabs(stream, f"{root}/out", f"{root}/checkpoint", 3000, ["doc_id"]).awaitTermination()
    return spark.read.parquet(f"{root}/out").select("doc_id", "text", "tab")


@query("select event_type, count(*) as n, round(sum(value), 4) as total from events group by 1")
def stream_totals(spark, sf_dir):
    root = own_folder(spark, "stream")
    stream = spark.readStream.schema(read_table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parquet*")
    g = stream.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))

    def last(batch, number):
        batch.write.mode("overwrite").parquet(f"{root}/out")

    g.writeStream.outputMode("complete").foreachBatch(last).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out")
