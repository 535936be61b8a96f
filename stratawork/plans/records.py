"""Queries of loaded configuration, forms, transcripts, search indexes, workbooks, JSON shapes and run states."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratawork.functions import columns as C
from stratawork.operators import config, dedup, forms, joins, rollup, rules, search, transcript, upsert, windows
from stratawork.plans.registry import registrar
from stratawork.session import own_folder, read_table
from stratawork.sources import paged, readers, sinks, workbooks

QUERIES, query = registrar()

_FAM = "case p_size % 9 when 0 then 'pdf' when 1 then 'image' when 2 then 'TEXT_FILE' when 3 then 'word_doc' when 4 then 'audio' when 5 then 'archive' when 6 then 'email_file' when 7 then 'Pdf' end"


@query(f"""select p_partkey, case when f in ('text_file', 'word_doc', 'spreadsheet', 'presentation', 'email_file') then 'Y' when f = 'pdf' then case when ok and s <> '' then 'Y' else 'N' end when f in ('image', 'audio', 'video') then 'N' else '' end as likely_text,
case when f = 'pdf' and d <> '' then d when f = 'pdf' then case when ok and s <> '' then 'N' else 'Y' end when f = 'image' then 'Y' when f in ('text_file', 'word_doc', 'spreadsheet', 'presentation', 'email_file', 'audio', 'video', 'archive') then 'N' else '' end as needs_ocr
from (select p_partkey, lower(coalesce({_FAM}, '')) as f, case when p_partkey % 2 = 0 then p_name else '' end as s, p_partkey % 3 > 0 as ok, case when p_partkey % 7 = 0 then 'PARTIAL' else '' end as d from part)""")
def text_signals(part):
    sample, ok, density = F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise(""), F.col("p_partkey") % 3 > 0, F.when(F.col("p_partkey") % 7 == 0, "PARTIAL").otherwise("")
    fam = F.expr(_FAM)
    return part.select("p_partkey", rules.likely_text(fam, sample, ok).alias("likely_text"), rules.needs_recognition(fam, sample, ok, density).alias("needs_ocr"))


@query("""with c as (select p_brand as family, lower(replace(p_type, ' ', '_')) as e, min(p_partkey) over (partition by p_brand) as o from part), e as (select '.' || e as extension, arg_min(family, o) as family, min(o) as o from c group by 1)
select s_suppkey, coalesce(e.family, 'other') as family, case when e.o % 2 = 0 then 'Y' else 'N' end as should_skip from (select s_suppkey, case when s_suppkey % 5 = 0 then '.none' else '.' || lower(replace(p_type, ' ', '_')) end as x from supplier join part on s_suppkey = p_partkey) left join e on x = e.extension""")
def family_table(part, supplier):
    """Families from a loaded table, joined by extension."""
    conf = part.groupBy(F.col("p_brand").alias("family")).agg(F.array_join(F.collect_set(F.concat(F.lit(" "), F.translate("p_type", " ", "_"))), ";").alias("extensions"), F.min("p_partkey").alias("ordinal"))
    loaded = config.families(conf.withColumn("should_skip", F.when(F.col("ordinal") % 2 == 0, " y ")))
    files = supplier.join(part, supplier["s_suppkey"] == part["p_partkey"]).select("s_suppkey", F.concat(F.lit("a/b"), F.when(F.col("s_suppkey") % 5 == 0, ".none").otherwise(F.concat(F.lit("."), F.translate("p_type", " ", "_")))).alias("path"))
    return rules.family_join(files, "path", loaded).select("s_suppkey", "family", "should_skip")


@query("""with w as (select p_brand as v, p_partkey % 40 as pts from (select p_brand, max(p_partkey) as p_partkey from part group by 1)), s as (select p_partkey, least(100, greatest(0, coalesce(w.pts, 0) + case when p_size > 25 then 15 else 0 end)) as score from part left join w on w.v = p_brand)
select p_partkey, score, case when score >= 45 then 'High' when score >= 20 then 'Medium' when score >= 5 then 'Low' else 'Skip' end as band from s""")
def score_table(spark, part):
    """Weights and bands from loaded tables: signals as rows, an equi join, a sum, and the band by its least score."""
    brands = part.select(F.lit("Brand").alias("signal_type"), F.col("p_brand").alias("signal_value"), (F.col("p_partkey") % 40).cast("string").alias("score_points"), F.col("p_partkey").cast("int").alias("ordinal"))
    size = spark.createDataFrame([("Size", "Y", "15", 0)], "signal_type string, signal_value string, score_points string, ordinal int")
    loaded = config.weights(brands.union(size))
    scored = rules.score_join(part, "p_partkey", {"Brand": F.col("p_brand"), "Size": F.when(F.col("p_size") > 25, "Y").otherwise("N")}, loaded)
    bands = config.bands(spark.createDataFrame([("Low", "5"), ("High", " 45 "), ("Medium", "20"), ("Skip", "x")], "band string, min_score string"))
    return rules.band_join(scored, "p_partkey", "score", bands)


@query("select c_custkey, c_name as keyword from customer where c_custkey % 4 = 0 and c_custkey % 3 > 0")
def active_keywords(customer):
    d = customer.select("c_custkey", F.when(F.col("c_custkey") % 3 > 0, F.col("c_name")).otherwise("").alias("keyword"), F.when(F.col("c_custkey") % 4 == 0, " y ").when(F.col("c_custkey") % 4 == 1, "N").alias("active"))
    return d.join(rules.active_keywords(d), "keyword", "left_semi").select("c_custkey", "keyword")


@query("""select page_id, path from (select page_id, lower(regexp_replace(url, '^[a-z]+://', '')) as path from pages) where len(string_split(path, '/')) - 1 <= 2 and not contains(path, 'page')""")
def scan_request(pages):
    """What a request in words leaves of an inventory: its depth counts from the first part of a path, as it names no folder."""
    p = pages.select("page_id", F.lower(F.regexp_replace("url", "^[a-z]+://", "")).alias("path"))
    return rules.requested(p, "path", rules.scan_request("dirs 2 levels deep excluding page")).select("page_id", "path")


_STATEMENT = (
    "('Example Life Insurance Company (U.S.A.)' || chr(10) || 'Page 1 of ' || (doc_id % 4 + 1) || chr(10) || 'Claim ID:' || chr(10) || 'C' || doc_id || chr(10) || 'Group Nbr: ' || chr(10) || (doc_id + 100) || chr(10) || '3/4/2021' || chr(10) || 'Payment Amount:' || chr(10) || '5/6/2022' || chr(10) || 'Payment is being made to:' || chr(10) || '$' || doc_id || '.50' || chr(10)"
    " || case when doc_id % 2 = 0 then '123456/A' || chr(10) || 'Transaction Seq. Nbr.:' || chr(10) || 'Main St ' || doc_id || chr(10) || 'Town' || chr(10) else '' end || 'Insured:' || chr(10) || ' A. Person ' || chr(10) || 'R. Person' || chr(10) || 'Side St' || chr(10) || 'City ' || doc_id || chr(10)"
    " || case when doc_id % 3 = 0 then '$7.00' || chr(10) || '$1.50' || chr(10) || '$5.50' || chr(10) || 'Home Health Aide' || chr(10) || '1/2/2021 - 1/9/2021' || chr(10) || 'Provider ' || doc_id || chr(10) else '' end || 'You used $' || doc_id || ' of your $100,000 lifetime maximum.' || chr(10) || text)"
)


@query("""select doc_id, 'C' || doc_id as claim_id, cast(doc_id + 100 as varchar) as group_nbr, doc_id % 4 + 1 as page_total, '2021-03-04' as payment_date, doc_id + 0.5 as payment_amount, case when doc_id % 2 = 0 then '123456/A' end as transaction_seq, case when doc_id % 2 = 0 then 'Main St ' || doc_id || ', Town' end as payment_recipient_address,
'A. Person' as insured_name, 'R. Person' as payment_recipient_name, 'Side St, City ' || doc_id as insured_address, case when doc_id % 3 = 0 then 7.0 end as total_charge, case when doc_id % 3 = 0 then 5.5 end as benefit_paid, case when doc_id % 3 = 0 then '2021-01-09' end as service_date_to, case when doc_id % 3 = 0 then 'Provider ' || doc_id end as provider,
cast(doc_id as double) as lifetime_used, case when doc_id % 6 = 0 then 21 when doc_id % 3 = 0 then 19 when doc_id % 2 = 0 then 14 else 12 end as n_fields from documents""")
def statement_fields(documents):
    """The 21 fields of a statement, from a page built before each document's whole text."""
    d = documents.select("doc_id", forms.extract(F.expr(_STATEMENT.replace("chr(10)", "'\\n'"))).alias("v"))
    t = d.select("doc_id", F.size("v").alias("n_fields"), *forms.typed(F.col("v")))
    iso = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    same = ("claim_id", "group_nbr", "page_total", "payment_amount", "transaction_seq", "payment_recipient_address", "insured_name", "payment_recipient_name", "insured_address", "total_charge", "benefit_paid", "provider", "lifetime_used", "n_fields")
    return t.select("doc_id", *same, iso("payment_date"), iso("service_date_to"))


_PAGE1 = (
    "('Policy Number: P' || doc_id || chr(10) || 'Claim Number: C-' || doc_id || chr(10) || 'Provider: Good Care  x' || chr(10) || 'Total Charges: $' || doc_id || '.25' || chr(10) || 'Hourly Rate: 30' || chr(10) || 'Service Date From: 1/2/2023' || chr(10) || 'Submitted By: A Person' || chr(10) || 'Date Submitted: 2/3/2023' || chr(10)"
    " || 'Q1: Was care given at home?' || chr(10) || ' Yes ' || chr(10) || case when doc_id % 2 = 0 then 'Q2. Was someone with you?' || chr(10) || 'No' || chr(10) || 'Q4. Proof type:' || chr(10) || 'Check' || chr(10) else '' end || case when doc_id % 5 = 0 then 'I-' || doc_id || chr(10) else '' end"
    " || case when doc_id % 3 = 0 then 'Additional Information:' || chr(10) || ' see note' || chr(10) else '' end || case when doc_id % 3 = 1 then 'I attest to the knowledge that all' || chr(10) || 'is true' || chr(10) || 'I attest that I have submitted proof of payment in full' || chr(10) || 'I-1' || chr(10) else '' end)"
)
_PAGE2 = "(case when doc_id % 3 = 2 then repeat('page two text ', 10) || chr(10) || 'Additional Information:' || chr(10) || 'on page two' || chr(10) || 'I-9' || doc_id else 'short' end)"


@query("""select doc_id, case when doc_id % 4 = 0 then cast(doc_id + 7 as varchar) when doc_id % 5 = 0 then cast(doc_id as varchar) when doc_id % 3 = 1 then '1' when doc_id % 3 = 2 then '9' || doc_id end as invoice_number, case when doc_id % 4 = 0 then '2023-05-06' end as doc_date, 'C-' || doc_id as claim_number, 'Good Care' as provider_name, '$' || doc_id || '.25' as total_charges,
'$30' as hourly_rate, 'A Person' as submitted_by, 'Yes' as care_at_home, case when doc_id % 2 = 0 then 'No' else 'Question not asked' end as shared_care, case when doc_id % 2 = 0 then 'Check' else 'Question not asked' end as proof_of_payment_type, case when doc_id % 3 = 0 then 'see note' when doc_id % 3 = 2 then 'on page two' else 'not extracted' end as additional_info,
case when doc_id % 3 = 1 then 'Yes' else 'No' end as fraud_attestation_checked, case when doc_id % 3 = 1 then 'I attest to the knowledge thatall is true' else 'not extracted' end as fraud_attestation_text, case when doc_id % 3 = 1 then 'I attest that I have submitted proof of paymentin full' else 'Question not asked' end as proof_payment_attest_text, 'Claim_Invoice' as doc_type from documents""")
def invoice_fields(documents):
    """Fields of an invoice of two pages and a file name; questions that older forms lack say so."""
    name = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("Invoice_"), F.col("doc_id") + 7, F.lit("_2023-05-06_x.pdf"))).otherwise("scan.pdf")
    page = lambda sql: F.expr(sql.replace("chr(10)", "'\\n'"))
    d = documents.select("doc_id", forms.invoice(page(_PAGE1), page(_PAGE2), name, F.lit(2)).alias("v"))
    as_is = ("invoice_number", "doc_date", "claim_number", "provider_name", "total_charges", "hourly_rate", "submitted_by", "care_at_home", "fraud_attestation_checked", "doc_type")
    shown = ("shared_care", "proof_of_payment_type", "additional_info", "fraud_attestation_text", "proof_payment_attest_text")
    return d.select("doc_id", *(F.col("v")[c].alias(c) for c in as_is), *(forms.shown(F.col("v"), c).alias(c) for c in shown))


@query("select conv_id, turn % 2 as page, string_agg(trim(text), chr(10) order by turn) as text from conversations where trim(text) <> '' group by 1, 2")
def page_lines(conversations):
    return forms.page_lines(conversations.select("conv_id", (F.col("turn") % 2).alias("page"), "turn", "text"), "conv_id", "page", "turn", "text")


_WORDS = """(select event_id, user_id, event_type, coalesce(name, 'Unknown') as speaker, event_id * 1000 as s, event_id * 1000 + 400 as e, case when value <= 20 then '[inaudible]' when value <= 50 then '[phonetic: ' || event_type || ']' else event_type end as w, value, event_id % 11 = 0 as over
from events left join (select n_nationkey, min(n_name) as name from nation where n_nationkey % 2 = 0 group by 1) on n_nationkey = event_id % 10)"""


def _words(events, nation):
    labels = nation.filter("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("label"), F.col("n_name").alias("speaker"))
    e = events.select("event_id", "user_id", "event_type", (F.col("event_id") % 10).alias("label"), (F.col("event_id") * 1000).alias("s"), (F.col("event_id") * 1000 + 400).alias("e"), (F.col("value") / 100).alias("confidence"), (F.col("event_id") % 11 == 0).alias("over"))
    return transcript.named(e, "label", labels).withColumn("w", transcript.marked_word(F.col("event_type"), F.col("confidence")))


@query(f"""with w as (select *, user_id as rec from {_WORDS}), p as (select *, lag(speaker) over (partition by rec order by event_id) as ps, lag(e) over (partition by rec order by event_id) as pe from w),
r as (select *, case when ps is null then 'start' when ps <> speaker then 'speaker' when s - pe >= 9000 then 'pause' end as reason from p), b as (select *, sum(case when reason is not null then 1 else 0 end) over (partition by rec order by event_id) as block from r),
t as (select rec, block, arg_min(speaker, event_id) as speaker, min(s) as started, arg_min(coalesce(reason, ''), event_id) as reason, string_agg(w, ' ' order by event_id) as said, bool_or(over) as over from b group by 1, 2)
select rec, block, speaker, started, reason, case when over then '[crosstalk] ' else '' end || said || case when lead(reason) over (partition by rec order by block) = 'pause' and lead(speaker) over (partition by rec order by block) = speaker then ' [pause]' else '' end as text from t""")
def transcript_blocks(events, nation):
    """Turns of a recording with its pauses: words looked up to speakers, marked, cut at changes and gaps."""
    w = _words(events, nation).withColumnRenamed("user_id", "rec")
    return transcript.blocks(w, "rec", "event_id", "speaker", "s", "e", "w", "over", 9000)


@query(f"""select user_id as rec, array_to_string(list_sort(list(distinct speaker) filter (where speaker <> 'Unknown')), ';') as identified, count(distinct event_id % 10) filter (where speaker = 'Unknown') as unknown, count(*) as n_words, round((max(event_id) * 1000 + 400) / 1000.0, 3) as duration from {_WORDS} group by 1""")
def transcript_documents(events, nation):
    """The JSON document of each recording, read back."""
    w = _words(events, nation).withColumnRenamed("user_id", "rec")
    d = transcript.documents(w, "rec", "event_id", "label", "speaker", "s", "e", "w", "confidence", "over")
    v = F.from_json("document", "duration_seconds double, speakers_identified array<string>, speakers_unknown bigint, words array<struct<word:string,start:double>>")
    return d.select("rec", v.alias("v")).select("rec", F.array_join("v.speakers_identified", ";").alias("identified"), F.col("v.speakers_unknown").alias("unknown"), F.size("v.words").alias("n_words"), F.col("v.duration_seconds").alias("duration"))


_TOKENS = "(select doc_id, unnest(list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda y: y <> '')) as token from documents)"


@query(f"select doc_id, count(*) as hits from {_TOKENS} where starts_with(token, 'licen') group by 1")
def fts_prefix(documents):
    return search.prefix(search.index(documents, "doc_id", "text"), "doc_id", "Licen")


@query(f"select doc_id, count(*) as hits from {_TOKENS} where token = 'that' group by 1")
def fts_stored(documents):
    """An index that is stored by token bucket and asked for one word: the scan reads that bucket alone."""
    target = own_folder(documents.sparkSession, "index")
    search.store(search.index(documents, "doc_id", "text"), target)
    return search.term(search.stored(documents.sparkSession, target, "that"), "doc_id", "that")


@query(f"select doc_id, count(*) as hits from (select doc_id, token from {_TOKENS} where doc_id % 4 <> 0 union all select doc_id, 'new' from documents where doc_id % 4 = 0) where token in ('that', 'new') group by 1")
def fts_refreshed(documents):
    """A stored index after a quarter of the documents was written anew."""
    spark, target = documents.sparkSession, own_folder(documents.sparkSession, "index")
    search.store(search.index(documents, "doc_id", "text"), target)
    new = search.index(documents.filter("doc_id % 4 = 0").select("doc_id", F.lit("New").alias("text")), "doc_id", "text")
    idx = search.refresh(spark, target, new, "doc_id")
    return idx.filter(F.col("token").isin("that", "new")).groupBy("doc_id").agg(F.count("*").alias("hits"))


@query("""select doc_id from (select doc_id, list(token) as x from (select doc_id, unnest(list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda y: y <> '')) as token from documents) group by 1) where list_contains(x, 'license') and (list_contains(x, 'copyright') or list_contains(x, 'from')) and not list_contains(x, 'würde')""")
def fts_query(documents):
    """A query in words: alternatives, exclusions, and stop words, which go."""
    all_of, any_of, none_of = search.parse_query("the & license & (copyright | from) & !würde")
    return search.boolean(search.index(documents, "doc_id", "text"), "doc_id", all_of, any_of, none_of)


@query("select s_suppkey, s_name, s_acctbal, n from (select s_suppkey, s_name, s_acctbal, row_number() over (order by s_suppkey) as n from supplier)")
def workbook_round_trip(supplier):
    """A table as workbooks of 700 numbered rows, in sheets that are full at 500, and read back from all of them."""
    spark, target = supplier.sparkSession, own_folder(supplier.sparkSession, "books")
    rows = windows.numbered(supplier.select("s_suppkey", "s_name", "s_acctbal"), ["s_suppkey"], "n")
    workbooks.write_books(rows, target, ["n"], 700, "suppliers", sheet_rows=501)
    sheets = [workbooks.read_rows(spark, f"{target}/*.xlsx", name, integers={"s_suppkey", "n"}) for name in ("suppliers", "suppliers_2") if name == "suppliers" or supplier.count() > 500]
    return sinks.union_all(sheets).select("s_suppkey", "s_name", F.col("s_acctbal").cast("double").alias("s_acctbal"), "n")


@query("select value, count(*) as n from (select case when trim(c_mktsegment) = '' or c_custkey % 9 = 0 then '(blank)' else c_mktsegment end as value from customer union all select p_brand from part) group by 1")
def type_report(customer, part):
    """The frequency of types over all workbooks that have such a column."""
    spark, target = customer.sparkSession, own_folder(customer.sparkSession, "books")
    tabs = {"a": customer.select("c_custkey", "c_name", F.when(F.col("c_custkey") % 9 == 0, " ").otherwise(F.col("c_mktsegment")).alias("File_Type")), "b": part.select(F.col("p_brand").alias("EXT"), "p_name", "p_partkey"), "c": part.select("p_name", "p_partkey")}
    for name, df in tabs.items():
        workbooks.write_books(df, f"{target}/{name}", ["c_custkey" if name == "a" else "p_partkey"], 100_000, name)
    return workbooks.type_column(spark, f"{target}/*/*.xlsx").groupBy("value").agg(F.count("*").alias("n"))


@query("select doc_id, source, lang, 'EXPORT' as label from documents")
def json_round_trip(documents):
    """An export as JSON documents of a list each, read back with its label."""
    target = own_folder(documents.sparkSession, "export")
    sinks.write_json_document(documents.select("doc_id", "source", "lang", "text"), target)
    return readers.read_export(documents.sparkSession, target, "EXPORT").select("doc_id", "source", "lang", F.col("_input_source").alias("label"))


@query("select conv_id, turn, role, n_files from (select conv_id, turn, role, turn % 3 as n_files from conversations)")
def lenient_json(conversations):
    """Documents of several shapes, a list of messages, an object of lists, a lone object, each message with a list of its own."""
    spark, target = conversations.sparkSession, own_folder(conversations.sparkSession, "shapes")
    files = F.transform(F.filter(F.array(F.lit(0), F.lit(1)), lambda k: k < F.col("turn") % 3), lambda k: F.struct(F.concat(F.lit("f"), k).alias("name")))
    rows = conversations.select("conv_id", F.to_json(F.struct("conv_id", "turn", "role", files.alias("attachments"))).alias("j"))
    each = rows.groupBy("conv_id").agg(F.array_join(F.collect_list("j"), ",").alias("l"), F.count("*").alias("n"))
    shape = F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("["), "l", F.lit("]"))).when(F.col("conv_id") % 3 == 1, F.concat(F.lit('{"x": 1, "attachments": [{"name": "no"}], "messages": ['), "l", F.lit("]}"))).otherwise(F.concat(F.lit('{"z": ['), "l", F.lit('], "a": [{"name": "no"}]}')))
    each.select((F.col("conv_id") % 50).alias("k"), shape.alias("value")).repartition(8).write.partitionBy("k").option("maxRecordsPerFile", 1).text(target)
    return readers.read_lenient(spark, f"{target}/*/*.txt").select("conv_id", "turn", "role", F.size("attachments").cast("bigint").alias("n_files"))


@query("select conv_id, turn, case turn % 4 when 0 then text when 1 then text || ' more' when 2 then text else text end as content from conversations")
def message_contents(conversations):
    """Contents that are strings, lists of parts (of which text counts) or plain text."""
    part = lambda kind, c: F.struct(F.lit(kind).alias("type"), c.alias("text"))
    parts = F.to_json(F.array(part("text", F.col("text")), part("image", F.lit("no")), part("text", F.lit("more"))))
    quoted = F.substring_index(F.to_json(F.struct(F.col("text").alias("x"))), '{"x":', -1)
    listed = F.trim("text").rlike("^[\\[\"]")  # such a text is given as a string, as it may be JSON itself
    raw = F.when(F.col("turn") % 4 == 1, parts).when((F.col("turn") % 4 == 2) | listed, F.left(quoted, F.length(quoted) - 1)).otherwise(F.col("text"))
    return conversations.select("conv_id", "turn", C.message_text(raw).alias("content"))


@query("select p_partkey, case p_partkey % 4 when 0 then 'x|y' when 1 then p_brand when 2 then '' else '' end as names, case when p_partkey % 2 = 0 then p_name else p_type end as id, p_size as charge from part")
def json_shapes(part):
    """Scalars or lists as lists, a nested or dotted key, and records in a fenced answer."""
    raw = F.when(F.col("p_partkey") % 4 == 0, '["x","y"]').when(F.col("p_partkey") % 4 == 1, F.concat(F.lit('"'), "p_brand", F.lit('"'))).when(F.col("p_partkey") % 4 == 2, " ")
    answer = F.concat(F.lit('```json\n{"service_records": [{"charge": '), "p_size", F.lit('}, {"charge": 1}]}\n```'))
    d = part.select("p_partkey", raw.alias("raw"), answer.alias("answer"), F.struct(F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).alias("Message-ID")).alias("Header"), F.col("p_type").alias("Header.Message-ID"))
    fields = {f.name: f.dataType for f in d.schema}
    return d.select("p_partkey", F.array_join(C.one_or_many(F.col("raw")), "|").alias("names"), C.nested_or_dotted(fields, "Header", "Message-ID").alias("id"), C.service_records(F.col("answer"))[0]["charge"].cast("bigint").alias("charge"))


@query("""select page_id, case when page_id % 4 = 0 then 'OneDrive' when page_id % 4 in (1, 2) then 'GoogleDriveSync' else 'Local' end as store, case when page_id % 3 = 0 then 'Id-' || page_id when page_id % 3 = 1 then 'q_' || page_id end as file_id, 'C:\\Users\\u' || page_id as cwd from pages""")
def path_names(pages):
    """Stores by folder names, ids in shared links, and directories that folder names stand for."""
    k = F.col("page_id").cast("string")
    path = F.concat(F.lit("/home"), F.when(F.col("page_id") % 4 == 0, "/OneDrive").when(F.col("page_id") % 4 == 1, "/Google Drive/x").when(F.col("page_id") % 4 == 2, "/GoogleDrive").otherwise("/onedrive2"))
    link = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://d/file/d/Id-"), k, F.lit("/view?id=no"))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("https://d/open?usp=1&id=q_"), k)).otherwise(F.lit("https://d/none"))
    return pages.select("page_id", C.source_store(path).alias("store"), C.drive_file_id(link).alias("file_id"), C.folder_cwd(F.concat(F.lit("p/C-Users-u"), k, F.lit("/"))).alias("cwd"))


@query("""select page_id, case page_id % 4 when 0 then 'March 5, 2024, 3:07:09 PM' when 1 then 'Today at 1:02:03 AM' when 2 then '' else 'Yesterday at 9:08:07 PM' end as raw, case page_id % 4 when 0 then timestamp '2024-03-05 15:07:09' when 1 then timestamp '2024-06-10 01:02:03' when 3 then timestamp '2024-06-09 21:08:07' end as parsed from pages""")
def post_dates(pages):
    """Dates in the headers of posts: the part after an edit mark counts only where the first has none."""
    head = F.when(F.col("page_id") % 4 == 0, "on: March 5, 2024, 3:07:09 PM Last Edit: June 1, 2024, 1:00:00 AM by X").when(F.col("page_id") % 4 == 1, "by A Last Edit :\n Today at 1:02:03 AM").when(F.col("page_id") % 4 == 2, "by A Last Edit: never").otherwise("Yesterday at 9:08:07 PM")
    raw = C.forum_date_text(head)
    return pages.select("page_id", raw.alias("raw"), C.forum_date(raw, F.lit("2024-06-10").cast("timestamp")).cast("timestamp_ntz").alias("parsed"))


@query("select path, depth, name from (select d as path, len(string_split(d, '/')) - 1 as depth, repeat('  ', len(string_split(d, '/')) - 1) || regexp_extract(d, '[^/]*$') as name from (select distinct 'r/' || lang || '/' || source as d from documents union select distinct 'r/' || lang from documents union select 'r'))")
def directory_rows(documents):
    """Directories, the deepest first, with indented names and the status of a new one."""
    p = documents.select(F.explode(C.ancestors(F.concat_ws("/", F.lit("r"), "lang", "source"))).alias("path")).distinct()
    rows = sinks.directory_rows(p.withColumn("depth", C.path_depth(F.col("path")).cast("bigint")))
    return rows.filter("status = 'not_scanned'").select("path", "depth", "name").orderBy(F.desc("depth"), "path")


@query("select c_custkey, day, n from (select c_custkey, strftime(date '2024-01-01' + cast(c_custkey % 60 as int), '%Y-%m-%d') as day, row_number() over (order by c_custkey % 60, c_custkey) as n from customer)")
def date_sort(customer):
    """Files in the order of the dates in their names."""
    name = F.concat(F.lit("Invoice_"), "c_custkey", F.lit("_"), F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 60).cast("int")), "yyyy-MM-dd"), F.lit("_x.pdf"))
    d = customer.select("c_custkey", F.regexp_extract(name, r"_(\d{4}-\d{2}-\d{2})_", 1).alias("day"))
    return windows.numbered(d, ["day", "c_custkey"], "n").select("c_custkey", "day", "n")


@query("select state, count(*) as n from (select user_id, arg_max(event_type, event_id) as state from events group by 1) group by 1")
def scan_states(events):
    """The last state of each scan of a history."""
    h = events.select(F.col("user_id").cast("string").alias("scan"), F.col("event_type").alias("state"), F.format_string("%012d", "event_id").alias("at"), F.lit(0).alias("rows"))
    return config.states(h).groupBy("state").agg(F.count("*").alias("n"))


@query("select path from (select user_id || '/' || event_id % 7 as path, max(case event_type when 'click' then 0 when 'view' then 1 when 'purchase' then 2 else -1 end) as r from events group by 1) where r < 2")
def level_gate(events):
    """Paths that a scan up to a level still has to walk."""
    level = F.when(F.col("event_type").isin("click", "view", "purchase"), F.col("event_type"))
    walked = events.select(F.concat_ws("/", "user_id", F.col("event_id") % 7).alias("path"), level.alias("level"))
    return upsert.gate(walked, "path", "level", ["click", "view", "purchase"], "purchase", "skip")


@query("select count(*) filter (where c_custkey % 3 = 0 and c_custkey % 2 <> 0) as copied, count(*) filter (where c_custkey % 3 = 0 and c_custkey % 2 = 0) as skipped, count(*) filter (where c_custkey % 2 = 0 or c_custkey % 3 = 0) as total from customer")
def copy_counts(spark, customer):
    """What a copy that leaves existing files alone would do, and does."""
    out, n = upsert.copied(customer.filter("c_custkey % 2 = 0").select("c_custkey"), customer.filter("c_custkey % 3 = 0").select("c_custkey"), "c_custkey")
    return spark.createDataFrame([(n["copied"], n["skipped"], out.count())], "copied bigint, skipped bigint, total bigint")


@query("select doc_id, source, md5(text) as digest from documents")
def paged_rows(spark, documents):
    """Whole documents that are given 100 a request, read by a task for each ten requests."""
    served = paged.served(spark, documents.select("doc_id", "source", "text"), ["doc_id"], 1000)
    return paged.read_paged(spark, served, "doc_id bigint, source string, text string", 100, 10).select("doc_id", "source", F.md5("text").alias("digest"))


@query("select c_custkey, c_name, case when 2 * c_custkey < (select max(c_custkey) from customer) then 1 else 2 end as crawl from customer")
def paged_resumed(spark, customer):
    """A paged source as a stream that stops half way, when the source had no more, and goes on from its checkpoint."""
    root = own_folder(spark, "crawl")
    top = customer.agg(F.max("c_custkey").alias("top"))
    halves = customer.select("c_custkey", "c_name").join(F.broadcast(top), F.lit(True))  # one row
    first = paged.served(spark, halves.filter("2 * c_custkey < top").drop("top"), ["c_custkey"])
    second = paged.served(spark, halves.drop("top"), ["c_custkey"])
    for crawl, fetch in ((1, first), (2, second)):
        name = paged.paged_source(spark, "crawled", fetch, "c_custkey bigint, c_name string", 100, 5)
        new = spark.readStream.format(name).load().withColumn("crawl", F.lit(crawl))
        new.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query("select distinct lower(p_brand) as name, list_aggregate(list_sort(list(p_partkey)), 'string_agg', ';') as paths from part group by 1")
def files_by_name(part):
    g = readers.by_name(part.select(F.col("p_brand").alias("name"), F.col("p_partkey").alias("path")))
    return g.select("name", F.array_join("paths", ";").alias("paths"))


@query("select name, count(*) as n from (select unnest(list_distinct(regexp_extract_all('Sub Do' || (p_partkey % 7) || '()' || chr(10) || 'x = 1' || chr(10) || '  Private Function F' || (p_partkey % 3) || '(a)', '(?m)^\\s*(?:Private )?(?:Sub|Function)\\s+(\\w+)', 1))) as name from part) group by 1")
def macro_names(part):
    src = F.concat(F.lit("Sub Do"), F.col("p_partkey") % 7, F.lit("()\nx = 1\n  Private Function F"), F.col("p_partkey") % 3, F.lit("(a)"))
    return part.select(F.explode(readers.macro_names(src)).alias("name")).groupBy("name").agg(F.count("*").alias("n"))


@query("select '/' || lower(lang) as cwd from documents where source = (select min(source) from documents) and lang is not null group by 1")
def seen_values(documents):
    line = F.to_json(F.struct(F.concat(F.lit("/"), F.lower("lang")).alias("cwd"), "doc_id"))
    return readers.seen_values(documents.select("source", line.alias("line")), "source", "line", "cwd")


@query("select lang, '- [' || lang || '](' || lang || '.md) (' || count(*) || ' sections)' as line from documents group by 1")
def chapter_index(documents):
    return sinks.chapter_index(documents.select("lang"), "lang")


@query("select doc_id, case when length(text) > 500 then left(text, 500) || '...' else text end as body, coalesce(lang, '') as lang from documents")
def json_rows(documents):
    rows = sinks.json_rows(documents.select("doc_id", "text", "lang"), ["text"])
    v = F.from_json("row", "array<string>")
    return rows.select(v.alias("v")).select(F.col("v")[0].cast("bigint").alias("doc_id"), F.col("v")[1].alias("body"), F.col("v")[2].alias("lang"))


@query("select o_custkey from orders where o_orderstatus = 'O' and o_custkey not in (select o_custkey from orders where o_orderstatus = 'P') group by 1")
def resumed_keys(orders):
    from stratawork.streaming.ingest import resumed

    return resumed(orders.filter("o_orderstatus = 'O'"), orders.filter("o_orderstatus = 'P'"), "o_custkey")


@query("select count(*) as rows, sum(strlen(coalesce(event_type, '')) + strlen(coalesce(cast(props as varchar), ''))) as text_bytes from events")
def live_counts(spark, sf_dir):
    """Counters that fill while rows are written."""
    from stratawork.streaming.ingest import counted

    df, live = counted(read_table(spark, sf_dir, "events"))
    df.write.parquet(own_folder(spark, "counted"))
    return spark.createDataFrame([(live.get["rows"], live.get["text_bytes"])], "rows bigint, text_bytes bigint")


@query("select user_id, count(*) as n from events group by 1 having count(*) > 1")
def dedup_sizes(events):
    return dedup.groups(events.select("user_id", "event_id", "event_type"), ["user_id"], F.min("event_id"), ["event_type"]).select("user_id", "n")


@query("select doc_id, item_id from documents d join (select item_id, regexp_replace(lower(text), '^\\s+|\\s+$', '', 'g') as a from benchmark) on a <> '' and contains(lower(d.text), a)")
def entity_hits_joined(documents, benchmark):
    """The join by the rarest characters, which a table of aliases beyond the automaton's bound takes."""
    return joins.containment_join(documents, "doc_id", "text", benchmark, "text", "item_id", few=10)


@query("""with p as (select distinct 'r/' || lang || '/' || source as path from documents where lang is not null and source is not null union select distinct 'r/' || lang from documents where lang is not null union select 'r'),
o as (select path, case when path = 'r/en' or starts_with(path, 'r/en/') then 0 else 1 end as k, case when path = 'r/en' or starts_with(path, 'r/en/') then 'r/en' else 'r' end as root from p)
select printf('D%03d', row_number() over (order by k, path)) as dir_id, path, root, case when path = root then '.' else substr(path, length(root) + 2) end as relative_path, case when path = root then 0 else len(string_split(substr(path, length(root) + 2), '/')) end as depth, 'Local' as store from o""")
def directory_records(documents):
    p = documents.filter("lang is not null and source is not null").select(F.explode(C.ancestors(F.concat_ws("/", F.lit("r"), "lang", "source"))).alias("path"))
    return rollup.records(p, "path", ["r/en/", "r"])


@query("select event_id, n from (select event_id, row_number() over (order by ts, event_id) as n from events) where n % 100 = 0")
def progress_rows(events):
    return windows.thinned(events.select("ts", "event_id", "event_type"), ["ts", "event_id"], 100).select("event_id", "n")


@query("select 'RUN_1' as run_id, count(*) as rows, 1.23 as elapsed_seconds, '{\"depth\": 2}' as config from pages")
def run_log(pages):
    return sinks.run_log(pages, "RUN_1", {"depth": 2}, 1.2345)
