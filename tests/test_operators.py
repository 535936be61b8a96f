"""Literal cases of the operators, with synthetic strings."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from stratawork.functions import columns as C
from stratawork.functions import html as H
from stratawork.operators import dedup, forms, joins, mail, rollup, rules, search, upsert, windows
from stratawork.sources import paged, readers, sinks


def one(spark, c, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(c(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw,want", [("3.9", 3), ("", None), ("abc", None), (" -2.5 ", -2), (None, None)])
def test_to_long(spark, raw, want):
    assert one(spark, C.to_long, raw) == want


@pytest.mark.parametrize("raw,want", [("Date & Time Sent", "date_time_sent"), ("body_clean.1", "body_clean_1"), ("original=saved", "original_saved"), ("???", "")])
def test_snake_case(spark, raw, want):
    assert one(spark, C.snake_case, raw) == want == C.snake_name(raw)


def test_headers():
    assert C.map_headers(["From", "To", "a b", "a-b", None, ""]) == ["from_addr", "to_addr", "a_b", "a_b_2", "unnamed", "unnamed_2"]
    with pytest.raises(ValueError):
        C.map_headers(["x", "x", "x 2"])


def test_message_ids(spark):
    assert one(spark, C.message_id, " <Abc@X.com> ") == "abc@x.com"
    assert one(spark, C.message_id_filter, "Message-ID: Abc@X.com") == "<abc@x.com>"
    assert one(spark, C.message_id_filter, None) == ""
    assert one(spark, C.header_message_id, "To: b\nMessage-ID:\n <Q@y>\nX: 1") == "<q@y>"


def test_safe_text_caps_first(spark):
    assert one(spark, lambda c: C.safe_text(c, 3), "a\x00bcd") == "ab"


def test_times(spark):
    assert one(spark, C.srt_time, 8100, "bigint") == "00:00:08,100"
    assert one(spark, C.clock_seconds, "1:02:03") == 3723
    assert one(spark, C.elapsed, 65, "bigint") == "1:05"


def test_html():
    assert H.html_text("<p>a<br>b <b>c</b></p><script>x()</script>") == "a\n\n\nb\nc".replace("\n\n\n", "\n\n")
    assert H.without_quote('<div>new<br><div class="X gmail_quote">old</div>after</div>') == "new"
    assert H.without_quote("tail A&B") == "tail A&B"
    quote = lambda body: f'<blockquote class="x bbc_standard_quote">{body}</blockquote>'
    post = f'a {quote("<cite><a>Quote from: Ann B on Monday</a></cite>hi <b>you</b>")}mine<blockquote>kept</blockquote>{quote("no cite")}'
    assert H.post_parts(post) == ("a mine kept", [("Ann B", "hi you"), ("unknown", "no cite")])
    nested = quote("<cite>Quote from: A on x</cite>outer " + quote("<cite>Quote from: B on y</cite>inner"))
    assert H.post_parts(nested) == ("", [("A", "outer Quote from: B on y inner"), ("B", "inner")])
    assert H.plain_text("a<br>b <script>x</script>") == "ab x"
    assert H.plain_text(None) == "" and H.html_text(None) == ""


METHODS = [
    ("x", "see my INLINE notes", "", "<p>", "Inline"), ("FWD - x", "a", "gmail_quote", "", "Forward"), ("re: fw: x", "a", "", "", "Original"), ("x", "a", '<div class="GMAIL_quote">', "", "Gmail"), ("x", "a", "MsoNormal", "", "Outlook"), ("x", "a", "msonormal", "<p>", "Clean_Reply"),
    ("x", "a\n> b", 'dir="auto"', "<p>", "GT_Prefix"), ("x", "a", 'dir="auto"', " <p> ", "iOS"), ("x", "a", 'dir="auto"', " ", "Original"), ("x", "a\n--- Original Message ---\nb", "", "", "Outlook_Plain"), ("x", "FROM: b\nsubject: c", "", "", "Outlook_Plain"),
    ("x", "so on Monday he wrote: b", "", "<p>", "OnWrote"), ("x", "a", "", "<p>", "Clean_Reply"), (None, None, None, None, "Original"), ("inline: x", "a", "", "<p>", "Clean_Reply"),
]


def test_strip_method(spark):
    d = spark.createDataFrame([(i, *m[:4]) for i, m in enumerate(METHODS)], "i int, s string, t string, h string, r string")
    got = d.select("i", mail.strip_method(*(F.col(c) for c in "sthr")).alias("m")).orderBy("i").collect()
    assert [r.m for r in got] == [m[4] for m in METHODS]


BODIES = [
    ("Outlook", "a\nFrom: B <b@x>\nSent: now\nold", "", "a"), ("Outlook", "From: B\nSent: now\nold", "", "From: B\nSent: now\nold"), ("Forward", "a\n---------- Forwarded message ---------\nold", "", "a"), ("Forward", "Begin forwarded message:\nold", "", ""),
    ("Forward", "a\nFrom: B\nDate: now\nold", "", "a"), ("GT_Prefix", "> old\n\n\nOn Monday A B wrote: \nnew\n \n\n>x\nend", "", "new\n\nend"), ("Outlook_Plain", "-----original message-----\nold", "", ""), ("Outlook_Plain", "a\nFrom: B\nSent: x\nold", "", "a"),
    ("iOS", "a\nOn Sep 11, 2024, at 6:47PM, B wrote:\nold", "", "a"), ("iOS", 'a\nFrom: "B" <b@x>\nSubject: q\nold', "<p>a</p><p>From:</p><p>B</p>", "a"), ("iOS", "a\n-------- Original message --------\nold", "", "a"), ("OnWrote", "a\nOn Monday, B wrote:\nold", "", "a"),
    ("Gmail", "plain", '<div>new<div class="gmail_quote">old</div></div>', "new"), ("Clean_Reply", " a ", "<p>html</p>", "a"), ("Original", None, None, ""),
]


def test_body_clean(spark):
    d = spark.createDataFrame([(i, *b[:3]) for i, b in enumerate(BODIES)], "i int, m string, t string, h string")
    got = d.select("i", mail.body_clean(F.col("m"), F.col("t"), F.col("h"), F.lit("")).alias("b")).orderBy("i").collect()
    assert [r.b for r in got] == [b[3] for b in BODIES]


@pytest.mark.parametrize(
    "body,sender,want",
    [
        ("Hi.\n\nAnn\nPartner\nExample Corp\nStreet", "ann@example.com", "Hi."),
        ("Hi.\n\nAnn\nPartner\n\nexample corp", "Ann <ann@EXAMPLE.com>", "Hi."),
        ("Hi.\n\nAnn\nExample Corp", "ann@other.org", "Hi.\n\nAnn\nExample Corp"),
        ("a\nb\nc\nd\ne\nf\ng\nExample Corp", "ann@example.com", "a\nb"),
        ("Hi\r\nGet Outlook for iOS", "", "Hi"),
        ("Hi.\nAnn\nThe information contained in this transmission is", "", "Hi.\nAnn"),
        (None, None, ""),
    ],
)
def test_signatures(spark, body, sender, want):
    assert spark.createDataFrame([(body, sender)], "b string, s string").select(mail.strip_signature(F.col("b"), F.col("s")).alias("x")).first()["x"] == want


def test_source_kind(spark):
    d = spark.createDataFrame([(1, "t", "a.msg"), (2, " ", "a.MSG"), (3, None, "a.eml"), (4, None, None)], "i int, t string, f string")
    assert [r.k for r in d.select("i", mail.source_kind(F.col("t"), F.col("f")).alias("k")).orderBy("i").collect()] == ["GMAIL_API", "MSG_FILE", "EML_FILE", "EML_FILE"]


def test_tree(spark):
    dirs = spark.createDataFrame([("r",), ("r/a",), ("r/a/b",), ("r/c",)], "path string")
    files = spark.createDataFrame([("r/a", 50), ("r/a/b", 150)], "dir string, size bigint")
    got = {r["path"]: (r["direct_count"], r["total_count"], r["total_size"], r["depth"]) for r in rollup.tree(dirs, files, "dir", "size").collect()}
    assert got == {"r": (0, 2, 200, 0), "r/a": (1, 2, 200, 1), "r/a/b": (1, 1, 150, 2), "r/c": (0, 0, 0, 1)}


def test_upsert_policies(spark):
    t = spark.createDataFrame([("a", "1", "", "x"), ("b", "1", "keep", "x")], "k string, o string, f string, i string")
    s = spark.createDataFrame([("a", "2", "new", ""), ("b", "2", "new", "y"), ("c", "3", "n", "z")], "k string, o string, f string, i string")
    got = upsert.upsert(t, s, "k", {"o": upsert.OVERWRITE, "f": upsert.KEEP_FILLED, "i": upsert.IF_FILLED})
    assert sorted(map(tuple, got.collect())) == [("a", "2", "new", "x"), ("b", "2", "keep", "y"), ("c", "3", "n", "z")]
    assert upsert.next_ids(spark.createDataFrame([("F00007",), ("x",)], "id string"), "id", "F") == 8


def test_dedup_keys_do_not_meet(spark):
    d = spark.createDataFrame([(1, "k", None), (2, None, "k"), (3, None, ""), (4, "k", "z")], "id int, sha string, mid string")
    got = dedup.winners(dedup.two_key(d, F.col("sha"), F.col("mid"), F.col("id")), ["key_type", "key"], [F.desc("id")])
    assert sorted(r["id"] for r in got.collect()) == [2, 3, 4]


def test_overlaps_count_once(spark):
    rows = [(1, 0.0, 250.0, "a"), (2, 100.0, 210.0, "b"), (3, 250.0, 300.0, "b"), (4, 205.0, 206.0, "a")]
    d = spark.createDataFrame(rows, "id bigint, s double, e double, who string")
    got = joins.overlapping(d, "id", "s", "e", "who", 50.0).collect()
    assert sorted(map(tuple, got)) == [(1, 2), (2, 4)]


def test_exclusion(spark):
    p = spark.createDataFrame([("R/a",), ("r/ab",), ("r/a/x",), ("q",)], "p string")
    ex = spark.createDataFrame([("r/A",), ("",)], "path string")
    assert sorted(r["p"] for r in joins.exclude_paths(p, "p", ex).collect()) == ["q", "r/ab"]


def test_gap_at_threshold_breaks(spark):
    d = spark.createDataFrame([(1, "a", 0, 10), (2, "a", 19, 30), (3, "a", 40, 50), (4, "b", 51, 60)], "id int, who string, s int, e int").withColumn("g", F.lit(1))
    got = windows.gap_blocks(d, ["g"], ["id"], "who", F.col("s") - F.col("__prev.e"), 10).orderBy("id").collect()
    assert [(r["block"], r["reason"]) for r in got] == [(1, "start"), (1, None), (2, "pause"), (3, "speaker")]


def test_rules(spark):
    assert one(spark, rules.skip_reason, "r/a.EXE") == "family:executable"
    assert one(spark, rules.skip_reason, "r/~$a.docx") == "lock_file"
    assert one(spark, lambda c: joins.band_of(c, rules.BANDS), 35, "int") == "Medium"
    assert one(spark, lambda c: rules.next_step(F.lit("Medium"), c), "Y") == "OCR then review"


def test_phrase_with_a_repeated_word(spark):
    d = spark.createDataFrame([(1, "so it is, so it is. W-9"), (2, "is it so")], "id int, t string")
    idx = search.index(d, "id", "t")
    assert [tuple(r) for r in search.phrase(idx, "id", ["so", "it", "is", "so"]).collect()] == [(1, 1)]
    assert [tuple(r) for r in search.phrase(idx, "id", ["W", "9"]).collect()] == [(1, 1)]


def test_forms(spark):
    page = "Claim ID: \nX1\n5/9/2024\nPayment Amount:\n6/6/2025\nPayment is being made to:\n$1,200.50\nInsured:\nA\nB\nC\nD\n"
    d = spark.createDataFrame([("a", page), ("b", None)], "k string, t string")
    got = d.select("k", forms.extract(F.col("t")).alias("v"))
    typed = got.select("k", *forms.typed(F.col("v"))).orderBy("k").collect()
    assert (typed[0]["claim_id"], typed[0]["payment_amount"], str(typed[0]["payment_date"]), typed[0]["insured_address"]) == ("X1", 1200.5, "2024-05-09", "C, D")
    assert all(typed[1][c] is None for c in typed[1].asDict() if c != "k")
    assert {r["field"]: r["a"] for r in forms.summary(got, "k", "v", ["a"]).collect()}["payment_amount"] == "$1,200.50"
    assert len(forms.STATEMENT_FIELDS) == 21 and len(forms.INVOICE_FIELDS) + len(forms.CONSTANT_FIELDS) + 8 == 32


def test_workbooks(spark, tmp_path):
    from stratawork.sources import workbooks

    a = spark.createDataFrame([(1, "=1+1\x00", 2.5, True), (2, "<&> é", None, None), (3, None, None, False)], "i int, `Date Sent` string, v double, b boolean").coalesce(1)
    path = str(tmp_path / "b.xlsx")
    assert workbooks.write_workbook({"a": a, "none": a.limit(0), "big": spark.range(5).coalesce(1)}, path, sheet_rows=3) == {"a": 2, "a_2": 1, "none": 0, "big": 2, "big_2": 2, "big_3": 1}
    assert workbooks.headers(spark, path) == ["i", "Date Sent", "v", "b"]
    got = workbooks.read_rows(spark, path, integers={"i"}).collect()
    assert [tuple(r) for r in got] == [(1, "=1+1", "2.5", "TRUE"), (2, "<&> é", None, None)]
    assert workbooks.read_rows(spark, path, "a", blank=True).collect()[1]["v"] == "" and workbooks.headers(spark, path, "none") == ["No issues found."]
    with pytest.raises(ValueError, match="no sheet 'zzz'"):
        workbooks.read_rows(spark, path, "zzz")


def test_lenient_json(spark, tmp_path):
    message = {"id": 1, "attachments": [{"name": "f1"}, {"name": "f2"}]}
    shapes = {"list": [message, {**message, "id": 2}], "known": {"a": [1], "records": [message], "x": 1}, "first": {"z": [message], "a": [{"id": 9}]}, "one": {"id": 7, "s": "t"}}
    want = {"list": [1, 2], "known": [1], "first": [1], "one": [7]}
    for name, shape in shapes.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(shape))
        assert sorted(r["id"] for r in readers.read_lenient(spark, str(tmp_path / f"{name}.json")).collect()) == want[name]
    assert readers.lenient_records("text") == [] and readers.lenient_records({"emails": []}) == []


def test_json_document_is_read_back(spark, tmp_path):
    d = spark.createDataFrame([(i, "q\n\"é" * (i % 3)) for i in range(7)], "i int, t string").repartition(3)
    sinks.write_json_document(d, str(tmp_path / "d"))
    assert sorted((r["i"], r["t"]) for r in readers.read_export(spark, str(tmp_path / "d"), "L").collect()) == sorted((r["i"], r["t"]) for r in d.collect())


def test_batched_inserts(spark, tmp_path):
    import sqlite3

    path = str(tmp_path / "t.db")
    with sqlite3.connect(path) as con:
        con.execute("create table t (i integer primary key check (i <> 13), s text)")
    d = spark.range(120).select(F.col("id").alias("i"), F.lit("x").alias("s")).filter("i <> 13").coalesce(1)
    insert = "insert or ignore into t values (?, ?)"
    for _ in range(2):  # again: nothing changes
        sinks.insert_rows(d, lambda: sqlite3.connect(path), insert)
    with sqlite3.connect(path) as con:
        assert con.execute("select count(*), min(i), max(i) from t").fetchone() == (119, 0, 119)
    with pytest.raises(Exception, match="CHECK"):  # the whole partition is rolled back
        sinks.insert_rows(spark.createDataFrame([(500, "x"), (13, "x")], "i int, s string").coalesce(1), lambda: sqlite3.connect(path), "insert into t values (?, ?)", 1)
    with sqlite3.connect(path) as con:
        assert con.execute("select count(*) from t where i = 500").fetchone() == (0,)


def test_paging_ends_at_a_short_page():
    asked = []

    def fetch(at, n):
        asked.append(at)
        return list(range(at, min(at + n, 25)))

    assert list(paged.paged(fetch, 10)) == list(range(25)) and asked == [0, 10, 20]


def test_scan_requests(spark):
    known = ["/home/Corpus", "/home/repo"]
    assert rules.scan_request("Files of my corpus, 3 levels deep, excluding tmp files, please", known) == {"depth": 3, "scan_type": "files", "exclude": ["tmp files"], "paths": ["/home/Corpus"]}
    assert rules.scan_request("show the repo 1 level deep") == {"depth": 1, "scan_type": "dirs", "exclude": [], "paths": []}
    d = spark.createDataFrame([("/home/corpus/a",), ("/home/Corpus/a/b/c/d/e",), ("/home/other",), ("/home/corpus/old/x",)], "p string")
    asked = {"depth": 3, "scan_type": "files", "exclude": ["old"], "paths": ["/home/Corpus/"]}
    assert [r["p"] for r in rules.requested(d, "p", asked).collect()] == ["/home/corpus/a"]


def test_names_and_shapes(spark):
    assert C.resolve(["Body", "Body.Text", "Message-ID of X"], "body.text") == "Body.Text" and C.resolve(["A", "full_body"], "Body") == "full_body"
    assert C.resolve(["A", "The Message Id"], "mid", ("message", "id")) == "The Message Id" and C.resolve(["A"], "b") is None
    assert [f.simpleString() for f in C.typed_schema(["a", "b"], {"b"})] == ["a:string", "b:bigint"]
    assert one(spark, C.without_fence, '```json\n{"a": 1}\n```') == '{"a": 1}'
    assert one(spark, C.message_text, '[{"type": "text", "text": "a"}, {"type": "x"}, {"type": "text", "text": "b"}]') == "a b"
    assert one(spark, C.message_text, '"he said \\"x\\""') == 'he said "x"' and one(spark, C.message_text, "plain") == "plain"
    assert one(spark, C.one_or_many, '["a", "b"]') == ["a", "b"] and one(spark, C.one_or_many, "c") == ["c"] and one(spark, C.one_or_many, None) == []
    assert one(spark, C.folder_cwd, "x/C--Users-a/") == "C:\\\\Users\\a" and one(spark, C.folder_cwd, "plain") is None
    assert one(spark, C.forum_date_text, "Last Edit: Today at 1:02:03 AM by X") == "Today at 1:02:03 AM"
    assert one(spark, C.dates, "in sept") == "N" and one(spark, C.dates, "jan 3rd 2020") == "Y" and one(spark, C.dates, " ") == ""


def test_search(spark):
    d = spark.createDataFrame([(1, "Öffnung und Café"), (2, "cafe offnung"), (3, "caf")], "id int, t string")
    idx = search.index(d, "id", "t")
    assert sorted(r["id"] for r in search.term(idx, "id", "CAFÉ").collect()) == [1, 2]
    assert sorted(r["id"] for r in search.prefix(idx, "id", "Caf").collect()) == [1, 2, 3]
    assert search.parse_query("the & rent & (due | late) & !paid") == (["rent"], ["due", "late"], ["paid"])
    with pytest.raises(ValueError):
        search.parse_query("(a1 | b1) & (c1 | d1)")


def test_transcripts(spark):
    from stratawork.operators import transcript

    assert one(spark, lambda c: transcript.marked_word(c, F.lit(0.2)), "w") == "[inaudible]" and one(spark, lambda c: transcript.marked_word(c, F.lit(0.1)), "[x]") == "[x]"
    with pytest.raises(ValueError):
        transcript.marked_word(F.lit("w"), F.lit(0.1), 0.6, 0.5)


def test_states(spark, tmp_path):
    from stratawork.operators import config

    path = str(tmp_path / "h")
    config.advance(None, spark, path, "s", "queued", "1")
    config.advance(spark.read.parquet(path), spark, path, "s", "running", "2")
    with pytest.raises(ValueError):
        config.advance(spark.read.parquet(path), spark, path, "s", "queued", "3")
    config.advance(spark.read.parquet(path), spark, path, "s", "done", "4", 7)
    assert [tuple(r) for r in config.states(spark.read.parquet(path)).collect()] == [("s", "done", "4", 7)]
    names = spark.createDataFrame([("a.pdf",), ("a_1.pdf",), ("b",)], "n string")
    assert config.next_free(names, "n", "a.pdf") == "a_2.pdf" and config.next_free(names, "n", "c.pdf") == "c.pdf" and config.next_free(names, "n", "b") == "b_1"


def test_settings(spark):
    from stratawork.operators import config

    d = spark.createDataFrame([("Fresh_Run", "y"), (None, "x"), ("prior_csv_1", "a"), ("prior_csv_2", "b"), ("prior_csv_4", "d")], "k string, v string")
    found = config.key_values(d)
    assert found["run_mode"] == "fresh" and config.numbered(found, "prior_csv") == ["a", "b"]
    assert config.key_values(d.union(spark.createDataFrame([("RUN_MODE", "incremental")], "k string, v string")))["run_mode"] == "incremental"


def test_enrolment(spark):
    from stratawork.operators import config

    p = spark.createDataFrame([("Ann ", 20.0, "old"), ("Bob", 20.0, "b")], "name string, seconds double, v string")
    new = spark.createDataFrame([(" ann", 12.0, "new"), ("Cy", 11.9, "short")], "name string, seconds double, v string")
    assert sorted((r["name_key"], r["v"]) for r in config.enrol(p, new).collect()) == [("ann", "new"), ("bob", "b")]


def test_upsert_keys(spark):
    t = spark.createDataFrame([("a", "1")], "k string, o string")
    twice = spark.createDataFrame([("a", "2"), ("a", "3"), ("b", "4"), ("b", "4")], "k string, o string")
    assert sorted(map(tuple, upsert.upsert(t, twice, "k", {"o": upsert.OVERWRITE}).collect())) == [("a", "3"), ("b", "4")]
    for bad in (spark.createDataFrame([(None, "2")], "k string, o string"), spark.createDataFrame([(" ", "2")], "k string, o string"), t.select("o")):
        with pytest.raises(ValueError):
            upsert.upsert(t, bad, "k", {})


def test_nearest_profile_by_blocks(spark):
    d = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [-1.0, -1.0]), (4, [0.0, 0.0]), (5, None)], "id int, v array<double>")
    p = spark.createDataFrame([("b", 2, [1.0, 0.1]), ("a", 1, [2.0, 0.2]), ("c", 3, [0.1, 1.0])], "profile string, ordinal int, pv array<double>")
    for block in (10, 1):
        got = joins.nearest_profile(d, "id", "v", p, 0.3, block).orderBy("id").collect()
        assert [r["profile"] for r in got] == ["a", "c", "Unknown", "Unknown", "Unknown"] and got[3]["similarity"] == 0


def test_retry():
    from stratawork.streaming.ingest import retry

    tried = []

    def f():
        tried.append(1)
        if len(tried) < 3:
            raise OSError
        return "done"

    assert retry(f, wait=0) == "done" and len(tried) == 3
    with pytest.raises(ValueError):
        retry(lambda: int("x"), wait=0)


def test_readers(spark, tmp_path):
    (tmp_path / "e.json").write_text(json.dumps({"emails": [{"a": 1}, {"a": 2, "b": "x"}]}))
    got = readers.read_export(spark, str(tmp_path / "e.json"), "MSG")
    assert sorted((r["a"], r["_input_source"]) for r in got.collect()) == [(1, "MSG"), (2, "MSG")]
    (tmp_path / "n.json").write_text(json.dumps({"x": 1}))
    with pytest.raises(ValueError):
        readers.read_export(spark, str(tmp_path / "n.json"), "MSG")
    (tmp_path / "s.csv").write_text("Date Sent,From\n1,a\n,\n2\n")
    assert [tuple(r) for r in readers.read_sheet(spark, str(tmp_path / "s.csv")).collect()] == [("1", "a"), ("2", None)]
    (tmp_path / "ids.txt").write_text("Message-ID\n# no\n<A@x>\na@X\n; no\nb@y\n")
    assert [r["message_id"] for r in readers.read_message_ids(spark, str(tmp_path / "ids.txt")).orderBy("position").collect()] == ["<a@x>", "<b@y>"]
    (tmp_path / "l.jsonl").write_text('{"cwd": "/A", "n": {"cwd": "/A"}}\n{bad\n')
    lines = readers.rewrite_json_lines(spark.read.text(str(tmp_path / "l.jsonl")), "value", "cwd", ["/a"], "/b")
    assert [r[0] for r in lines.collect()] == ['{"cwd": "/b", "n": {"cwd": "/A"}}', "{bad"]


def test_walk(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    for p in ("x.txt", "a/y.txt", "a/b/z.txt"):
        (tmp_path / p).write_text("hi")
    import os

    os.symlink(tmp_path, tmp_path / "a" / "loop")
    os.symlink(tmp_path / "a" / "b", tmp_path / "c")
    spark.dataSource.register(readers.WalkSource)
    walk = spark.read.format("walk").option("path", str(tmp_path)).load()
    got = walk.filter("kind = 'file'").collect()
    assert sorted((r["name"], r["depth"], r["size_bytes"]) for r in got) == [("x.txt", 0, 2), ("y.txt", 1, 2), ("z.txt", 2, 2)]
    stats = {os.path.relpath(r["path"], tmp_path): (r["subdirs"], r["files"], r["size"]) for r in readers.shallow_stats(walk).collect()}
    assert stats == {".": (1, 1, 2), "a": (1, 1, 2), "a/b": (0, 1, 2)}
    followed = spark.read.format("walk").option("path", str(tmp_path)).option("links", "true").load()
    assert sorted(r["name"] for r in readers.whole_files(followed, [".sys"], ["system"]).collect()) == ["x.txt", "y.txt", "z.txt"]
    assert readers.whole_files(followed, [".txt"], []).count() == 0 and readers.whole_files(walk, [], ["B"]).count() == 2
    shallow = spark.read.format("walk").option("path", str(tmp_path)).option("depth", "1").load()
    assert sorted(r["name"] for r in shallow.filter("kind = 'file'").collect()) == ["x.txt", "y.txt"]
    names = readers.by_name(got_names := walk.filter("kind = 'file'").select(F.upper("name").alias("name"), "path"))
    assert sorted(r["name"] for r in names.collect()) == ["x.txt", "y.txt", "z.txt"] and got_names.count() == 3
    (tmp_path / "bad.txt").write_bytes(b"\xff\xfe")
    samples = {os.path.basename(r["path"]): (r["sample"], r["extracted"]) for r in readers.read_sample(spark, str(tmp_path / "*.txt"), 1).collect()}
    assert samples == {"x.txt": ("h", True), "bad.txt": ("", False)}


def test_sinks(spark, tmp_path):
    a, b = spark.createDataFrame([(1, "x\x00")], "i int, t string"), spark.createDataFrame([(2, 3.0)], "i int, v double")
    u = sinks.union_all([a, b])
    assert sinks.ordered_columns(u, ["v", "none"]).columns == ["v", "i", "t"]
    sinks.write_sheet(a, str(tmp_path / "s"))
    assert spark.read.option("header", True).csv(str(tmp_path / "s")).first()["t"] == "x"
    sinks.write_report({"empty": a.limit(0)}, str(tmp_path / "r"))
    assert spark.read.option("header", True).csv(str(tmp_path / "r/empty")).first()[0] == "No issues found."
    sinks.write_rollover(spark.range(10).coalesce(1), str(tmp_path / "o"), 4)
    assert len(list((tmp_path / "o").glob("part-*"))) == 3


@pytest.mark.parametrize("parts", [1, 8, 64])
def test_rollover_numbers_wide_rows_once(spark, parts):
    """Counting reads a narrow and numbering a wide table: both have to see the same partitions."""
    from stratawork.operators.windows import rollover

    n = 4000
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        wide = spark.range(n).select(((F.col("id") * 7919) % n).alias("k"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 32).alias("text"))
        got = rollover(wide, ["k"], 700, 137).select("k", "tab", "row_in_tab", F.length("text").alias("size")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted((r["k"], r["tab"], r["row_in_tab"], r["size"]) for r in got) == [(k, (k + 137) // 700 + 1, (k + 137) % 700 + 1, 2048) for k in range(n)]


def test_tables_are_reloaded_and_seeded(spark, tmp_path):
    from stratawork.operators import config

    spark.sql(f"create schema if not exists reloaded location '{tmp_path}/db'")
    a, b = spark.range(3).toDF("i"), spark.range(5).toDF("i")
    sinks.reload([("reloaded.child", a), ("reloaded.parent", b)])
    sinks.reload([("reloaded.child", b), ("reloaded.parent", a)], shared={"reloaded.parent"})
    assert spark.table("reloaded.child").count() == 5 and spark.table("reloaded.parent").count() == 5
    assert config.seed(spark, "reloaded.bands", [("High", 60)], "band string, min_score int")
    assert not config.seed(spark, "reloaded.bands", [], "band string, min_score int") and spark.table("reloaded.bands").count() == 1
    assert config.migrate(a, {"i": "j"}, str(tmp_path / "m")) == 3 and spark.read.parquet(str(tmp_path / "m")).columns == ["j"]
    with pytest.raises(ValueError):
        sinks.checked_header(["a"], ["a", "b"], "tab")
    sinks.checked_header(["a"], ["a"], "tab")
    spark.sql("drop schema reloaded cascade")


def test_an_idle_stream_ends(spark, tmp_path):
    from stratawork.streaming.ingest import until_idle

    spark.range(25).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))
    q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).start()
    assert until_idle(q, 4) == 25 and not q.isActive
    assert spark.read.parquet(str(tmp_path / "out")).count() == 25


def test_first_seen_drops_repeats(spark, tmp_path):
    from stratawork.streaming.ingest import first_seen, run_to_end

    for k, rows in enumerate(([("a", "2024-01-01 00:00:00"), ("b", "2024-01-01 01:00:00")], [("a", "2024-01-01 02:00:00"), ("c", "2024-01-01 03:00:00")])):
        spark.createDataFrame(rows, "k string, t string").selectExpr("k", "timestamp(t) as t").coalesce(1).write.parquet(str(tmp_path / "in" / f"f{k}"))
        stream = spark.readStream.schema("k string, t timestamp").parquet(str(tmp_path / "in" / "*"))
        run_to_end(first_seen(stream, "k", "t"), str(tmp_path / "out"), str(tmp_path / "c"))
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]


def test_losers_are_rows(spark):
    """Every row but the winner of a key of two or more, repeats and a null key too."""
    from stratawork.operators import dedup

    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2), ("b", 4), (None, 5), (None, 6), ("c", 8), ("c", 7)], "k string, id int")
    assert sorted(map(tuple, dedup.losers(df, ["k"], F.min("id"), "id").collect())) == [("a", 1, 2), ("a", 1, 3), ("c", 7, 8)]
    assert dedup.losers(df.limit(0), ["k"], F.min("id"), "id").count() == 0
