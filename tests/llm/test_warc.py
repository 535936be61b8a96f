from __future__ import annotations

import hashlib

from stratawork.llm import warc


def test_round_trip(spark):
    big, small = "<p>" + "é" * 120, "<p>x"
    rows = [(5, "http://a/5", big), (2, "http://a/2", big), (9, "http://a/9\r\nX: y", big), (1, None, small), (3, "http://a/3", small), (4, "u", None), (6, "u", ""), (7, "u", "solo" * 50), (7, "u", "solo" * 50), (None, "u", big)]
    pages = spark.createDataFrame([(*r, "q", 1) for r in rows], "page_id bigint, url string, html string, uri string, nth int").repartition(3)
    got = warc.round_trip(pages).collect()
    assert len(got) == len(rows)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    by = {}
    for r in got:
        by.setdefault(r["page_id"], []).append(r)
    for page, _, html in rows:
        assert all((r["payload_bytes"], r["payload_digest"]) == (len((html or "").encode()), sha(html)) for r in by[page])
    kinds = {k: sorted((r["record_type"], r["refers_to"]) for r in v) for k, v in by.items()}
    assert kinds[2] == [("response", None)] and kinds[5] == kinds[9] == kinds[None] == [("revisit", 2)]
    assert all(kinds[k] == [("response", None)] for k in (1, 3, 4, 6))
    assert kinds[7] == [("response", None), ("revisit", 7)]
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_fresh_ids_and_references(spark, tmp_path):
    """Each record has an id of its own, fresh in the final archives; a revisit names a response that is there, by id, target and date."""
    import glob

    from stratawork.llm.support import Scratch

    big = "<p>" + "z" * 200
    rows = [(7, "http://a/1", big), (7, "http://a/2", big), (None, "http://a/3", "x"), (None, "http://a/4", "x"), (3, "http://a/5", "y" * 1_000_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(2)
    s = Scratch(spark, "warc")
    headers = s.table("headers", warc.write_archives(pages, s.path("raw")))
    numbered, archives = warc.counted(s, headers)
    assert archives == 2 and sorted({r["archive"] for r in numbered.collect()}) == [0, 1]
    manifest = s.table("manifest", warc.rewrite_archives(warc.resolve(s, numbered), s.path("final"), archives))
    assert sum(r["records"] for r in manifest.collect()) == 5
    read = lambda k: [h for f in glob.glob(s.path(k).removeprefix("file:") + "/*.gz") for h, _ in warc.records(f)]
    raw, final = read("raw"), read("final")
    ids = [h["WARC-Record-ID"] for h in raw + final]
    assert len(set(ids)) == len(ids) == 10
    by = {h["WARC-Record-ID"]: h for h in final}
    revisits = [h for h in final if h["WARC-Type"] == "revisit"]
    assert len(revisits) == 1
    to = by[revisits[0]["WARC-Refers-To"]]
    assert to["WARC-Type"] == "response" and to["X-Page-ID"] == "7" and to["WARC-Target-URI"] == revisits[0]["WARC-Refers-To-Target-URI"] and to["WARC-Date"] == revisits[0]["WARC-Refers-To-Date"]
