"""Queries over whole inputs: small tables whose rows a cut would lose."""

from __future__ import annotations

import duckdb
import pytest

from stratawork.plans import catalogue


@pytest.fixture
def run(spark, tmp_path):
    """The rows of a query, sorted, over tables given as SQL."""

    def rows(name, **tables):
        for t, sql in tables.items():
            duckdb.sql(f"copy ({sql}) to '{tmp_path}/{t}.parquet' (format parquet)")
        return sorted(map(tuple, catalogue.queries()[name](spark, str(tmp_path)).collect()), key=str)

    return rows


def test_session_messages(run):
    texts = "case turn when 3 then 'x <local-command-stdout> and more text' when 4 then '<command-name>/clear and more text' when 5 then 'then <ide_opened_file> and more text' when 6 then 'short' else 'if a < b then <b>bold</b> ' || turn end"
    got = run("session_messages", conversations=f"select 1::bigint as conv_id, turn, case turn when 7 then 'system' else 'user' end as role, {texts} as text from range(40) t(turn)")
    assert sorted(r[1] for r in got) == [0, 1, 2, *range(8, 31)]


def test_entity_hits(run):
    documents = """(values (1, 'See "Acme Widget Works", and (ZED)s'), (2, 'superacme widget worksmanship'), (3, 'acme widgets works' || chr(10) || 'acme widget, works'), (4, 'a foo  bar'), (5, 'xfoo bars'), (6, null)) t(doc_id, text)"""
    benchmark = """(values (10, ' Acme Widget Works '), (11, 'zed'), (12, 'FOO bar'), (13, '  '), (14, 'widget,'), (11, 'zed)')) t(item_id, text)"""
    assert run("entity_hits", documents=f"from {documents}", benchmark=f"from {benchmark}") == [(1, 10), (1, 11), (2, 10), (3, 14), (5, 12)]


def test_entity_hits_by_contains(spark):
    d = "/root/testdata/sf0.001"
    sql = f"select doc_id, item_id from '{d}/documents.parquet' d join '{d}/benchmark.parquet' b on contains(lower(d.text), lower(b.text))"
    assert sorted(map(tuple, catalogue.queries()["entity_hits"](spark, d).collect())) == sorted(duckdb.sql(sql).fetchall())


def test_incremental(run):
    tables = {"documents": "select i as doc_id, i * 10 as n_chars from range(8) t(i)", "labels": "select unnest([2, 3, 20])::bigint as doc_id"}
    assert run("incremental_new_only", **tables) == [(i, i * 10) for i in (0, 1, 4, 5, 6, 7)]
    assert sorted(run("incremental_accumulate", **tables)) == [(i,) for i in (*range(8), 20)]


def test_strip_original(run):
    documents = "select * from (values (1, 'no boundary'), (2, 'kept' || chr(10) || '-----Original message-----' || chr(10) || 'old'), (17, 'marked')) t(doc_id, text)"
    assert run("strip_original", documents=documents) == [(1, 11), (17, 6), (2, 4)]


def test_profile_conflicts(run):
    # the first vector of a label is its profile; vectors 101 and 102 of labels 1 and 10 are nearest to 0's, 103 to none
    vectors = "(values (50, 0, [1, 0, 0]), (51, 1, [0, 1, 0]), (52, 10, [0, 0, 1]), (101, 1, [3, 1, 0]), (102, 10, [3, 0, 1]), (103, 10, [-1, -1, -1]), (104, 1, [3, 1, 1])) t(vec_id, label, v)"
    embeddings = f"select vec_id::bigint as vec_id, label::bigint as label, v::float[] as embedding from {vectors}"
    assert run("profile_conflicts", embeddings=embeddings) == [("0", 3, "0, 1, 10")]


def test_name_sort(run):
    customer = "select i as c_custkey, 'N' || (99999 - i) as c_name, case when i % 2 = 0 then 'A' else 'b' end as c_mktsegment from range(20000) t(i)"
    got = sorted(run("name_sort", customer=customer), key=lambda r: r[2])
    assert [r[0] for r in got] == [*range(19998, -1, -2), *range(19999, 0, -2)] and [r[2] for r in got] == list(range(1, 20001))


def test_numeric_suffix_sort(run):
    assert len(run("numeric_suffix_sort", supplier="select i as s_suppkey, 'S#' || i as s_name from range(30) t(i)")) == 30


def test_text_layer(run):
    conversations = "select conv_id, turn, repeat('x', n) as text from (values (1, 0, 100), (1, 6, 99), (1, 7, 5), (2, 4, 99), (2, 5, 500), (3, 8, 200)) t(conv_id, turn, n)"
    assert run("text_layer", conversations=conversations) == [(1, True, 6), (2, False, 4), (3, False, None)]


def test_money_dates(run):
    documents = "select * from (values (8, 'ten Dollars'), (9, 'a recent percentage'), (10, 'USD 5 on 2024-01-02'), (12, '50 cents'), (7, 'amount added'), (13, 'feb 3rd 2021'), (1, 'dated by its mark')) t(doc_id, text)"
    assert run("money_dates", documents=documents) == [(1, "N", "Y"), (10, "Y", "Y"), (12, "Y", "N"), (13, "N", "Y"), (7, "Y", "N"), (8, "Y", "N"), (9, "N", "N")]


def test_compared_bodies_are_whole(run):
    # alike in the first 30 characters: 1 has no mark, 7 an amount, 17 a quoted message
    documents = "select doc_id, repeat('x', 40) as text from (values (1), (7), (17)) t(doc_id)"
    x = "x" * 40
    assert run("majority_vote", documents=documents) == [(1, x, "YYYY", "ALL_MATCH"), (17, x, "YNYN", "PARTIAL"), (7, x + " $1,234.50", "NYYY", "PARTIAL")]
    assert run("match_code", documents=documents) == [("NYYY", 1), ("YNYN", 1), ("YYYY", 1)]
    quoted = 40 + len("\n-----Original Message-----\nold")
    average = round((40 + 50 + quoted) / 3, 4)
    assert run("shortest_longest", documents=documents) == [("c1", 3, 1, 40.0), ("c2", 1, 3, average), ("c3", 2, 2, round(130 / 3, 4)), ("c4", 1, 3, average)]


def test_interval_overlap(run):
    """An event of value 0 has no length: it counts where another holds it, as in the SQL."""
    events = "select * from (values (1, 5, 'view', timestamp '2024-01-01 00:00:00', 10.0::double), (2, 5, 'click', timestamp '2024-01-01 00:01:00', 0.0::double), (3, 5, 'buy', timestamp '2024-01-01 00:01:00', 0.0::double), (4, 5, 'buy', timestamp '2024-01-01 00:03:20', 0.0::double)) t(event_id, user_id, event_type, ts, value)"
    assert run("interval_overlap", events=events) == [(1, 2), (1, 3)]


def test_fts_language(run):
    """A word with marks is not the word without: only the first has a stem that is asked for."""
    documents = "select * from (values (1, 'Tioned things under'), (2, 'tioné things under'), (3, 'tion thíngs under'), (4, 'THINGS')) t(doc_id, text)"
    assert run("fts_language", documents=documents) == [(1,)]
    assert run("fts_not", documents=documents.replace("'tion thíngs under'", "'cópyright thíngs'")) == [(3,)]
