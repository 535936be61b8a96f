"""Texts and pages that recursion, by markup or by a pattern, would not survive."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from stratawork.functions import columns as C
from stratawork.functions import html
from stratawork.operators import mail, rules


def test_blank_lines(spark):
    df = spark.createDataFrame([("a" + "\n" * 1_000_000 + "b",), ("a\n" + " \t\n" * 300_000 + "b",), ("> q\na\n\n\n> q\nb",)], "t string")
    assert [r[0] for r in df.select(mail.strip_gt(F.col("t"))).collect()] == ["a\n\nb", "a\n\nb", "a\n\nb"]
    titles = spark.createDataFrame([("Re: " * 200_000 + "x",), ("Re:Re:  y",), ("Really",)], "t string")
    assert [r[0] for r in titles.select(C.plain_title(F.col("t"))).collect()] == ["x", "y", "Really"]


def test_line_of_a_tab_is_blank(spark):
    df = spark.createDataFrame([("body\n\t\nA Person\nDirector",)], "t string")
    assert df.select(mail.walk_back(F.col("t"), 4)).first()[0] == "body\n\t"


@pytest.mark.parametrize("tag", ["p", "li", "td", "b", "div", "blockquote", "x"])
def test_unclosed_tags(tag):
    began = time.monotonic()
    page = f"<{tag}>a" * 100_000
    assert html.html_text(page) == "\n".join("a" * 100_000)
    assert html.plain_text(page) == "a" * 100_000
    assert html.without_quote(page + "<i class='gmail_quote'>old") == "\n".join("a" * 100_000)
    if tag != "blockquote":
        assert html.post_parts(page)[0] == " ".join("a" * 100_000)
    assert html.plain_text(page + "</y>" * 100_000 + f"</{tag}>" * 50_000) == "a" * 100_000
    assert time.monotonic() - began < 60


def test_implied_ends():
    tree = html._Tree("<ul><li>a<ul><li>b<li>c</ul><li>d</ul><table><tr><td>1<td>2<table><tr><td>3</table>4<tr><td>5</table><p>x<p>y<div><p>z</div>")
    shape = lambda n: [k if isinstance(k, str) else (k.tag, shape(k)) for k in n.kids]
    inner = ("ul", [("li", ["b"]), ("li", ["c"])])
    table = ("table", [("tr", [("td", ["1"]), ("td", ["2", ("table", [("tr", [("td", ["3"])])]), "4"])]), ("tr", [("td", ["5"])])])
    assert shape(tree.root) == [("ul", [("li", ["a", inner]), ("li", ["d"])]), table, ("p", ["x"]), ("p", ["y", ("div", [("p", ["z"])])])]


def test_contents_that_look_like_json(spark):
    texts = ["[not json", '"said" he', '[1, 2]', '["a"]', '[{"type": "text", "text": "x"}, {"type": "text", "text": "y"}]', '"a \\"b\\""', "plain", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(C.message_text(F.col("t"))).collect()] == ["[not json", '"said" he', "[1, 2]", '["a"]', "x y", 'a "b"', "plain", None, ""]


def test_requests(spark):
    ask = rules.scan_request("List files in Work and Photos 3 levels deep, excluding old backups, please", ["D:/Work", "D:/photos/x", "D:/abc"])
    assert ask == {"depth": 3, "scan_type": "files", "exclude": ["old backups"], "paths": ["D:/Work", "D:/photos/x"]}
    assert rules.scan_request("scan abc skip tmp and go") == {"depth": None, "scan_type": "dirs", "exclude": ["tmp"], "paths": []}
    assert rules.scan_request("ignore")["exclude"] == [] and rules.scan_request("")["depth"] is None
    df = spark.createDataFrame([(p,) for p in ["D:\\Work", "d:/work/a", "D:/work/a/b/c/d", "D:/works/x", "D:/photos/x/old backups/y", "E:/x"]], "path string")
    assert sorted(r[0] for r in rules.requested(df, "path", ask).collect()) == ["D:\\Work", "d:/work/a"]
    assert rules.requested(df, "path", rules.scan_request("1 level deep")).count() == 2
