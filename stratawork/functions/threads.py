"""Forum pages to posts: a table function over an element tree, and the thread that its posts make up."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratawork.functions.columns import forum_date, forum_date_text, likes, plain_title
from stratawork.functions.html import _Tree, _all, _nodes, _said, parts_of
from stratawork.operators.windows import HOT_ROWS, positions
from stratawork.session import written

#: Classes and addresses of the forum's theme; fixed values.
WRAPPER, POSTER, INFO, SMALL, DETAILS = "windowbg", "poster", "postinfo", "smalltext", "topic_details"
PROFILE, TOPIC, MESSAGE = r"action=profile;u=\d+", r"topic=(\d+)", r"msg[=#]?(\d+)"
BODY_CLASS = r"\bpost\b|inner|post_body"
PER_PAGE = 15

_QUOTES = "array<struct<author:string,text:string>>"
THREAD_POST = f"place int, post_id string, author string, info string, links array<string>, small string, own_text string, raw_html string, quotes {_QUOTES}, said string"
SHOWN_POST = f"place int, topic_id bigint, post_id string, small string, own_text string, raw_html string, quotes {_QUOTES}, said string"


class _Page(_Tree):
    """A tree that also knows the source between an element's tags."""

    def __init__(self, source: str):
        self.spans: dict[int, list[int]] = {}
        self.source, self.lines = source, [0, *(m.end() for m in re.finditer("\n", source))]
        super().__init__(source)

    def _offset(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def handle_starttag(self, tag, attrs):
        super().handle_starttag(tag, attrs)
        if self.at.tag == tag:
            self.spans[id(self.at)] = [self._offset() + len(self.get_starttag_text() or ""), len(self.source)]

    def _leave(self, node):
        at, end = self.at, self._offset()
        while at is not node.up:
            self.spans[id(at)][1] = end
            at = at.up
        super()._leave(node)

    def inner(self, node) -> str:
        start, end = self.spans[id(node)]
        return self.source[start:end]


def _has(name: str, tag: str = "div"):
    return lambda n: n.tag == tag and name in n.attrs.get("class", "").split()


def _first(node, test):
    return next(_all(node, test), None) if node is not None else None


def _text(node) -> str | None:
    return None if node is None else re.sub(r"\s+", " ", _said(node, set())).strip()


def _post(page: _Page, wrapper, body) -> tuple:
    own, quotes = parts_of(body)
    return own, page.inner(body), [{"author": a, "text": t} for a, t in quotes], "".join(_nodes(wrapper, set()))


def _rows_of_thread(source: str | None):
    """The posts of a topic's page: blocks with the id of a message and a body; the other columns are null where the page has no such part."""
    page = _Page(source or "")
    for place, w in enumerate(_all(page.root, lambda n: _has(WRAPPER)(n) and re.fullmatch(r"msg\d+", n.attrs.get("id", "")))):
        body = _first(w, lambda n: n.tag == "div" and re.fullmatch(r"msg_\d+", n.attrs.get("id", ""))) or _first(w, lambda n: n.tag == "div" and re.search(BODY_CLASS, n.attrs.get("class", "")))
        if body is None:
            continue
        author = _first(_first(w, _has(POSTER)), lambda n: n.tag == "a" and re.search(PROFILE, n.attrs.get("href", "")))
        links = [_text(a) for a in _all(w, _has(SMALL, "a"))]
        own, raw, quotes, said = _post(page, w, body)
        yield place, w.attrs["id"], "" if author is None else "".join(x.strip() for x in _nodes(author, set())), _text(_first(w, _has(INFO))), links, _text(_first(w, _has(SMALL, "span"))), own, raw, quotes, said


def _rows_shown(source: str | None):
    """The posts of a member's page: blocks that link to a message of a topic and have a body."""
    page = _Page(source or "")
    for place, w in enumerate(_all(page.root, _has(WRAPPER))):
        link = _first(_first(w, _has(DETAILS)), lambda n: n.tag == "a" and re.search(TOPIC + ".*msg" + r"\d+", n.attrs.get("href", "")))
        body = _first(w, _has("inner")) or _first(w, _has("post"))
        if link is None or body is None:
            continue
        named = re.search(MESSAGE, link.attrs["href"])
        own, raw, quotes, said = _post(page, w, body)
        yield place, int(re.search(TOPIC, link.attrs["href"])[1]), f"msg{named[1]}", _text(_first(w, _has(SMALL, "span"))) or "", own, raw, quotes, said


@F.udtf(returnType=THREAD_POST)
class _ThreadPosts:
    def eval(self, source: str):
        yield from _rows_of_thread(source)


@F.udtf(returnType=SHOWN_POST)
class _ShownPosts:
    def eval(self, source: str):
        yield from _rows_shown(source)


def _dated(df: DataFrame, text: Column, as_of: Column) -> DataFrame:
    return df.withColumn("date_text", text).withColumn("post_date", forum_date(F.col("date_text"), as_of)).withColumn("likes", likes(F.col("said"))).drop("said")


def topic_posts(pages: DataFrame, html: str, as_of: Column) -> DataFrame:
    """``pages`` without its source, a row a post: place, post_id, author, own_text, raw_html, quotes, date_text, post_date and likes.

    A date is sought in the post's information, then in each of its small
    links, then in its first small span. A page without posts, empty or null,
    gives no row; a post without a date that can be read has a null post_date.
    """
    posts = pages.lateralJoin(_ThreadPosts(F.col(html).outer())).drop(html)
    tried = F.concat(F.array("info"), F.coalesce("links", F.array().cast("array<string>")), F.array("small"))
    found = F.filter(F.transform(tried, forum_date_text), lambda d: d != "")
    return _dated(posts, F.coalesce(F.get(found, F.lit(0)), F.lit("")), as_of).drop("info", "links", "small")


def shown_posts(pages: DataFrame, html: str, as_of: Column) -> DataFrame:
    """The posts of a member's pages, with the topic of each: what a crawl seeks topics by."""
    return _dated(pages.lateralJoin(_ShownPosts(F.col(html).outer())).drop(html), F.col("small"), as_of).drop("small")


def thread(posts: DataFrame, topic: str, page: str, cutoff: Column | None = None, rows: int = HOT_ROWS) -> DataFrame:
    """Each post of a topic once, with its position and the seconds since the one before.

    Undated posts and those before ``cutoff`` go. A post on several pages is
    the one of the smallest (page, place). Ties of a date keep that order. A
    topic of more than ``rows`` posts is numbered by many tasks. Pages are parsed
    once: their posts are written before topics are counted.
    """
    dated = posts.filter(F.col("post_date").isNotNull() if cutoff is None else F.col("post_date") >= cutoff)
    rest = [c for c in dated.columns if c not in (topic, "post_id")]
    once = dated.groupBy(topic, "post_id").agg(F.min_by(F.struct(*rest), F.struct(page, "place")).alias("x")).select(topic, "post_id", "x.*")
    return positions(written(once.sparkSession, once, "posts"), [topic], ["post_date", page, "place"], "post_date", rows)


def topic_head(html: Column, topic: Column) -> Column:
    """struct<title, last_start>: the first second-level heading without reply marks (else 'Thread n'), and the greatest offset that a link to the topic's pages names."""

    @F.pandas_udf(T.StructType([T.StructField("title", T.StringType()), T.StructField("starts", T.ArrayType(T.StringType()))]))
    def run(sources: pd.Series) -> pd.DataFrame:
        out = []
        for s in sources:
            root = _Tree(s or "").root
            h2 = _first(root, lambda n: n.tag == "h2")
            out.append((None if h2 is None else "".join(x.strip() for x in _nodes(h2, set())), [n.attrs["href"] for n in _all(root, lambda n: n.tag == "a" and "topic=" in n.attrs.get("href", ""))]))
        return pd.DataFrame(out, columns=["title", "starts"])

    h = run(html)
    offsets = F.transform(h["starts"], lambda s: F.call_function("regexp_extract", s, F.concat(F.lit("topic="), topic.cast("string"), F.lit(r"\.(\d+)")), F.lit(1)).try_cast("bigint"))
    return F.struct(F.coalesce(F.trim(plain_title(h["title"])), F.concat(F.lit("Thread "), topic.cast("string"))).alias("title"), F.coalesce(F.array_max(offsets), F.lit(0)).alias("last_start"))


def page_offsets(last_start: Column, size: int = PER_PAGE) -> Column:
    """The offsets of a topic's pages, the first 0."""
    return F.sequence(F.lit(0).cast("bigint"), F.greatest(last_start, F.lit(0)) + size - 1, F.lit(size).cast("bigint"))
