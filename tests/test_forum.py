"""Forum pages to posts and threads."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratawork.functions import threads

def now():
    return F.lit("2024-01-02 12:00:00")


def _block(k, body, info="", author="A", open_end=False):
    return f'<div class="windowbg odd" id="msg{k}"><div class="poster"><a href="?action=profile;u=3">{author}</a></div>{info}<div id="msg_{k}">{body}' + ("" if open_end else "</div></div>")


def _date(x):
    return f'<div class="postinfo">Reply {x}</div>'


def test_posts_of_a_page(spark):
    page = (
        _block(1, "x <b>y</b>", _date("March 1, 2020, 1:00:00 PM Last Edit: May 1, 2021, 1:00:00 AM"))
        + _block(2, "edited only", '<span class="smalltext">Last Edit: Today at 2:00:00 AM</span>')
        + _block(3, "no date")
        + '<div class="windowbg" id="other">no message</div><div class="windowbg" id="msg9">no body</div>'
        + '<div class="windowbg" id="msg4"><a class="smalltext">none</a><a class="smalltext">Yesterday at 3:00:00 PM</a><p class="post_body">not a div</p><div class="inner">by class</div>1 person likes this</div>'
        + _block(5, "<blockquote class='bbc_standard_quote'><cite>Quote from: B C on x</cite>q</blockquote>own\nline", _date("March 1, 2020, 1:00:05 PM"), open_end=True)
    )
    df = spark.createDataFrame([(1, page), (2, ""), (3, None), (4, "<p>no posts")], "page int, html string")
    rows = {r.post_id: r for r in threads.topic_posts(df, "html", now()).collect()}
    assert set(rows) == {"msg1", "msg2", "msg3", "msg4", "msg5"} and {r.page for r in rows.values()} == {1}
    assert [str(rows[k].post_date) for k in ("msg1", "msg2", "msg3", "msg4", "msg5")] == ["2020-03-01 13:00:00", "2024-01-02 02:00:00", "None", "2024-01-01 15:00:00", "2020-03-01 13:00:05"]
    assert (rows["msg1"].own_text, rows["msg1"].raw_html, rows["msg1"].author) == ("x y", "x <b>y</b>", "A")
    assert (rows["msg4"].own_text, rows["msg4"].author, rows["msg4"].likes) == ("by class", "", 1)
    assert rows["msg5"].own_text == "own line" and [tuple(q) for q in rows["msg5"].quotes] == [("B C", "q")] and rows["msg5"].raw_html.endswith("own\nline")


def test_threads_number_each_post_once(spark):
    first = _block(2, "b", _date("March 1, 2020, 1:00:10 PM")) + _block(1, "a", _date("March 1, 2020, 1:00:00 PM")) + _block(7, "old", _date("March 1, 2001, 1:00:00 PM"))
    second = _block(2, "again", _date("March 1, 2020, 1:00:10 PM")) + _block(3, "c", _date("March 1, 2020, 1:00:10 PM"))
    df = spark.createDataFrame([(5, 0, first), (5, 15, second), (6, 0, first)], "topic int, start int, html string")
    posts = threads.topic_posts(df, "html", now())
    want = [(5, "msg1", "a", 1, None), (5, "msg2", "b", 2, 10), (5, "msg3", "c", 3, 0), (6, "msg1", "a", 1, None), (6, "msg2", "b", 2, 10)]
    for rows in (1 << 22, 1):  # left to a window, and by segments
        t = threads.thread(posts, "topic", "start", F.lit("2004-01-01").cast("timestamp"), rows)
        assert [(r.topic, r.post_id, r.own_text, r.position, r.lag_seconds) for r in t.orderBy("topic", "position").collect()] == want


def test_heads_and_offsets(spark):
    df = spark.createDataFrame([(5, "<h2>Re: Re: A title</h2><a href='x?topic=5.30'>3</a><a href='x?topic=5.15'>2</a><a href='x?topic=15.90'>n</a>"), (6, None), (7, "<h2></h2><a href='?topic=7.0'>")], "topic int, html string")
    h = {r.topic: r.h for r in df.select("topic", threads.topic_head(F.col("html"), F.col("topic")).alias("h")).collect()}
    assert tuple(h[5]) == ("A title", 30) and tuple(h[6]) == ("Thread 6", 0) and tuple(h[7]) == ("", 0)
    o = spark.createDataFrame([(0,), (7,), (30,)], "n int").select(threads.page_offsets(F.col("n")).alias("o")).collect()
    assert [r.o for r in o] == [[0], [0, 15], [0, 15, 30]]


def test_unclosed_markup_of_any_depth(spark):
    deep = _block(1, "<b>a" * 100_000, _date("March 1, 2020, 1:00:00 PM"), open_end=True)
    df = spark.createDataFrame([(1, deep)], "page int, html string")
    r = threads.topic_posts(df, "html", now()).first()
    assert r.own_text == " ".join(["a"] * 100_000) and len(r.raw_html) == 400_000


def test_shown_posts(spark):
    block = lambda link, body: f'<div class="windowbg"><div class="topic_details"><h5>{link}</h5><span class="smalltext"> Today at 1:02:03 AM</span></div>{body}</div>'
    page = block("none", '<div class="inner">x</div>') + block('<a href="?topic=12.msg34#msg34">t</a>', '<div class="post">only post</div>') + block('<a href="?topic=12.msg35">t</a>', "no body")
    r = threads.shown_posts(spark.createDataFrame([(page,), (None,)], "html string"), "html", now()).collect()
    assert [(x.topic_id, x.post_id, x.own_text, str(x.post_date)) for x in r] == [(12, "msg34", "only post", "2024-01-02 01:02:03")]
