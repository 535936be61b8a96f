"""Queries of forum pages: each page of the table becomes a page of a topic, of a member or of a folder's listing."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratawork.functions import threads
from stratawork.plans.messages import _NODES, _SPACED, _decoded
from stratawork.plans.registry import registrar

QUERIES, query = registrar()

_SAID = _SPACED.format(_decoded(f"array_to_string(list_filter(list_transform({_NODES.format('html')}, lambda y: regexp_replace(y, '^\\s+|\\s+$', '', 'g')), lambda y: y <> ''), ' ')"))
_AT = "timestamp '2020-03-01' + to_seconds(cast((page_id * 37) % 101 * 60 as integer))"


def _date(seconds: int):
    at = F.timestamp_seconds(F.lit(1_583_020_800) + (F.col("page_id") * 37) % 101 * 60 + seconds)
    return F.date_format(at, "MMMM d, yyyy, h:mm:ss a")


def _topic_page():
    """Four pages a topic with a post that has a quote and likes and one whose body is the page of the table, left open; between them one without a date, and on each fourth page a post that the page before it has, too."""
    post = lambda k, author, head, body, tail="": F.concat(F.lit('<div class="windowbg" id="msg'), k, F.lit('"><div class="poster"><h4><a href="?action=profile;u=7"> '), author, F.lit(" </a></h4></div>"), head, F.lit('<div id="msg_'), k, F.lit('">'), body, F.lit(tail))
    info = F.concat(F.lit('<div class="postinfo">Reply #1 <b>'), _date(0), F.lit("</b> Last Edit: May 1, 2021, 1:02:03 AM</div>"))
    small = F.concat(F.lit('<a class="smalltext" href="#"> '), _date(7), F.lit("</a>"))
    user, page = F.concat(F.lit("U"), F.col("page_id") % 3), F.col("page_id")
    quote = F.lit('<blockquote class="bbc_standard_quote"><cite><a>Quote from: A B on today</a></cite>said</blockquote>hello <i>there</i>')
    ends = "</div></div>"
    liked = F.concat(F.lit("</div><p>"), page % 5, F.lit(" people like this</div>"))
    first = F.concat(post(page * 2, user, info, quote), liked)
    again = F.when(page % 4 == 3, post(page * 2 - 2, F.lit("late"), info, F.lit("again"), ends)).otherwise("")
    undated = post(page + 1_000_000_000, user, F.lit(""), F.lit("no date"), ends)
    head = F.concat(F.lit("<h2> Re: Re: Topic <b>"), F.floor(page / 4), F.lit('</b></h2><a href="?topic='), F.floor(page / 4), F.lit("."), page % 4 * 15, F.lit('">x</a><a href="?topic=x.900">y</a>'))
    return F.concat(head, again, first, undated, post(page * 2 + 1, F.lit("B"), small, F.col("html")))


@query(f"""with x as (select page_id // 4 as topic, page_id, 'msg' || page_id * 2 as post_id, 'U' || page_id % 3 as author, {_AT} as post_date, 'hello there' as own_text, 'A B' as quoted, page_id % 5 as likes, true as same_source from pages
union all select page_id // 4, page_id, 'msg' || (page_id * 2 + 1), 'B', {_AT} + interval 7 second, {_SAID}, null, 0, true from pages)
select topic, post_id, author, own_text, quoted, likes, same_source, row_number() over w as position, date_sub('second', lag(post_date) over w, post_date) as lag_seconds from x window w as (partition by topic order by post_date, page_id, post_id)""")
def topic_posts(pages):
    """The posts of whole topic pages, numbered in their topic."""
    p = pages.select(F.floor(F.col("page_id") / 4).alias("topic"), "page_id", F.length("html").alias("n"), _topic_page().alias("page"))
    t = threads.thread(threads.topic_posts(p, "page", F.lit("2024-01-01 00:00:00")), "topic", "page_id", F.lit("2004-01-01").cast("timestamp"))
    same = (F.length("raw_html") == F.col("n")) | (F.size("quotes") > 0)
    return t.select("topic", "post_id", "author", "own_text", F.get("quotes", F.lit(0))["author"].alias("quoted"), "likes", same.alias("same_source"), "position", "lag_seconds")


@query("""select page_id, 'Topic' || (page_id // 4) as title, page_id % 4 * 15 as last_start, page_id % 4 + 1 as n_pages from pages""")
def topic_heads(pages):
    h = pages.select("page_id", threads.topic_head(_topic_page(), F.floor(F.col("page_id") / 4)).alias("h"))
    return h.select("page_id", "h.title", "h.last_start", F.size(threads.page_offsets(F.col("h.last_start"))).alias("n_pages"))


@query(f"""select page_id, page_id % 9 as topic_id, 'msg' || page_id as post_id, '2024-01-01 01:02:03' as posted, {_SAID} as own_text from pages""")
def shown_posts(pages):
    """The posts of a member's pages; a block without a link to a topic is none."""
    block = lambda link, body: F.concat(F.lit('<div class="windowbg"><div class="topic_details"><h5>'), link, F.lit('</h5><span class="smalltext"> Today at 1:02:03 AM</span></div><div class="post"><div class="inner">'), body)
    link = F.concat(F.lit('<a href="?topic='), F.col("page_id") % 9, F.lit(".msg"), "page_id", F.lit("#msg"), "page_id", F.lit('">t</a>'))
    page = F.concat(block(F.lit("no link"), F.lit("x</div></div></div>")), block(link, F.col("html")))
    s = threads.shown_posts(pages.select("page_id", page.alias("page")), "page", F.lit("2024-01-01 12:00:00"))
    return s.select("page_id", "topic_id", "post_id", F.date_format("post_date", "yyyy-MM-dd HH:mm:ss").alias("posted"), "own_text")
