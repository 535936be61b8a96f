"""Registration of queries: a function over named tables, and its SQL."""

from __future__ import annotations

import functools
import inspect
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratawork.session import read_table, ship


def registrar() -> tuple[dict, Callable]:
    """A dictionary of queries and the decorator that fills it: parameters are names of tables, or spark or sf_dir."""
    found: dict = {}

    def query(sql: str | None):
        def take(f):
            names = list(inspect.signature(f).parameters)

            @functools.wraps(f)
            def run(spark, sf_dir):
                ship(spark)
                given = {"spark": spark, "sf_dir": sf_dir}
                return f(*(given[n] if n in given else read_table(spark, sf_dir, n) for n in names))

            del run.__wrapped__
            found[f.__name__] = (run, sql and " ".join(sql.split("\n")))
            return run

        return take

    return found, query


#: The documents hold no quotes, amounts or dates: these are put into some of them, in the same way on both sides.
MARKED_SQL = (
    "(text || case when doc_id % 5 = 0 then chr(10) || 'On Jan 1, 2024, A wrote:' || chr(10) || '> quoted line' else '' end"
    " || case when doc_id % 7 = 0 then ' $1,234.50' else '' end || case when doc_id % 11 = 0 then ' 2024-03-05' else '' end"
    " || case when doc_id % 13 = 0 then chr(10) || 'From: A' || chr(10) || 'Sent: today' else '' end"
    " || case when doc_id % 17 = 0 then chr(10) || '-----Original Message-----' || chr(10) || 'old' else '' end)"
)


def marked() -> Column:
    return F.expr(MARKED_SQL.replace("chr(10)", "'\\n'"))


#: A message a document: its marked text with more marks, a subject, markup, what it answers and its sender, in the same way on both sides.
MAIL_SQL = (
    "select doc_id, source, lang, " + MARKED_SQL + " || case when doc_id % 43 = 0 then chr(10) || 'On Jan 2, 2024, B wrote: old' else '' end"
    " || case when doc_id % 53 = 0 then chr(10) || 'On Sep 11, 2024, at 6:47 PM, C wrote: old' else '' end"
    " || case when doc_id % 47 = 0 then chr(10) || chr(10) || 'A Person' || chr(10) || 'Director' || chr(10) || 'Example Corp' || chr(10) || 'Main Street' else '' end as t,"
    " case when doc_id % 29 = 0 then 'Fwd: x' when doc_id % 2 = 0 then 'Re: x' else 'x' end as subject,"
    " case when doc_id % 31 = 0 then '<div>body</div><div class=\"Gmail_Quote\">old</div>' when doc_id % 37 = 0 then '<p class=\"MsoNormal\">body</p>' when doc_id % 41 = 0 then '<div dir=\"auto\">body</div>' else '' end as html,"
    " case when doc_id % 2 = 0 then '<p@x>' else '' end as in_reply_to, case when doc_id % 3 = 0 then 'A@Example.com' else 'a@other.org' end as sender from documents"
)


def messages(documents: DataFrame) -> DataFrame:
    columns = MAIL_SQL.removeprefix("select ").removesuffix(" from documents").replace("chr(10)", "'\\n'")
    return documents.sparkSession.sql(f"select {columns} from {{documents}}", documents=documents)
