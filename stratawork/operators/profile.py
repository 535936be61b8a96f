"""Row-wise comparison of columns: majority, pattern codes, shortest and longest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratawork.operators.mail import let


def _values(columns: list[str]) -> Column:
    return F.array(*(F.coalesce(F.col(c), F.lit("")) for c in columns))


def _commonest(values: Column) -> Column:
    ranked = F.transform(values, lambda v, i: F.struct(F.size(F.filter(values, lambda w: w == v)).alias("n"), (-i).alias("p")))
    best = F.array_max(F.filter(ranked, lambda r: F.get(values, -r["p"]) != ""))
    return F.coalesce(F.get(values, -best["p"]), F.lit(""))


def voted(columns: list[str]) -> Column:
    """struct<majority, code>, each value and the vote worked out once a row."""

    def both(v: Column, m: Column) -> Column:
        letters = F.transform(v, lambda x: F.when(x == "", "E").when(x == m, "Y").otherwise("N"))
        return F.struct(m.alias("majority"), F.when(m == "", "-" * len(columns)).otherwise(F.array_join(letters, "")).alias("code"))

    return let(_values(columns), lambda v: let(_commonest(v), lambda m: both(v, m)))


def majority(columns: list[str]) -> Column:
    """The most common non-empty value; ties go to the first column."""
    return let(_values(columns), _commonest)


def code(columns: list[str]) -> Column:
    """Y (majority), N (another) or E (empty) a column; dashes if all are empty."""
    return voted(columns)["code"]


def flag(code_: Column) -> Column:
    y = F.length(F.regexp_replace(code_, "[^Y]", ""))
    n = F.length(F.regexp_replace(code_, "[^N]", ""))
    empty = code_.contains("E") | code_.contains("-")
    return F.when((n == 0) & ~empty, "ALL_MATCH").when(n == 0, "MATCH (some empty)").when(y <= 1, "NONE_MATCH").otherwise("PARTIAL")
