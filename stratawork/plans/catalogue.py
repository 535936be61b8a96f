"""Every query of the library's own operators, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratawork.plans import extras, forum, inventory, messages, records, relational, timeline

_MODULES = (relational, messages, inventory, timeline, extras, records, forum)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in _MODULES for k, (f, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for m in _MODULES for k, (_, sql) in m.QUERIES.items() if sql}
