"""Sinks: tables with a fixed or united schema, reports, rollover files, and appended histories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratawork.functions.columns import safe_text


def ordered_columns(df: DataFrame, first: list[str]) -> DataFrame:
    """The named columns that exist, then the others sorted."""
    head = [c for c in first if c in df.columns]
    return df.select(*head, *sorted(c for c in df.columns if c not in head))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames over the union of their columns."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def write_sheet(df: DataFrame, path: str, cap: int = 32_000) -> None:
    """A CSV whose text is capped, clean of control characters, quoted and so never a formula."""
    cols = [safe_text(F.col(f"`{n}`"), cap).alias(n) if t == "string" else F.col(f"`{n}`") for n, t in df.dtypes]
    df.select(*cols).write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def write_tables(tables: dict[str, DataFrame], root: str, formats: tuple[str, ...] = ("parquet", "csv")) -> None:
    for name, df in tables.items():
        for f in formats:
            w = df.write.mode("overwrite")
            (w.option("header", True) if f == "csv" else w).format(f).save(f"{root}/{name}.{f}")


def write_report(tables: dict[str, DataFrame], root: str) -> None:
    """One table a sheet; an empty one says that there are no issues."""
    for name, df in tables.items():
        if df.isEmpty():
            df = df.sparkSession.createDataFrame([("No issues found.",)], "message string")
        df.write.mode("overwrite").option("header", True).csv(f"{root}/{name}")


def write_rollover(df: DataFrame, path: str, cap: int) -> None:
    """Files of at most ``cap`` rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", cap).option("header", True).csv(path)


def append_history(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_markdown(df: DataFrame, path: str, by: str, text: str, order: str) -> None:
    """A text folder a chapter, its sections in order."""
    df.select(by, order, text).repartition(by).sortWithinPartitions(by, order).select(by, F.col(text).alias("value")).write.mode("overwrite").partitionBy(by).text(path)


def write_json_document(df: DataFrame, path: str, root: str = "emails") -> None:
    """JSON documents ``{root: [...]}``, one a partition, which ``read_export`` reads back in parallel."""

    def run(batches):
        import pyarrow as pa

        opened = False
        for b in batches:
            rows = b.column(0).to_pylist()
            lines = [f"{',' if opened or k else ''}{r}" for k, r in enumerate(rows)]
            if rows and not opened:
                lines[0] = f'{{"{root}": [\n{lines[0]}'
                opened = True
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]}" if opened else f'{{"{root}": []}}'], pa.string())], names=["value"])

    df.select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)))).mapInArrow(run, "value string").write.mode("overwrite").text(path)


def write_audit(df: DataFrame, path: str) -> None:
    """The one-row report beside a document."""
    df.select(F.to_json(F.struct(*df.columns))).write.mode("overwrite").text(path)


def insert_rows(df: DataFrame, connect, statement: str, batch: int = 50) -> None:
    """Rows into a database by a parameterised statement, in batches, the remainder too; a partition is one transaction.

    ``connect`` gives a DB-API connection on an executor. A failure rolls the
    partition back and is raised, and Spark runs it again: a statement that
    passes over keys that are there, or replaces them, is then idempotent.
    """

    def run(rows):
        con = connect()
        try:
            held = []
            for r in rows:
                held.append(tuple(r))
                if len(held) == batch:
                    con.executemany(statement, held)
                    held = []
            if held:
                con.executemany(statement, held)
            con.commit()
        except BaseException:
            con.rollback()
            raise
        finally:
            con.close()

    df.foreachPartition(run)


def reload(tables: list[tuple[str, DataFrame]], shared: set[str] = frozenset()) -> None:
    """Replaces the tables, children first as listed; shared ones are left as they are."""
    for name, df in tables:
        if name not in shared:
            df.write.mode("overwrite").saveAsTable(name)


def json_rows(df: DataFrame, bodies: list[str], cap: int = 500) -> DataFrame:
    """Each row as a JSON array of its cells, long bodies cut with a suffix, nulls empty."""
    from stratawork.functions.columns import shorten, text

    cells = [text(shorten(F.col(f"`{c}`").cast("string"), cap) if c in bodies else F.col(f"`{c}`").cast("string")) for c in df.columns]
    return df.select(F.to_json(F.array(*cells)).alias("row"))


def chapter_index(df: DataFrame, by: str) -> DataFrame:
    """A line of markdown for each chapter with the number of its sections."""
    return df.groupBy(by).agg(F.count("*").alias("n")).select(by, F.concat(F.lit("- ["), F.col(by), F.lit("]("), F.col(by), F.lit(".md) ("), F.col("n").cast("string"), F.lit(" sections)")).alias("line"))


def directory_rows(tree: DataFrame, status: str = "not_scanned") -> DataFrame:
    """An inventory of directories: names indented by depth, and a status for those without one."""
    from stratawork.functions.columns import depth_name

    old = F.col("status") if "status" in tree.columns else F.lit(None).cast("string")
    return tree.select(depth_name(F.col("path")).alias("name"), *[c for c in tree.columns if c != "status"], F.coalesce(old, F.lit(status)).alias("status"))


def checked_header(found: list[str], wanted: list[str], title: str) -> None:
    """Raises if a tab that is to be appended to has other columns."""
    if list(found) != list(wanted):
        raise ValueError(f"{title} has the columns {found}, not {wanted}")


def top_level(tree: DataFrame, depth: str = "depth") -> DataFrame:
    """The directories that a run began at."""
    return tree.filter(F.col(depth) == 0)


def run_log(df: DataFrame, run: str, settings: dict, seconds: float) -> DataFrame:
    """One row of a run's history: its rows, seconds to two places and settings as JSON."""
    import json

    return df.agg(F.count("*").alias("rows")).select(F.lit(run).alias("run_id"), "rows", F.round(F.lit(float(seconds)), 2).alias("elapsed_seconds"), F.lit(json.dumps(settings, sort_keys=True)).alias("config"))
