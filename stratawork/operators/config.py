"""Configuration tables as relations: families, weights, bands, key and value sheets, and idempotent seeding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratawork.functions.columns import strip, text


def families(df: DataFrame) -> DataFrame:
    """(family, extension, should_skip) of ``;``-joined extensions: lower case, a dot added, the first family of an extension wins; flags default to N."""
    e = df.select("family", F.posexplode(F.split(text(F.col("extensions")), ";")).alias("i", "e"), F.coalesce(F.upper(strip(F.col("should_skip"))), F.lit("N")).alias("should_skip"), "ordinal")
    e = e.withColumn("e", F.lower(strip(F.col("e")))).filter("e <> ''").withColumn("extension", F.when(F.col("e").startswith("."), F.col("e")).otherwise(F.concat(F.lit("."), "e")))
    return e.groupBy("extension").agg(F.min(F.struct("ordinal", "i", "family", "should_skip")).alias("b")).select("b.family", "extension", "b.should_skip")


def weights(df: DataFrame) -> DataFrame:
    """(signal_type, signal_value, points): blank types and values dropped, what is no number is 0, the last of a repeat wins."""
    d = df.filter((strip(text(F.col("signal_type"))) != "") & (strip(text(F.col("signal_value"))) != ""))
    return d.groupBy("signal_type", "signal_value").agg(F.max(F.struct("ordinal", F.coalesce(F.col("score_points").try_cast("int"), F.lit(0)).alias("points"))).alias("b")).select("signal_type", "signal_value", "b.points")


def key_values(df: DataFrame) -> dict[str, str]:
    """First two cells where both are filled, keys in lower case; run_mode wins over the older fresh_run. A sheet of settings."""
    found = {r[0].strip().lower(): r[1] for r in df.select(*df.columns[:2]).na.drop().collect()}
    if "run_mode" not in found and "fresh_run" in found:
        found["run_mode"] = "fresh" if found["fresh_run"].strip().upper() in ("Y", "TRUE", "1") else "accumulate"
    return found


def numbered(settings: dict[str, str], prefix: str) -> list[str]:
    """The values of prefix_1, prefix_2 and on, up to the first gap."""
    out = []
    while (v := settings.get(f"{prefix}_{len(out) + 1}")) not in (None, ""):
        out.append(v)
    return out


def seed(spark: SparkSession, table: str, rows: list[tuple], schema: str) -> bool:
    """Creates and fills a table unless it exists."""
    if spark.catalog.tableExists(table):
        return False
    spark.createDataFrame(rows, schema).write.saveAsTable(table)
    return True


def migrate(df: DataFrame, names: dict[str, str], path: str) -> int:
    """Rewrites a table under new column names and checks that no row was lost."""
    df.select(*(F.col(c).alias(names.get(c, c)) for c in df.columns)).write.mode("overwrite").parquet(path)
    n, m = df.count(), df.sparkSession.read.parquet(path).count()
    if n != m:
        raise RuntimeError(f"{n} rows became {m}")
    return m


def covered(df: DataFrame, path: str, level: str, levels: list[str], least: str) -> DataFrame:
    """Paths whose highest level is at least ``least``."""
    rank = F.create_map(*(F.lit(x) for i, v in enumerate(levels) for x in (v, i)))[F.col(level)]
    return df.groupBy(path).agg(F.max(rank).alias("rank")).filter(F.col("rank") >= levels.index(least)).select(path, F.element_at(F.array(*map(F.lit, levels)), F.col("rank") + 1).alias(level))


def enrol(profiles: DataFrame, new: DataFrame, least_seconds: float = 12.0) -> DataFrame:
    """Profiles by trimmed lower-case name, the new one of a name replacing the old; shorter recordings are refused."""
    n = new.filter(F.col("seconds") >= least_seconds).withColumn("name_key", F.lower(F.trim("name")))
    return n.unionByName(profiles.withColumn("name_key", F.lower(F.trim("name"))).join(n.select("name_key"), "name_key", "left_anti"), allowMissingColumns=True)


def first_row_totals(total: Column, by: list[str], order: list[Column]) -> Column:
    """The total on the first row of a run, zero on the rest."""
    return F.when(F.row_number().over(W.partitionBy(*by).orderBy(*order)) == 1, total).otherwise(F.lit(0))


def smallest_unused(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """The smallest number that no name of the form prefix + number has."""
    used = df.select(F.regexp_extract(column, rf"^{prefix}(\d+)$", 1).try_cast("bigint").alias("n")).filter("n is not null").distinct()
    first = used.select((F.col("n") + 1).alias("n")).union(df.sparkSession.range(1, 2).toDF("n"))
    return first.join(used, "n", "left_anti").agg(F.min("n").alias("n"))


def bands(df: DataFrame) -> DataFrame:
    """(band, min_score): what is no number is 0, the highest first."""
    return df.select("band", F.coalesce(strip(text(F.col("min_score"))).try_cast("int"), F.lit(0)).alias("min_score")).orderBy(F.desc("min_score"), "band")


#: What a scan may be in, and what may follow.
STATES = {None: ("queued",), "queued": ("running", "stopped"), "running": ("done", "error", "stopped"), "done": (), "error": ("queued",), "stopped": ("queued",)}


def advance(history: DataFrame | None, spark: SparkSession, path: str, scan: str, state: str, at: str, rows: int = 0) -> None:
    """Appends a state of a scan to its history at ``path``; one that may not follow the last raises."""
    last = None
    if history is not None:
        r = history.filter(F.col("scan") == scan).agg(F.max(F.struct("at", "state")).alias("x")).first()["x"]
        last = r["state"] if r else None
    if state not in STATES.get(last, ()):
        raise ValueError(f"{scan} is {last}, {state} may not follow")
    spark.createDataFrame([(scan, state, at, rows)], "scan string, state string, at string, rows bigint").write.mode("append").parquet(path)


def states(history: DataFrame) -> DataFrame:
    """(scan, state, at, rows): the last state of each scan."""
    return history.groupBy("scan").agg(F.max(F.struct("at", "state", "rows")).alias("x")).select("scan", "x.state", "x.at", "x.rows")


def next_free(names: DataFrame, column: str, wanted: str) -> str:
    """The name itself if it is free, else the first of name_1, name_2 and on (before the extension) that is."""
    stem, dot, ext = wanted.rpartition(".")
    stem, ext = (stem, dot + ext) if dot else (wanted, "")
    if names.filter(F.col(column) == wanted).isEmpty():
        return wanted
    n = smallest_unused(names.select(F.regexp_replace(column, rf"{ext.replace('.', chr(92) + '.')}$", "").alias("__n")), "__n", f"{stem}_").first()["n"]
    return f"{stem}_{n}{ext}"
