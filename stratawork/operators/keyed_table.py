"""A keyed inventory as a table in hash buckets, of which an upsert rewrites those that it touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratawork.functions.columns import norm_path
from stratawork.operators.upsert import OVERWRITE, upsert
from stratawork.operators.windows import numbered
from stratawork.session import written

BUCKETS = 256
_KEY, _BUCKET = "__key", "bucket"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(key.cast("binary")), F.lit(buckets)).cast("int")


def _keyed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` with its normalised key (slashes, end, case) and the bucket of that."""
    k = df.withColumn(_KEY, norm_path(F.col(key)))
    return k.withColumn(_BUCKET, bucket_of(F.col(_KEY), buckets))


def _check(df: DataFrame, key: str) -> None:
    if not df.filter(F.coalesce(F.trim(F.col(key)), F.lit("")) == "").isEmpty():
        raise ValueError(f"rows without a {key}")


def create(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Writes a table whose rows have different keys, paths aside from slashes and case; rows without a key raise."""
    _check(df, key)
    _keyed(df, key, buckets).drop(_KEY).repartition(buckets, _BUCKET).write.partitionBy(_BUCKET).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(_BUCKET)


def last_of(df: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows that repeat a key the one that comes last by ``order``; of equal ones the greatest, so that a lost task gives the same again."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max(F.struct(order, *(c for c in rest if c != order))).alias("__s")).select(key, *(F.col("__s")[c].alias(c) for c in rest))


def upsert_into(spark: SparkSession, path: str, source: DataFrame, key: str, policy: dict[str, str], order: str, id_col: str | None = None, prefix: str = "F", width: int = 5, protected: tuple[str, ...] = (), buckets: int = BUCKETS) -> dict[str, int]:
    """Applies ``source`` to the table at ``path`` and gives how many keys were inserted and updated, and the buckets touched.

    Keys are compared as normalised paths; an insert keeps the source's
    spelling, an update the target's. Of rows that repeat a key the last by
    ``order`` counts. ``policy`` is that of ``upsert``; ``protected`` columns
    are never changed by an update. With ``id_col``, inserts get the numbers
    after the largest in use, in the order of ``order``. Rows without a key
    raise before anything is written.

    Only the touched buckets are read, but for one column of ids, joined and
    written, and replace their folders in one commit; the files of others stay
    as they are. Of the source, the numbers of touched buckets come to the
    driver, which ``buckets`` bounds. An empty source changes nothing.
    """
    _check(source, key)
    s = last_of(_keyed(source, key, buckets), _KEY, order)
    s = written(spark, s, "upsert")
    touched = sorted(r[0] for r in s.select(_BUCKET).distinct().collect())
    if not touched:
        return {"inserted": 0, "updated": 0, "buckets": 0}
    whole = spark.read.parquet(path)
    columns = [c for c in whole.columns if c != _BUCKET]
    target = whole.filter(F.col(_BUCKET).isin(touched)).drop(_BUCKET).withColumn(_KEY, norm_path(F.col(key)))
    known = s.join(target.select(_KEY), _KEY, "left_semi")
    fresh = s.join(target.select(_KEY), _KEY, "left_anti")
    inserted, updates = fresh.count(), known.count()  # before the target's files are replaced
    if id_col:
        top = whole.agg(F.max(F.regexp_extract(F.col(id_col), rf"^{prefix}(\d{{{width},}})$", 1).try_cast("bigint"))).first()[0] or 0
        named = F.concat(F.lit(prefix), F.lpad((F.col("__n") + top).cast("string"), F.greatest(F.lit(width), F.length((F.col("__n") + top).cast("string"))), "0"))
        fresh = numbered(fresh, [order, _KEY], "__n").withColumn(id_col, named).drop("__n")
    rules = {c: p for c, p in policy.items() if c not in protected and c not in (key, id_col)}
    shared = [c for c in s.columns if c in columns and c not in (key, id_col)]
    updated = upsert(target, known.select(_KEY, *shared), _KEY, rules)
    new = fresh.select(_KEY, *(F.col(c).cast(whole.schema[c].dataType).alias(c) if c in fresh.columns else F.lit(None).cast(whole.schema[c].dataType).alias(c) for c in columns))
    out = updated.unionByName(new).withColumn(_BUCKET, bucket_of(F.col(_KEY), buckets)).select(*columns, _BUCKET)
    out = written(spark, out, "upsert")  # the folders that it replaces are read no more
    out.repartition(len(touched), _BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_BUCKET).parquet(path)
    return {"inserted": inserted, "updated": updates, "buckets": len(touched)}


def signals(columns: list[str], protected: tuple[str, ...]) -> dict[str, str]:
    """The policy of a write of signals: every column but the protected ones."""
    return {c: OVERWRITE for c in columns if c not in protected}


def advance_status(spark: SparkSession, path: str, keys: DataFrame, key: str, status: str, to: str, buckets: int = BUCKETS) -> dict[str, int]:
    """Sets ``status`` of known keys to ``to``; unknown ones are inserted with nothing else, so they are left out first."""
    known = _keyed(keys.select(key).distinct(), key, buckets)
    there = spark.read.parquet(path).filter(F.col(_BUCKET).isin([r[0] for r in known.select(_BUCKET).distinct().collect()])).select(norm_path(F.col(key)).alias(_KEY))
    rows = known.join(there, _KEY, "left_semi").select(key, F.lit(to).alias(status))
    return upsert_into(spark, path, rows, key, {status: OVERWRITE}, status, buckets=buckets)
