"""Keyed upserts with a write policy for each column, and incremental runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OVERWRITE, KEEP_FILLED, IF_FILLED = "overwrite", "keep_filled", "if_filled"


def upsert(target: DataFrame, source: DataFrame, key: str, policy: dict[str, str]) -> DataFrame:
    """The target after the source's rows: new keys are inserted, known ones updated column by column.

    overwrite takes the source's value, keep_filled the target's unless it is
    blank, if_filled the source's unless it is blank; columns without a policy
    keep the target's. Of rows that repeat a key in the source the greatest
    counts; rows without a key raise, as an insert could not be found again.
    One full outer join by key.
    """
    if key not in source.columns or key not in target.columns:
        raise ValueError(f"both sides need the key {key}")
    if not source.filter(F.col(key).isNull() | (F.trim(F.col(key).cast("string")) == "")).isEmpty():
        raise ValueError(f"source rows without a {key}")
    rest = [c for c in source.columns if c != key]
    if rest:
        source = source.groupBy(key).agg(F.max(F.struct(*rest)).alias("__s")).select(key, "__s.*")
    else:
        source = source.distinct()
    s = source.select(key, *(F.col(c).alias(f"__{c}") for c in source.columns if c != key), F.lit(True).alias("__new"))
    j = target.withColumn("__old", F.lit(True)).join(s, key, "full")
    out = [F.col(key)]
    for c in target.columns:
        if c == key:
            continue
        new = F.col(f"__{c}") if c in source.columns else F.lit(None).cast(target.schema[c].dataType)
        blank = lambda x: x.isNull() | (x.cast("string") == "")
        p = policy.get(c)
        kept = F.col(c)
        if p == OVERWRITE:
            kept = F.when(F.col("__new"), new).otherwise(F.col(c))
        elif p == KEEP_FILLED:
            kept = F.when(blank(F.col(c)) & F.col("__new"), new).otherwise(F.col(c))
        elif p == IF_FILLED:
            kept = F.when(F.col("__new") & ~blank(new), new).otherwise(F.col(c))
        out.append(F.when(F.col("__old").isNull(), new).otherwise(kept).alias(c))
    return j.select(*out)


def next_ids(df: DataFrame, id_col: str, prefix: str, width: int = 5) -> int:
    """The number after the largest id of the form prefix + digits."""
    n = df.agg(F.max(F.regexp_extract(id_col, rf"^{prefix}(\d{{{width},}})$", 1).try_cast("int"))).first()[0]
    return (n or 0) + 1


def incremental(prior: DataFrame, new: DataFrame, key: str, mode: str) -> DataFrame:
    """fresh: the new rows; accumulate: prior rows and the new ones they lack; incremental: only the new ones they lack."""
    fresh = new.dropDuplicates([key])
    if mode == "fresh":
        return fresh
    lacked = fresh.join(prior.select(key), key, "left_anti")
    return prior.unionByName(lacked, allowMissingColumns=True) if mode == "accumulate" else lacked


def gate(df: DataFrame, path: str, level: str, levels: list[str], wanted: str, mode: str) -> DataFrame:
    """What is walked again of ``df`` (path, level reached, null if none): with mode skip the paths below ``wanted``, with rewalk all; abort raises if any reached it."""
    rank = F.coalesce(F.create_map(*(F.lit(x) for i, v in enumerate(levels) for x in (v, i)))[F.col(level)], F.lit(-1))
    done = df.groupBy(path).agg(F.max(rank).alias("__r"))
    if mode == "rewalk":
        return done.select(path)
    if mode == "abort":
        if not done.filter(F.col("__r") >= levels.index(wanted)).isEmpty():
            raise RuntimeError(f"some paths reached {wanted} already")
        return done.select(path)
    if mode != "skip":
        raise ValueError(f"unknown mode {mode}")
    return done.filter(F.col("__r") < levels.index(wanted)).select(path)


def copied(target: DataFrame, source: DataFrame, key: str) -> tuple[DataFrame, dict[str, int]]:
    """The target and the source's rows that it lacks, and what a copy would do: how many are copied and skipped."""
    fresh = source.dropDuplicates([key])
    new = fresh.join(target.select(key), key, "left_anti")
    n, m = fresh.count(), new.count()
    return target.unionByName(new, allowMissingColumns=True), {"copied": m, "skipped": n - m}


def snapshot_diff(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, state) of two snapshots with the same columns: new, gone, changed or unchanged, by one full outer join of keys and hashes."""
    rest = [c for c in before.columns if c != key]
    hashed = lambda df, name: df.select(key, F.sha2(F.to_json(F.struct(*rest)), 256).alias(name))
    j = hashed(before, "__b").join(hashed(after, "__a"), key, "full")
    state = F.when(F.col("__b").isNull(), "new").when(F.col("__a").isNull(), "gone").when(F.col("__a") != F.col("__b"), "changed").otherwise("unchanged")
    return j.select(key, state.alias("state"))
