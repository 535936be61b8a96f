"""Deduplication with winner selection, ordered distinct, and insert policies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def two_key(df: DataFrame, first: Column, second: Column, own: Column) -> DataFrame:
    """``df`` with key_type and key: the first key if present, else the second, else the row's own; keys of different types never meet."""
    kind = F.when(first.isNotNull() & (first != ""), "first").when(second.isNotNull() & (second != ""), "second").otherwise("none")
    key = F.when(kind == "first", first).when(kind == "second", second).otherwise(own.cast("string"))
    return df.withColumn("key_type", kind).withColumn("key", key)


def winners(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The best row of each key; the order has to end in a unique column. The window keeps one row a task and key before it shuffles."""
    return df.withColumn("__rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("__rn = 1").drop("__rn")


def groups(df: DataFrame, keys: list[str], winner: Column, labels: list[str]) -> DataFrame:
    """A row a key with more than one row: its size, its winner and the sorted distinct values of each label."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), winner.alias("winner"), *(F.array_join(F.array_sort(F.collect_set(c)), ";").alias(f"{c}s") for c in labels)).filter("n > 1")


def losers(df: DataFrame, keys: list[str], winner: Column, id_col: str) -> DataFrame:
    """(keys, winner, loser): a row for each row that another of its keys beat, so no group is ever a list; null keys form no group.

    Winners are one aggregate with partial sums; the join back is of keys
    whose large partitions Spark splits.
    """
    best = df.groupBy(*keys).agg(winner.alias("winner"), F.count("*").alias("__n")).filter("__n > 1").drop("__n")
    return df.join(best, keys).filter(F.col(id_col) != F.col("winner")).select(*keys, "winner", F.col(id_col).alias("loser"))


def first_wins(df: DataFrame, key: Column, ordinal: str) -> DataFrame:
    return winners(df.withColumn("__key", key), ["__key"], [F.asc(ordinal)]).drop("__key")


def insert_or_ignore(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The target and the new rows whose key it lacks."""
    return target.unionByName(new.join(target.select(key), key, "left_anti"), allowMissingColumns=True)


def insert_or_replace(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The new rows and the target's others."""
    return new.unionByName(target.join(new.select(key), key, "left_anti"), allowMissingColumns=True)
