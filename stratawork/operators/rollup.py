"""Directory trees: direct statistics and sums over everything below."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratawork.functions.columns import ancestors, path_depth, path_parent, source_store
from stratawork.operators.windows import numbered


def direct(files: DataFrame, directory: str, size: str) -> DataFrame:
    return files.groupBy(F.lower(F.col(directory)).alias("dir")).agg(F.count("*").alias("direct_count"), F.sum(size).alias("direct_size"))


def tree(dirs: DataFrame, files: DataFrame, directory: str, size: str) -> DataFrame:
    """Each directory with its parent, depth, direct and total counts and sizes.

    Files are summed by directory first, then each sum goes to all ancestors:
    rows grow with the depth, not with the tree, and one aggregate does it.
    """
    own = direct(files, directory, size)
    total = own.select(F.explode(ancestors(F.col("dir"))).alias("dir"), "direct_count", "direct_size").groupBy("dir").agg(F.sum("direct_count").alias("total_count"), F.sum("direct_size").alias("total_size"))
    base = dirs.groupBy(F.lower(F.col("path")).alias("dir")).agg(F.max("path").alias("path"))
    out = base.join(own, "dir", "left").join(total, "dir", "left").na.fill(0, ["direct_count", "direct_size", "total_count", "total_size"])
    return out.select("path", path_parent(F.col("path")).alias("parent"), path_depth(F.col("path")).alias("depth"), "direct_count", "direct_size", "total_count", "total_size")


def records(dirs: DataFrame, path: str, roots: list[str]) -> DataFrame:
    """(dir_id, path, root, relative_path, depth, store) of the directories at and below some roots, numbered in the order of roots and paths.

    The relative path of a root is a dot and its depth 0; a directory below
    two roots is the first one's.
    """
    found = None
    for k, r in enumerate(roots):
        root = r.rstrip("/")
        inside = (F.col(path) == root) | F.col(path).startswith(root + "/")
        value = F.struct(F.lit(k).alias("ordinal"), F.lit(root).alias("root"))
        found = F.when(inside, value) if found is None else found.when(inside, value)
    d = dirs.select(F.regexp_replace(path, "/+$", "").alias(path)).distinct().withColumn("r", found).filter("r is not null")
    rest = F.substring(F.col(path), F.length("r.root") + 2, F.lit(1 << 30))
    d = d.select(F.col(path).alias("path"), "r.ordinal", "r.root", F.when(rest == "", ".").otherwise(rest).alias("relative_path"))
    d = d.withColumn("depth", F.when(F.col("relative_path") == ".", 0).otherwise(F.size(F.split("relative_path", "/"))))
    n = numbered(d, ["ordinal", "path"], "n")
    return n.select(F.format_string("D%03d", "n").alias("dir_id"), "path", "root", "relative_path", "depth", source_store(F.col("path")).alias("store"))
