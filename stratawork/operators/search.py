"""Full-text search: positions of folded tokens, terms, phrases and boolean queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratawork.functions.columns import tokens

def _folds() -> dict[str, str]:
    """Letters with marks and the plain letters that they decompose to, of the Latin, Greek and Cyrillic blocks."""
    import unicodedata

    found = {}
    for code in (*range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000)):
        low = chr(code).lower()
        base = "".join(x for x in unicodedata.normalize("NFD", low) if not unicodedata.combining(x))
        if len(low) == 1 and len(base) == 1 and base != low:
            found[low] = base
    return found


_FOLDED = _folds()
FOLD_FROM, FOLD_TO = "".join(_FOLDED), "".join(_FOLDED.values())
#: English words that boolean queries pass over; fixed values.
STOP_WORDS = "a an and are as at be but by for if in into is it no not of on or such that the their then there these they this to was will with".split()
BUCKETS = 64


def folded(word: str) -> str:
    return "".join(_FOLDED.get(x, x) for x in word.lower())


def bucket(token: Column) -> Column:
    return F.pmod(F.crc32(token.cast("binary")), F.lit(BUCKETS)).cast("int")


def store(idx: DataFrame, path: str) -> int:
    """Writes an index by token bucket, sorted by token, so that a query of a word reads one bucket and few row groups; gives its rows, checked."""
    idx.withColumn("bucket", bucket(F.col("token"))).repartition(BUCKETS, "bucket").sortWithinPartitions("bucket", "token").write.mode("overwrite").partitionBy("bucket").parquet(path)
    n, m = idx.count(), idx.sparkSession.read.parquet(path).count()
    if n != m:
        raise RuntimeError(f"{n} entries became {m}")
    return m


def stored(spark: SparkSession, path: str, *words: str) -> DataFrame:
    """The entries of a stored index for some words (none: all), by partition pruning and a filter in the scan."""
    df = spark.read.parquet(path)
    if not words:
        return df.drop("bucket")
    import zlib

    keys = [folded(w) for w in words]
    return df.filter(F.col("bucket").isin(sorted({zlib.crc32(k.encode()) % BUCKETS for k in keys})) & F.col("token").isin(keys)).drop("bucket")


def refresh(spark: SparkSession, path: str, new: DataFrame, key: str) -> DataFrame:
    """A stored index after documents have changed: entries of the keys in ``new`` (an index) replace the old ones."""
    return stored(spark, path).join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def prefix(idx: DataFrame, key: str, start: str) -> DataFrame:
    """Keys with a token that starts so, and how many."""
    return idx.filter(F.col("token").startswith(folded(start))).groupBy(key).agg(F.count("*").alias("hits"))


def index(df: DataFrame, key: str, *texts: str, marks: bool = True) -> DataFrame:
    """(token, key, col, pos) of every token, case and, with ``marks``, marks folded; no stemming."""
    plain = lambda c: F.translate(F.lower(c), FOLD_FROM, FOLD_TO) if marks else F.lower(c)
    parts = [df.select(key, F.lit(c).alias("col"), F.posexplode(tokens(plain(F.col(c)))).alias("pos", "token")) for c in texts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("token", key, "col", "pos")


def term(idx: DataFrame, key: str, word: str) -> DataFrame:
    return idx.filter(F.col("token") == folded(word)).groupBy(key).agg(F.count("*").alias("hits"))


def phrase(idx: DataFrame, key: str, words: list[str]) -> DataFrame:
    """Keys in which the words follow one another: each entry names the places that the phrase could start at, and all words have to name one."""
    words = [folded(w) for w in words]
    at = F.array(*(F.struct(F.lit(w).alias("w"), F.lit(k).alias("k")) for k, w in enumerate(words)))
    own = F.transform(F.filter(at, lambda x: x["w"] == F.col("token")), lambda x: x["k"])
    starts = idx.filter(F.col("token").isin(sorted(set(words)))).select(key, "col", "pos", F.explode(own).alias("k"))
    hits = starts.groupBy(key, "col", (F.col("pos") - F.col("k")).alias("p")).agg(F.count("*").alias("n"))
    return hits.filter(F.col("n") == len(words)).groupBy(key).agg(F.count("*").alias("hits"))


def boolean(idx: DataFrame, key: str, all_of: list[str] = (), any_of: list[str] = (), none_of: list[str] = ()) -> DataFrame:
    """Keys that hold all, some and none of the words, by one aggregate; no stemming."""
    words = [folded(w) for w in (*all_of, *any_of, *none_of)]
    has = lambda w: F.max(F.when(F.col("token") == folded(w), 1).otherwise(0)) == 1
    cond = F.lit(True)
    for w in all_of:
        cond = cond & has(w)
    if any_of:
        some = F.lit(False)
        for w in any_of:
            some = some | has(w)
        cond = cond & some
    for w in none_of:
        cond = cond & ~has(w)
    return idx.filter(F.col("token").isin(words)).groupBy(key).agg(cond.alias("ok")).filter("ok").select(key)


def parse_query(text: str) -> tuple[list[str], list[str], list[str]]:
    """(all, any, none) of a query such as ``rent & (due | late) & !paid``: words joined by | are alternatives, ! excludes, stop words go.

    One group of alternatives is allowed; others raise.
    """
    import re

    all_of, any_of, none_of = [], [], []
    for part in re.split(r"&|\s+and\s+", text.lower()):
        words = [w for w in re.split(r"\||\s+or\s+", part.strip().strip("()"))]
        negated = [w.strip().lstrip("!").strip() for w in words if w.strip().startswith("!")]
        plain = [w.strip() for w in words if w.strip() and not w.strip().startswith("!")]
        none_of += negated
        plain = [w for w in plain if w not in STOP_WORDS]
        if len(plain) > 1:
            if any_of:
                raise ValueError("one group of alternatives at most")
            any_of = plain
        else:
            all_of += plain
    return all_of, any_of, none_of
