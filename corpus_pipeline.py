"""The corpus pipeline: quality rules, quality classifier, n-gram Jaccard join, best-fit packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratawork.llm import jaccard_join, packing, quality_classifier, quality_rules
from stratawork.llm.language_id import held_out
from stratawork.llm.queries import WORD_BPE, vocabulary
from stratawork.llm.support import Scratch, if_small, prepare
from stratawork.session import read_table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep; null and empty texts go."""
    prepare(spark)
    return quality_rules.kept_documents(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rule ensemble scores 0.5 or more; it learns from labelled rows of the whole table that are not held out, as its own input may hold one class alone."""
    model = quality_classifier.train(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id"), 3, 1))
    return quality_classifier.good_documents(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document (by id) of each group that near-duplicate links join, and all without an id.

    Rows that repeat an id are one document: the one of the smallest hashes of
    its text and its columns stays. They are found by an aggregate of hashes
    and thinned with partial aggregates, so an id that many rows share is not
    brought together first.
    """
    comp = jaccard_join.jaccard_components(docs)
    gone = Scratch(spark, "copies").table("gone", comp.filter("component_id <> doc_id").select("doc_id").distinct())
    out = docs.join(if_small(gone)[0], "doc_id", "left_anti")  # few enough ids go to the texts, not the texts to them
    repeats = Scratch(spark, "repeats")
    again = repeats.table("again", docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"))  # reads ids alone
    if not again.isEmpty():
        # hashed before they are sorted: the least of structs is found by sorting rows, and rows with whole texts need not fit
        hashes = docs.select("doc_id", F.struct(F.xxhash64("text").alias("h"), F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)).alias("g")).alias("b"))
        best = repeats.table("best", hashes.join(if_small(again)[0], "doc_id").groupBy("doc_id").agg(F.min("b").alias("b")).select("doc_id", "b.h", "b.g"))
        b = if_small(best)[0].alias("b")
        once = out.alias("d").join(b, F.col("d.doc_id") == F.col("b.doc_id"), "left_anti")
        kept = out.alias("d").join(b, (F.col("d.doc_id") == F.col("b.doc_id")) & (F.xxhash64("d.text") == F.col("b.h")) & (F.xxhash64(*(F.col(f"d.`{c}`") for c in docs.columns)) == F.col("b.g")), "left_semi")
        out = once.union(kept.dropDuplicates(["doc_id"]))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, vocabulary(WORD_BPE), end_id=0)


STAGES = [("quality_rules", rules), ("quality_classifier", classifier), ("ngram_jaccard_join", near_duplicates), ("best_fit_packing", pack)]
#: Tokenising, fitting and components are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.table(f"{k}-{name}", stage(spark, docs, sf_dir))
        if k:
            scratch.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
