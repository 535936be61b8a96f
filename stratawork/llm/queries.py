"""The registered queries: each applies its operator to whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratawork.llm.support import prepare
from stratawork.session import read_table

WORD_BPE, PIECE_BPE = "word_bpe_49k.json", "piece_bpe_32k.model"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratawork.llm.tokens import count_tokens

    return count_tokens(read_table(spark, sf_dir, "documents"), vocabulary(WORD_BPE))


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratawork.llm.warc import round_trip

    return round_trip(read_table(spark, sf_dir, "pages")).drop("url")


def op3_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratawork.llm.language_id import held_out, predict, train

    docs = read_table(spark, sf_dir, "documents")
    prepare(spark)
    trees = train(docs.filter(~held_out(F.col("doc_id"), 4, 2)))
    return predict(docs, trees).select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratawork.llm.token_files import round_trip

    return round_trip(read_table(spark, sf_dir, "documents"), vocabulary(WORD_BPE), end_id=1)


def op5_pq_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratawork.llm.vector_links import near_vectors

    return near_vectors(read_table(spark, sf_dir, "embeddings"))


def op6_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratawork.llm.pieces import piece_digests

    return piece_digests(read_table(spark, sf_dir, "documents"), vocabulary(PIECE_BPE))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratawork.llm.packing import pack_documents

    return pack_documents(read_table(spark, sf_dir, "documents"), vocabulary(WORD_BPE), end_id=0)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratawork.llm.jaccard_join import jaccard_components

    return jaccard_components(read_table(spark, sf_dir, "documents"))


def op9_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratawork.llm.language_id import held_out
    from stratawork.llm.quality_classifier import score, train

    docs, out = read_table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 3, 1)
    model = train(docs, read_table(spark, sf_dir, "labels"), ~out)
    return score(docs, model).select("doc_id", out.alias("held_out"), "score", "predicted")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratawork.llm.quality_rules import apply_rules

    prepare(spark)
    return apply_rules(read_table(spark, sf_dir, "documents"))


def op11_elkan_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratawork.llm.elkan import cluster

    return cluster(read_table(spark, sf_dir, "embeddings"))


def op12_merkle_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratawork.llm.merkle import every_fifth, manifest

    return manifest(read_table(spark, sf_dir, "documents"), every_fifth(F.col("doc_id")))


def op13_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratawork.llm.suffix_repeats import keep_first

    return keep_first(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_warc_revisits, op2_token_counts, op3_ppm_language, op4_token_files, op5_pq_near_vectors, op6_piece_viterbi, op7_best_fit_packing, op8_jaccard_join, op9_rule_ensemble, op10_quality_rules, op11_elkan_clusters, op12_merkle_paths, op13_suffix_repeats)}


def oracle_sql() -> dict[str, str]:
    from stratawork.llm.oracle import statements

    return statements()
