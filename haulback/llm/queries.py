"""The queries of this subpackage, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulback.llm import decontamination, line_dedup, mixing, ngram_scores, quality, spelling
from haulback.llm.fingerprints import fingerprints
from haulback.llm.jaccard_join import similar_groups
from haulback.llm.language_id import held_out, identify, train_dictionaries
from haulback.llm.licences import scan
from haulback.llm.packing import pack
from haulback.llm.simple8b import read_ids, write_ids
from haulback.llm.tables import documents
from haulback.llm.whitening import whiten


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(documents(spark, sf_dir)).drop("text_hash", "root")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(documents(spark, sf_dir)).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(documents(spark, sf_dir)).drop("rule")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = identify(docs, train_dictionaries(docs.filter(~held_out(F.col("doc_id")))))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ngram_scores.scores(documents(spark, sf_dir), ~ngram_scores.held_out(F.col("doc_id")), order=3)
    return scored.withColumn("held_out", ngram_scores.held_out(F.col("doc_id")))


def op9_simple8b_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_ids(write_ids(documents(spark, sf_dir)))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(documents(spark, sf_dir))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_packing, op3_document_fingerprints, op4_line_dedup, op5_license_scan,
        op6_quality_rules, op7_language_id, op8_lm_scoring, op9_simple8b_output, op10_source_mixing,
        op11_spelling_variants, op12_benchmark_decontamination, op13_embedding_whitening,
    )
}

ORACLE: dict[str, str] = {
    "op4_line_dedup": line_dedup.ORACLE_SQL,
    "op6_quality_rules": quality.ORACLE_SQL,
    "op10_source_mixing": mixing.ORACLE_SQL,
    "op11_spelling_variants": spelling.ORACLE_SQL,
    "op12_benchmark_decontamination": decontamination.ORACLE_SQL,
}
