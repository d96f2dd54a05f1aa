"""The queries of this subpackage: every operator over its whole table, digest columns derived from its output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, decontaminate, filter_audit, jaccard, langid, lm, mixing, neardup, phrases, pii, quality, secrets, warc
from tidemark.llm.oracle import ORACLE_SQL


__all__ = ["ORACLE_SQL", "QUERIES"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf_dir, "documents"))


def quality_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules with languages as hosts and a limit of five texts, at which small tables lose lines too."""
    return quality.quality_verdicts(table(spark, sf_dir, "documents"), "lang", quality.Limits(line_texts=5))


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents")).drop("source")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.contamination(docs, benchmark))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    example = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(example)
    return chat.digest(chat.windows(turns))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_data(table(spark, sf_dir, "documents")))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.secret_spans(table(spark, sf_dir, "documents")))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_components(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scores": op1_lm_scores,
    "op2_mixing": op2_mixing,
    "op3_decontamination": op3_decontamination,
    "op4_warc": op4_warc,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_personal_data": op7_personal_data,
    "op8_quality_rules": op8_quality_rules,
    "op9_secret_scans": op9_secret_scans,
    "op10_language_id": op10_language_id,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_filter_audit": op12_filter_audit,
    "op13_phrases": op13_phrases,
    "quality_by_language": quality_by_language,
}
