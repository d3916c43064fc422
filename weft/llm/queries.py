"""Registered queries of the numbered operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import attention, audit, crosstoken, decontam, dedup, kneserney, langid, licenses, nndescent, packing, perspectives, separators, urlrules
from .ship import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(_table(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nndescent.nearest(_table(spark, sf_dir, "embeddings"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.match(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.rotate(_table(spark, sf_dir, "conversations"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneserney.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.classes(_table(spark, sf_dir, "documents")).drop("node")


def op9_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention.score(_table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return separators.token_counts(_table(spark, sf_dir, "documents"), files=True)


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge(_table(spark, sf_dir, "pages"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstoken.score(_table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_licenses": op2_licenses,
    "op3_neighbours": op3_neighbours,
    "op4_packing": op4_packing,
    "op5_decontamination": op5_decontamination,
    "op6_perspectives": op6_perspectives,
    "op7_quality": op7_quality,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_attention_scores": op9_attention_scores,
    "op10_token_counts": op10_token_counts,
    "op11_url_rules": op11_url_rules,
    "op12_alignment": op12_alignment,
    "op13_filter_audit": op13_filter_audit,
}
ORACLES: dict[str, str] = {
    "op6_perspectives": perspectives.ORACLE,
    "op11_url_rules": urlrules.ORACLE,
    "op13_filter_audit": audit.ORACLE,
}
