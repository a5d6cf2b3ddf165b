"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from courtline.llm import (chat, decontaminate, infill, licenses, merkle, neardup, packing, pii, quality, substrings, toxicity,
                           warc, webtext)
from courtline.llm.oracle_sql import SQL  # noqa: F401
from courtline.llm.shared import documents, pages


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(pages(spark, sf_dir))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(documents(spark, sf_dir))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_substrings(documents(spark, sf_dir))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webtext.main_text(pages(spark, sf_dir))


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hazard = r"\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, k, role, hazard) for k, role in enumerate(("user", "assistant"))],
                                  "conv_id long, turn long, role string, text string")
    return chat.chat_digests(table.unionByName(added))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(documents(spark, sf_dir))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.infill_digests(documents(spark, sf_dir))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_personal_data": op2_personal_data,
    "op3_toxicity": op3_toxicity,
    "op4_warc": op4_warc,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_licenses": op6_licenses,
    "op7_quality": op7_quality,
    "op8_packing": op8_packing,
    "op9_substrings": op9_substrings,
    "op10_main_text": op10_main_text,
    "op11_chat": op11_chat,
    "op12_manifest": op12_manifest,
    "op13_infill": op13_infill,
}
