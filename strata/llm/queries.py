"""The query of each operator, over its whole table. Each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import license_scan
from strata.llm.common import table
from strata.llm.decontaminate import contaminated
from strata.llm.fingerprints import fingerprints
from strata.llm.html_extract import main_texts
from strata.llm.langid import held_out, language_id
from strata.llm.manifest import manifest_digests
from strata.llm.minhash import near_duplicates
from strata.llm.mixing import document_sizes, mix
from strata.llm.packing import pack_documents
from strata.llm.periodic_runs import run_digests
from strata.llm.quality import quality_rules
from strata.llm.secret_scan import scan
from strata.llm.substring import repeated_units

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return license_scan.scan(table(spark, d, "documents"))


def op2_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return fingerprints(table(spark, d, "documents"))


def op3_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    return scan(table(spark, d, "documents"))


def op4_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    return language_id(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "_language.*")


def op5_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules(table(spark, d, "documents"))


def op6_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return pack_documents(table(spark, d, "documents"))


def op7_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    return main_texts(table(spark, d, "pages"))


def op8_minhash_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates(table(spark, d, "documents"))


def op9_mixing(spark: SparkSession, d: str) -> DataFrame:
    mixed = mix(document_sizes(table(spark, d, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return repeated_units(table(spark, d, "documents"))


def op11_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    return run_digests(table(spark, d, "documents"))


def op12_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    return manifest_digests(table(spark, d, "documents"))


def op13_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_fingerprints": op2_fingerprints,
    "op3_secret_scan": op3_secret_scan,
    "op4_language_id": op4_language_id,
    "op5_quality_rules": op5_quality_rules,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_html_extraction": op7_html_extraction,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_mixing": op9_mixing,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_decontamination": op13_decontamination,
}
