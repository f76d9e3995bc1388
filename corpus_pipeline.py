"""The corpus pipeline: language ID, near-duplicates, secrets, mixing, packing.

``STAGES`` lists (name, function). Each function takes (spark, docs, sf_dir) and returns a DataFrame that
is written as Parquet and read again as the next one's ``docs``. Every stage works on all rows that its
predecessor kept; all but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import documents_like, free_name, table, written
from strata.llm.langid import UNKNOWN, held_out, language_id
from strata.llm.minhash import one_of_each
from strata.llm.mixing import mixed_documents
from strata.llm.packing import pack_documents
from strata.llm.secret_scan import redacted

# A document goes when no language fits it better than this, or when it has no letter.
MIN_LANGUAGE_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; texts without letters and undecided ones go.

    Where no row that teaches is labelled (held-out ones don't) nothing can be learned, and no document is
    rejected.
    """
    if docs.filter("lang is not null and text is not null").filter(~held_out(F.col("doc_id"))).isEmpty():
        return docs
    out = free_name(docs.columns, "_language")
    judged = language_id(docs, out)
    found = (F.col(f"{out}.lang_pred") != UNKNOWN) & (F.col(f"{out}.score") >= MIN_LANGUAGE_SCORE)
    return documents_like(judged.filter(found), docs)


def near_duplicates_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_each(docs)


def secrets_redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark."""
    return redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target weights; a document comes once for each epoch that takes it."""
    return mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: a row for each piece of a document."""
    return pack_documents(docs)


STAGES = [
    ("language_id", known_language),
    ("near_dedup", near_duplicates_once),
    ("secret_scan", secrets_redacted),
    ("mixing", mixed),
    ("packing", packed),
]

# Token ids, the forest and the language model are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
