"""Documents to packed training sequences, in five stages.

Each stage is a function of (spark, docs, sf_dir); its rows are written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of their input.

Stages take null ids, null, empty and very long texts, rows that repeat an id or a text, columns
of any further names and empty tables. Texts without words are rejected by the first stage; rows
that repeat an id are documents of their own unless their words repeat as well; further columns
pass through all stages but the last, which names its own.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import neardup, secrets, weaklabels
from tidelog.llm.fertility import judged
from tidelog.llm.frames import bounded_batches, table, written_table
from tidelog.llm.packing import packed

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the bands of their language keep."""
    bounded_batches(spark)
    found, column = judged(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return found.where(F.col(column)["kept"]).select(*docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to this stage's input, calls good."""
    bounded_batches(spark)
    return weaklabels.good_ones(docs, weaklabels.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the least id."""
    bounded_batches(spark)
    return neardup.one_of_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret; ``n_chars`` follows the text."""
    bounded_batches(spark)
    clean = secrets.redact_column(docs, secrets.fit(docs))
    if "n_chars" not in docs.columns:
        return clean
    size = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return clean.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    bounded_batches(spark)
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

#: Bands, a fitted model and a search decide; SQL does not express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written_table(stage(spark, docs, sf_dir), name)
    return docs
