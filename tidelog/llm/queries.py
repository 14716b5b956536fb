"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import chat, decontam, kdsearch, licenses, neardup, secrets, weaklabels
from tidelog.llm.alignment import aligned
from tidelog.llm.bpe import token_digests
from tidelog.llm.fertility import fertility_rules
from tidelog.llm.frames import table
from tidelog.llm.packing import packed
from tidelog.llm.sharding import sharded
from tidelog.llm.whitening import whitened

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.secret_spans(docs, secrets.fit(docs))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(table(spark, sf_dir, "conversations"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return fertility_rules(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return weaklabels.quality_scores(docs, weaklabels.fit(docs))


def op7_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_digests(docs, ranks, public_tokenizers.PATTERN)


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdsearch.top_inner_products(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return aligned(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontam.hit_counts(decontam.contaminated(docs, benchmark))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


def registered() -> dict[str, Query]:
    found = [
        op1_secret_scans,
        op2_minhash_near_dedup,
        op3_chat_formatting,
        op4_quality_rules,
        op5_license_scans,
        op6_quality_classifier,
        op7_byte_level_bpe,
        op8_exact_top_k,
        op9_sharding,
        op10_best_fit_packing,
        op11_tokenizer_alignment,
        op12_benchmark_decontamination,
        op13_embedding_whitening,
    ]
    return {query.__name__: query for query in found} | {"pipeline": corpus_pipeline.run}


def oracle() -> dict[str, str]:
    found = {
        "op5_license_scans": licenses.oracle(),
        "op8_exact_top_k": kdsearch.oracle(every=100, k=10),
        "op12_benchmark_decontamination": decontam.oracle(),
        "pipeline": corpus_pipeline.ORACLE_SQL,
    }
    return {name: sql for name, sql in found.items() if sql}
