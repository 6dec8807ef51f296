"""Registered queries of the operators: whole tables in, digests out."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.llm import (ann, bpe, collocations, cross_align, license_scan, line_dedup, merkle, ngram_join, packing,
                           quality_classifier, quality_rules, sharding, token_counts)
from lakeproof.llm.common import documents, file_bytes, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

SEQUENCE = 4096
SHARDS = 8
NEIGHBOURS = 5


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> bytes:
    return file_bytes(public_tokenizers.path(name))


@query
def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.decode(bpe.encode(documents(spark, sf_dir), ranks, pattern), ranks, pattern)
    return coded.select("doc_id", F.expr("cast(length(ids) / 4 as long)").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), SEQUENCE)


@query
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = ngram_join.link_documents(documents(spark, sf_dir), width=3, num=90, den=100)
    return linked.select("doc_id", "n_shingles", "component_id")


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir)).drop("places")


@query
def op2_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard_by_bytes(documents(spark, sf_dir), SHARDS)
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"))


@query
def op4_posting_list_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_vectors(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, NEIGHBOURS)


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir))


@query
def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures, _ = cross_align.alignment_measures(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"),
                                                 vocabulary("piece_bpe_32k.model"))
    return measures


@query
def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(documents(spark, sf_dir))


ORACLE["op12_document_fingerprints"] = merkle.SQL


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))
