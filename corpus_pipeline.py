"""A training-data pipeline over ``documents``, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps, with the columns of
``documents``; the last returns the packed pieces. Quality labels come from ``sf_dir``.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.llm import line_dedup, ngram_join, packing, quality_classifier, quality_rules
from lakeproof.llm.common import file_bytes, stored, table
from lakeproof.llm.text_stats import statistics

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SEQUENCE = 4096


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the quality classifier accepts.

    Only the counts of texts are stored, for the fit; the verdict counts them again, which costs
    less than a copy of every text on disk. A null text counts as an empty one; rows with a null
    id are judged as all others.
    """
    model = quality_classifier.fit(stored(statistics(docs), "quality"), table(spark, sf_dir, "labels"))
    return quality_classifier.accept(docs, model).select(*COLUMNS)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the quality rules keep; counts and nulls as in ``classify``."""
    rules = quality_rules.fit(stored(statistics(docs), "rules"), table(spark, sf_dir, "labels"))
    return quality_rules.keep(docs, rules).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes repeated blocks from later documents; one with no word left goes."""
    cleaned = line_dedup.dedup_lines(docs, carry=("lang", "source", "n_chars"))
    emptied = (F.col("n_deleted") > 0) & (F.col("n_deleted") == F.col("n_lines"))
    length = F.when(F.col("n_deleted") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.where(~emptied).withColumn("n_chars", length).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by five-word shingles at 0.8."""
    return ngram_join.without_near_duplicates(docs, width=5, num=80, den=100).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences."""
    tokenizer = file_bytes(public_tokenizers.path("word_bpe_49k.json"))
    return packing.packed_documents(docs, tokenizer, SEQUENCE)


STAGES = [("quality classifier", classify), ("quality rules", apply_rules), ("line dedup", dedup_lines),
          ("n-gram Jaccard join", drop_near_duplicates), ("best-fit packing", pack)]

# Neither the models nor the alignment can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on the stored result of the one before."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
