import random

import pytest
from pyspark.sql import functions as F

CLASHING = ("n_tokens", "ids", "shard", "slot", "row", "size", "key", "gone", "label", "score", "sig", "rank",
            "offset", "n", "k0", "piece", "shingles", "text_hash")


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in any column, empty and very long texts, repeated rows, clashing extra columns."""
    r = random.Random(5)
    long = " ".join("".join(r.choice("abcdeé") for _ in range(r.randint(1, 9))) for _ in range(30_000))
    rows = [(1, "Some words of a text.\nAnd a second line."), (2, None), (3, ""), (3, ""), (None, "no id here"),
            (None, None), (4, long), (5, "Some words of a text.\nAnd a second line."), (6, " \t\n "), (7, "one"),
            (8, "x" * 30_000), (1, "Some words of a text.\nAnd a second line.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit(None).cast("string") for c in CLASHING}).cache()


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0), (4, None, 0), (5, 1, 0), (5, 0, 1)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def few(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
