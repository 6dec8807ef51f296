"""Were all files read? Rows read per file against the rows its footer tells.

A lenient read skips a file it cannot open and drops the rest of one that breaks off. The
account compares, file by file, what the inventory knows, what the footer says and what a
lenient read gave, so that nothing is missing without a number.
"""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.functions.paths import percent_decode
from lakeproof.sources import storage, tables as tb

READ, SHORT, SKIPPED = "read", "short", "skipped"


def _footer_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path in batch["data_file"]:
            try:
                system, inner = storage.resolve(path)
                with system.open_input_file(inner) as file:
                    rows.append(pq.read_metadata(file).num_rows)
            except Exception:  # a file without a footer is a finding, not a failure
                rows.append(None)
        yield batch.assign(footer_rows=pd.array(rows, "Int64"))


def footer_rows(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """Adds ``footer_rows`` to rows with a ``data_file``; null where no footer can be read."""
    tasks = tasks or int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType(list(files.schema.fields)).add("footer_rows", "long")
    return files.repartition(tasks, "data_file").mapInPandas(_footer_rows, schema)


def plain_path(path: Column) -> Column:
    """A path without its scheme, so that two spellings of one place are equal."""
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")


def rows_by_file(spark: SparkSession, root: str, files: DataFrame, schema: T.StructType,
                 decode: bool = False) -> DataFrame:
    """``file, rows_read`` of a lenient read of the files' folders.

    Without ``decode`` only row counts are taken, which opens files but reads no column; with
    it every column is decoded, so that a damaged page shows as well.
    """
    data = tb.read_folders(spark, root, files, schema, lenient=True, extra=[F.col("_metadata.file_path").alias("__file")])
    counts = [F.count(F.lit(1)).alias("rows_read")]
    if decode:
        counts.append(F.max(F.xxhash64(*[F.col(f"`{f.name}`") for f in schema.fields])).alias("decoded"))
    found = data.groupBy("__file").agg(*counts)
    # The result depends on the decoded values, so that no optimiser leaves the columns out.
    rows = F.when(F.col("decoded").isNotNull(), F.col("rows_read")) if decode else F.col("rows_read")
    return found.select(plain_path(percent_decode(F.col("__file"))).alias("file"), rows.alias("rows_read"))


def account(spark: SparkSession, root: str, files: DataFrame, schema: T.StructType,
            decode: bool = False) -> DataFrame:
    """Per known file: ``footer_rows``, ``rows_read`` and whether it was read, short or skipped."""
    known = footer_rows(files).withColumn("file", plain_path(F.col("data_file")))
    read = rows_by_file(spark, root, files, schema, decode)
    rows = F.coalesce("rows_read", F.lit(0))
    state = (F.when(F.col("footer_rows").isNull() | (F.col("rows_read").isNull() & (F.col("footer_rows") > 0)), SKIPPED)
             .when(rows < F.col("footer_rows"), SHORT).otherwise(READ))
    # One row a file on either side.
    return known.join(read, "file", "left").select(*files.columns, "footer_rows", rows.alias("rows_read"), state.alias("state"))
