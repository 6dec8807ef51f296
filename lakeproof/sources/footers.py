"""Schemas of Parquet files from their footers, unreadable files flagged."""
from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from lakeproof.functions import paths
from lakeproof.functions.types import canonical_schema
from lakeproof.sources import storage

CORRUPTED = "corrupted"  # fixed value in place of a schema


SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"  # fixed value: footer key of Spark

# How Spark reads unsigned whole numbers.
UNSIGNED = {pa.uint8(): pa.int16(), pa.uint16(): pa.int32(), pa.uint32(): pa.int64(),
            pa.uint64(): pa.decimal128(20, 0)}


def _as_read(kind: pa.DataType) -> pa.DataType:
    """The Arrow type that stands for what Spark's reader makes of a column."""
    if kind in UNSIGNED:
        return UNSIGNED[kind]
    if pa.types.is_dictionary(kind):
        return _as_read(kind.value_type)
    if pa.types.is_timestamp(kind) and kind.unit == "ns":
        return pa.timestamp("us", tz="UTC")  # only the 96-bit form gets here
    if pa.types.is_fixed_size_binary(kind):
        return pa.binary()
    if pa.types.is_map(kind):
        return pa.map_(_as_read(kind.key_type), _as_read(kind.item_type))
    if pa.types.is_list(kind) or pa.types.is_large_list(kind) or pa.types.is_fixed_size_list(kind):
        return pa.list_(_as_read(kind.value_type))
    if pa.types.is_struct(kind):
        return pa.struct([pa.field(f.name, _as_read(f.type)) for f in kind])
    return kind


def _nullable(document):
    """A schema document with every part nullable, as file readers report it."""
    if isinstance(document, list):
        return [_nullable(d) for d in document]
    if isinstance(document, dict):
        return {k: True if k in ("nullable", "containsNull", "valueContainsNull") else _nullable(v)
                for k, v in document.items()}
    return document


def footer_schema(path: str) -> T.StructType:
    """Spark schema of one Parquet file, as Spark would read it; only the footer is opened.

    A schema Spark wrote into the footer wins over the file's own types.
    """
    system, inner = storage.resolve(path)
    with system.open_input_file(inner) as file:
        footer = pq.read_metadata(file)
    written = (footer.metadata or {}).get(SPARK_SCHEMA)
    if written is not None:
        return T.StructType.fromJson(_nullable(json.loads(written)))
    leaves = [footer.schema.column(i) for i in range(len(footer.schema))]
    for leaf in leaves:
        if "timeUnit=nanoseconds" in str(leaf.logical_type):
            raise ValueError(f"Illegal Parquet type: {leaf.path} counts nanoseconds")
    arrow = footer.schema.to_arrow_schema()
    plain = pa.schema([pa.field(f.name, _as_read(f.type)) for f in arrow])
    read = from_arrow_schema(plain, prefer_timestamp_ntz=True)
    return T.StructType.fromJson(_nullable(read.jsonValue()))


def _capture(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for row in batch.to_dict("records"):
            try:
                row.update(schema_json=canonical_schema(footer_schema(row["data_file"])),
                           is_corrupted=False, error_message=None)
            except Exception as error:  # any unreadable file is a finding, not a failure
                text = (str(error).splitlines() or [type(error).__name__])[0]
                row.update(schema_json=CORRUPTED, is_corrupted=True, error_message=text)
            rows.append(row)
        yield pd.DataFrame(rows)


def capture_files(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """Adds schema_json, is_corrupted and error_message to rows with a ``data_file``."""
    tasks = tasks or int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType(list(files.schema.fields)).add("schema_json", "string").add(
        "is_corrupted", "boolean").add("error_message", "string")
    return files.repartition(tasks, "data_file").mapInPandas(_capture, schema)


def capture_partitions(captured: DataFrame, keep: list[str]) -> DataFrame:
    """One catalog row per partition folder from its captured files.

    A partition is corrupted when any file is; otherwise the file with the smallest path
    speaks for it, and ``schemas`` tells how many different ones it holds.
    """
    good = F.when(~F.col("is_corrupted"), F.col("schema_json"))
    rows = captured.withColumn("file_path", paths.parent("data_file")).groupBy("file_path", *keep).agg(
        F.bool_or("is_corrupted").alias("is_corrupted"),
        F.min(F.when(~F.col("is_corrupted"), F.struct("data_file", "schema_json"))).alias("first"),
        F.min(F.when(F.col("is_corrupted"), F.struct("data_file", "error_message"))).alias("bad"),
        F.count_distinct(good).alias("schemas"), F.count(F.lit(1)).alias("files"))
    text = F.when(F.col("is_corrupted"), F.lit(CORRUPTED)).otherwise(F.col("first.schema_json"))
    return rows.select("file_path", text.alias("schema_json"), "is_corrupted",
                       F.col("bad.error_message").alias("error_message"), *keep, "schemas", "files")
