"""Inventory from a folder into which listings arrive as Parquet files.

The stream's own record of listings read takes the place of the high-water mark.  Rows of
an object that is stored already, as it was modified last, are left out, so a listing that
arrives twice, in one micro-batch or in several, adds its files once.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.operators import inventory as inv
from lakeproof.operators.merge import absent_rows
from lakeproof.spec import DEFAULT, PartitionSpec


def ingest_listings(spark: SparkSession, folder: str, schema: T.StructType, target: str,
                    checkpoint: str, mapping: DataFrame, execution_id: str,
                    spec: PartitionSpec = DEFAULT, files_per_batch: int = 100) -> None:
    """Reads every listing that has arrived since the last call and adds its files.

    Each micro-batch owns one folder ``batch=N`` of the target and overwrites it, so a batch
    that runs again after a crash leaves no doubled rows.
    """
    same = [*inv.DATASET, "key", "last_modified_time"]

    def stored(other: DataFrame, number: int) -> DataFrame | None:
        try:
            return other.sparkSession.read.parquet(target).filter(F.col("batch") != number).select(*same)
        except AnalysisException:   # nothing stored yet
            return None

    def add(batch: DataFrame, number: int) -> None:
        parsed = inv.parse_keys(inv.mapped_only(batch, mapping), spec)
        rows = parsed.select(
            F.lit(execution_id).alias("execution_id"), *inv.DATASET, "key", "extension", "size",
            "last_modified_time", "partition_key", spec.run, spec.date,
            F.lit(None).cast("string").alias("load_status"))
        rows, before = rows.dropDuplicates(same), stored(batch, number)
        if before is not None:
            rows = absent_rows(before, rows, same, 1)   # both sides have a row per object
        rows.write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
              .parquet(folder))
    query = (stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
