"""File inventory: new files, key parsing, candidate metrics."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeproof.functions import paths
from lakeproof.operators.lookup import SALT, is_small, lookup
from lakeproof.operators.merge import absent_rows, upsert
from lakeproof.session import cut_lineage
from lakeproof.spec import DEFAULT, PartitionSpec

DATASET = ["s3_bucket_name", "bucket_prefix"]


def high_water_marks(inventory: DataFrame, by: list[str] = DATASET) -> DataFrame:
    """Newest stored modification time per dataset."""
    return inventory.groupBy(*by).agg(F.max("last_modified_time").alias("stored_until"))


def newer_files(listing: DataFrame, inventory: DataFrame, by: list[str] = DATASET,
                late: bool = False, salt: int = SALT) -> DataFrame:
    """Listed files modified after the newest stored one; all files of an unknown dataset.

    The marks, one row per dataset, are computed at once and broadcast when they are few,
    so that the listing is not shuffled.  With ``late`` files of the very same time are kept
    as well unless their key is stored already; ``listing`` then needs a ``key`` column.
    """
    marks = cut_lineage(high_water_marks(inventory, by))
    marked = lookup(listing, marks, by, "left", salt, is_small(marks))
    mark, time = F.col("stored_until"), F.col("last_modified_time")
    if not late:
        return marked.filter(mark.isNull() | (time > mark)).drop("stored_until")
    kept = marked.filter(mark.isNull() | (time >= mark)).drop("stored_until")
    return absent_rows(inventory, kept, [*by, "key"], 1)  # an object is listed once


def mapped_only(listing: DataFrame, mapping: DataFrame, by: list[str] = DATASET,
                salt: int = SALT) -> DataFrame:
    """Rows of mapped datasets only."""
    mapped = cut_lineage(mapping.select(*by).distinct())
    return lookup(listing, mapped, by, "left_semi", salt, is_small(mapped))


def parse_keys(listing: DataFrame, spec: PartitionSpec = DEFAULT, lower: bool = False) -> DataFrame:
    """Adds key (from path, when absent), partition_key, run id and snapshot date."""
    df = listing
    if "key" not in df.columns:
        df = df.withColumn("key", paths.object_key("path", "s3_bucket_name", spec.scheme))
    if "extension" not in df.columns:
        df = df.withColumn("extension", paths.extension(paths.file_name("key")))
    return (df.withColumn("partition_key", paths.partition_key("key"))
            .withColumn(spec.run, paths.partition_value("key", spec.run, lower))
            .withColumn(spec.date, paths.partition_date("key", spec.date)))


def new_inventory(listing: DataFrame, inventory: DataFrame, mapping: DataFrame,
                  execution_id: str, spec: PartitionSpec = DEFAULT, late: bool = False) -> DataFrame:
    """Inventory rows to append for one listing, all datasets in one plan."""
    if late and "key" not in listing.columns:
        listing = listing.withColumn("key", paths.object_key("path", "s3_bucket_name", spec.scheme))
    fresh = newer_files(listing, inventory, late=late)
    parsed = parse_keys(mapped_only(fresh, mapping), spec)
    return parsed.select(
        F.lit(execution_id).alias("execution_id"), *DATASET, "key", "extension", "size",
        "last_modified_time", "partition_key", spec.run, spec.date,
        F.lit(None).cast("string").alias("load_status"))


def candidate_metrics(inventory: DataFrame, only: Column | None = None) -> DataFrame:
    """Files, structured files and MB per dataset over rows not loaded yet."""
    waiting = inventory.filter(F.col("load_status").isNull())
    if only is not None:
        waiting = waiting.filter(only)
    return waiting.groupBy(*DATASET).agg(
        F.count(F.lit(1)).alias("total_file_count"),
        paths.megabytes(F.sum("size")).alias("table_file_size_mb"),
        F.count("extension").alias("structured_file_count"))


def upsert_candidates(candidates: DataFrame, metrics: DataFrame, execution_id: str) -> DataFrame:
    """Refreshes undecided candidates; adds a row for a dataset that has none.

    Both sides hold few rows a dataset, so no key is hot and none is spread over sub-keys.
    """
    undecided = F.col("candidate_for_managed_table_creation").isNull()
    figures = ["total_file_count", "table_file_size_mb", "structured_file_count"]
    fresh = metrics.select(
        F.lit(execution_id).alias("execution_id"), *DATASET,
        paths.dataset_name("bucket_prefix").alias("table_name"), *figures)
    return upsert(candidates, metrics, DATASET, {c: c for c in figures},
                  guard=F.col("t.candidate_for_managed_table_creation").isNull(),
                  present=undecided, new_rows=fresh, salt=1)


def add_mappings(mapping: DataFrame, incoming: DataFrame) -> DataFrame:
    """Mapping table plus the incoming rows it does not have."""
    keys = ["dataset_name", "s3_bucket_name", "bucket_prefix"]
    return mapping.unionByName(absent_rows(mapping, incoming, keys))


def eligible_candidates(candidates: DataFrame, bucket: str, low: int, high: int) -> DataFrame:
    """Undecided, uncreated candidates of a bucket within a file-count range."""
    return candidates.filter(
        F.col("managed_table_created").isNull()
        & F.col("candidate_for_managed_table_creation").isNull()
        & (F.col("s3_bucket_name") == bucket)
        & F.col("structured_file_count").between(low, high))
