"""Schemas of the state tables.  Names and types are fixed values."""
from __future__ import annotations

from pyspark.sql import types as T

from lakeproof.spec import DEFAULT, PartitionSpec


_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(),
          "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(),
          "timestamp": T.TimestampType()}


def _struct(ddl: str) -> T.StructType:
    """``name type`` pairs as a schema; needs no running session."""
    pairs = [pair.split() for pair in ddl.split(",")]
    return T.StructType([T.StructField(name.strip("`"), _TYPES[kind]) for name, kind in pairs])


MAPPING = _struct(
    "dataset_name string, s3_bucket_name string, bucket_prefix string, "
    "dbx_catalog string, dbx_managed_table_schema string, datetime timestamp")

LISTING = _struct(
    "s3_bucket_name string, bucket_prefix string, path string, file_name string, "
    "last_modified_time timestamp, size bigint, extension string")


def inventory(spec: PartitionSpec = DEFAULT) -> T.StructType:
    return _struct(
        "execution_id string, s3_bucket_name string, bucket_prefix string, key string, "
        "extension string, size bigint, last_modified_time timestamp, partition_key string, "
        f"`{spec.run}` string, `{spec.date}` date, load_status string")


CANDIDATES = _struct(
    "execution_id string, s3_bucket_name string, bucket_prefix string, table_name string, "
    "total_file_count bigint, table_file_size_mb double, structured_file_count bigint, "
    "candidate_for_managed_table_creation string, schema_analysis_results string, "
    "managed_table_created string, error_message string, recon_job_run string, "
    "recon_status string, recon_execution_time timestamp, partition_key string")

PARTITION_TAGS = _struct(
    "dataset_name string, run_id string, run_tag_key string, run_tag_value string")

SCHEMA_CATALOG = _struct(
    "file_path string, schema_json string, is_corrupted boolean, error_message string, "
    "bucket_prefix string, execution_id string, s3_bucket_name string, run_timestamp timestamp")

CLAIMS = _struct(
    "execution_id string, s3_bucket_name string, bucket_prefix string, table_name string, "
    "migration_status string, datetime timestamp")


def load_status(spec: PartitionSpec = DEFAULT) -> T.StructType:
    return _struct(
        "partition_path string, bucket_name string, bucket_prefix string, "
        f"`{spec.run}` string, `{spec.date}` date, load_status string")


def pending_status(spec: PartitionSpec = DEFAULT) -> T.StructType:
    """Load status not merged into the inventory yet; ``was`` is the status it replaces."""
    return load_status(spec).add("was", "string")


def ledger(spec: PartitionSpec = DEFAULT) -> T.StructType:
    """Files that each load or repair of a partition pair took."""
    return _struct(
        f"s3_bucket_name string, bucket_prefix string, `{spec.run}` string, `{spec.date}` date, "
        "partition_path string, data_file string, size bigint, last_modified_time timestamp, "
        "load_id string, step string, loaded_at timestamp")


RECON_RESULTS = _struct(
    "execution_id string, table_name string, recon_type string, exec_timestamp timestamp, "
    "exec_duration double, status string, source_metrics string, target_metrics string, "
    "metrics_compared int, metrics_matched int, metrics_different int, summary string, "
    "error_log string")

REMEDIATION_LOG = _struct(
    "execution_id string, s3_bucket_name string, bucket_prefix string, dataset_name string, "
    "remediation_attempted_time timestamp, partitions_attempted int, "
    "partitions_remediated int, partitions_failed int, remediation_status string, "
    "error_msg string")

SCHEMA_COMPARISON = _struct(
    "Base_Column_Name string, Base_Data_Type string, Failed_Column_Name string, "
    "Failed_Data_Type string, Status string, dataset_name string")

COPY_MAPPING = _struct(
    "s3_batch_copy_id string, src_inventory_s3_location string, src_bucket_name string, "
    "src_prefix string, src_inventory_name string, dest_inventory_s3_location string, "
    "dest_bucket_name string, dest_prefix string, dest_inventory_name string, "
    "last_recon_timestamp timestamp, runId string, status string, recon_status string, "
    "enabled boolean")

REPORT_LIST = _struct(
    "bucket_name string, prefix string, inventory_s3_location string, path string, "
    "size double, name string, modificationTime timestamp, processed string, runId string")

REPORT_DETAILS = _struct(
    "Bucket string, Key string, Size string, LastModifiedDate string, ETag string, "
    "inventory_s3_location string, path string, name string, prefix string, processed string, "
    "runId string")

DIFFERENCES = _struct(
    "s3_batch_copy_id string, runId string, Key string, Size bigint, ETag string, "
    "lastModifiedDate timestamp, src_bucket string, src_prefix string, dest_bucket_name string, "
    "dest_prefix string, status string, time_stamp timestamp, sync_to_dest_bucket_status string")

# One element of the JSON text that describes the reports below a manifest root.
REPORT_ENTRY = _struct("file string, name string, size double, modificationTime timestamp")

MANIFEST = ("fileFormat string, fileSchema string, "
            "files array<struct<key string, size bigint, MD5checksum string>>")

OBJECTS = _struct(
    "s3_batch_copy_id string, bucket string, prefix string, rel_key string, size bigint, "
    "modified timestamp, etag string")

# Result types and statuses: fixed values.
EXPECTED_CHECKS = (
    "ROW_COUNT", "COLUMN_COUNT", "SCHEMA_VALIDATION", "Partiton_Data_count",
    "CHECKSUM_VALIDATION", "VERIFIED")
READ_ERROR, SOURCE_ERROR, CRITICAL_ERROR = "data_read_error", "source_read_error", "critical_error"

ONLY_SRC = "EXISTS_IN_SRC_AND_BUT_NOT_IN_DEST"
ONLY_DEST = "EXISTS_IN_DEST_AND_BUT_NOT_IN_SRC"
SRC_NEWER = "FILES_IN_SRC_ARE_NEWER_THAN_DESTINATION"
DEST_NEWER_OTHER_SIZE = "FILES_IN_DEST_ARE_NEWER_THAN_SRC_AND_NOT_OF_SAME_SIZE"
SAME = "EXISTS_IN_SRC_AND_DEST_SAME"
OTHER_CHECKSUM = "EXISTS_IN_SRC_AND_DESTINATION_BUT_DIFFERENT_CHECKSUM"
NOT_SAME = "EXISTS_IN_SRC_AND_DEST_BUT_NOT_SAME"
UNKNOWN = "UNKNOWN"
CLAIMED = "picked_up_for_migration"
