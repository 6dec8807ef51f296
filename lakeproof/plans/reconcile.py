"""Reconciling managed tables with their source folders."""
from __future__ import annotations

import time
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lakeproof import schemas
from lakeproof.functions.numeric import TOLERANCE_PCT
from lakeproof.functions.types import describe_columns
from lakeproof.operators import digest, drift, inventory as inv, ledger, partitions as parts, recon
from lakeproof.operators.lookup import is_small, lookup
from lakeproof.operators.profile import PER_GROUP
from lakeproof.plans.state import Tables
from lakeproof.session import SPARK_ERRORS, cut_lineage
from lakeproof.sources import accounting, tables as tb
from lakeproof.spec import DEFAULT, PartitionSpec


def above_floor(df: DataFrame, spec: PartitionSpec) -> DataFrame:
    if spec.floor is None or spec.date not in df.columns:
        return df
    return df.filter(F.col(spec.date) >= F.lit(spec.floor).cast("date"))


def _newest(counts: DataFrame, side: str, columns: list[str], n: int) -> list[Row]:
    """At most ``n`` newest partitions of one side, from the partition counts."""
    return (counts.filter(F.col(side) > 0).orderBy(*[F.desc(c) for c in columns]).limit(n)
            .select(*columns).collect())


Check = tuple[str, Callable[[], DataFrame]]


def pair_checks(source: DataFrame, target: DataFrame, table: str, execution_id: str,
                spec: PartitionSpec = DEFAULT, latest: int = 1, strict: bool = False,
                tolerance_pct: float = TOLERANCE_PCT, extra: bool = False,
                all_partitions: bool = False, per_group: int | None = PER_GROUP,
                limit: int | None = 8) -> list[Check]:
    """The checks of one table pair, each a name and a function that builds its result row.

    One pass per side over the partition columns gives the counts; checksum and profile
    then read only the latest partitions, chosen by literals that reach the scan.
    ``extra`` adds the record counts per partition.  With ``all_partitions`` the checksum
    covers every partition by digests and the profile reads all rows; ``latest`` is the
    number of newest partitions otherwise.  ``per_group`` and ``limit`` bound the profiled
    columns, None for all of them.
    """
    columns, spark = spec.columns, source.sparkSession
    counts = cut_lineage(recon.partition_counts(source, target, columns))
    src_cols = describe_columns(source, table, "source")
    tgt_cols = describe_columns(target, table, "target")
    checks: list[Check] = [
        ("ROW_COUNT", lambda: recon.row_count(counts, table, execution_id)),
        ("COLUMN_COUNT", lambda: recon.column_count(src_cols, tgt_cols, execution_id)),
        ("SCHEMA_VALIDATION", lambda: recon.schema_check(src_cols, tgt_cols, execution_id)),
        ("Partiton_Data_count", lambda: recon.partition_set(counts, columns, table, execution_id))]
    if extra:
        checks.append(("PARTITION_RECORD_COUNT",
                       lambda: recon.partition_record_count(counts, columns, table, execution_id)))
    src_keys = _newest(counts, "source_count", columns, latest)
    tgt_keys = _newest(counts, "target_count", columns, latest)
    if not src_keys or not tgt_keys:
        return checks + [(check, partial(recon.error_result, spark, table, check,
                                         "No latest partition found", execution_id, "SKIP"))
                         for check in ("CHECKSUM_VALIDATION", "VERIFIED")]
    if all_partitions:
        checks.append(("CHECKSUM_VALIDATION", lambda: recon.digest_check(
            digest.compare_partitions(source, target, columns, columns), table, execution_id)))
        checks.append(("VERIFIED", lambda: recon.verify(
            source, target, columns, table, execution_id, None, tolerance_pct, per_group, limit)))
        return checks
    checks.append(("CHECKSUM_VALIDATION", lambda: recon.checksum(
        parts.restrict_to_values(source, src_keys[:1], columns),
        parts.restrict_to_values(target, tgt_keys[:1], columns), columns, table, execution_id,
        src_keys[0].asDict(), tgt_keys[0].asDict(), strict)))
    checks.append(("VERIFIED", lambda: recon.verify(
        parts.restrict_to_values(source, src_keys, columns),
        parts.restrict_to_values(target, tgt_keys, columns), columns, table, execution_id,
        [r.asDict() for r in src_keys], tolerance_pct, per_group, limit)))
    return checks


def reconcile_pair(source: DataFrame, target: DataFrame, table: str, execution_id: str,
                   spec: PartitionSpec = DEFAULT, **options) -> DataFrame:
    """All checks of one table pair as result rows, in one plan."""
    checks = pair_checks(source, target, table, execution_id, spec, **options)
    return reduce(DataFrame.unionByName, [build() for _, build in checks])


def run_checks(checks: list[Check], spark: SparkSession, table: str, execution_id: str) -> DataFrame:
    """Runs the checks one by one: each is timed, and one that fails stops no other.

    A check yields one row, so the rows collected here are as many as there are checks.
    """
    rows: list[Row] = []
    for name, build in checks:
        start = time.monotonic()
        try:
            found = build().collect()
        except Exception as error:  # becomes the check's own result
            found = recon.error_result(spark, table, name, f"{name} failed: {_first_line(error)}",
                                       execution_id).collect()
        seconds = time.monotonic() - start
        rows += [Row(**{**r.asDict(), "exec_duration": seconds}) for r in found]
    return spark.createDataFrame(rows, schemas.RECON_RESULTS)


def _first_line(error: Exception) -> str:
    return (str(error).splitlines() or [type(error).__name__])[0]


def source_index(spark: SparkSession, tables: Tables, datasets: DataFrame,
                 spec: PartitionSpec = DEFAULT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For all given datasets at once: read schema per dataset, partition folders, their files.

    The schema is that of the latest loaded and tracked partition; the folders are those of
    tracked partitions that were loaded or failed to load, the files all that are known there.
    """
    mine = cut_lineage(datasets.select(*inv.DATASET).distinct())
    small = is_small(mine)

    def only(df: DataFrame) -> DataFrame:
        return lookup(df, mine, inv.DATASET, "left_semi", small=small)

    def tracked(*status: str) -> DataFrame:
        files = parts.work_files(only(spark.table(tables.inventory)), spec, F.col("load_status").isin(*status))
        return parts.blessed_partitions(parts.partition_rows(above_floor(files, spec), spec),
                                        spark.table(tables.tags), spec)

    found = drift.latest_readable_schemas(only(spark.table(tables.catalog)), tracked("loaded"), spec,
                                          inv.DATASET)
    folders = cut_lineage(tracked("loaded", "failed").select(*inv.DATASET, "partition_path", spec.run, spec.date).distinct())
    known = ledger.known_files(only(spark.table(tables.inventory)), spec)
    files = lookup(known, folders.select(*inv.DATASET, "partition_path"), [*inv.DATASET, "partition_path"], "left_semi")
    return (cut_lineage(found.select(*inv.DATASET, "schema_json")), folders,
            cut_lineage(files.select(*inv.DATASET, "partition_path", "data_file")))


Index = tuple[DataFrame, DataFrame, DataFrame]


def source_account(spark: SparkSession, index: Index, bucket: str, prefix: str,
                   spec: PartitionSpec = DEFAULT, decode: bool = False) -> DataFrame | None:
    """Per known source file of a dataset whether a lenient read gives all its rows."""
    mine = (F.col("s3_bucket_name") == bucket) & (F.col("bucket_prefix") == prefix)
    found = index[0].filter(mine).first()
    if found is None:
        return None
    return accounting.account(spark, f"{spec.scheme}{bucket}/{prefix}", index[2].filter(mine),
                              drift.read_schema(found.schema_json, spec), decode)


def source_side(spark: SparkSession, index: Index, bucket: str, prefix: str,
                spec: PartitionSpec = DEFAULT) -> DataFrame | None:
    """Source rows of a dataset; None when no schema is known for it.

    Folders are named to the reader in batches, so that no other is listed or opened.
    """
    mine = (F.col("s3_bucket_name") == bucket) & (F.col("bucket_prefix") == prefix)
    found = index[0].filter(mine).first()
    if found is None:
        return None
    root, schema = f"{spec.scheme}{bucket}/{prefix}", drift.read_schema(found.schema_json, spec)
    return above_floor(tb.read_folders(spark, root, index[1].filter(mine), schema, lenient=True), spec)


def reconcile_all(spark: SparkSession, tables: Tables, bucket: str | None = None,
                  only: list[str] | None = None, only_open: bool = False,
                  spec: PartitionSpec = DEFAULT, decode: bool = False, **options) -> DataFrame:
    """Checks every mapped table, stores results and verdicts; one failure stops no other.

    The source is read leniently; the row count's result tells how many files did not give
    all their rows (with ``decode`` also those with a damaged page).  ``options`` are those of
    ``pair_checks``.
    """
    work = parts.reconciliation_work(spark.table(tables.mapping), spark.table(tables.candidates),
                                     bucket, only, only_open)
    index = source_index(spark, tables, work.select(
        F.col("source_s3_bucket").alias("s3_bucket_name"),
        F.col("source_bucket_prefix").alias("bucket_prefix")), spec)
    stored = spark.createDataFrame([], schemas.RECON_RESULTS)
    for row in work.toLocalIterator():
        rows = _one_table(spark, index, row, spec, decode, options)
        tb.append_rows(rows, tables.results)
        stored = stored.unionByName(rows)
    tb.replace_table(recon.merge_rollup(spark.table(tables.candidates), recon.rollup(stored)),
                     tables.candidates)
    return stored


def _one_table(spark: SparkSession, index: Index, row: Row, spec: PartitionSpec, decode: bool,
               options: dict) -> DataFrame:
    table, run = row.target_table_name, row.execution_id
    if not row.source_s3_bucket or not row.source_bucket_prefix:
        return recon.error_result(spark, table, schemas.SOURCE_ERROR,
                                  "Missing bucket or prefix in mapping", run)
    try:
        source = source_side(spark, index, row.source_s3_bucket, row.source_bucket_prefix, spec)
        if source is None:
            return recon.error_result(spark, table, schemas.READ_ERROR,
                                      "Source data is not present", run)
        target = above_floor(spark.table(".".join(
            [x for x in (row.target_catalog_name, row.target_schema_name, table) if x])), spec)
    except SPARK_ERRORS as error:
        return recon.error_result(spark, table, schemas.READ_ERROR,
                                  f"Failed to read source or target data: {_first_line(error)}", run)
    try:
        account = source_account(spark, index, row.source_s3_bucket, row.source_bucket_prefix, spec, decode)
        checks = pair_checks(source, target, table, run, spec, **options)
        name, build = checks[0]     # the row count speaks of rows, so it tells what was not read
        checks[0] = (name, lambda: recon.note_files(build(), account))
        return run_checks(checks, spark, table, run)
    except Exception as error:  # recorded, so that the other tables are still checked
        return recon.error_result(spark, table, schemas.CRITICAL_ERROR,
                                  f"Critical processing error: {_first_line(error)}", run)
