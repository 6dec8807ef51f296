"""Partition selection: blessed, latest, failed; load plans and claims."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeproof import schemas
from lakeproof.functions import paths
from lakeproof.operators.inventory import DATASET
from lakeproof.operators.lookup import BROADCAST_ROWS, SALT, is_small, lookup
from lakeproof.session import cut_lineage
from lakeproof.spec import DEFAULT, PartitionSpec

NAMED = 64  # partitions named as literals in one filter


def work_files(inventory: DataFrame, spec: PartitionSpec = DEFAULT,
               status: Column | None = None) -> DataFrame:
    """Structured files in the expected layout that wait for loading (or have ``status``)."""
    wanted = F.col("load_status").isNull() if status is None else status
    return inventory.filter(wanted & F.col("extension").isNotNull()
                            & (F.lower("partition_key") == spec.key_text))


def partition_rows(files: DataFrame, spec: PartitionSpec = DEFAULT) -> DataFrame:
    """Distinct partitions behind inventory rows."""
    return files.select(
        *DATASET, paths.partition_path("s3_bucket_name", "key", spec.scheme).alias("partition_path"),
        F.col(spec.run), F.col(spec.date)).distinct()


def tagged_partitions(tags: DataFrame, spec: PartitionSpec = DEFAULT) -> DataFrame:
    """Distinct (dataset, run, date) the tracker vouches for; unreadable dates drop out."""
    return (tags.filter(F.lower("run_tag_key") == spec.date)
            .select("dataset_name", F.col("run_id").alias(spec.run),
                    paths.lenient_date("run_tag_value").alias(spec.date))
            .filter(F.col(spec.date).isNotNull()).distinct())


def blessed_partitions(partitions: DataFrame, tags: DataFrame, spec: PartitionSpec = DEFAULT,
                       by_dataset: bool = True, salt: int = SALT) -> DataFrame:
    """Partitions the tracker knows by run id and date (and by dataset name)."""
    known = tagged_partitions(tags, spec)
    if not by_dataset:
        keys = [spec.run, spec.date]
        return lookup(partitions, known.select(*keys).distinct(), keys, "left_semi", salt)
    named = partitions.withColumn("dataset_name", paths.dataset_name("bucket_prefix"))
    return lookup(named, known, ["dataset_name", spec.run, spec.date], "left_semi", salt)


def load_plan(inventory: DataFrame, tags: DataFrame, spec: PartitionSpec = DEFAULT) -> DataFrame:
    """Blessed partitions that still wait for loading."""
    return blessed_partitions(partition_rows(work_files(inventory, spec), spec), tags, spec)


def claimable(candidates: DataFrame, claims: DataFrame, low: int | None = None,
              high: int | None = None, bucket: str | None = None) -> DataFrame:
    """Decided, uncreated candidates no run has claimed.  The verdict only advises."""
    keys = ["execution_id", *DATASET]
    ready = candidates.filter(
        F.lower("candidate_for_managed_table_creation").isin("true", "false")
        & F.col("managed_table_created").isNull())
    if low is not None:
        ready = ready.filter(F.col("structured_file_count").between(low, high))
    if bucket is not None:
        ready = ready.filter(F.col("s3_bucket_name") == bucket)
    taken = claims.filter(F.col("migration_status") == schemas.CLAIMED).select(*keys).distinct()
    return lookup(ready.select(*keys, "table_name").distinct(), taken, keys, "left_anti")


def claim(candidates: DataFrame, claims: DataFrame, **limits) -> DataFrame:
    """Claim rows to append."""
    return claimable(candidates, claims, **limits).select(
        "*", F.lit(schemas.CLAIMED).alias("migration_status"),
        F.current_timestamp().alias("datetime"))


def latest_snapshot(partitions: DataFrame, by: list[str], spec: PartitionSpec = DEFAULT) -> DataFrame:
    """Newest partition per dataset; equal dates are decided by the larger run id."""
    newest = F.max(F.struct(spec.date, spec.run)).alias("latest")
    return (partitions.filter(F.col(spec.date).isNotNull()).groupBy(*by).agg(newest)
            .select(*by, F.col(f"latest.{spec.run}"), F.col(f"latest.{spec.date}")))


def latest_partitions(df: DataFrame, columns: list[str], n: int = 1,
                      by: list[str] | None = None) -> DataFrame:
    """The newest ``n`` distinct partitions, all columns descending.

    Per group the ranking runs over distinct partitions only, and Spark limits each
    map task to ``n`` rows per group before the shuffle.
    """
    order = [F.col(c).desc() for c in columns]
    if not by:
        return df.select(*columns).distinct().orderBy(*order).limit(n)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return (df.select(*by, *columns).distinct().withColumn("__rank", rank)
            .filter(F.col("__rank") <= n).drop("__rank"))


def restrict(df: DataFrame, partitions: DataFrame, columns: list[str],
             at_most: int | None = None) -> DataFrame:
    """Rows of the given partitions (null-safe).

    ``at_most`` is a bound on the number of partitions the caller can prove (a limit); a few
    are then named as literals, which prune the scan.  Others are a semi join.
    """
    if at_most is not None and at_most <= NAMED:
        return restrict_to_values(df, partitions.select(*columns).distinct().collect(), columns)
    keys = partitions.select(*[F.col(c).alias(f"__{c}") for c in columns])
    if at_most is not None and at_most <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    same = [df[c].eqNullSafe(keys[f"__{c}"]) for c in columns]
    condition = same[0]
    for one in same[1:]:
        condition = condition & one
    return df.join(keys, condition, "left_semi")


def restrict_to_values(df: DataFrame, rows: list, columns: list[str]) -> DataFrame:
    """As ``restrict`` for at most a handful of known partitions, by literals.

    Literals reach the scan, so other partitions are not listed or opened.
    """
    condition = F.lit(False)
    for row in rows:
        same = F.lit(True)
        for c in columns:
            same = same & F.col(c).eqNullSafe(F.lit(row[c]).cast(df.schema[c].dataType))
        condition = condition | same
    return df.filter(condition)


def newest_rows(df: DataFrame, by: list[str], time: str = "last_modified_time",
                salt: int = SALT) -> DataFrame:
    """Every row at the newest time of its group, ties included."""
    newest = cut_lineage(df.groupBy(*by).agg(F.max(time).alias(time)))
    return lookup(df, newest, [*by, time], "left_semi", salt, is_small(newest))


def failed_partitions(inventory: DataFrame, mapping: DataFrame, spec: PartitionSpec = DEFAULT,
                      bucket: str | None = None, datasets: list[str] | None = None,
                      salt: int = SALT) -> DataFrame:
    """Distinct failed partitions with the managed schema of their dataset.

    Optionally of one bucket, or of the named datasets as far as they are mapped.
    """
    if bucket is not None:
        inventory = inventory.filter(F.col("s3_bucket_name") == bucket)
    if datasets is not None:
        inventory = inventory.filter(paths.dataset_name("bucket_prefix").isin(*datasets))
        mapping = mapping.filter(F.col("dataset_name").isin(*datasets))
    failed = work_files(inventory, spec, F.col("load_status") == "failed")
    failed = failed.filter(F.col(spec.run).isNotNull() & F.col(spec.date).isNotNull())
    if spec.floor:
        failed = failed.filter(F.col(spec.date) >= F.lit(spec.floor).cast("date"))
    rows = failed.select(
        "execution_id", *DATASET, spec.run, spec.date,
        paths.dataset_name("bucket_prefix").alias("dataset_name"),
        paths.partition_path("s3_bucket_name", "key", spec.scheme).alias("partition_path")).distinct()
    target = mapping.select(*DATASET, "dataset_name",
                            F.col("dbx_managed_table_schema").alias("managed_schema")).distinct()
    how = "left" if datasets is None else "inner"
    return lookup(rows, target, [*DATASET, "dataset_name"], how, salt)


def table_targets(mapping: DataFrame, scheme: str = "s3://") -> DataFrame:
    """Managed table name and storage root per mapped dataset."""
    return mapping.select(
        *DATASET, "dataset_name",
        F.concat_ws(".", "dbx_catalog", "dbx_managed_table_schema", "dataset_name")
        .alias("managed_table_name"),
        F.concat(F.lit(scheme), "s3_bucket_name", F.lit("/"), "bucket_prefix").alias("root_path"))


def with_roots(files: DataFrame, roots: DataFrame, salt: int = SALT) -> DataFrame:
    """Inventory rows with the mounted path of their key; buckets without a root drop out."""
    joined = lookup(files, roots.select("s3_bucket_name", "volume_name"), ["s3_bucket_name"],
                    "inner", salt)
    return joined.withColumn("volume_path_key", F.concat_ws("/", "volume_name", "key"))


def reconciliation_work(mapping: DataFrame, candidates: DataFrame, bucket: str | None = None,
                        tables: list[str] | None = None, only_open: bool = False) -> DataFrame:
    """Mapped tables whose managed table exists; optionally a list, or not yet reconciled."""
    made = candidates.filter(F.lower("managed_table_created") == "true")
    if bucket is not None:
        made = made.filter(F.col("s3_bucket_name") == bucket)
    if tables is not None:
        made = made.filter(F.col("table_name").isin(*tables))
    if only_open:
        made = made.filter(F.col("recon_job_run").isNull())
    made = made.select("execution_id", F.col("table_name").alias("__name"), F.col("s3_bucket_name").alias("__bucket"),
                       F.col("bucket_prefix").alias("__prefix")).distinct()
    # A name may stand for sources in two buckets; what one side does not state decides nothing.
    same = ((F.col("dataset_name") == F.col("__name"))
            & F.coalesce(F.col("s3_bucket_name") == F.col("__bucket"), F.lit(True))
            & F.coalesce(F.col("bucket_prefix") == F.col("__prefix"), F.lit(True)))
    return mapping.join(made, same, "inner").select(
        "execution_id", F.col("dbx_catalog").alias("target_catalog_name"),
        F.col("dbx_managed_table_schema").alias("target_schema_name"),
        F.col("dataset_name").alias("target_table_name"),
        F.col("s3_bucket_name").alias("source_s3_bucket"),
        F.col("bucket_prefix").alias("source_bucket_prefix"))


def source_rows(data: DataFrame, tags: DataFrame, inventory: DataFrame, dataset: str,
                spec: PartitionSpec = DEFAULT, salt: int = SALT) -> DataFrame:
    """Source side of a check: rows of partitions both tracked and inventoried.

    A partition listed under two spellings of its date is one partition, so no data row
    is repeated.  When either list is empty the date floor alone applies.
    """
    keys = [spec.run, spec.date]
    rows = data.withColumn(spec.date, paths.lenient_date(spec.date))
    tracked = (tagged_partitions(tags, spec).filter(F.col("dataset_name") == dataset)
               .select(*keys).distinct())
    listed = (inventory.filter(F.col("load_status").isin("loaded", "failed")
                               & F.col("extension").isNotNull())
              .select(F.col(spec.run), paths.lenient_date(spec.date).alias(spec.date)).distinct())
    if spec.floor:
        floor = F.lit(spec.floor).cast("date")
        rows, tracked, listed = (x.filter(F.col(spec.date) >= floor)
                                 for x in (rows, tracked, listed))
    if tracked.isEmpty() or listed.isEmpty():
        return rows
    # The data is far larger than its list of partitions: measure the list, move no data.
    wanted = cut_lineage(tracked.join(listed, keys, "left_semi"))
    return lookup(rows, wanted, keys, "left_semi", salt, is_small(wanted))
