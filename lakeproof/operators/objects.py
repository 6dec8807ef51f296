"""Comparing two object inventories: classes, verdict, actions, sync plan, outcome."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeproof import schemas
from lakeproof.functions import paths
from lakeproof.operators.lookup import SALT, is_small, lookup
from lakeproof.session import cut_lineage

KEY = ["s3_batch_copy_id", "rel_key"]
# Which folder is compared with which; a batch may map several.
PAIR = ["src_bucket_name", "src_prefix", "dest_bucket_name", "dest_prefix"]
ATTRIBUTES = ["modified", "size", "etag", "bucket", "prefix"]


def keys(objects: DataFrame) -> list[str]:
    """What names an object: batch, mapped pair of folders (where known) and relative key."""
    return [*KEY, *(["pair"] if "pair" in objects.columns else [])]


def pair_id() -> Column:
    """One text for a mapped pair of folders."""
    return F.to_json(F.array(*[F.coalesce(F.col(c), F.lit("")) for c in PAIR]))


def enabled_mappings(mapping: DataFrame, batch: str | None = None) -> DataFrame:
    rows = mapping.filter(F.col("enabled"))
    return rows if batch is None else rows.filter(F.col("s3_batch_copy_id") == batch)


def mapping_side(mapping: DataFrame, side: str) -> DataFrame:
    """Bucket, prefix and report location of one side (``src`` or ``dest``) of a mapping."""
    location = F.col(f"{side}_inventory_s3_location")
    bucket, name = F.col(f"{side}_bucket_name"), F.col(f"{side}_inventory_name")
    return mapping.select(
        "s3_batch_copy_id", pair_id().alias("pair"), bucket.alias("bucket_name"),
        F.col(f"{side}_prefix").alias("prefix"),
        name.alias("inventory_name"), location.alias("inventory_s3_location"),
        paths.manifest_root(location, bucket, name).alias("manifest_path"))


def side_objects(details: DataFrame, mapping: DataFrame, side: str, salt: int = SALT) -> DataFrame:
    """Objects of one side of each mapping, keyed relative to its prefix.

    Sizes and times of the report are text; they are compared as numbers and times.
    """
    where = cut_lineage(mapping_side(mapping, side).select(
        "s3_batch_copy_id", "pair", F.col("bucket_name").alias("Bucket"), "prefix",
        "inventory_s3_location").distinct())
    rows = lookup(details.filter(F.col("processed") == "false"), where,
                  ["Bucket", "prefix", "inventory_s3_location"], "inner", salt, is_small(where))
    return rows.select(
        "s3_batch_copy_id", "pair", F.col("Bucket").alias("bucket"), "prefix",
        paths.strip_root(F.col("Key"), F.col("prefix")).alias("rel_key"),
        F.col("Size").try_cast("bigint").alias("size"),
        F.col("LastModifiedDate").try_cast("timestamp").alias("modified"),
        F.col("ETag").alias("etag"))


def current_objects(objects: DataFrame) -> DataFrame:
    """One row per key: the newest report row, with the number of rows it stands for.

    Repeated rows of a key are combined before the shuffle, so no key can grow a task, and
    the comparison below joins one row to one row.
    """
    newest = F.max(F.struct(*ATTRIBUTES)).alias("o")
    key = keys(objects)
    return (objects.groupBy(*key).agg(newest, F.count(F.lit(1)).alias("copies"))
            .select(*key, *[F.col(f"o.{c}").alias(c) for c in ATTRIBUTES], "copies"))


def classify(source: DataFrame, target: DataFrame, compare: str = "time") -> DataFrame:
    """Every key of either side with its class.

    ``compare="time"`` gives the six classes by modification time and size (the checksum
    class comes from ``with_checksums``).  ``compare="etag"`` is the older rule: size and
    ETag, folder markers kept, objects of the destination alone not reported.
    """
    key = keys(source)

    def side(df: DataFrame, tag: str) -> DataFrame:
        return current_objects(df).select(
            *key, *[F.col(c).alias(f"{tag}_{c}") for c in [*ATTRIBUTES, "copies"]])

    pair = side(source, "src").join(side(target, "dest"), key, "full_outer")
    no_src, no_dest = F.col("src_copies").isNull(), F.col("dest_copies").isNull()
    same_size = F.col("src_size") == F.col("dest_size")
    if compare == "etag":
        same = same_size & (F.col("src_etag") == F.col("dest_etag"))
        status = (F.when(no_dest, F.lit(schemas.ONLY_SRC)).when(same, F.lit(schemas.SAME))
                  .when(~same, F.lit(schemas.NOT_SAME)).otherwise(F.lit(schemas.UNKNOWN)))
        return pair.filter(~no_src).withColumn("status", status)
    newer = F.col("src_modified") > F.col("dest_modified")
    not_older = F.col("dest_modified") >= F.col("src_modified")
    status = (F.when(no_dest, F.lit(schemas.ONLY_SRC)).when(no_src, F.lit(schemas.ONLY_DEST))
              .when(newer, F.lit(schemas.SRC_NEWER))
              .when(not_older & ~same_size, F.lit(schemas.DEST_NEWER_OTHER_SIZE))
              .when(not_older & same_size, F.lit(schemas.SAME))
              .otherwise(F.lit(schemas.UNKNOWN)))
    one_sided_marker = (no_src | no_dest) & paths.is_folder_marker("rel_key")
    return pair.filter(~one_sided_marker).withColumn("status", status)


def with_checksums(classified: DataFrame, mismatched: DataFrame, small: bool = False) -> DataFrame:
    """Turns SAME into the checksum class for keys whose content was found to differ.

    ``small``: the list of such keys was checked to fit a broadcast.
    """
    return _restated(classified, mismatched, schemas.OTHER_CHECKSUM, small)


def with_unread(classified: DataFrame, unread: DataFrame, small: bool = False) -> DataFrame:
    """Turns SAME into UNKNOWN for keys whose content was to be compared and could not be read."""
    return _restated(classified, unread, schemas.UNKNOWN, small)


def _restated(classified: DataFrame, listed: DataFrame, status: str, small: bool) -> DataFrame:
    key = keys(classified)
    bad = listed.select(*key).distinct().withColumn("__bad", F.lit(True))
    joined = lookup(classified, bad, key, "left", 1, small)
    wrong = F.col("__bad") & (F.col("status") == schemas.SAME)
    return joined.withColumn("status", F.when(wrong, F.lit(status)).otherwise(F.col("status"))).drop("__bad")


def differences(classified: DataFrame) -> DataFrame:
    """Rows of the difference table: everything but SAME, with the action to take."""
    return with_action(classified.filter(F.col("status") != schemas.SAME))


def with_action(classified: DataFrame) -> DataFrame:
    action = F.when(F.col("status") == schemas.ONLY_SRC, F.lit("Copy")).otherwise(F.lit("Review"))
    return classified.withColumn("sync_to_dest_bucket_status", action)


def diff_rows(found: DataFrame, mapping: DataFrame, run: str, salt: int = SALT) -> DataFrame:
    """Differences in the layout of the stored table.

    Buckets and prefixes of both sides come from the mapping the row belongs to, so rows
    that exist on one side only keep theirs.
    """
    sides = cut_lineage(mapping.select("s3_batch_copy_id", pair_id().alias("pair"), *[
        F.col(c).alias(f"map_{c}") for c in PAIR]).distinct())
    known = "pair" in found.columns
    on = ["s3_batch_copy_id", *(["pair"] if known else [])]
    rows = lookup(found, sides if known else sides.drop("pair"), on, "inner", salt, is_small(sides))
    # Without a pair the side that has the object names its mapping.
    mine = F.lit(True) if known else (
            F.coalesce(F.col("src_bucket") == F.col("map_src_bucket_name"), F.lit(True))
            & F.coalesce(F.col("src_prefix") == F.col("map_src_prefix"), F.lit(True))
            & F.coalesce(F.col("dest_bucket") == F.col("map_dest_bucket_name"), F.lit(True))
            & F.coalesce(F.col("dest_prefix") == F.col("map_dest_prefix"), F.lit(True)))
    return rows.filter(mine).select(
        "s3_batch_copy_id", F.lit(run).alias("runId"), F.col("rel_key").alias("Key"),
        F.coalesce("src_size", "dest_size").alias("Size"),
        F.coalesce("src_etag", "dest_etag").alias("ETag"),
        F.coalesce("src_modified", "dest_modified").alias("lastModifiedDate"),
        F.col("map_src_bucket_name").alias("src_bucket"), F.col("map_src_prefix").alias("src_prefix"),
        F.col("map_dest_bucket_name").alias("dest_bucket_name"),
        F.col("map_dest_prefix").alias("dest_prefix"), "status",
        F.current_timestamp().alias("time_stamp"), "sync_to_dest_bucket_status")


def verdict(classified: DataFrame, by: list[str] | None = None, compare: str = "time") -> DataFrame:
    """FAILED on a checksum difference, WARNING on any other, else SUCCESS, per batch.

    Under the older ETag rule every difference is FAILED.  Pass all classified rows, SAME
    included, so that a batch without differences is reported too.
    """
    by = by or ["s3_batch_copy_id"]
    bad = F.count_if(F.col("status") == schemas.OTHER_CHECKSUM).alias("checksum_differences")
    other = F.count_if(F.col("status") != schemas.SAME).alias("differences")
    counts = classified.groupBy(*by).agg(bad, other)
    failed = F.col("checksum_differences") > 0
    if compare == "etag":
        failed = F.col("differences") > 0
    status = (F.when(failed, F.lit("FAILED")).when(F.col("differences") > 0, F.lit("WARNING"))
              .otherwise(F.lit("SUCCESS")))
    return counts.withColumn("status", status)


def status_summary(diffs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Differences per status as one sorted JSON list per batch."""
    by = by or ["s3_batch_copy_id"]
    counts = diffs.groupBy(*by, "status").agg(F.count(F.lit(1)).alias("count"))
    entries = F.array_sort(F.collect_list(F.to_json(F.struct("status", "count"))))
    return counts.groupBy(*by).agg(
        F.concat(F.lit("["), F.array_join(entries, ", "), F.lit("]")).alias("recon_status"))


def diff_report(mapping: DataFrame, diffs: DataFrame) -> DataFrame:
    """Differences of the current run of each enabled mapping, counted by status."""
    keys = ["s3_batch_copy_id", "runId"]
    counts = diffs.groupBy(*keys, F.col("status").alias("recon_status"), "time_stamp").agg(
        F.count(F.lit(1)).alias("objects"))
    runs = enabled_mappings(mapping).select(
        *keys, "src_bucket_name", "dest_bucket_name", "last_recon_timestamp", "status")
    return counts.join(runs, keys, "inner")


def current_differences(mapping: DataFrame, diffs: DataFrame, batch: str | None = None,
                        status: str | None = None, salt: int = SALT) -> DataFrame:
    """Stored differences of the current run of enabled mappings, one status if given."""
    rows = diffs if status is None else diffs.filter(F.col("status") == status)
    runs = cut_lineage(enabled_mappings(mapping, batch).select("s3_batch_copy_id", "runId").distinct())
    return lookup(rows, runs, ["s3_batch_copy_id", "runId"], "left_semi", salt, is_small(runs))


def sync_plan(missing: DataFrame, scheme: str = "s3://") -> DataFrame:
    """Source path, destination path and kind of each object still to be copied."""
    key = F.col("Key")
    return missing.filter(F.col("status") == schemas.ONLY_SRC).select(
        paths.object_url("src_bucket", "src_prefix", key, scheme).alias("src_key"),
        paths.object_url("dest_bucket_name", "dest_prefix", key, scheme).alias("dest_key"),
        paths.node_type(key).alias("type"))


def copy_summary(outcomes: DataFrame, by: list[str] | None = None,
                 status: str = "status", seconds: str = "duration") -> DataFrame:
    """Copied, failed and skipped items, time, average and rate from outcome rows."""
    def n(value: str) -> Column:
        return F.count_if(F.col(status) == value)
    counts = outcomes.groupBy(*(by or [])).agg(
        n("SUCCESS").alias("copied"), n("FAILED").alias("failed"), n("SKIPPED").alias("skipped"),
        F.sum(seconds).cast("double").alias("total_seconds"))
    copied, total = F.col("copied"), F.col("total_seconds")
    return (counts.withColumn("avg_seconds", F.round(F.try_divide(total, copied), 1))
            .withColumn("copied_per_minute", F.round(F.try_divide(copied * 60.0, total), 1)))
