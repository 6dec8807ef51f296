"""The ledger of partition pairs: which files make a pair, and which of them a load took.

A pair (run id, date) of a dataset may have several folders, spelt differently, and files may
arrive late in any of them. A load replaces what the table has of a pair, so it must take all
files known of the pair, of every folder and whatever their status. The ledger keeps the files
each load took; the newest load of a pair is what the table holds of it.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeproof.functions import paths
from lakeproof.operators import partitions as parts
from lakeproof.operators.inventory import DATASET
from lakeproof.operators.lookup import lookup
from lakeproof.spec import DEFAULT, PartitionSpec


def pair_keys(spec: PartitionSpec = DEFAULT) -> list[str]:
    return [*DATASET, spec.run, spec.date]


def known_files(inventory: DataFrame, spec: PartitionSpec = DEFAULT, waiting: bool = False) -> DataFrame:
    """A row per data file in the expected layout; of a file listed again, the newest listing.

    Files that no reader takes as data (names with a leading ``_`` or ``.``) are none.
    """
    status = F.col("load_status").isNull() if waiting else F.lit(True)
    rows = parts.work_files(inventory, spec, status).filter(~paths.file_name("key").rlike("^[_.]"))
    newest = F.max(F.struct("last_modified_time", "size")).alias("last")
    folded = rows.groupBy(*pair_keys(spec), "key").agg(newest, F.bool_or(F.col("load_status") == "loaded").alias("loaded"))
    return folded.select(
        *pair_keys(spec), paths.partition_path("s3_bucket_name", "key", spec.scheme).alias("partition_path"),
        F.concat(F.lit(spec.scheme), "s3_bucket_name", F.lit("/"), "key").alias("data_file"),
        F.col("last.size").alias("size"), F.col("last.last_modified_time").alias("last_modified_time"),
        F.coalesce("loaded", F.lit(False)).alias("loaded"))


def pair_files(inventory: DataFrame, pairs: DataFrame, spec: PartitionSpec = DEFAULT,
               waiting: bool = False) -> DataFrame:
    """Files of the given pairs, from all their folders; with ``waiting`` only unloaded ones."""
    keys = pair_keys(spec)
    return lookup(known_files(inventory, spec, waiting), pairs.select(*keys).distinct(), keys, "left_semi").drop("loaded")


def taken(files: DataFrame, pairs: DataFrame, load_id: str, step: str,
          spec: PartitionSpec = DEFAULT) -> DataFrame:
    """Ledger rows for the pairs that one step wrote, from the files it read."""
    keys = pair_keys(spec)
    mine = lookup(files, pairs.select(*keys).distinct(), keys, "left_semi")
    return mine.select(*keys, "partition_path", "data_file", "size", "last_modified_time",
                       F.lit(load_id).alias("load_id"), F.lit(step).alias("step"),
                       F.current_timestamp().alias("loaded_at"))


def held_files(ledger: DataFrame, spec: PartitionSpec = DEFAULT) -> DataFrame:
    """Files the table holds: those of each pair's newest load."""
    keys = pair_keys(spec)
    load = F.struct("loaded_at", "load_id", "step")
    newest = ledger.groupBy(*keys).agg(F.max(load).alias("load")).select(*keys, "load.*")
    return lookup(ledger, newest, [*keys, "loaded_at", "load_id", "step"], "left_semi")


def stale_pairs(inventory: DataFrame, ledger: DataFrame, spec: PartitionSpec = DEFAULT) -> DataFrame:
    """Pairs of which files count as loaded that their newest load did not take.

    Only pairs the ledger knows; they need loading again although no file of them waits.
    """
    keys = pair_keys(spec)
    held = held_files(ledger, spec)
    files = lookup(known_files(inventory, spec).filter("loaded"), held.select(*keys).distinct(), keys, "left_semi")
    # A file is one row on either side.
    return files.join(held.select(*keys, "data_file"), [*keys, "data_file"], "left_anti").select(
        *keys, "partition_path").distinct()


def ledger_report(inventory: DataFrame, ledger: DataFrame, spec: PartitionSpec = DEFAULT) -> DataFrame:
    """Per pair: folders and files known, files held, and those known but not held."""
    keys = pair_keys(spec)
    held = held_files(ledger, spec).select(*keys, "data_file", F.lit(1).alias("held"))
    both = known_files(inventory, spec).join(held, [*keys, "data_file"], "left")
    return both.groupBy(*keys).agg(
        F.count_distinct("partition_path").alias("folders"), F.count(F.lit(1)).alias("files"),
        F.count("held").alias("files_held"), F.count_if(F.col("held").isNull()).alias("files_missing"))
