"""Distributed listing of folders, names starting with ``_`` or ``.`` included."""
from __future__ import annotations

import time
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.functions import paths
from lakeproof.session import cut_lineage
from lakeproof.sources import storage


ROWS = 10_000  # rows handed to Spark at a time
WAITS = (0.2, 1.0)  # seconds before a folder is tried again


def _children(folder: str) -> list:
    """Entries of a folder; none when it is gone.  Other faults are tried again."""
    for wait in WAITS:
        try:
            return storage.children(folder)
        except (FileNotFoundError, NotADirectoryError):
            return []
        except (OSError, ValueError):
            time.sleep(wait)
    return storage.children(folder)


def _lister(deep: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for root in batch.to_dict("records"):
                waiting = [root.pop("__folder").rstrip("/")]
                while waiting:
                    shown = waiting.pop()
                    try:
                        inner = storage.resolve(shown)[1]
                        found = _children(shown)
                    except (FileNotFoundError, NotADirectoryError):
                        found = []
                    except (OSError, ValueError) as fault:
                        yield pd.DataFrame([{**root, "path": shown, "is_dir": None, "size": None,
                                             "last_modified_time": None,
                                             "error": f"{type(fault).__name__}: {fault}"}])
                        continue
                    rows = [{**root, "path": shown + entry.path[len(inner):],
                             "is_dir": not entry.is_file,
                             "size": entry.size if entry.is_file else 0,
                             "last_modified_time": entry.mtime, "error": None} for entry in found]
                    for start in range(0, len(rows), ROWS):
                        yield pd.DataFrame(rows[start:start + ROWS])
                    if deep:
                        waiting += [r["path"] for r in rows if r["is_dir"]]
    return run


def _list(folders: DataFrame, deep: bool, tasks: int) -> DataFrame:
    keep = [f for f in folders.schema.fields if f.name != "__folder"]
    schema = T.StructType(keep).add("path", "string").add("is_dir", "boolean").add(
        "size", "long").add("last_modified_time", "timestamp").add("error", "string")
    return folders.repartition(tasks, "__folder").mapInPandas(_lister(deep), schema)


def list_files(roots: DataFrame, path: str = "path", split_levels: int = 2,
               tasks: int | None = None, folders: bool = False, errors: str = "fail") -> DataFrame:
    """One row per object below each root, with the other columns of ``roots``.

    The first ``split_levels`` levels are listed level by level, so that the folders of
    one huge root become work for many tasks; only then does a task walk a whole subtree,
    holding one folder's entries at a time.
    With ``folders`` empty and inner folders are rows too, their path ending in a slash.
    A folder that cannot be listed after some tries fails the listing; ``errors="report"``
    gives a row with its path and the fault in a column ``error`` instead.  A folder that
    does not exist has no objects.
    """
    if errors not in ("fail", "report"):
        raise ValueError(f"unknown treatment of errors: {errors}")
    tasks = tasks or int(roots.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    level = roots.withColumnRenamed(path, "__folder")
    found = []
    for _ in range(split_levels):
        # Listing is not repeatable while files arrive, so each level is fixed once.
        entries = cut_lineage(_list(level, False, tasks))
        found.append(entries if folders else entries.filter(~F.col("is_dir") | F.col("error").isNotNull()))
        level = entries.filter("is_dir").select(
            *[c for c in level.columns if c != "__folder"], F.col("path").alias("__folder"))
    rest = _list(level, True, tasks)
    found.append(rest if folders else rest.filter(~F.col("is_dir") | F.col("error").isNotNull()))
    out = reduce(DataFrame.unionByName, found)
    if errors == "fail":
        fault = F.raise_error(F.concat(F.lit("cannot list "), F.col("path"), F.lit(": "), F.col("error")))
        out = out.withColumn("path", F.when(F.col("error").isNotNull(), fault).otherwise(F.col("path"))).drop("error")
    if folders:
        return out.withColumn("path", F.when(F.col("is_dir"), F.concat("path", F.lit("/")))
                              .otherwise(F.col("path"))).drop("is_dir")
    name = paths.file_name("path")
    return out.drop("is_dir").withColumn("file_name", name).withColumn(
        "extension", paths.extension(name))


def dataset_roots(mapping: DataFrame, scheme: str = "s3://") -> DataFrame:
    """Roots to list: one per mapped (bucket, prefix)."""
    return mapping.select("s3_bucket_name", "bucket_prefix").distinct().withColumn(
        "path", F.concat(F.lit(scheme), "s3_bucket_name", F.lit("/"), "bucket_prefix"))


def roots_frame(spark: SparkSession, roots: list[str]) -> DataFrame:
    return spark.createDataFrame([(r,) for r in roots], "path string")
