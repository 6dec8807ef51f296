"""Content checksums of files."""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.functions import paths
from lakeproof.operators.objects import keys
from lakeproof.sources import storage


def _digests(columns: dict[str, str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source, target in columns.items():
                batch[target] = [_md5_or_none(p) for p in batch[source]]
            yield batch
    return run


def _md5_or_none(path: str) -> str | None:
    try:
        return storage.md5_of(path)
    except OSError:
        return None


def file_checksums(files: DataFrame, columns: dict[str, str], tasks: int | None = None) -> DataFrame:
    """Adds an MD5 column per path column; null where a file cannot be read.

    Files are read in chunks, so their size does not matter to a task's memory.  Large
    and small files are dealt out at random over many tasks.
    """
    tasks = tasks or int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType(list(files.schema.fields))
    for target in columns.values():
        schema = schema.add(target, "string")
    spread = files.repartition(tasks, *list(columns))
    return spread.mapInPandas(_digests(columns), schema)


def compare_contents(sample: DataFrame, scheme: str = "s3://", decode: bool = True,
                     tasks: int | None = None) -> DataFrame:
    """Source and destination MD5 of sampled objects (rows of ``classify``).

    Keys in reports are percent-encoded; ``decode`` turns them into object names.
    """
    def url(side: str):
        raw = paths.object_url(f"{side}_bucket", f"{side}_prefix", "rel_key", scheme)
        return paths.percent_decode(raw) if decode else raw
    located = sample.select(*keys(sample), url("src").alias("src_path"), url("dest").alias("dest_path"))
    hashed = file_checksums(located, {"src_path": "src_md5", "dest_path": "dest_md5"}, tasks)
    return hashed.withColumn("checksum_valid", F.col("src_md5") == F.col("dest_md5"))


def mismatched(contents: DataFrame) -> DataFrame:
    """Keys whose content differs; files that could not be read are ``unread``."""
    return contents.filter(~F.col("checksum_valid")).select(*keys(contents))


def unread(contents: DataFrame) -> DataFrame:
    """Keys of which one side or both could not be read: nothing is known of their content."""
    return contents.filter(F.col("checksum_valid").isNull()).select(*keys(contents))
