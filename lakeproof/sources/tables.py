"""Readers and writers of tables and partition folders."""
from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce
from itertools import groupby
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof import schemas
from lakeproof.functions.paths import partition_date, partition_value
from lakeproof.operators.lookup import is_small, lookup
from lakeproof.session import cut_lineage
from lakeproof.spec import DEFAULT, PartitionSpec

FEW = 64  # datasets named as literals in one filter
BATCH = 5000  # partition paths named in one read
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Mapping CSV with header, stamped with the time of reading."""
    return (spark.read.schema(schemas.MAPPING).option("header", True).csv(path)
            .withColumn("datetime", F.current_timestamp()))


def read_partitions(spark: SparkSession, root: str, paths: list[str] | None = None,
                    schema: T.StructType | None = None, lenient: bool = False) -> DataFrame:
    """Partition folders below ``root`` in one read, partition columns from the path.

    Without ``schema`` it is inferred; without ``paths`` the whole root is read, while an
    empty list of paths is no rows.  Strict reads fail on an unreadable file, lenient ones
    skip it; the choice binds this read only.
    """
    if paths is not None and not paths:
        if schema is None:
            raise ValueError("no paths to infer a schema from")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", root).option("ignoreCorruptFiles", lenient)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*([root] if paths is None else paths))


def read_folders(spark: SparkSession, root: str, folders: DataFrame, schema: T.StructType,
                 lenient: bool = False, extra: Sequence[Column] = ()) -> DataFrame:
    """Rows of the folders named by ``partition_path``, whatever their number.

    ``extra`` adds columns that only the reader knows, such as those of ``_metadata``.

    Folders are named to the reader in bounded batches, one layout of partition columns in
    each, so that nothing else below the root is listed, opened or mistaken for a partition.
    """
    ordered = folders.select("partition_path").distinct().orderBy("partition_path")
    reads = [read_partitions(spark, root, list(same), schema, lenient)
             for batch in batches(r.partition_path for r in ordered.toLocalIterator())
             for _, same in groupby(sorted(batch, key=layout), key=layout)]
    names = [F.col(f"`{f.name}`") for f in schema.fields]
    if not reads:   # a read of nothing still knows its columns
        reads = [read_partitions(spark, root, None, schema, lenient).filter(F.lit(False))] if extra else []
    if not reads:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, [r.select(*names, *extra) for r in reads])


def layout(path: str) -> tuple[str, ...]:
    """The names of the partition columns in a path, as it spells them."""
    return tuple(s.split("=")[0] for s in path.split("/") if "=" in s)


def read_as_stored(spark: SparkSession, folders: list[str], schema: T.StructType,
                   spec: PartitionSpec = DEFAULT) -> DataFrame:
    """Partition folders whose files may hold the partition columns themselves.

    Columns in the data win; what the data lacks is taken from the path.
    """
    data = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*folders)
    have, path = {c.lower() for c in data.columns}, F.col("_metadata.file_path")
    if spec.run.lower() not in have:
        data = data.withColumn(spec.run, partition_value(path, spec.run))
    if spec.date.lower() not in have:
        data = data.withColumn(spec.date, partition_date(path, spec.date))
    return data


def batches(rows: Iterable, size: int = BATCH, *, weight: Callable[[Any], int] = lambda row: 1) -> Iterator[list]:
    """Rows in lists of bounded weight (at least one row), for readers that want paths by name."""
    chunk, held = [], 0
    for row in rows:
        more = weight(row)
        if chunk and held + more > size:
            yield chunk
            chunk, held = [], 0
        chunk.append(row)
        held += more
    if chunk:
        yield chunk


def create_table(spark: SparkSession, table: str, schema: T.StructType,
                 spec: PartitionSpec = DEFAULT, location: str | None = None) -> None:
    """Creates a managed Parquet table partitioned by the pair, unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
              f"PARTITIONED BY (`{spec.run}`, `{spec.date}`){place}")


def partition_columns_of(spark: SparkSession, table: str, default: list[str] | None = None) -> list[str]:
    """Partition columns of a catalog table in name order; the default when it has none."""
    found = sorted(c.name for c in spark.catalog.listColumns(table) if c.isPartition)
    return found or list(default or [])


def merged_schema(have: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of both; a column both know must have one type."""
    known = {f.name.lower(): f for f in have.fields}
    out = T.StructType(list(have.fields))
    for field in new.fields:
        old = known.get(field.name.lower())
        if old is None:
            out = out.add(T.StructField(field.name, field.dataType, True))
        elif old.dataType.simpleString() != field.dataType.simpleString():  # nulls aside
            raise ValueError(f"{field.name}: table has {old.dataType.simpleString()}, "
                             f"data has {field.dataType.simpleString()}")
    return out


def fits(have: T.StructType, new: T.StructType) -> bool:
    """True when rows of the new schema can be appended to a table of the old one."""
    try:
        merged_schema(have, new)
    except ValueError:
        return False
    return True


def append_evolving(df: DataFrame, table: str, spec: PartitionSpec = DEFAULT,
                    replace_partitions: bool = False) -> None:
    """Appends rows; columns the table lacks are added to it, ones the data lacks are null.

    ``replace_partitions`` overwrites exactly the partitions present in ``df``: a load that
    is repeated after a crash then leaves no doubled rows.
    """
    spark = df.sparkSession
    have = spark.table(table).schema
    merged = merged_schema(have, df.schema)
    known = {f.name.lower() for f in have.fields}
    added = [f for f in merged.fields if f.name.lower() not in known]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    target = spark.table(table).schema
    present = {c.lower(): c for c in df.columns}
    rows = df.select(*[
        (F.col(f"`{present[f.name.lower()]}`") if f.name.lower() in present
         else F.lit(None).cast(f.dataType)).alias(f.name) for f in target.fields])
    # Rebalancing splits hot partitions over several tasks and files and merges tiny ones.
    rows = rows.hint("rebalance", spec.run, spec.date)
    if not replace_partitions:
        rows.write.mode("append").insertInto(table)
        return
    _overwrite_partitions(rows, table)


def _overwrite_partitions(rows: DataFrame, table: str) -> None:
    """Overwrites just the partitions that the rows belong to."""
    # Inserting into a catalog table heeds the session's setting, not the writer's option.
    spark = rows.sparkSession
    before = spark.conf.get(OVERWRITE)
    spark.conf.set(OVERWRITE, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(OVERWRITE, before)


# State that has rows of many datasets is kept in a folder for each. The column is derived, of
# fixed length and never empty, whatever bucket and prefix are.
DATASET_KEY = "dataset_key"


def with_dataset_key(df: DataFrame) -> DataFrame:
    """``df`` with the key of its bucket and prefix, last."""
    text = F.concat(F.coalesce("s3_bucket_name", F.lit("")), F.lit("/"), F.coalesce("bucket_prefix", F.lit("")))
    return df.drop(DATASET_KEY).withColumn(DATASET_KEY, F.sha2(text, 256))


def of_datasets(df: DataFrame, datasets: DataFrame) -> DataFrame:
    """Rows of the given datasets; of a table kept by dataset, only their folders are read."""
    names = ["s3_bucket_name", "bucket_prefix"]
    if DATASET_KEY not in df.columns:
        return lookup(df, datasets.select(*names).distinct(), names, "left_semi")
    keys = cut_lineage(with_dataset_key(datasets).select(DATASET_KEY).distinct())
    if keys.count() <= FEW:
        return df.filter(F.col(DATASET_KEY).isin([r[0] for r in keys.collect()]))
    return lookup(df, keys, [DATASET_KEY], "left_semi", small=is_small(keys))


def _by_dataset(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table) and DATASET_KEY in partition_columns_of(spark, table)


def append_rows(df: DataFrame, table: str) -> None:
    """Appends audit or result rows, creating the table at first use."""
    if _by_dataset(df.sparkSession, table):
        with_dataset_key(df).write.mode("append").partitionBy(DATASET_KEY).saveAsTable(table)
    else:
        df.write.mode("append").saveAsTable(table)


def replace_touched(df: DataFrame, table: str) -> None:
    """Puts the rows of ``df`` in place of what a table kept by dataset has of their datasets.

    ``df`` must hold all rows of each dataset in it and may be computed from the table itself.
    Other datasets' files are not read, written or renamed, and the table never goes away.
    """
    columns = [F.col(f"`{c}`") for c in df.sparkSession.table(table).columns]
    rows = with_dataset_key(df).select(*columns).hint("rebalance", DATASET_KEY)
    _overwrite_partitions(rows, table)


def empty_like(df: DataFrame, table: str) -> None:
    """An empty table with the schema of a frame."""
    df.limit(0).write.mode("overwrite").saveAsTable(table)


def write_partitioned(df: DataFrame, path: str, columns: list[str]) -> None:
    """Hive-style folders; Spark splits hot partitions and merges tiny tasks."""
    df.hint("rebalance", *columns).write.mode("errorifexists").partitionBy(*columns).parquet(path)


def ensure_table(spark: SparkSession, table: str, schema: T.StructType, by_dataset: bool = False) -> None:
    """Creates an empty table unless it exists, or finishes a replacement cut off half-way.

    ``by_dataset`` keeps the rows of each dataset (bucket and prefix) in a folder of its own.
    """
    if spark.catalog.tableExists(table):
        return
    if spark.catalog.tableExists(_following(table)):
        spark.sql(f"ALTER TABLE {_following(table)} RENAME TO {table}")
    elif by_dataset:
        with_dataset_key(spark.createDataFrame([], schema)).write.partitionBy(DATASET_KEY).saveAsTable(table)
    else:
        spark.createDataFrame([], schema).write.saveAsTable(table)


def _following(table: str) -> str:
    return f"{table}__next"


def replace_table(df: DataFrame, table: str) -> None:
    """Puts a new state in place of a table that ``df`` may itself be computed from.

    The new state is complete on storage before the old one goes; ``ensure_table`` takes up
    a replacement that was cut off in between.
    """
    spark = df.sparkSession
    if _by_dataset(spark, table):
        _replace_all_datasets(df, table)
        return
    following = _following(table)
    spark.sql(f"DROP TABLE IF EXISTS {following}")
    df.write.saveAsTable(following)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {following} RENAME TO {table}")


def _replace_all_datasets(df: DataFrame, table: str) -> None:
    """``replace_table`` where rows are kept by dataset: folder by folder, the table stays."""
    spark = df.sparkSession
    rows = cut_lineage(with_dataset_key(df))
    gone = spark.table(table).select(DATASET_KEY).distinct().join(
        rows.select(DATASET_KEY).distinct(), [DATASET_KEY], "left_anti").collect()
    replace_touched(rows, table)
    for row in gone:    # datasets without rows: at most as many as there are datasets
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({DATASET_KEY} = '{row[0]}')")
