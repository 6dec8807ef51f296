"""Helpers of the text operators: column choice, Arrow loops, shared tables."""
from __future__ import annotations

import functools
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lakeproof.session import fresh_folder

# Rows of one output batch; bounds what a task holds when texts are long.
SLICE = 256
# Words in each generation of a memo in one Python worker.
MEMO = 250_000
# Rows of one key that stay together in a join, and how many keys may have more.
TOGETHER, HUBS = 512, 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; all others are left out."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.col(f"`{text_col}`").cast("string").alias("text"))


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """``df`` written below the shared folder and read again: cut lineage, fixed rows."""
    path = fresh_folder(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_join(rows: DataFrame, side: DataFrame, key: str, counts: DataFrame, total: int,
                how: str = "inner") -> DataFrame:
    """``rows`` joined with the one row that ``side`` has for their ``key``, keys of many rows split.

    ``counts`` (``key, n``) counts the rows of each key, ``total`` all of them. A key with more than
    ``TOGETHER`` rows, or with its share of ``total`` by ``HUBS`` if that is more, is dealt over
    copies of its row in ``side``. There are ``HUBS`` such keys at most, so they are broadcast.
    Rows without a key are dealt alike.
    """
    most = max(TOGETHER, total // HUBS)
    hubs = F.broadcast(counts.where(F.col("n") > most).select(
        key, F.ceil(F.col("n") / most).cast("int").alias("_copies")))
    copies = F.when(F.col(key).isNull(), F.lit(HUBS)).otherwise(F.coalesce("_copies", F.lit(1)))
    dealt = (rows.join(hubs, key, "left")
             .withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), copies).cast("int")).drop("_copies"))
    copied = (side.join(hubs, key, "left")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)))
              .drop("_copies"))
    return dealt.join(copied, [key, "_salt"], how).drop("_salt")


def by_rows(df: DataFrame, schema: str | StructType,
            start: Callable[[], Callable[..., tuple]]) -> DataFrame:
    """One output row for each input row.

    ``start`` runs once in each task and gives the function of one row (its values in
    column order). Output leaves in small batches, so memory follows the longest rows.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = start()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                rows = zip(*(c.to_pylist() for c in part.columns), strict=True)
                yield to_batch([one(*row) for row in rows], arrow)
            release_unused()
    return df.mapInArrow(run, schema)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


class Memo(dict):
    """A bounded cache of a pure function of one text; long ones are not kept.

    Two generations: when the young one is full it becomes the old one, and what is asked for
    again moves up, so frequent texts stay.
    """

    def __init__(self, fn: Callable, limit: int = MEMO, longest: int = 64):
        super().__init__()
        self.fn, self.limit, self.longest, self.old = fn, limit, longest, {}

    def __missing__(self, key):
        if len(key) > self.longest:
            return self.fn(key)
        value = self.old[key] if key in self.old else self.fn(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def release_unused() -> None:
    """Gives freed Arrow buffers back, which a Python worker else holds as long as it lives."""
    pa.default_memory_pool().release_unused()


_kept: dict = {}


def drop_kept() -> None:
    """Frees what ``worker_cache`` keeps in this Python worker."""
    _kept.clear()
    gc.collect()
    release_unused()


def worker_cache(fn: Callable) -> Callable:
    """Keeps the result of ``fn`` between the tasks of a Python worker.

    Only the latest one: workers outlive a stage, and what the stages of a pipeline remember
    would add up.
    """
    @functools.wraps(fn)
    def kept(*args):
        if _kept.get("of") != (fn.__qualname__, args):
            drop_kept()
            _kept.update({"of": (fn.__qualname__, args), "value": fn(*args)})
        return _kept["value"]
    return kept


@functools.cache
def file_bytes(path: str) -> bytes:
    """A vocabulary file, read once by the driver and sent to the tasks (a few MB)."""
    with open(path, "rb") as f:
        return f.read()
