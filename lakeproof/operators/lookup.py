"""Joins of many rows to a side that has one row per key.

The many side may hold a third of its rows under one key.  Two ways keep it whole:

* the lookup side was measured and is small: it is broadcast, the many side is not moved;
* otherwise rows are spread over ``salt`` sub-keys and the one-row-per-key side is
  repeated once per sub-key, so no task ever receives a whole hot key.

Lookup sides hold a row per dataset, partition or folder and are small beside the rows.
Adaptive execution may split what is still uneven after that; nothing here depends on it.
A side that was not measured is never broadcast: Spark's estimate follows the size of compressed
files and knows neither derived columns nor the copies per sub-key, so it could fill the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = 32
BROADCAST_ROWS = 100_000  # lookup rows are a few short columns: some megabytes at most
_SALT = "__salt"


def is_small(table: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True when ``table`` has at most ``rows`` rows.  Meant for materialised tables."""
    return table.limit(rows + 1).count() <= rows


def lookup(rows: DataFrame, table: DataFrame, on: list[str], how: str = "inner",
           salt: int = SALT, small: bool = False) -> DataFrame:
    """Equi-join of ``rows`` with ``table`` on same-named columns.

    ``how`` is one of inner, left, left_semi, left_anti: the kinds in which only
    ``rows`` may be repeated-key, so repeating ``table`` changes no result.  ``small`` says
    that ``table`` was checked to be within the broadcast bound.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"lookup cannot run as {how}")
    if small:
        return rows.join(F.broadcast(table), on, how)
    if salt <= 1:
        return rows.join(table.hint("merge"), on, how)
    # The task's number is the same when the task runs again, reads no column, and differs
    # between the many tasks over which the rows of a hot key are spread.
    left = rows.withColumn(_SALT, F.pmod(F.spark_partition_id(), F.lit(salt)))
    every = F.explode(F.sequence(F.lit(0), F.lit(salt - 1)))
    return left.join(table.withColumn(_SALT, every).hint("merge"), [*on, _SALT], how).drop(_SALT)
