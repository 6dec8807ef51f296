"""Keyed changes of state tables as pure functions of snapshots.

Each takes the present table (and a source) and returns the whole new table.  An
update is refused, while the plan runs, when several source rows match one target
row.  Source rows are first folded to one per key, so a key repeated many times
is combined before the shuffle and never multiplied in the join.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeproof.operators.lookup import SALT, lookup


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def insert_absent(target: DataFrame, source: DataFrame, keys: list[str],
                  salt: int = SALT) -> DataFrame:
    """``target`` plus the source rows whose keys it does not have."""
    return target.unionByName(absent_rows(target, source, keys, salt), allowMissingColumns=True)


def absent_rows(target: DataFrame, source: DataFrame, keys: list[str],
                salt: int = SALT) -> DataFrame:
    return lookup(source, target.select(*keys).distinct(), keys, "left_anti", salt)


def update_matched(target: DataFrame, source: DataFrame, keys: list[str],
                   sets: Mapping[str, Column | str], guard: Column | None = None,
                   salt: int = SALT, small: bool = False) -> DataFrame:
    """Updates target rows that have a source row with the same keys.

    ``sets`` maps a target column to an expression.  Expressions and ``guard`` see the
    target columns as ``t.name`` and the source columns as ``s.name``; a plain string
    is short for ``s.<string>``.  ``small``: the source was checked to fit a broadcast.
    """
    columns = target.columns
    values = [c for c in source.columns if c not in keys]
    folded = source.groupBy(*keys).agg(
        F.first(F.struct(*(values or [F.lit(True).alias("present")]))).alias("s"),
        F.count(F.lit(1)).alias("__n"))
    joined = lookup(target, folded, keys, "left", salt, small)
    # The target columns keep their names; alias them as ``t`` for the expressions.
    joined = joined.alias("t")
    hit = F.col("__n").isNotNull()
    if guard is not None:
        hit = hit & F.coalesce(guard, F.lit(False))

    def changed(name: str, value: Column | str) -> Column:
        kind = target.schema[name].dataType
        new = F.col(f"s.{value}") if isinstance(value, str) else value
        refuse = F.raise_error(F.lit(f"several source rows match one row on {keys}"))
        return (F.when(hit & (F.col("__n") > 1), refuse.cast(kind))
                .when(hit, new.cast(kind)).otherwise(F.col(f"t.`{name}`")).alias(name))

    return joined.select(*[changed(c, sets[c]) if c in sets else F.col(f"t.`{c}`").alias(c)
                           for c in columns])


def upsert(target: DataFrame, source: DataFrame, keys: list[str],
           sets: Mapping[str, Column | str], guard: Column | None = None,
           present: Column | None = None, new_rows: DataFrame | None = None,
           salt: int = SALT) -> DataFrame:
    """Updates where ``present`` target rows match, inserts the other source rows."""
    known = target if present is None else target.filter(present)
    updated = update_matched(target, source, keys, sets, guard, salt)
    rows = absent_rows(known, new_rows if new_rows is not None else source, keys, salt)
    return updated.unionByName(rows, allowMissingColumns=True).select(*target.columns)


def supersede(target: DataFrame, source: DataFrame, keys: list[str], run: str,
              flag: str = "processed", run_column: str = "runId",
              salt: int = SALT) -> DataFrame:
    """Retires unprocessed target rows that ``source`` replaces, then adds ``source``.

    After the first step no unprocessed row matches, so every source row is new.
    """
    waiting = F.col(f"t.{flag}") == "false"
    retired = update_matched(
        target, source.select(*keys).distinct(), keys,
        {flag: F.lit("ignored"),
         run_column: F.concat(F.col(f"t.{run_column}"), F.lit(":"), F.lit(run))},
        waiting, salt)
    fresh = source.withColumn(flag, F.lit("false")).withColumn(run_column, F.lit(run))
    return retired.unionByName(fresh, allowMissingColumns=True)


def update_where(target: DataFrame, predicate: Column, sets: Mapping[str, object]) -> DataFrame:
    """Sets columns to values where the predicate holds; all see the old row."""
    hit = F.coalesce(predicate, F.lit(False))
    return target.select(*[
        F.when(hit, _column(sets[c]).cast(target.schema[c].dataType)).otherwise(F.col(f"`{c}`"))
        .alias(c) if c in sets else F.col(f"`{c}`") for c in target.columns])


def delete_where(target: DataFrame, predicate: Column) -> DataFrame:
    """Drops rows where the predicate holds; an unknown predicate keeps the row."""
    return target.filter(~F.coalesce(predicate, F.lit(False)))


def mark_done(target: DataFrame, done: DataFrame, keys: list[str], run: str,
              flag: str = "processed", run_column: str = "runId") -> DataFrame:
    """Sets waiting work items with a row in ``done`` to processed."""
    return update_matched(target, done.select(*keys).distinct(), keys,
                          {flag: F.lit("true"), run_column: F.lit(run)},
                          F.col(f"t.{flag}") == "false")
