"""Column profiles: picking columns, min / max / abs_sum, comparison."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeproof.functions.numeric import TOLERANCE_PCT, difference_pct, within_tolerance
from lakeproof.functions.types import lower_names

# Type groups in the order columns are taken.
GROUPS = ("int", "decimal", "string", "date")
PER_GROUP = 2
NUMERIC = ("int", "decimal")


def type_group(data_type: Column) -> Column:
    """Group of a Spark type name, null for a type that is not profiled."""
    return (F.when(data_type.isin("int", "bigint"), F.lit("int"))
            .when(data_type.isin("double", "float") | F.startswith(data_type, F.lit("decimal")),
                  F.lit("decimal"))
            .when(data_type == "string", F.lit("string"))
            .when(data_type.isin("date", "timestamp", "timestamp_ntz"), F.lit("date")))


def pick_columns(descriptors: DataFrame, exclude: list[str], by: list[str],
                 per_group: int = PER_GROUP) -> DataFrame:
    """First columns of each type group per table, partition columns left out."""
    skip = [c.lower() for c in exclude]
    grouped = (descriptors.withColumn("type_group", type_group(F.col("data_type")))
               .filter(F.col("type_group").isNotNull() & ~F.lower("column_name").isin(*skip)))
    rank = F.row_number().over(Window.partitionBy(*by, "type_group").orderBy("position"))
    return (grouped.withColumn("rank", rank).filter(F.col("rank") <= per_group)
            .select(*by, "column_name", "data_type", "type_group", "rank"))


def picked(df: DataFrame, exclude: list[str], per_group: int | None = PER_GROUP,
           limit: int | None = 8) -> dict[str, str]:
    """The same choice for one frame, from its schema: column to type group."""
    groups: dict[str, list[str]] = {g: [] for g in GROUPS}
    skip = {c.lower() for c in exclude}
    for field in df.schema.fields:
        name = field.dataType.simpleString()
        group = ("int" if name in ("int", "bigint")
                 else "decimal" if name in ("double", "float") or name.startswith("decimal")
                 else "string" if name == "string"
                 else "date" if name in ("date", "timestamp", "timestamp_ntz") else None)
        if group and field.name.lower() not in skip:
            groups[group].append(field.name.lower())
    flat = [(c, g) for g in GROUPS for c in groups[g][:per_group]]
    return dict(flat[:limit])


def profile(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One pass over the data: min, max of every column, abs_sum of numeric ones.

    Result rows are (column_name, stat, value as text).  A missing column is left
    out.  Whole numbers are summed as decimals, which do not overflow at any table size.
    """
    df = lower_names(df)
    present = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggregates, shape = [], []
    for name, group in columns.items():
        if name not in present:
            continue
        value = F.col(f"`{name}`")
        for stat, agg in (("min", F.min(value)), ("max", F.max(value))):
            text = F.coalesce(agg.cast("string"), F.lit("null"))
            aggregates.append(text.alias(f"{name}.{stat}"))
            shape.append((name, stat))
        if group in NUMERIC:
            whole = present[name] in ("int", "bigint")
            number = value.cast("decimal(20,0)") if whole else value
            total = F.coalesce(F.sum(F.abs(number)).cast("string"), F.lit("0"))
            aggregates.append(total.alias(f"{name}.abs_sum"))
            shape.append((name, "abs_sum"))
    if not aggregates:
        raise ValueError("none of the chosen columns exists")
    wide = df.agg(*aggregates)
    entries = F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(s).alias("stat"),
                                 F.col(f"`{n}.{s}`").alias("value")) for n, s in shape])
    return wide.select(F.explode(entries).alias("e")).select("e.*")


def compare_profiles(source: DataFrame, target: DataFrame,
                     tolerance_pct: float = TOLERANCE_PCT) -> DataFrame:
    """Common statistics side by side: abs_sum by tolerance, the rest by text."""
    keys = ["column_name", "stat"]
    pair = source.withColumnRenamed("value", "source_value").join(
        target.withColumnRenamed("value", "target_value"), keys, "inner")
    s, t = F.col("source_value"), F.col("target_value")
    close = within_tolerance(s, t, tolerance_pct)
    matched = F.when(F.col("stat") == "abs_sum", close).otherwise(s == t)
    gap = F.when(F.col("stat") == "abs_sum", difference_pct(s, t))
    return pair.withColumn("matched", matched).withColumn("difference_pct", gap)
