"""Type tokens, column descriptors and the canonical schema document."""
from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted spellings of each atomic type, by Spark's own name.
TOKENS = {
    "tinyint": ("tinyint", "int8", "byte", "bytetype"),
    "smallint": ("smallint", "int16", "short", "shorttype"),
    "int": ("int", "int32", "integer", "integertype"),
    "bigint": ("bigint", "int64", "long", "longtype"),
    "float": ("float", "floattype"),
    "double": ("double", "doubletype"),
    "string": ("string", "stringtype"),
    "date": ("date", "date32", "date32[day]", "datetype"),
    "boolean": ("boolean", "bool", "booleantype"),
    "binary": ("binary", "binarytype"),
    "timestamp_ntz": ("timestamp_ntz", "timestampntz", "timestampntztype"),
}


def normal_type(token: Column | str) -> Column:
    """Spark's name of a type token in any accepted spelling; null when unsupported."""
    token = F.col(token) if isinstance(token, str) else token
    text = F.regexp_replace(F.lower(F.trim(token)), r"\(\)$", "")
    decimal = r"^decimal[a-z0-9]*\(\s*(\d+)\s*,\s*(\d+)\s*\)$"
    case = F.when(F.rlike(text, F.lit(decimal)),
                  F.concat(F.lit("decimal("), F.regexp_extract(text, decimal, 1), F.lit(","),
                           F.regexp_extract(text, decimal, 2), F.lit(")")))
    for name, spellings in TOKENS.items():
        case = case.when(text.isin(*spellings), F.lit(name))
    case = case.when(F.startswith(text, F.lit("timestamp")), F.lit("timestamp"))
    nested = F.rlike(text, F.lit("^(array|map|struct)<"))
    return case.when(nested, text).when(F.startswith(text, F.lit("{")), token)


def canonical_schema(schema: T.StructType) -> str:
    """One text per schema: lower-cased names in order, nullability kept, metadata dropped."""
    fields = [{"metadata": {}, "name": f.name.lower(), "nullable": f.nullable,
               "type": f.dataType.jsonValue()} for f in schema.fields]
    fields.sort(key=lambda field: field["name"])
    return json.dumps({"fields": fields, "type": "struct"}, sort_keys=True)


def captured_columns(catalog: DataFrame, keys: list[str], text: str = "schema_json") -> DataFrame:
    """One row per column of each captured schema: ``keys``, position, name, data_type."""
    # Spark keeps a nested JSON value as text when the target field is a string.
    document = F.from_json(F.col(text), "fields array<struct<name string, type string, nullable boolean>>")
    fields = catalog.select(*keys, F.posexplode(document["fields"]).alias("position", "field"))
    raw = F.col("field.type")
    return fields.select(
        *keys, "position", F.lower("field.name").alias("column_name"),
        F.coalesce(normal_type(raw), raw).alias("data_type"),
        F.col("field.nullable").alias("nullable")).transform(with_precision)


def with_precision(columns: DataFrame, data_type: str = "data_type") -> DataFrame:
    """Adds precision and scale of decimal types."""
    def part(group: int) -> Column:
        text = F.regexp_extract(data_type, r"^decimal\((\d+),(\d+)\)$", group)
        return F.nullif(text, F.lit("")).cast("int")
    return columns.withColumn("precision", part(1)).withColumn("scale", part(2))


def describe_columns(df: DataFrame, table: str, side: str) -> DataFrame:
    """Column descriptors of a frame as rows."""
    rows = [(table, side, i, f.name.lower(), f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    ddl = ("table_name string, side string, position int, column_name string, "
           "data_type string, nullable boolean")
    return df.sparkSession.createDataFrame(rows, ddl).transform(with_precision)


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-cased column names; refuses names that would collide."""
    names = [c.lower() for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names differ only in case: {df.columns}")
    return df.toDF(*names)
