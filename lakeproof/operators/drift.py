"""Schema drift: baseline, verdict, type report, alignment to a base schema."""
from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.functions import paths
from lakeproof.functions.types import captured_columns
from lakeproof.operators.lookup import SALT, lookup
from lakeproof.operators.merge import update_matched
from lakeproof.spec import DEFAULT, PartitionSpec

RUN = ["bucket_prefix", "execution_id"]


def schema_groups(catalog: DataFrame, by: list[str] = RUN, order: str = "path") -> DataFrame:
    """Captured partitions folded to one row per distinct schema and layout.

    A dataset of many partitions has few schemas, so all later steps are small whatever
    share of the catalog one dataset holds.
    """
    path = F.struct(F.lower("file_path").alias("low"), F.col("file_path").alias("path"))
    first = path if order == "path" else F.struct(F.col(order).alias("at"), path.alias("path"))
    return (catalog.withColumn("partition_structure", paths.partition_structure("file_path"))
            .groupBy(*by, "is_corrupted", "schema_json", "partition_structure")
            .agg(F.count(F.lit(1)).alias("files"), F.min(first).alias("first")))


def baseline(catalog: DataFrame, by: list[str] = RUN, order: str = "path") -> DataFrame:
    """Schema and layout of the first readable partition per dataset.

    First means smallest path, or oldest when ``order`` names a time column.
    """
    return _baseline(schema_groups(catalog, by, order), by, order)


def _baseline(groups: DataFrame, by: list[str], order: str) -> DataFrame:
    file_path = "base.first.path" if order == "path" else "base.first.path.path"
    base = F.min(F.struct("first", "schema_json", "partition_structure")).alias("base")
    return (groups.filter(~F.col("is_corrupted")).groupBy(*by).agg(base)
            .select(*by, F.col("base.schema_json").alias("baseline_schema"),
                    F.col(file_path).alias("baseline_path"),
                    F.col("base.partition_structure").alias("baseline_structure")))


def drift_verdict(catalog: DataFrame, by: list[str] = RUN, order: str = "path",
                  mixed: DataFrame | None = None) -> DataFrame:
    """Counts, consistency flags, candidate flag and JSON summary per dataset.

    A dataset whose partitions are all corrupted gets the verdict false.  ``mixed`` names the
    datasets (``by``) that have a partition with files of several schemas: these are not
    consistent, though the catalog has one schema for each partition.
    """
    groups = schema_groups(catalog, by, order)
    joined = groups.join(_baseline(groups, by, order), by, "left")
    good = ~F.col("is_corrupted")

    def files(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("files")).otherwise(F.lit(0)))

    counts = joined.groupBy(*by).agg(
        files(good).alias("total_non_corrupted_files"),
        files(F.col("is_corrupted")).alias("corrupted_files"),
        files(good & (F.col("schema_json") == F.col("baseline_schema"))).alias("same_schema"),
        files(good & (F.col("partition_structure") == F.col("baseline_structure")))
        .alias("same_structure"))
    total, whole = F.col("total_non_corrupted_files"), F.lit(True)
    if mixed is not None:
        counts = counts.join(mixed.select(*by).distinct().withColumn("__mixed", F.lit(True)), by, "left")
        whole = F.col("__mixed").isNull()
    flags = counts.select(
        *by, total, "corrupted_files",
        ((F.col("same_schema") == total) & whole).alias("schema_consistent"),
        (F.col("same_structure") == total).alias("partition_consistent"))
    fields = ["total_non_corrupted_files", "corrupted_files", "schema_consistent",
              "partition_consistent"]
    # Text format of the summary is a fixed value: blanks after comma and colon.
    parts = [F.concat(F.lit(f'"{f}": '), F.col(f).cast("string")) for f in fields]
    summary = F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
    candidate = ((F.col("corrupted_files") == 0) & F.col("schema_consistent")
                 & F.col("partition_consistent"))
    return (flags.withColumn("candidate_for_managed_table_creation", candidate)
            .withColumn("schema_analysis_results", summary))


def merge_verdict(candidates: DataFrame, verdict: DataFrame) -> DataFrame:
    columns = ["candidate_for_managed_table_creation", "schema_analysis_results"]
    return update_matched(candidates, verdict.select(*RUN, *columns), RUN, {c: c for c in columns})


def with_partition(catalog: DataFrame, spec: PartitionSpec = DEFAULT) -> DataFrame:
    """Adds the partition pair read from each captured path."""
    return (catalog.withColumn(spec.run, paths.partition_value("file_path", spec.run))
            .withColumn(spec.date, paths.partition_date("file_path", spec.date)))


def effective_schemas(catalog: DataFrame, latest: DataFrame, spec: PartitionSpec = DEFAULT,
                      by: list[str] | None = None, salt: int = SALT) -> DataFrame:
    """Captured schema of each dataset's latest partition (smallest path on several files)."""
    by = by or ["bucket_prefix"]
    keys = [*by, spec.run, spec.date]
    readable = with_partition(catalog, spec).filter(~F.col("is_corrupted"))
    hits = lookup(readable, latest.select(*keys), keys, "left_semi", salt)
    first = F.min_by("schema_json", "file_path").alias("schema_json")
    return hits.groupBy(*keys).agg(first)


def latest_readable_schemas(catalog: DataFrame, partitions: DataFrame, spec: PartitionSpec = DEFAULT,
                            by: list[str] | None = None, salt: int = SALT) -> DataFrame:
    """Schema of the newest of the given partitions that could be read, per dataset."""
    by = by or ["bucket_prefix"]
    found = effective_schemas(catalog, partitions.distinct(), spec, by, salt)
    newest = F.max_by(F.struct(spec.run, spec.date, "schema_json"), F.struct(spec.date, spec.run))
    return found.groupBy(*by).agg(newest.alias("n")).select(*by, "n.*")


def newest_schemas(catalog: DataFrame, by: list[str], time: str = "run_timestamp") -> DataFrame:
    """Schema captured last per dataset, the older rule for the read schema."""
    newest = F.max_by("schema_json", F.struct(time, "file_path")).alias("schema_json")
    return catalog.filter(~F.col("is_corrupted")).groupBy(*by).agg(newest)


def stored_schema(schema_json: str) -> T.StructType:
    """A captured schema as Spark's type."""
    fields = json.loads(schema_json)["fields"]
    return T.StructType.fromJson({
        "type": "struct", "fields": [{**f, "metadata": f.get("metadata") or {}} for f in fields]})


def read_schema(schema_json: str, spec: PartitionSpec = DEFAULT) -> T.StructType:
    """Schema to read a dataset with: the captured one plus the partition pair."""
    pair = (spec.run.lower(), spec.date.lower())
    schema = T.StructType([f for f in stored_schema(schema_json).fields if f.name.lower() not in pair])
    return schema.add(spec.run, T.StringType(), True).add(spec.date, T.DateType(), True)


def type_report(catalog: DataFrame, failed: DataFrame, base: DataFrame,
                by: list[str] | None = None, spec: PartitionSpec = DEFAULT,
                salt: int = SALT) -> DataFrame:
    """Column types of failed partitions against the base schema of their dataset.

    ``base`` has ``by`` and ``schema_json``; ``failed`` has ``by`` and the partition pair.
    Columns on one side only are reported as missing.
    """
    by = by or ["bucket_prefix"]
    keys = [*by, spec.run, spec.date]
    readable = with_partition(catalog, spec).filter(~F.col("is_corrupted"))
    wanted = lookup(readable, failed.select(*keys).distinct(), keys, "left_semi", salt)
    # Partitions of a dataset share few schemas: compare each schema once per partition set.
    parts = wanted.groupBy(*keys).agg(F.min_by("schema_json", "file_path").alias("schema_json"))
    schemas = parts.groupBy(*by, "schema_json").agg(F.count(F.lit(1)).alias("partitions"))
    found = captured_columns(schemas, [*by, "schema_json", "partitions"]).select(
        *by, "schema_json", "partitions", "column_name", F.col("data_type").alias("failed_type"))
    expected = captured_columns(base.withColumnRenamed("schema_json", "base_json"), by, "base_json").select(
        *by, "column_name", F.col("data_type").alias("base_type"))
    grid = schemas.join(expected, by, "inner")
    pairs = grid.join(found, [*by, "schema_json", "partitions", "column_name"], "full_outer")
    status = (F.when(F.col("base_type").isNull(), F.lit("MISSING_IN_BASE"))
              .when(F.col("failed_type").isNull(), F.lit("MISSING_IN_FAILED"))
              .when(F.col("base_type") == F.col("failed_type"), F.lit("PASS"))
              .otherwise(F.lit("FAIL")))
    return pairs.select(*by, "column_name", "base_type", "failed_type",
                        status.alias("status"), "partitions")


def comparison_rows(report: DataFrame) -> DataFrame:
    """The report in the column names of the comparison table."""
    upper = F.upper("column_name")
    return report.select(
        F.when(F.col("base_type").isNotNull(), upper).alias("Base_Column_Name"),
        F.col("base_type").alias("Base_Data_Type"),
        F.when(F.col("failed_type").isNotNull(), upper).alias("Failed_Column_Name"),
        F.col("failed_type").alias("Failed_Data_Type"), F.col("status").alias("Status"),
        paths.dataset_name("bucket_prefix").alias("dataset_name"))


def column_outcome(report: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per column: ever matched, ever mismatched, partitions of each kind."""
    by = by or ["bucket_prefix"]
    passed = F.col("status") == "PASS"
    return report.groupBy(*by, "column_name").agg(
        F.bool_or(passed).alias("ever_matched"), F.bool_or(~passed).alias("ever_mismatched"),
        F.sum(F.when(passed, F.col("partitions")).otherwise(0)).alias("partitions_matched"),
        F.sum(F.when(passed, 0).otherwise(F.col("partitions"))).alias("partitions_mismatched"))


def _aligned(value: Column, have: T.DataType, want: T.DataType, lenient: bool) -> Column:
    """A value in the wanted type; fields of structs meet by name in any case, at any depth.

    A field the value lacks is null, one the type lacks drops out; a null stays null.
    """
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        present = {f.name.lower(): f for f in have.fields}
        fields = []
        for field in want.fields:
            old = present.get(field.name.lower())
            inner = F.lit(None).cast(field.dataType) if old is None else _aligned(
                value.getField(old.name), old.dataType, field.dataType, lenient)
            fields.append(inner.alias(field.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: _aligned(x, have.elementType, want.elementType, lenient))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        made = F.map_from_entries(F.transform(F.map_entries(value), lambda e: F.struct(
            _aligned(e["key"], have.keyType, want.keyType, lenient).alias("key"),
            _aligned(e["value"], have.valueType, want.valueType, lenient).alias("value"))))
        if not lenient:
            return made
        # A key cannot be null: a map with a key that does not fit is null as a whole.
        return F.when(~F.exists(F.map_keys(value), lambda k: _loses(k, have.keyType, want.keyType)), made)
    return value.try_cast(want) if lenient else value.cast(want)


def _loses(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """Whether a lenient cast would turn a part of the value into null."""
    if have == want:
        return F.lit(False)
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        present = {f.name.lower(): f for f in have.fields}
        lost = F.lit(False)
        for field in want.fields:
            old = present.get(field.name.lower())
            if old is not None:
                lost = lost | _loses(value.getField(old.name), old.dataType, field.dataType)
        return value.isNotNull() & lost
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.coalesce(F.exists(value, lambda x: _loses(x, have.elementType, want.elementType)), F.lit(False))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        return F.coalesce(F.exists(F.map_entries(value), lambda e: _loses(e["key"], have.keyType, want.keyType)
                                   | _loses(e["value"], have.valueType, want.valueType)), F.lit(False))
    return value.isNotNull() & value.try_cast(want).isNull()


def align(df: DataFrame, schema: T.StructType, lenient: bool = False,
          fill_missing: bool = False) -> DataFrame:
    """``df`` with the columns and types of ``schema``, matched in any case.

    Extra columns drop out.  Missing ones are left out, or added as null with
    ``fill_missing``.  Fields inside structs, arrays and maps are matched by name as well,
    missing ones there being null.  ``lenient`` turns values that do not fit into null
    instead of failing the job; ``lost_values`` counts them.
    """
    present = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for field in schema.fields:
        have = present.get(field.name.lower())
        if have is None:
            if fill_missing:
                out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        out.append(_aligned(F.col(f"`{have.name}`"), have.dataType, field.dataType, lenient).alias(field.name))
    return df.select(*out)


def lost_values(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column of ``schema`` that needs a cast: values a lenient cast would lose a part of."""
    present = {f.name.lower(): f for f in df.schema.fields}
    counts = []
    for field in schema.fields:
        have = present.get(field.name.lower())
        if have is None or have.dataType == field.dataType:
            continue
        lost = _loses(F.col(f"`{have.name}`"), have.dataType, field.dataType)
        counts.append(F.count_if(lost).alias(field.name))
    if not counts:
        return df.sparkSession.createDataFrame([], "column_name string, lost bigint")
    one = df.agg(*counts)
    return one.unpivot([], one.columns, "column_name", "lost")
