"""Schema drift over captured schemas, and alignment of drifted data."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.functions.types import normal_type
from lakeproof.operators import drift, partitions as parts
from queries.registry import query
from queries.views import table, view

_BASE = """f AS (SELECT *, row_number() OVER (PARTITION BY bucket_prefix ORDER BY lower(file_path), file_path) AS n
  FROM schema_catalog WHERE NOT is_corrupted),
base AS (SELECT bucket_prefix, execution_id, schema_json AS baseline_schema, file_path AS baseline_path,
  array_to_string(list_sort(regexp_extract_all(file_path, '([^/]+)=[^/]+', 1)), '/') AS baseline_structure FROM f WHERE n = 1)"""
_VERDICT = _BASE + """, j AS (SELECT c.*, b.baseline_schema, b.baseline_structure,
  array_to_string(list_sort(regexp_extract_all(c.file_path, '([^/]+)=[^/]+', 1)), '/') AS structure
  FROM schema_catalog c LEFT JOIN base b USING (bucket_prefix, execution_id)),
v AS (SELECT bucket_prefix, execution_id, CAST(count(*) FILTER (NOT is_corrupted) AS BIGINT) AS total_non_corrupted_files,
  CAST(count(*) FILTER (is_corrupted) AS BIGINT) AS corrupted_files,
  count(*) FILTER (NOT is_corrupted AND schema_json = baseline_schema) = count(*) FILTER (NOT is_corrupted) AS schema_consistent,
  count(*) FILTER (NOT is_corrupted AND structure = baseline_structure) = count(*) FILTER (NOT is_corrupted) AS partition_consistent
  FROM j GROUP BY 1, 2),
w AS (SELECT *, corrupted_files = 0 AND schema_consistent AND partition_consistent AS candidate_for_managed_table_creation,
  concat('{"total_non_corrupted_files": ', total_non_corrupted_files, ', "corrupted_files": ', corrupted_files, ', "schema_consistent": ',
    CAST(schema_consistent AS VARCHAR), ', "partition_consistent": ', CAST(partition_consistent AS VARCHAR), '}') AS schema_analysis_results FROM v)"""


@query("schema_baseline", f"WITH {_BASE} SELECT * FROM base")
def schema_baseline(spark, sf):
    return drift.baseline(view(spark, sf, "schema_catalog"))


@query("drift_verdict", f"WITH {_VERDICT} SELECT * FROM w")
def drift_verdict(spark, sf):
    return drift.drift_verdict(view(spark, sf, "schema_catalog"))


@query("drift_verdict_merge", f"WITH {_VERDICT}" + """, cand AS (SELECT DISTINCT bucket_prefix, 'run-1' AS execution_id FROM schema_catalog
  WHERE bucket_prefix NOT LIKE '%3/' UNION ALL SELECT DISTINCT bucket_prefix, 'run-2' FROM schema_catalog)
SELECT c.bucket_prefix, c.execution_id, CAST(w.candidate_for_managed_table_creation AS VARCHAR) AS candidate_for_managed_table_creation,
  w.schema_analysis_results FROM cand c LEFT JOIN w USING (bucket_prefix, execution_id)""")
def drift_verdict_merge(spark, sf):
    catalog = view(spark, sf, "schema_catalog")
    one = catalog.select("bucket_prefix").distinct()
    empty = [F.lit(None).cast("string").alias(c) for c in
             ("candidate_for_managed_table_creation", "schema_analysis_results")]
    candidates = (one.filter("bucket_prefix NOT LIKE '%3/'").withColumn("execution_id", F.lit("run-1"))
                  .unionByName(one.withColumn("execution_id", F.lit("run-2")))
                  .select("bucket_prefix", "execution_id", *empty))
    return drift.merge_verdict(candidates, drift.drift_verdict(catalog))


_PARTS = r"""pc AS (SELECT *, nullif(regexp_extract(file_path, '(?i)run_id=([^/]+)', 1), '') AS run_id,
  TRY_CAST(regexp_extract(file_path, '(?i)snapshot_date=([^/]+)', 1) AS DATE) AS snapshot_date FROM schema_catalog WHERE NOT is_corrupted),
lp AS (SELECT bucket_prefix, max((snapshot_date, run_id)) AS m FROM pc GROUP BY 1),
eff AS (SELECT pc.bucket_prefix, pc.run_id, pc.snapshot_date, arg_min(schema_json, file_path) AS schema_json
  FROM pc JOIN lp ON pc.bucket_prefix = lp.bucket_prefix AND (pc.snapshot_date, pc.run_id) = lp.m GROUP BY 1, 2, 3)"""


def _latest(spark, sf):
    catalog = drift.with_partition(view(spark, sf, "schema_catalog")).filter("NOT is_corrupted")
    return parts.latest_snapshot(catalog, ["bucket_prefix"])


@query("effective_schema", f"WITH {_PARTS} SELECT * FROM eff")
def effective_schema(spark, sf):
    return drift.effective_schemas(view(spark, sf, "schema_catalog"), _latest(spark, sf))


@query("newest_schema", """
SELECT bucket_prefix, arg_max(schema_json, (seed, file_path)) AS schema_json FROM schema_catalog WHERE NOT is_corrupted GROUP BY 1""")
def newest_schema(spark, sf):
    return drift.newest_schemas(view(spark, sf, "schema_catalog"), ["bucket_prefix"], "seed")


# Every captured partition counts as failed; the base is the usual layout of the dataset.
_REPORT = f"""WITH {_PARTS}, one AS (SELECT bucket_prefix, run_id, snapshot_date, arg_min(seed, file_path) AS seed,
  arg_min(file_path, file_path) AS file_path FROM pc GROUP BY 1, 2, 3),
cols AS (SELECT o.bucket_prefix, o.file_path, c.column_name, c.data_type FROM one o JOIN catalog_columns c ON o.file_path = c.file_path),
base AS (SELECT DISTINCT bucket_prefix, 'amt' AS column_name, 'decimal(18,2)' AS data_type FROM schema_catalog
  UNION SELECT DISTINCT bucket_prefix, 'id', 'bigint' FROM schema_catalog),
grid AS (SELECT o.bucket_prefix, o.file_path, b.column_name, b.data_type FROM one o JOIN base b ON o.bucket_prefix = b.bucket_prefix),
rep AS (SELECT coalesce(g.bucket_prefix, c.bucket_prefix) AS bucket_prefix, coalesce(g.column_name, c.column_name) AS column_name,
  g.data_type AS base_type, c.data_type AS failed_type,
  CASE WHEN g.data_type IS NULL THEN 'MISSING_IN_BASE' WHEN c.data_type IS NULL THEN 'MISSING_IN_FAILED'
       WHEN g.data_type = c.data_type THEN 'PASS' ELSE 'FAIL' END AS status
  FROM grid g FULL JOIN cols c ON g.file_path = c.file_path AND g.column_name = c.column_name)"""


def _type_report(spark, sf):
    catalog = view(spark, sf, "schema_catalog")
    failed = drift.with_partition(catalog).select("bucket_prefix", "run_id", "snapshot_date").distinct()
    usual = '{"fields":[{"name":"amt","nullable":true,"type":"DecimalType(18,2)"},{"name":"ID","nullable":true,"type":"long"}]}'
    base = catalog.select("bucket_prefix", F.lit(usual).alias("schema_json")).distinct()
    return drift.type_report(catalog, failed, base)


@query("schema_type_report", _REPORT + """ SELECT bucket_prefix, column_name, base_type, failed_type, status,
  CAST(count(*) AS BIGINT) AS partitions FROM rep GROUP BY ALL""")
def schema_type_report(spark, sf):
    report = _type_report(spark, sf)
    keys = ["bucket_prefix", "column_name", "base_type", "failed_type", "status"]
    return report.groupBy(*keys).agg(F.sum("partitions").alias("partitions"))


@query("schema_comparison_rows", _REPORT + """ SELECT DISTINCT CASE WHEN base_type IS NOT NULL THEN upper(column_name) END AS Base_Column_Name,
  base_type AS Base_Data_Type, CASE WHEN failed_type IS NOT NULL THEN upper(column_name) END AS Failed_Column_Name,
  failed_type AS Failed_Data_Type, status AS Status, rtrim(substr(bucket_prefix, 9), '/') AS dataset_name FROM rep""")
def schema_comparison_rows(spark, sf):
    return drift.comparison_rows(_type_report(spark, sf)).distinct()


@query("schema_column_outcome", _REPORT + """ SELECT bucket_prefix, column_name, bool_or(status = 'PASS') AS ever_matched,
  bool_or(status <> 'PASS') AS ever_mismatched, CAST(count(*) FILTER (status = 'PASS') AS BIGINT) AS partitions_matched,
  CAST(count(*) FILTER (status <> 'PASS') AS BIGINT) AS partitions_mismatched FROM rep GROUP BY 1, 2""")
def schema_column_outcome(spark, sf):
    return drift.column_outcome(_type_report(spark, sf))


# Type tokens in both spellings, one per part.
_TOKENS = """SELECT p_partkey, CASE p_partkey % 16 WHEN 0 THEN 'DecimalType(10,2)' WHEN 1 THEN 'decimal(18, 4)' WHEN 2 THEN 'int64'
  WHEN 3 THEN 'LongType()' WHEN 4 THEN ' Integer ' WHEN 5 THEN 'ShortType()' WHEN 6 THEN 'byte' WHEN 7 THEN 'FloatType()'
  WHEN 8 THEN 'double' WHEN 9 THEN 'StringType()' WHEN 10 THEN 'date32[day]' WHEN 11 THEN 'timestamp[us]'
  WHEN 12 THEN 'TimestampNTZType()' WHEN 13 THEN 'bool' WHEN 14 THEN 'BinaryType()' ELSE 'interval' END AS token FROM {part}"""


@query("type_tokens", f"""WITH t AS ({_TOKENS.format(part='part')})
SELECT p_partkey, token, CASE p_partkey % 16 WHEN 0 THEN 'decimal(10,2)' WHEN 1 THEN 'decimal(18,4)' WHEN 2 THEN 'bigint' WHEN 3 THEN 'bigint'
  WHEN 4 THEN 'int' WHEN 5 THEN 'smallint' WHEN 6 THEN 'tinyint' WHEN 7 THEN 'float' WHEN 8 THEN 'double' WHEN 9 THEN 'string'
  WHEN 10 THEN 'date' WHEN 11 THEN 'timestamp' WHEN 12 THEN 'timestamp_ntz' WHEN 13 THEN 'boolean' WHEN 14 THEN 'binary' END AS data_type FROM t""")
def type_tokens(spark, sf):
    tokens = spark.sql(_TOKENS.format(part=f"parquet.`{sf}/part.parquet`"))
    return tokens.withColumn("data_type", normal_type("token"))


def drifted_lines(spark, sf):
    """Line items whose numbers arrive as text, some of it unreadable; one extra column."""
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("L_OrderKey"), "l_linenumber",
        F.when(F.col("l_orderkey") % 53 == 0, F.lit("n/a")).otherwise(
            F.col("l_quantity").cast("decimal(18,2)").cast("string")).alias("quantity"),
        F.col("l_shipdate").cast("date").cast("string").alias("ship_date"), "l_returnflag")


BASE_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.LongType()),
    T.StructField("quantity", T.DecimalType(18, 2)), T.StructField("ship_date", T.DateType()),
    T.StructField("l_comment", T.StringType())])


@query("remediation_cast", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE CAST(l_quantity AS DECIMAL(18,2)) END AS quantity,
  CAST(l_shipdate AS DATE) AS ship_date, CAST(NULL AS VARCHAR) AS l_comment FROM lineitem""")
def remediation_cast(spark, sf):
    return drift.align(drifted_lines(spark, sf), BASE_SCHEMA, lenient=True, fill_missing=True)


@query("remediation_lost_values", """
SELECT 'quantity' AS column_name, CAST(count(*) AS BIGINT) AS lost FROM lineitem WHERE l_orderkey % 53 = 0
UNION ALL SELECT 'l_orderkey', 0 UNION ALL SELECT 'l_linenumber', 0 UNION ALL SELECT 'ship_date', 0""")
def remediation_lost_values(spark, sf):
    return drift.lost_values(drifted_lines(spark, sf), BASE_SCHEMA)


NESTED = ("key bigint, s struct<A: decimal(18,2), b: bigint, c: string>, items array<struct<k: bigint, v: int>>, "
          "m map<int, struct<p: string, q: decimal(18,2)>>")


@query("remediation_nested", """
SELECT l_orderkey AS key, CASE WHEN l_orderkey % 53 <> 0 THEN CAST(l_quantity AS DECIMAL(18,2)) END AS a, CAST(l_partkey AS BIGINT) AS b,
  CAST(NULL AS VARCHAR) AS c, CAST(l_orderkey AS BIGINT) AS k, CAST(l_linenumber AS INTEGER) AS v, CAST(l_linenumber AS INTEGER) AS map_key,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS q, l_orderkey % 7 = 0 AS no_struct FROM lineitem WHERE l_orderkey % 7 <> 0
UNION ALL SELECT l_orderkey, NULL, NULL, NULL, CAST(l_orderkey AS BIGINT), CAST(l_linenumber AS INTEGER), CAST(l_linenumber AS INTEGER),
  CAST(l_extendedprice AS DECIMAL(18,2)), true FROM lineitem WHERE l_orderkey % 7 = 0""")
def remediation_nested(spark, sf):
    """Structs with swapped, renamed-in-case, missing and extra fields, also in arrays and maps."""
    raw = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS key",
        """CASE WHEN l_orderkey % 7 <> 0 THEN named_struct('B', cast(l_partkey as string), 'x', 1,
           'a', CASE WHEN l_orderkey % 53 = 0 THEN 'n/a' ELSE cast(cast(l_quantity as decimal(18,2)) as string) END) END AS s""",
        "array(named_struct('v', cast(l_linenumber as string), 'K', l_orderkey)) AS items",
        "map(cast(l_linenumber as string), named_struct('q', cast(cast(l_extendedprice as decimal(18,2)) as string))) AS m")
    base = T.StructType.fromDDL(NESTED)
    done = drift.align(raw, base, lenient=True)
    return done.selectExpr("key", "s.A AS a", "s.b AS b", "s.c AS c", "items[0].k AS k", "items[0].v AS v", "map_keys(m)[0] AS map_key",
                           "map_values(m)[0].q AS q", "s IS NULL AS no_struct")
