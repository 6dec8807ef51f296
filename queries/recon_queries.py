"""Reconciliation checks over a line-item table and its damaged copy."""
from __future__ import annotations

from pyspark.sql import functions as F

from lakeproof import PartitionSpec
from lakeproof.functions import numeric
from lakeproof.functions.types import captured_columns
from lakeproof.operators import checksum as cs, digest as dg, profile as pf, recon
from lakeproof.plans.reconcile import reconcile_pair
from queries.registry import query
from queries.views import table, view

PARTITION = ["snapshot_date", "run_id"]
_RESULT = ["table_name", "recon_type", "status", "source_metrics", "target_metrics",
           "metrics_compared", "metrics_matched", "metrics_different", "summary"]
_COUNTS = """s AS (SELECT snapshot_date, run_id, count(*) AS n FROM recon_src GROUP BY 1, 2),
t AS (SELECT snapshot_date, run_id, count(*) AS n FROM recon_tgt GROUP BY 1, 2),
c AS (SELECT coalesce(s.snapshot_date, t.snapshot_date) AS snapshot_date, coalesce(s.run_id, t.run_id) AS run_id,
  CAST(coalesce(s.n, 0) AS BIGINT) AS source_count, CAST(coalesce(t.n, 0) AS BIGINT) AS target_count
  FROM s FULL JOIN t ON s.snapshot_date = t.snapshot_date AND s.run_id = t.run_id)"""


def pair(spark, sf):
    return view(spark, sf, "recon_src"), view(spark, sf, "recon_tgt")


def counts(spark, sf):
    return recon.partition_counts(*pair(spark, sf), PARTITION)


@query("recon_partition_count", f"""WITH {_COUNTS}
SELECT *, abs(source_count - target_count) AS difference,
  CASE WHEN source_count = 0 THEN 0.0 ELSE round(abs(source_count - target_count) / CAST(source_count AS DOUBLE) * 100.0, 2) END AS variance_pct,
  CASE WHEN source_count = target_count THEN 'PASS' ELSE 'FAIL' END AS status FROM c""")
def recon_partition_count(spark, sf):
    return recon.partition_differences(counts(spark, sf))


@query("recon_partition_count_result", f"""WITH {_COUNTS},
d AS (SELECT *, row_number() OVER (ORDER BY snapshot_date, run_id) AS nth FROM c WHERE source_count <> target_count),
x AS (SELECT (SELECT count(*) FROM c) AS total, (SELECT count(*) FROM d) AS bad,
  (SELECT string_agg(concat('snapshot_date=', CAST(snapshot_date AS VARCHAR), ', run_id=', run_id, ': Source=', source_count, ', Target=', target_count), '; ' ORDER BY nth) FROM d WHERE nth <= 3) AS shown)
SELECT 'lineitem' AS table_name, 'PARTITION_RECORD_COUNT' AS recon_type, 'FAIL' AS status,
  CAST(total AS VARCHAR) AS source_metrics, CAST(total AS VARCHAR) AS target_metrics,
  CAST(total AS INTEGER) AS metrics_compared, CAST(total - bad AS INTEGER) AS metrics_matched, CAST(bad AS INTEGER) AS metrics_different,
  concat('Partition record count differences: ', total - bad, '/', total, ' partitions match - Mismatched: [', shown,
    CASE WHEN bad > 3 THEN concat('; and ', bad - 3, ' more partitions') ELSE '' END, ']') AS summary FROM x""")
def recon_partition_count_result(spark, sf):
    return recon.partition_record_count(counts(spark, sf), PARTITION, "lineitem", "r").select(*_RESULT)


@query("recon_row_count", """
WITH x AS (SELECT (SELECT count(*) FROM recon_src) AS s, (SELECT count(*) FROM recon_tgt) AS t)
SELECT 'lineitem' AS table_name, 'ROW_COUNT' AS recon_type, CASE WHEN s = t THEN 'PASS' ELSE 'FAIL' END AS status,
  CAST(s AS VARCHAR) AS source_metrics, CAST(t AS VARCHAR) AS target_metrics, 0 AS metrics_compared,
  0 AS metrics_matched, 0 AS metrics_different,
  CASE WHEN s = t THEN concat('Row count matches: Source=', s, ', Target=', t)
       ELSE concat('Row count difference: ', abs(s - t), ' (Source=', s, ', Target=', t, ')') END AS summary FROM x""")
def recon_row_count(spark, sf):
    return recon.row_count(counts(spark, sf), "lineitem", "r").select(*_RESULT)


@query("recon_partition_set", f"""WITH {_COUNTS}
SELECT CAST(count(*) FILTER (source_count > 0) AS BIGINT) AS source, CAST(count(*) FILTER (target_count > 0) AS BIGINT) AS target,
  CAST((SELECT count(*) FROM (SELECT snapshot_date, run_id FROM recon_src EXCEPT SELECT snapshot_date, run_id FROM recon_tgt)) AS BIGINT) AS missing_in_target,
  CAST((SELECT count(*) FROM (SELECT snapshot_date, run_id FROM recon_tgt EXCEPT SELECT snapshot_date, run_id FROM recon_src)) AS BIGINT) AS missing_in_source
FROM c""")
def recon_partition_set(spark, sf):
    return recon.partition_set_totals(counts(spark, sf))


# Inventory partitions against tracked ones: many are on one side only.
@query("recon_partition_set_result", """
WITH a AS (SELECT DISTINCT snapshot_date, run_id FROM inventory WHERE snapshot_date IS NOT NULL AND seed % 3 <> 0),
b AS (SELECT DISTINCT snapshot_date, run_id FROM inventory WHERE snapshot_date IS NOT NULL AND seed % 4 <> 0 AND run_id <> 'R2'),
m AS (SELECT *, row_number() OVER (ORDER BY snapshot_date, run_id) AS n FROM (SELECT * FROM a EXCEPT SELECT * FROM b)),
k AS (SELECT *, row_number() OVER (ORDER BY snapshot_date, run_id) AS n FROM (SELECT * FROM b EXCEPT SELECT * FROM a)),
x AS (SELECT (SELECT count(*) FROM a) AS s, (SELECT count(*) FROM b) AS t, (SELECT count(*) FROM m) AS mt, (SELECT count(*) FROM k) AS ms,
  coalesce((SELECT string_agg(concat('(snapshot_date=', CAST(snapshot_date AS VARCHAR), ', run_id=', run_id, ')'), '; ' ORDER BY n) FROM m WHERE n <= 3), '') AS fm,
  coalesce((SELECT string_agg(concat('(snapshot_date=', CAST(snapshot_date AS VARCHAR), ', run_id=', run_id, ')'), '; ' ORDER BY n) FROM k WHERE n <= 3), '') AS fk)
SELECT 'inv' AS table_name, 'Partiton_Data_count' AS recon_type, CASE WHEN mt = 0 AND ms = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
  CAST(s AS VARCHAR) AS source_metrics, CAST(t AS VARCHAR) AS target_metrics, 0 AS metrics_compared, 0 AS metrics_matched, 0 AS metrics_different,
  concat('Source distinct partition count = ', s, ', managed table distinct partition count = ', t, '. ',
    CASE WHEN mt = 0 AND ms = 0 THEN 'All partitions match.' ELSE concat('Partition mismatch detected. Missing in target: ', mt, ' [', fm, ']. Missing in source: ', ms, ' [', fk, '].') END) AS summary
FROM x""")
def recon_partition_set_result(spark, sf):
    dated = view(spark, sf, "inventory").filter("snapshot_date IS NOT NULL")
    both = recon.partition_counts(dated.filter("seed % 3 <> 0"),
                                  dated.filter("seed % 4 <> 0 AND run_id <> 'R2'"), PARTITION)
    return recon.partition_set(both, PARTITION, "inv", "r").select(*_RESULT)


@query("recon_variance", """
WITH s AS (SELECT l_returnflag, run_id, count(*) AS n FROM recon_src WHERE l_partkey % 5 <> 0 OR run_id <> 'R1' GROUP BY 1, 2),
t AS (SELECT l_returnflag, run_id, count(*) AS n FROM recon_tgt GROUP BY 1, 2)
SELECT t.l_returnflag, t.run_id, CASE WHEN coalesce(s.n, 0) = 0 THEN 0.0
  ELSE round(abs(s.n - t.n) / CAST(s.n AS DOUBLE) * 100.0, 2) END AS variance_pct
FROM t LEFT JOIN s ON s.l_returnflag = t.l_returnflag AND s.run_id = t.run_id""")
def recon_variance(spark, sf):
    source, target = pair(spark, sf)
    both = recon.partition_counts(source.filter("l_partkey % 5 <> 0 OR run_id <> 'R1'"), target,
                                  ["l_returnflag", "run_id"])
    return both.select("l_returnflag", "run_id", numeric.variance_pct(
        F.col("source_count"), F.col("target_count")).alias("variance_pct"))


def catalog_sides(spark, sf):
    """Descriptors of every captured partition against the layout all should have."""
    catalog = view(spark, sf, "schema_catalog").filter("NOT is_corrupted")
    found = captured_columns(catalog, ["file_path"]).withColumnRenamed("file_path", "table_name")
    usual = '{"fields":[{"name":"AMT","nullable":true,"type":"decimal(18,2)"},{"name":"id","nullable":true,"type":"bigint"}]}'
    base = captured_columns(catalog.select(F.col("file_path").alias("table_name"),
                                           F.lit(usual).alias("schema_json")), ["table_name"])
    return base, found


_SIDES = """base AS (SELECT file_path AS table_name, 'amt' AS column_name, 'decimal(18,2)' AS data_type FROM schema_catalog WHERE NOT is_corrupted
  UNION ALL SELECT file_path, 'id', 'bigint' FROM schema_catalog WHERE NOT is_corrupted),
found AS (SELECT file_path AS table_name, column_name, data_type FROM catalog_columns),
d AS (SELECT coalesce(b.table_name, f.table_name) AS table_name, coalesce(b.column_name, f.column_name) AS column_name,
  b.data_type AS source_type, f.data_type AS target_type,
  CASE WHEN b.data_type IS NULL THEN 'MISSING_IN_SOURCE' WHEN f.data_type IS NULL THEN 'MISSING_IN_TARGET'
       WHEN b.data_type = f.data_type THEN 'MATCH'
       WHEN b.data_type LIKE 'decimal%' AND f.data_type LIKE 'decimal%' THEN 'PRECISION_MISMATCH' ELSE 'TYPE_MISMATCH' END AS kind
  FROM base b FULL JOIN found f ON b.table_name = f.table_name AND b.column_name = f.column_name)"""


@query("recon_schema_differences", f"WITH {_SIDES} SELECT * FROM d")
def recon_schema_differences(spark, sf):
    base, found = catalog_sides(spark, sf)
    return recon.schema_differences(base, found, ["table_name"])


@query("recon_schema", f"""WITH {_SIDES},
g AS (SELECT table_name, count(*) AS n, count(*) FILTER (kind = 'MATCH') AS m,
  string_agg(CASE WHEN kind = 'MISSING_IN_SOURCE' THEN column_name END, ', ') AS ms, string_agg(CASE WHEN kind = 'MISSING_IN_TARGET' THEN column_name END, ', ') AS mt,
  string_agg(CASE WHEN kind = 'TYPE_MISMATCH' THEN concat(column_name, ' (src: ', source_type, ', tgt: ', target_type, ')') END, ', ') AS ty,
  string_agg(CASE WHEN kind = 'PRECISION_MISMATCH' THEN concat(column_name, ' (src: ', source_type, ', tgt: ', target_type, ')') END, ', ') AS pr FROM d GROUP BY 1)
SELECT table_name, CASE WHEN n = m THEN 'PASS' ELSE 'FAIL' END AS status, CAST(n AS INTEGER) AS metrics_compared,
  CAST(m AS INTEGER) AS metrics_matched, CAST(n - m AS INTEGER) AS metrics_different,
  CASE WHEN n = m THEN 'Schema matches completely: All columns, types, and precision/scale are identical' ELSE
   concat('Schema differences found: ', concat_ws(' | ', 'Missing in source: 1 columns [''' || ms || ''']', 'Missing in target: 1 columns [''' || mt || ''']',
     'Type mismatches: 1 columns [''' || ty || ''']', 'Precision mismatches: 1 columns [''' || pr || ''']')) END AS summary
FROM g""")
def recon_schema(spark, sf):
    base, found = catalog_sides(spark, sf)
    return recon.schema_check(base, found, "r").select(
        "table_name", "status", "metrics_compared", "metrics_matched", "metrics_different", "summary")


@query("recon_column_count", f"""WITH {_SIDES},
g AS (SELECT table_name, count(source_type) AS s, count(target_type) AS t FROM d GROUP BY 1)
SELECT table_name, CASE WHEN s = t THEN 'PASS' ELSE 'FAIL' END AS status, CAST(s AS VARCHAR) AS source_metrics, CAST(t AS VARCHAR) AS target_metrics,
  CASE WHEN s = t THEN concat('Column count matches: Source=', s, ', Target=', t)
       ELSE concat('Column count difference: ', abs(s - t), ' (Source=', s, ', Target=', t, ')') END AS summary FROM g""")
def recon_column_count(spark, sf):
    base, found = catalog_sides(spark, sf)
    return recon.column_count(base, found, "r").select(
        "table_name", "status", "source_metrics", "target_metrics", "summary")


@query("recon_partition_columns", """
WITH x AS (SELECT key, string_split(partition_key, ', ') AS s,
  CASE WHEN seed % 10 = 0 THEN ['snapshot_date'] WHEN seed % 10 = 1 THEN ['region', 'run_id', 'snapshot_date'] ELSE ['run_id', 'snapshot_date'] END AS t
  FROM inventory WHERE partition_key IS NOT NULL)
SELECT key AS table_name, CASE WHEN list_sort(s) = t THEN 'PASS' ELSE 'FAIL' END AS status,
  CASE WHEN list_sort(s) = t THEN 'Partition columns match' ELSE concat('Missing in source: [',
    array_to_string(list_sort(list_filter(t, lambda v: NOT list_contains(s, v))), ', '), '], missing in target: [',
    array_to_string(list_sort(list_filter(s, lambda v: NOT list_contains(t, v))), ', '), ']') END AS summary
FROM x""")
def recon_partition_columns(spark, sf):
    sides = view(spark, sf, "inventory").filter("partition_key IS NOT NULL").selectExpr(
        "key AS table_name", "partition_key AS source_columns",
        "CASE WHEN seed % 10 = 0 THEN 'SNAPSHOT_DATE' WHEN seed % 10 = 1 THEN 'snapshot_date, region, run_id'"
        " ELSE 'snapshot_date, run_id' END AS target_columns")
    return recon.partition_columns(sides, "r").select("table_name", "status", "summary")


_ROW = "concat_ws('||', CAST(l_linenumber AS VARCHAR), CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), l_returnflag, CAST(price AS VARCHAR), CAST(quantity AS VARCHAR), CAST(ship_date AS VARCHAR))"
_CHECKSUM = """SELECT {by} CAST(sum(s) AS BIGINT) AS source_record_count, CAST(sum(t) AS BIGINT) AS target_record_count,
  CAST(count(*) FILTER (s > 0) AS BIGINT) AS source_distinct, CAST(count(*) FILTER (t > 0) AS BIGINT) AS target_distinct,
  CAST(count(*) FILTER (s > 0 AND t > 0) AS BIGINT) AS matched_record_count, CAST(sum(abs(s - t)) AS BIGINT) AS unmatched_rows,
  CASE WHEN count(*) FILTER (s > 0) = count(*) FILTER (t > 0) AND count(*) FILTER (s > 0) = count(*) FILTER (s > 0 AND t > 0) {extra} THEN 'PASS' ELSE 'FAIL' END AS status
FROM h {group}"""
_HASHED = "h AS (SELECT {by} c, sum(s) AS s, sum(t) AS t FROM (SELECT {by} sha256({row}) AS c, 1 AS s, 0 AS t FROM {src} UNION ALL SELECT {by} sha256({row}), 0, 1 FROM {tgt}) u GROUP BY ALL)"
_LATEST = """ls AS (SELECT * FROM recon_src WHERE (snapshot_date, run_id) = (SELECT (snapshot_date, run_id) FROM recon_src ORDER BY snapshot_date DESC, run_id DESC LIMIT 1)),
lt AS (SELECT * FROM recon_tgt WHERE (snapshot_date, run_id) = (SELECT (snapshot_date, run_id) FROM recon_tgt ORDER BY snapshot_date DESC, run_id DESC LIMIT 1))"""


def latest_pair(spark, sf):
    from lakeproof.operators.partitions import latest_partitions, restrict
    return [restrict(x, latest_partitions(x, PARTITION, 1), PARTITION, at_most=1) for x in pair(spark, sf)]


@query("recon_checksum", "WITH " + _LATEST + ", " + _HASHED.format(by="", row=_ROW, src="ls", tgt="lt") + " "
       + _CHECKSUM.format(by="", extra="", group=""))
def recon_checksum(spark, sf):
    return cs.compare_checksums(*latest_pair(spark, sf), PARTITION)


@query("recon_checksum_all", "WITH " + _HASHED.format(by="", row=_ROW, src="recon_src", tgt="recon_tgt") + " "
       + _CHECKSUM.format(by="", extra="", group=""))
def recon_checksum_all(spark, sf):
    return cs.compare_checksums(*pair(spark, sf), PARTITION)


_STRICT_ROW = "concat_ws('|', " + ", ".join(
    f"coalesce(concat(length(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)), '-')" for c in
    ("l_linenumber", "l_orderkey", "l_partkey", "l_returnflag", "price", "quantity", "ship_date")) + ")"


@query("recon_checksum_strict", "WITH " + _HASHED.format(
    by="snapshot_date, run_id, ", row=_STRICT_ROW, src="recon_src", tgt="recon_tgt") + " " + _CHECKSUM.format(
    by="snapshot_date, run_id, ", extra="AND sum(abs(s - t)) = 0", group="GROUP BY 1, 2"))
def recon_checksum_strict(spark, sf):
    return cs.compare_checksums(*pair(spark, sf), PARTITION, by=PARTITION, strict=True)


_SUMS = """l AS (SELECT run_id, snapshot_date, sha256({row}) AS checksum FROM recon_src),
r AS (SELECT run_id, snapshot_date, sha256({row}) AS checksum FROM recon_tgt),
b AS (SELECT run_id, snapshot_date, checksum, 1 AS s, 0 AS t FROM l UNION ALL SELECT run_id, snapshot_date, checksum, 0, 1 FROM r),
c AS (SELECT run_id, snapshot_date, checksum, CAST(sum(s) AS BIGINT) AS src, CAST(sum(t) AS BIGINT) AS tgt FROM b GROUP BY 1, 2, 3)
""".format(row=_STRICT_ROW)


@query("recon_digest_partitions", "WITH " + _SUMS + """SELECT run_id, snapshot_date, CAST(sum(src) AS BIGINT) AS source_record_count,
CAST(sum(tgt) AS BIGINT) AS target_record_count, CASE WHEN sum(abs(src - tgt)) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM c GROUP BY 1, 2""")
def recon_digest_partitions(spark, sf):
    """All partitions by sums of row digests: no row is shuffled."""
    return dg.compare_partitions(*pair(spark, sf), PARTITION, PARTITION)


@query("recon_checksum_descent", "WITH " + _SUMS + "SELECT run_id, snapshot_date, checksum, src, tgt FROM c WHERE src <> tgt")
def recon_checksum_descent(spark, sf):
    """The differing rows of all partitions, found by descent into digest ranges."""
    return dg.differing_rows(*pair(spark, sf), PARTITION, PARTITION)


_PROFILED = [("l_orderkey", "int"), ("l_linenumber", "int"), ("quantity", "decimal"), ("price", "decimal"),
             ("l_returnflag", "string"), ("ship_date", "date")]


def _profile_sql(source: str) -> str:
    parts = []
    for name, group in _PROFILED:
        for stat in ("min", "max") + (("abs_sum",) if group in pf.NUMERIC else ()):
            value = f"sum(abs({name}))" if stat == "abs_sum" else f"{stat}({name})"
            parts.append(f"SELECT '{name}' AS column_name, '{stat}' AS stat, CAST({value} AS VARCHAR) AS value "
                         f"FROM {source}")
    return " UNION ALL ".join(parts)


@query("recon_profile", _profile_sql("recon_src"))
def recon_profile(spark, sf):
    source, _ = pair(spark, sf)
    return pf.profile(source, pf.picked(source, PARTITION))


_COMPARED = """cmp AS (SELECT p.column_name, p.stat, p.value AS source_value, q.value AS target_value,
  CASE WHEN p.stat <> 'abs_sum' OR p.value = q.value THEN p.value = q.value
       ELSE abs(CAST(p.value AS DOUBLE) - CAST(q.value AS DOUBLE)) / greatest(abs(CAST(p.value AS DOUBLE)), abs(CAST(q.value AS DOUBLE))) * 100.0 <= {tol} END AS matched
  FROM p JOIN q ON p.column_name = q.column_name AND p.stat = q.stat)"""


@query("recon_profile_compare", f"WITH p AS ({_profile_sql('recon_src')}), q AS ({_profile_sql('recon_tgt')}), "
       + _COMPARED.format(tol=0.02) + " SELECT * FROM cmp")
def recon_profile_compare(spark, sf):
    source, target = pair(spark, sf)
    columns = pf.picked(source, PARTITION)
    compared = pf.compare_profiles(pf.profile(source, columns), pf.profile(target, columns), tolerance_pct=0.02)
    return compared.drop("difference_pct")


@query("recon_verified", f"WITH {_LATEST}, p AS ({_profile_sql('ls')}), q AS ({_profile_sql('lt')}), "
       + _COMPARED.format(tol=0.001) + """
SELECT 'lineitem' AS table_name, 'VERIFIED' AS recon_type, CASE WHEN bool_and(matched) THEN 'PASS' ELSE 'FAIL' END AS status,
  CAST(count(*) AS INTEGER) AS metrics_compared, CAST(count(*) FILTER (matched) AS INTEGER) AS metrics_matched,
  CAST(count(*) FILTER (NOT matched) AS INTEGER) AS metrics_different FROM cmp""")
def recon_verified(spark, sf):
    source, target = latest_pair(spark, sf)
    return recon.verify(source, target, PARTITION, "lineitem", "r").select(
        "table_name", "recon_type", "status", "metrics_compared", "metrics_matched", "metrics_different")


@query("recon_picked_columns", """
WITH g AS (SELECT file_path, column_name, data_type, CASE WHEN data_type = 'bigint' THEN 'int' WHEN data_type LIKE 'decimal%' THEN 'decimal'
  WHEN data_type = 'string' THEN 'string' ELSE 'date' END AS type_group FROM catalog_columns WHERE column_name <> 'id' OR seed % 2 = 0)
SELECT *, CAST(1 AS INTEGER) AS rank FROM g WHERE column_name <> 'extra'""")
def recon_picked_columns(spark, sf):
    catalog = view(spark, sf, "schema_catalog").filter("NOT is_corrupted")
    columns = captured_columns(catalog, ["file_path", "seed"]).filter("column_name <> 'id' OR seed % 2 = 0")
    return pf.pick_columns(columns, ["EXTRA"], ["file_path"]).select(
        "file_path", "column_name", "data_type", "type_group", "rank")


# Pairs of statistics of every kind: equal, close, far, blank, no numbers, tiny, infinite.
_PAIRS = """SELECT l_orderkey, l_linenumber, l_extendedprice,
  CASE WHEN l_orderkey % 11 = 0 THEN 'null' WHEN l_orderkey % 11 = 1 THEN 'abc' WHEN l_orderkey % 11 = 2 THEN '0.00000000001'
       WHEN l_orderkey % 11 = 3 THEN ' 7.50 ' ELSE CAST(CAST(l_extendedprice AS decimal(18,2)) AS string) END AS a,
  CASE WHEN l_orderkey % 11 = 0 THEN '' WHEN l_orderkey % 11 = 1 THEN '1' WHEN l_orderkey % 11 = 2 THEN '0'
       WHEN l_orderkey % 11 = 3 THEN '7.5' WHEN l_orderkey % 11 = 4 THEN 'Infinity'
       WHEN l_orderkey % 11 < 7 THEN CAST(CAST(l_extendedprice AS decimal(18,2)) + CAST(0.05 AS decimal(18,2)) AS string)
       WHEN l_orderkey % 11 = 9 THEN CAST(CAST(l_extendedprice AS decimal(18,2)) + CAST(500 AS decimal(18,2)) AS string)
       ELSE CAST(CAST(l_extendedprice AS decimal(18,2)) AS string) END AS b
FROM {lineitem}"""


@query("numeric_tolerance", f"""WITH pairs AS ({_PAIRS.format(lineitem='lineitem')}),
n AS (SELECT *, TRY_CAST(CASE WHEN lower(trim(a)) IN ('null', 'none', '') THEN '0' ELSE trim(a) END AS DOUBLE) AS x,
  TRY_CAST(CASE WHEN lower(trim(b)) IN ('null', 'none', '') THEN '0' ELSE trim(b) END AS DOUBLE) AS y FROM pairs)
SELECT l_orderkey % 11 AS kind, CAST(count(*) AS BIGINT) AS pairs, CAST(count(*) FILTER (
  CASE WHEN a = b THEN true WHEN x IS NULL OR y IS NULL THEN false WHEN x = y THEN true
       WHEN greatest(abs(x), abs(y)) < 1e-10 THEN true WHEN isinf(x) OR isinf(y) THEN false
       ELSE abs(x - y) / greatest(abs(x), abs(y)) * 100.0 <= 0.001 END) AS BIGINT) AS matched
FROM n GROUP BY 1""")
def numeric_tolerance(spark, sf):
    pairs = spark.sql(_PAIRS.format(lineitem=f"parquet.`{sf}/lineitem.parquet`"))
    close = numeric.within_tolerance(F.col("a"), F.col("b"))
    return pairs.groupBy((F.col("l_orderkey") % 11).alias("kind")).agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if(close).alias("matched"))


@query("recon_rollup", """
WITH g AS (SELECT execution_id, table_name, list(DISTINCT recon_type) AS types, list(DISTINCT status) AS st FROM results GROUP BY 1, 2),
j AS (SELECT *, list_has_all(types, ['ROW_COUNT', 'COLUMN_COUNT', 'SCHEMA_VALIDATION', 'Partiton_Data_count', 'CHECKSUM_VALIDATION', 'VERIFIED'])
  OR list_contains(types, 'data_read_error') AS ran FROM g)
SELECT execution_id, table_name, CASE WHEN ran THEN 'true' ELSE 'false' END AS job_run,
  CASE WHEN ran AND NOT list_contains(st, 'FAIL') AND NOT list_contains(st, 'ERROR') THEN 'PASS'
       WHEN ran AND list_contains(types, 'data_read_error') THEN 'SKIPPED' ELSE 'FAIL' END AS recon_status FROM j""")
def recon_rollup(spark, sf):
    return recon.rollup(view(spark, sf, "results"))


@query("recon_rollup_merge", """
WITH v AS (SELECT execution_id, table_name, bool_or(status IN ('FAIL', 'ERROR')) AS bad, bool_or(recon_type = 'data_read_error') AS unread,
  count(DISTINCT CASE WHEN recon_type <> 'data_read_error' THEN recon_type END) = 6 AS full_set FROM results GROUP BY 1, 2)
SELECT c.table_name, CASE WHEN v.bad IS NULL THEN c.recon_job_run WHEN full_set OR unread THEN 'true' ELSE 'false' END AS recon_job_run,
  CASE WHEN v.bad IS NULL THEN c.recon_status WHEN (full_set OR unread) AND NOT bad THEN 'PASS' WHEN unread THEN 'SKIPPED' ELSE 'FAIL' END AS recon_status,
  v.bad IS NOT NULL AS stamped
FROM candidates c LEFT JOIN v ON c.execution_id = v.execution_id AND c.table_name = v.table_name""")
def recon_rollup_merge(spark, sf):
    candidates = view(spark, sf, "candidates").withColumn("recon_execution_time", F.lit(None).cast("timestamp"))
    merged = recon.merge_rollup(candidates, recon.rollup(view(spark, sf, "results")))
    return merged.select("table_name", "recon_job_run", "recon_status",
                         F.col("recon_execution_time").isNotNull().alias("stamped"))


@query("recon_full", f"""WITH {_COUNTS}, {_LATEST}, {_HASHED.format(by='', row=_ROW, src='ls', tgt='lt')},
k AS ({_CHECKSUM.format(by='', extra='', group='')}),
p AS ({_profile_sql('ls')}), q AS ({_profile_sql('lt')}), {_COMPARED.format(tol=0.001)}
SELECT 'ROW_COUNT' AS recon_type, CASE WHEN sum(source_count) = sum(target_count) THEN 'PASS' ELSE 'FAIL' END AS status,
  CAST(sum(source_count) AS VARCHAR) AS source_metrics, CAST(sum(target_count) AS VARCHAR) AS target_metrics, CAST(0 AS INTEGER) AS metrics_different FROM c
UNION ALL SELECT 'COLUMN_COUNT', 'PASS', '9', '9', 0
UNION ALL SELECT 'SCHEMA_VALIDATION', 'PASS', NULL, NULL, 0
UNION ALL SELECT 'Partiton_Data_count', CASE WHEN bool_and(source_count > 0 AND target_count > 0) THEN 'PASS' ELSE 'FAIL' END,
  CAST(count(*) FILTER (source_count > 0) AS VARCHAR), CAST(count(*) FILTER (target_count > 0) AS VARCHAR), 0 FROM c
UNION ALL SELECT 'PARTITION_RECORD_COUNT', CASE WHEN bool_and(source_count = target_count) THEN 'PASS' ELSE 'FAIL' END,
  CAST(count(*) AS VARCHAR), CAST(count(*) AS VARCHAR), CAST(count(*) FILTER (source_count <> target_count) AS INTEGER) FROM c
UNION ALL SELECT 'CHECKSUM_VALIDATION', status, CAST(source_record_count AS VARCHAR), CAST(target_record_count AS VARCHAR),
  CAST(source_distinct - matched_record_count AS INTEGER) FROM k
UNION ALL SELECT 'VERIFIED', CASE WHEN bool_and(matched) THEN 'PASS' ELSE 'FAIL' END, NULL, NULL, CAST(count(*) FILTER (NOT matched) AS INTEGER) FROM cmp""")
def recon_full(spark, sf):
    rows = reconcile_pair(*pair(spark, sf), "lineitem", "r", PartitionSpec(floor=None), extra=True)
    long_text = F.col("recon_type").isin("SCHEMA_VALIDATION", "VERIFIED")
    return rows.select("recon_type", "status", *[
        F.when(~long_text, F.col(c)).alias(c) for c in ("source_metrics", "target_metrics")], "metrics_different")
