"""Inventory, merge, partition and claim operators."""
from __future__ import annotations

from pyspark.sql import functions as F

from lakeproof.functions import paths
from lakeproof.operators import inventory as inv, merge, partitions as parts
from lakeproof.plans import migrate
from lakeproof.sources.reports import latest_reports
from queries.registry import query
from queries.views import table, view


def listing(spark, sf):
    """Inventory rows before parsing, as a lister would deliver them."""
    return view(spark, sf, "inv_src").select(
        F.col("bucket").alias("s3_bucket_name"), F.col("prefix").alias("bucket_prefix"),
        F.concat(F.lit("s3://"), "bucket", F.lit("/"), "key").alias("path"), "size",
        F.col("modified").alias("last_modified_time"), "seed")


@query("inv_key_parse", r"""
SELECT key, nullif(CASE WHEN contains(regexp_extract(key, '([^/]*)$', 1), '.')
       THEN regexp_extract(key, '\.([^./]*)$', 1) END, '') AS extension,
       nullif(array_to_string(regexp_extract_all(lower(key), '([a-zA-Z0-9_]+)=', 1), ', '), '') AS partition_key,
       nullif(regexp_extract(key, '(?i)run_id=([^/]+)', 1), '') AS run_id,
       TRY_CAST(nullif(regexp_extract(key, '(?i)snapshot_date=([^/]+)', 1), '') AS DATE) AS snapshot_date,
       regexp_extract(prefix, '([^/]+)/?$', 1) AS dataset_name
FROM inv_src""")
def inv_key_parse(spark, sf):
    return inv.parse_keys(listing(spark, sf)).select(
        "key", "extension", "partition_key", "run_id", "snapshot_date",
        paths.dataset_name("bucket_prefix").alias("dataset_name"))


@query("inv_partition_path", r"""
SELECT DISTINCT s3_bucket_name, bucket_prefix,
       concat('s3://', s3_bucket_name, '/', regexp_replace(key, '/[^/]*$', '')) AS partition_path,
       run_id, snapshot_date
FROM inventory
WHERE load_status IS NULL AND extension IS NOT NULL AND lower(partition_key) = 'run_id, snapshot_date'""")
def inv_partition_path(spark, sf):
    return parts.partition_rows(parts.work_files(view(spark, sf, "inventory")))


@query("inv_partition_structure", r"""
SELECT bucket_prefix, array_to_string(list_sort(regexp_extract_all(key, '([^/]+)=[^/]+', 1)), '/') AS structure,
       CAST(count(*) AS BIGINT) AS files
FROM inventory GROUP BY 1, 2""")
def inv_partition_structure(spark, sf):
    structure = paths.partition_structure("key").alias("structure")
    return view(spark, sf, "inventory").groupBy("bucket_prefix", structure).agg(
        F.count(F.lit(1)).alias("files"))


@query("inv_new_rows", r"""
WITH stored AS (
  SELECT s3_bucket_name, bucket_prefix, max(last_modified_time) AS upto FROM inventory
  WHERE seed % 2 = 0 AND last_modified_time < TIMESTAMP '1999-01-01' AND bucket_prefix <> 'trusted/ds_4/'
  GROUP BY 1, 2)
SELECT 'run-x' AS execution_id, i.s3_bucket_name, i.bucket_prefix, i.key, i.extension, i.size,
       i.last_modified_time, i.partition_key, i.run_id, i.snapshot_date, CAST(NULL AS VARCHAR) AS load_status
FROM inventory i
JOIN dataset_mapping m ON i.s3_bucket_name = m.s3_bucket_name AND i.bucket_prefix = m.bucket_prefix
LEFT JOIN stored s ON i.s3_bucket_name = s.s3_bucket_name AND i.bucket_prefix = s.bucket_prefix
WHERE s.upto IS NULL OR i.last_modified_time > s.upto""")
def inv_new_rows(spark, sf):
    stored = view(spark, sf, "inventory").filter(
        "seed % 2 = 0 AND last_modified_time < timestamp_ntz '1999-01-01' AND bucket_prefix <> 'trusted/ds_4/'")
    return inv.new_inventory(listing(spark, sf), stored, view(spark, sf, "dataset_mapping"), "run-x")


@query("inv_incremental_late", r"""
WITH stored AS (SELECT * FROM inventory WHERE seed % 2 = 0 AND last_modified_time < TIMESTAMP '1999-01-01'),
marks AS (SELECT s3_bucket_name, bucket_prefix, max(last_modified_time) AS upto FROM stored GROUP BY 1, 2)
SELECT i.key, i.last_modified_time FROM inventory i
LEFT JOIN marks s ON i.s3_bucket_name = s.s3_bucket_name AND i.bucket_prefix = s.bucket_prefix
WHERE (s.upto IS NULL OR i.last_modified_time >= s.upto)
  AND NOT EXISTS (SELECT 1 FROM stored t WHERE t.s3_bucket_name = i.s3_bucket_name
                  AND t.bucket_prefix = i.bucket_prefix AND t.key = i.key)""")
def inv_incremental_late(spark, sf):
    all_files = view(spark, sf, "inventory")
    stored = all_files.filter("seed % 2 = 0 AND last_modified_time < timestamp_ntz '1999-01-01'")
    return inv.newer_files(all_files, stored, late=True).select("key", "last_modified_time")


@query("inv_candidate_metrics", """
SELECT s3_bucket_name, bucket_prefix, CAST(count(*) AS BIGINT) AS total_file_count,
       round(CAST(sum(size) AS DOUBLE) / 1048576.0, 2) AS table_file_size_mb,
       CAST(count(extension) AS BIGINT) AS structured_file_count
FROM inventory WHERE load_status IS NULL GROUP BY 1, 2""")
def inv_candidate_metrics(spark, sf):
    return inv.candidate_metrics(view(spark, sf, "inventory"))


# One dataset per customer, so that the upsert has many keys on both sides.
_PER_CUSTOMER = """
SELECT concat('bkt-', cast(o_custkey % 2 AS string)) AS s3_bucket_name,
       concat('trusted/c_', cast(o_custkey AS string), '/') AS bucket_prefix,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'parquet' END AS extension,
       cast(round(o_totalprice * 100) AS bigint) AS size, cast(NULL AS string) AS load_status
FROM {orders}"""
_UPSERT_TARGET = """
SELECT 'run-0' AS execution_id, concat('bkt-', cast(c_custkey % 2 AS string)) AS s3_bucket_name,
       concat('trusted/c_', cast(c_custkey AS string), '/') AS bucket_prefix,
       concat('c_', cast(c_custkey AS string)) AS table_name, cast(7 AS bigint) AS total_file_count,
       cast(1.5 AS double) AS table_file_size_mb, cast(5 AS bigint) AS structured_file_count,
       CASE WHEN c_custkey % 3 = 0 THEN 'true' ELSE NULL END AS candidate_for_managed_table_creation,
       CASE WHEN c_custkey % 6 = 0 THEN 'true' ELSE NULL END AS managed_table_created
FROM {customer} WHERE c_custkey % 4 <> 0"""


@query("candidate_upsert", f"""
WITH files AS ({_PER_CUSTOMER.format(orders='orders')}),
target AS ({_UPSERT_TARGET.format(customer='customer')}),
metrics AS (SELECT s3_bucket_name, bucket_prefix, CAST(count(*) AS BIGINT) AS n,
            round(CAST(sum(size) AS DOUBLE) / 1048576.0, 2) AS mb, CAST(count(extension) AS BIGINT) AS k
            FROM files GROUP BY 1, 2)
SELECT t.execution_id, t.s3_bucket_name, t.bucket_prefix, t.table_name,
       CASE WHEN m.n IS NOT NULL AND t.candidate_for_managed_table_creation IS NULL THEN m.n ELSE t.total_file_count END AS total_file_count,
       CASE WHEN m.n IS NOT NULL AND t.candidate_for_managed_table_creation IS NULL THEN m.mb ELSE t.table_file_size_mb END AS table_file_size_mb,
       CASE WHEN m.n IS NOT NULL AND t.candidate_for_managed_table_creation IS NULL THEN m.k ELSE t.structured_file_count END AS structured_file_count,
       t.candidate_for_managed_table_creation, t.managed_table_created
FROM target t LEFT JOIN metrics m ON t.s3_bucket_name = m.s3_bucket_name AND t.bucket_prefix = m.bucket_prefix
UNION ALL
SELECT 'run-x', s3_bucket_name, bucket_prefix, regexp_extract(bucket_prefix, '([^/]+)/?$', 1), n, mb, k, NULL, NULL
FROM metrics m WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.s3_bucket_name = m.s3_bucket_name
  AND t.bucket_prefix = m.bucket_prefix AND t.candidate_for_managed_table_creation IS NULL)""")
def candidate_upsert(spark, sf):
    files = spark.sql(_PER_CUSTOMER.format(orders=f"parquet.`{sf}/orders.parquet`"))
    target = spark.sql(_UPSERT_TARGET.format(customer=f"parquet.`{sf}/customer.parquet`"))
    return inv.upsert_candidates(target, inv.candidate_metrics(files), "run-x")


@query("mapping_insert_absent", """
WITH incoming AS (SELECT table_name AS dataset_name, s3_bucket_name, bucket_prefix, 'new' AS dbx_catalog,
                  'new' AS dbx_managed_table_schema FROM candidates)
SELECT * FROM mapping UNION ALL
SELECT * FROM incoming i WHERE NOT EXISTS (SELECT 1 FROM mapping m WHERE m.dataset_name = i.dataset_name
  AND m.s3_bucket_name = i.s3_bucket_name AND m.bucket_prefix = i.bucket_prefix)""")
def mapping_insert_absent(spark, sf):
    incoming = view(spark, sf, "candidates").select(
        F.col("table_name").alias("dataset_name"), "s3_bucket_name", "bucket_prefix",
        F.lit("new").alias("dbx_catalog"), F.lit("new").alias("dbx_managed_table_schema"))
    return inv.add_mappings(view(spark, sf, "mapping"), incoming)


_STATUS = """SELECT s3_bucket_name AS bucket_name, bucket_prefix, run_id, snapshot_date,
  CASE WHEN month(snapshot_date) % 4 = 0 THEN 'failed' ELSE 'loaded' END AS load_status
FROM inventory WHERE snapshot_date IS NOT NULL AND run_id <> 'R3' AND extension IS NOT NULL"""


@query("load_status_merge", f"""
WITH status AS (SELECT bucket_name, bucket_prefix, run_id, snapshot_date, min(load_status) AS s
                FROM ({_STATUS}) x GROUP BY 1, 2, 3, 4)
SELECT i.key, CASE WHEN i.load_status IS NULL AND s.s IS NOT NULL THEN s.s ELSE i.load_status END AS load_status
FROM inventory i LEFT JOIN status s ON i.s3_bucket_name = s.bucket_name AND i.bucket_prefix = s.bucket_prefix
  AND i.run_id = s.run_id AND i.snapshot_date = s.snapshot_date""")
def load_status_merge(spark, sf):
    inventory = view(spark, sf, "inventory")
    named = inventory.filter("snapshot_date IS NOT NULL AND run_id <> 'R3' AND extension IS NOT NULL")
    status = named.select(
        F.col("s3_bucket_name").alias("bucket_name"), "bucket_prefix", "run_id", "snapshot_date",
        F.when(F.month("snapshot_date") % 4 == 0, F.lit("failed")).otherwise(F.lit("loaded"))
        .alias("load_status"))
    return migrate.record_status(inventory, status).select("key", "load_status")


@query("report_supersede", """
WITH fresh AS (SELECT bucket_name, prefix, path, max(name) AS name FROM reports WHERE half = 1 GROUP BY 1, 2, 3)
SELECT t.bucket_name, t.prefix, t.path, t.name,
       CASE WHEN f.path IS NOT NULL AND t.processed = 'false' THEN 'ignored' ELSE t.processed END AS processed,
       CASE WHEN f.path IS NOT NULL AND t.processed = 'false' THEN concat(t.runId, ':run-7') ELSE t.runId END AS runId
FROM report_list t LEFT JOIN fresh f ON t.bucket_name = f.bucket_name AND t.prefix = f.prefix AND t.path = f.path
UNION ALL SELECT bucket_name, prefix, path, name, 'false', 'run-7' FROM fresh""")
def report_supersede(spark, sf):
    fresh = latest_reports(view(spark, sf, "reports").filter("half = 1").drop("half"))
    return merge.supersede(view(spark, sf, "report_list"), fresh, ["bucket_name", "prefix", "path"], "run-7")


@query("report_mark_done", """
WITH done AS (SELECT DISTINCT bucket_name, path FROM reports WHERE half = 1 AND substr(path, -1) <> '9')
SELECT t.bucket_name, t.prefix, t.path, t.name,
       CASE WHEN d.path IS NOT NULL AND t.processed = 'false' THEN 'true' ELSE t.processed END AS processed,
       CASE WHEN d.path IS NOT NULL AND t.processed = 'false' THEN 'run-8' ELSE t.runId END AS runId
FROM report_list t LEFT JOIN done d ON t.bucket_name = d.bucket_name AND t.path = d.path""")
def report_mark_done(spark, sf):
    done = view(spark, sf, "reports").filter("half = 1 AND substr(path, -1) <> '9'")
    return merge.mark_done(view(spark, sf, "report_list"), done, ["bucket_name", "path"], "run-8")


@query("latest_report", """
SELECT path, max(name) AS name FROM reports GROUP BY 1""")
def latest_report(spark, sf):
    reports = view(spark, sf, "reports").drop("half").distinct()
    return latest_reports(reports).select("path", "name")


@query("claim_release", """
SELECT * FROM claims WHERE NOT (execution_id = 'run-1' AND s3_bucket_name = 'bkt-0')""")
def claim_release(spark, sf):
    gone = (F.col("execution_id") == "run-1") & (F.col("s3_bucket_name") == "bkt-0")
    return merge.delete_where(view(spark, sf, "claims"), gone)


@query("flag_update", """
SELECT bucket_prefix, CASE WHEN managed_table_created IS NULL AND s3_bucket_name = 'bkt-1' THEN 'true'
       ELSE managed_table_created END AS managed_table_created,
       CASE WHEN managed_table_created IS NULL AND s3_bucket_name = 'bkt-1' THEN 'noted'
       ELSE error_message END AS error_message
FROM candidates""")
def flag_update(spark, sf):
    open_ones = F.col("managed_table_created").isNull() & (F.col("s3_bucket_name") == "bkt-1")
    changed = merge.update_where(view(spark, sf, "candidates"), open_ones,
                                 {"managed_table_created": "true", "error_message": "noted"})
    return changed.select("bucket_prefix", "managed_table_created", "error_message")


_BLESSED = r"""WITH p AS (SELECT DISTINCT s3_bucket_name, bucket_prefix,
  concat('s3://', s3_bucket_name, '/', regexp_replace(key, '/[^/]*$', '')) AS partition_path, run_id, snapshot_date
  FROM inventory WHERE {status} AND extension IS NOT NULL AND partition_key = 'run_id, snapshot_date'),
b AS (SELECT DISTINCT p.*, regexp_extract(bucket_prefix, '([^/]+)/?$', 1) AS dataset_name FROM p
  WHERE EXISTS (SELECT 1 FROM tags t WHERE lower(run_tag_key) = 'snapshot_date'
    AND t.dataset_name = regexp_extract(bucket_prefix, '([^/]+)/?$', 1) AND t.run_id = p.run_id
    AND TRY_CAST(t.run_tag_value AS DATE) = p.snapshot_date)) """


@query("load_plan", _BLESSED.format(status="load_status IS NULL") + "SELECT * FROM b")
def load_plan(spark, sf):
    return parts.load_plan(view(spark, sf, "inventory"), view(spark, sf, "tags"))


@query("blessed_partitions", r"""
SELECT DISTINCT s3_bucket_name, bucket_prefix, run_id, snapshot_date FROM inventory i
WHERE snapshot_date IS NOT NULL AND EXISTS (SELECT 1 FROM tags t WHERE lower(run_tag_key) = 'snapshot_date'
  AND t.run_id = i.run_id AND TRY_CAST(t.run_tag_value AS DATE) = i.snapshot_date)""")
def blessed_partitions(spark, sf):
    pairs = view(spark, sf, "inventory").select(
        "s3_bucket_name", "bucket_prefix", "run_id", "snapshot_date").distinct()
    return parts.blessed_partitions(pairs, view(spark, sf, "tags"), by_dataset=False)


@query("latest_snapshot", _BLESSED.format(status="load_status = 'loaded'") + """
SELECT bucket_prefix, snapshot_date, run_id FROM (SELECT *, row_number() OVER (PARTITION BY bucket_prefix
  ORDER BY snapshot_date DESC, run_id DESC) AS n FROM b) x WHERE n = 1""")
def latest_snapshot(spark, sf):
    loaded = parts.work_files(view(spark, sf, "inventory"), status=F.col("load_status") == "loaded")
    blessed = parts.blessed_partitions(parts.partition_rows(loaded), view(spark, sf, "tags"))
    return parts.latest_snapshot(blessed, ["bucket_prefix"])


@query("latest_n_partitions", """
SELECT DISTINCT bucket_prefix, snapshot_date, run_id FROM (
  SELECT *, dense_rank() OVER (PARTITION BY bucket_prefix ORDER BY snapshot_date DESC, run_id DESC) AS n
  FROM inventory WHERE snapshot_date IS NOT NULL) x WHERE n <= 5""")
def latest_n_partitions(spark, sf):
    dated = view(spark, sf, "inventory").filter("snapshot_date IS NOT NULL")
    return parts.latest_partitions(dated, ["snapshot_date", "run_id"], 5, ["bucket_prefix"])


@query("restrict_to_latest", """
WITH top AS (SELECT DISTINCT snapshot_date, run_id FROM recon_src ORDER BY 1 DESC, 2 DESC LIMIT 3)
SELECT s.* FROM recon_src s JOIN top t ON s.snapshot_date = t.snapshot_date AND s.run_id = t.run_id""")
def restrict_to_latest(spark, sf):
    rows = view(spark, sf, "recon_src")
    columns = ["snapshot_date", "run_id"]
    return parts.restrict(rows, parts.latest_partitions(rows, columns, 3), columns, at_most=3)


@query("newest_rows", """
SELECT i.key, i.bucket_prefix, i.last_modified_time FROM inventory i
JOIN (SELECT bucket_prefix, max(last_modified_time) AS t FROM inventory GROUP BY 1) m
  ON i.bucket_prefix = m.bucket_prefix AND i.last_modified_time = m.t""")
def newest_rows(spark, sf):
    return parts.newest_rows(view(spark, sf, "inventory"), ["bucket_prefix"]).select(
        "key", "bucket_prefix", "last_modified_time")


@query("failed_partitions", r"""
SELECT DISTINCT i.execution_id, i.s3_bucket_name, i.bucket_prefix, i.run_id, i.snapshot_date,
       regexp_extract(i.bucket_prefix, '([^/]+)/?$', 1) AS dataset_name,
       concat('s3://', i.s3_bucket_name, '/', regexp_replace(key, '/[^/]*$', '')) AS partition_path,
       m.dbx_managed_table_schema AS managed_schema
FROM inventory i LEFT JOIN dataset_mapping m ON i.s3_bucket_name = m.s3_bucket_name
 AND i.bucket_prefix = m.bucket_prefix AND regexp_extract(i.bucket_prefix, '([^/]+)/?$', 1) = m.dataset_name
WHERE load_status = 'failed' AND extension IS NOT NULL AND partition_key = 'run_id, snapshot_date'
  AND snapshot_date >= DATE '2000-01-01'""")
def failed_partitions(spark, sf):
    from lakeproof import PartitionSpec
    return parts.failed_partitions(view(spark, sf, "inventory"), view(spark, sf, "dataset_mapping"),
                                   PartitionSpec(floor="2000-01-01"))


@query("unclaimed", """
SELECT DISTINCT execution_id, s3_bucket_name, bucket_prefix, table_name FROM candidates c
WHERE candidate_for_managed_table_creation IN ('true', 'false') AND managed_table_created IS NULL
  AND structured_file_count BETWEEN 3 AND 30
  AND NOT EXISTS (SELECT 1 FROM claims k WHERE k.migration_status = 'picked_up_for_migration'
    AND k.execution_id = c.execution_id AND k.s3_bucket_name = c.s3_bucket_name
    AND k.bucket_prefix = c.bucket_prefix)""")
def unclaimed(spark, sf):
    return parts.claimable(view(spark, sf, "candidates"), view(spark, sf, "claims"), 3, 30)


@query("claim_rows", """
SELECT execution_id, s3_bucket_name, bucket_prefix, table_name, 'picked_up_for_migration' AS migration_status
FROM candidates c WHERE candidate_for_managed_table_creation IN ('true', 'false') AND managed_table_created IS NULL
  AND NOT EXISTS (SELECT 1 FROM claims k WHERE k.migration_status = 'picked_up_for_migration'
    AND k.execution_id = c.execution_id AND k.s3_bucket_name = c.s3_bucket_name
    AND k.bucket_prefix = c.bucket_prefix)""")
def claim_rows(spark, sf):
    return parts.claim(view(spark, sf, "candidates"), view(spark, sf, "claims")).drop("datetime")


@query("eligible_candidates", """
SELECT execution_id, bucket_prefix FROM candidates WHERE managed_table_created IS NULL
  AND candidate_for_managed_table_creation IS NULL AND s3_bucket_name = 'bkt-1'
  AND structured_file_count BETWEEN 5 AND 35""")
def eligible_candidates(spark, sf):
    return inv.eligible_candidates(view(spark, sf, "candidates"), "bkt-1", 5, 35).select(
        "execution_id", "bucket_prefix")


@query("table_targets", """
SELECT s3_bucket_name, bucket_prefix, dataset_name,
       concat(dbx_catalog, '.', dbx_managed_table_schema, '.', dataset_name) AS managed_table_name,
       concat('s3://', s3_bucket_name, '/', bucket_prefix) AS root_path FROM mapping""")
def table_targets(spark, sf):
    return parts.table_targets(view(spark, sf, "mapping"))


@query("layout_guard", r"""
WITH r AS (SELECT key, concat('/vol/', s3_bucket_name, '/', key) AS volume_path_key FROM inventory
           WHERE s3_bucket_name = 'bkt-1')
SELECT key, volume_path_key,
  regexp_matches(volume_path_key, '/run_id=[^/]+/snapshot_date=[^/]+/')
  AND NOT regexp_matches(volume_path_key, 'snapshot_date=[^/]+/.*snapshot_date=') AS loadable
FROM r""")
def layout_guard(spark, sf):
    inventory = view(spark, sf, "inventory")
    roots = inventory.select("s3_bucket_name").distinct().filter("s3_bucket_name = 'bkt-1'").select(
        "s3_bucket_name", F.concat(F.lit("/vol/"), "s3_bucket_name").alias("volume_name"))
    rooted = parts.with_roots(inventory, roots)
    return rooted.select("key", "volume_path_key", paths.hive_layout("volume_path_key").alias("loadable"))


@query("reconciliation_work", """
SELECT k.execution_id, m.dbx_catalog AS target_catalog_name, m.dbx_managed_table_schema AS target_schema_name,
       m.dataset_name AS target_table_name, m.s3_bucket_name AS source_s3_bucket,
       m.bucket_prefix AS source_bucket_prefix
FROM mapping m JOIN (SELECT DISTINCT table_name, s3_bucket_name, bucket_prefix, execution_id FROM candidates
  WHERE managed_table_created = 'true' AND recon_job_run IS NULL AND s3_bucket_name = 'bkt-1') k
  ON m.dataset_name = k.table_name AND m.s3_bucket_name = k.s3_bucket_name AND m.bucket_prefix = k.bucket_prefix""")
def reconciliation_work(spark, sf):
    return parts.reconciliation_work(view(spark, sf, "mapping"), view(spark, sf, "candidates"),
                                     "bkt-1", only_open=True)


@query("source_rows", """
SELECT s.* FROM recon_src s
WHERE s.snapshot_date >= DATE '1998-01-01'
  AND EXISTS (SELECT 1 FROM tags t WHERE t.dataset_name = 'ds_2' AND lower(t.run_tag_key) = 'snapshot_date'
    AND TRY_CAST(t.run_tag_value AS DATE) = s.snapshot_date AND t.run_id = s.run_id)
  AND EXISTS (SELECT 1 FROM inventory i WHERE i.load_status IN ('loaded', 'failed') AND i.extension IS NOT NULL
    AND i.bucket_prefix = 'trusted/ds_2/' AND i.snapshot_date = s.snapshot_date AND i.run_id = s.run_id)""")
def source_rows(spark, sf):
    from lakeproof import PartitionSpec
    inventory = view(spark, sf, "inventory").filter("bucket_prefix = 'trusted/ds_2/'")
    return parts.source_rows(view(spark, sf, "recon_src"), view(spark, sf, "tags"), inventory, "ds_2",
                             PartitionSpec(floor="1998-01-01"))


@query("remediation_summary", r"""
WITH f AS (SELECT DISTINCT s3_bucket_name, bucket_prefix, run_id, snapshot_date FROM inventory
           WHERE load_status = 'failed' AND extension IS NOT NULL AND snapshot_date IS NOT NULL),
o AS (SELECT *, CASE WHEN month(snapshot_date) = 5 AND bucket_prefix = 'trusted/ds_2/' THEN 'failed' ELSE 'loaded' END AS st FROM f)
SELECT s3_bucket_name, bucket_prefix, regexp_extract(bucket_prefix, '([^/]+)/?$', 1) AS dataset_name,
       CAST(count(*) AS INTEGER) AS partitions_attempted,
       CAST(count(*) FILTER (st = 'loaded') AS INTEGER) AS partitions_remediated,
       CAST(count(*) FILTER (st = 'failed') AS INTEGER) AS partitions_failed,
       CASE WHEN count(*) FILTER (st = 'failed') = 0 THEN 'PASS' ELSE 'FAIL' END AS remediation_status
FROM o GROUP BY 1, 2, 3""")
def remediation_summary(spark, sf):
    failed = view(spark, sf, "inventory").filter(
        "load_status = 'failed' AND extension IS NOT NULL AND snapshot_date IS NOT NULL")
    rows = failed.select("s3_bucket_name", "bucket_prefix", "run_id", "snapshot_date").distinct()
    bad = (F.month("snapshot_date") == 5) & (F.col("bucket_prefix") == "trusted/ds_2/")
    outcome = rows.select(
        "*", F.lit("run-1").alias("execution_id"), paths.dataset_name("bucket_prefix").alias("dataset_name"),
        F.concat_ws("/", "run_id", F.col("snapshot_date").cast("string")).alias("partition_path"),
        F.when(bad, F.lit("failed")).otherwise(F.lit("loaded")).alias("load_status"))
    return migrate.remediation_summary(outcome).select(
        "s3_bucket_name", "bucket_prefix", "dataset_name", "partitions_attempted",
        "partitions_remediated", "partitions_failed", "remediation_status")


@query("remediation_reopen", """
WITH summary AS (SELECT concat('run-', cast(c_custkey % 3 AS string)) AS execution_id,
    concat('c_', cast(c_custkey AS string)) AS table_name, c_custkey % 7 AS failed FROM customer WHERE c_custkey % 2 = 0)
SELECT c.bucket_prefix, CASE WHEN s.failed = 0 THEN NULL ELSE c.recon_job_run END AS recon_job_run
FROM candidates c LEFT JOIN summary s ON c.execution_id = s.execution_id AND c.table_name = s.table_name""")
def remediation_reopen(spark, sf):
    customers = table(spark, sf, "customer").filter("c_custkey % 2 = 0")
    summary = customers.select(
        F.expr("concat('run-', c_custkey % 3)").alias("execution_id"),
        F.expr("concat('c_', c_custkey)").alias("dataset_name"),
        F.lit(9).cast("bigint").alias("partitions_attempted"),
        F.expr("9 - c_custkey % 7").alias("partitions_remediated"),
        F.expr("c_custkey % 7").alias("partitions_failed"))
    return migrate.reopen(view(spark, sf, "candidates"), summary).select("bucket_prefix", "recon_job_run")
