"""Input views derived from the given tables, in SQL both engines understand.

``@name@`` stands for a given table.  Every residue class of a key is one kind of defect.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, str] = {}

VIEWS["inv_src"] = """
SELECT concat('bkt-', cast(o_orderkey % 5 % 2 AS string)) AS bucket,
       concat('trusted/ds_', cast(o_orderkey % 5 AS string), '/') AS prefix,
       concat('trusted/ds_', cast(o_orderkey % 5 AS string), '/',
         CASE WHEN o_orderkey % 17 = 0 THEN 'loose/'
              WHEN o_orderkey % 13 = 0 THEN concat('run_id=R', cast(o_custkey % 4 AS string), '/')
              ELSE concat(CASE WHEN o_custkey % 2 = 0 THEN 'RUN_ID=R' ELSE 'run_id=R' END,
                          cast(o_custkey % 4 AS string), '/snapshot_date=',
                          cast(cast(date_trunc('month', o_orderdate) AS date) AS string), '/') END,
         CASE WHEN o_orderkey % 11 = 0 THEN concat('_SUCCESS_', cast(o_orderkey AS string))
              ELSE concat('part-', cast(o_orderkey AS string),
                          CASE WHEN o_orderkey % 7 = 0 THEN '.csv' ELSE '.parquet' END) END) AS key,
       cast(round(o_totalprice * 100) AS bigint) AS size,
       o_orderdate AS modified, o_orderkey AS seed,
       concat('R', cast(o_custkey % 4 AS string)) AS run
FROM @orders@"""

# missing (19), other size (23), older than source (29), extra (31), same etag broken (37)
VIEWS["inv_dst"] = """
SELECT 'bkt-copy' AS bucket, prefix, key,
       size + CASE WHEN seed % 23 = 0 THEN 1 ELSE 0 END AS size,
       CASE WHEN seed % 29 = 0 THEN modified - INTERVAL '1' DAY
            ELSE modified + INTERVAL '1' DAY END AS modified, seed
FROM inv_src WHERE seed % 19 <> 0
UNION ALL
SELECT 'bkt-copy', prefix, concat(key, '.extra'), size, modified, seed
FROM inv_src WHERE seed % 31 = 0"""

# The inventory with keys already parsed: input of everything after the parsing step.
VIEWS["inventory"] = """
SELECT concat('run-', cast(seed % 3 AS string)) AS execution_id, bucket AS s3_bucket_name,
       prefix AS bucket_prefix, key,
       CASE WHEN seed % 11 = 0 THEN NULL WHEN seed % 7 = 0 THEN 'csv' ELSE 'parquet' END AS extension,
       size, modified AS last_modified_time,
       CASE WHEN seed % 17 = 0 THEN NULL WHEN seed % 13 = 0 THEN 'run_id'
            ELSE 'run_id, snapshot_date' END AS partition_key,
       CASE WHEN seed % 17 = 0 THEN NULL ELSE run END AS run_id,
       CASE WHEN seed % 17 = 0 OR seed % 13 = 0 THEN NULL
            ELSE cast(date_trunc('month', modified) AS date) END AS snapshot_date,
       CASE WHEN seed % 6 = 1 THEN 'loaded' WHEN seed % 6 = 2 THEN 'failed' ELSE NULL END AS load_status, seed
FROM inv_src"""

VIEWS["tags"] = """
SELECT DISTINCT concat('ds_', cast(o_orderkey % 5 AS string)) AS dataset_name,
       concat('R', cast(o_custkey % 4 AS string)) AS run_id,
       CASE WHEN o_custkey % 3 = 0 THEN 'SNAPSHOT_DATE' ELSE 'snapshot_date' END AS run_tag_key,
       CASE WHEN o_orderkey < 5 THEN 'not-a-date'
            ELSE cast(cast(date_trunc('month', o_orderdate) AS date) AS string) END AS run_tag_value
FROM @orders@ WHERE o_orderkey % 4 <> 0"""

VIEWS["recon_src"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag,
       cast(l_quantity AS decimal(18,2)) AS quantity,
       cast(l_extendedprice AS decimal(18,2)) AS price,
       cast(l_shipdate AS date) AS ship_date,
       concat('R', cast(l_suppkey % 4 AS string)) AS run_id,
       cast(date_trunc('month', l_shipdate) AS date) AS snapshot_date
FROM @lineitem@"""

# dropped (97), changed value (89), duplicated (101)
VIEWS["recon_tgt"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag,
       cast(quantity + CASE WHEN l_orderkey % 89 = 0 THEN 1 ELSE 0 END AS decimal(18,2)) AS quantity,
       price, ship_date, run_id, snapshot_date
FROM recon_src WHERE l_orderkey % 97 <> 0
UNION ALL
SELECT * FROM recon_src WHERE l_orderkey % 101 = 0"""

# corrupted (50), other type (20), other precision (30), missing column (33), extra column (35)
VIEWS["schema_catalog"] = """
SELECT concat('trusted/', lower(replace(p_brand, '#', '_')), '/') AS bucket_prefix,
       'run-1' AS execution_id,
       concat('trusted/', lower(replace(p_brand, '#', '_')), '/run_id=R',
              cast(p_partkey % 3 AS string), '/snapshot_date=2024-01-',
              substr(concat('0', cast(1 + p_partkey % 28 AS string)), -2, 2), '/',
              cast(p_partkey AS string)) AS file_path,
       CASE WHEN p_partkey % 50 = 0 THEN 'corrupted'
            WHEN p_partkey % 20 = 0 THEN '{"fields":[{"name":"amt","nullable":true,"type":"string"},{"name":"id","nullable":true,"type":"long"}],"type":"struct"}'
            WHEN p_partkey % 30 = 0 THEN '{"fields":[{"name":"amt","nullable":true,"type":"DecimalType(10,2)"},{"name":"id","nullable":true,"type":"int64"}],"type":"struct"}'
            WHEN p_partkey % 33 = 0 THEN '{"fields":[{"name":"amt","nullable":true,"type":"decimal(18,2)"}],"type":"struct"}'
            WHEN p_partkey % 35 = 0 THEN '{"fields":[{"name":"amt","nullable":true,"type":"decimal(18,2)"},{"name":"extra","nullable":true,"type":"TimestampNTZType()"},{"name":"id","nullable":true,"type":"LongType()"}],"type":"struct"}'
            ELSE '{"fields":[{"name":"amt","nullable":true,"type":"decimal(18,2)"},{"name":"id","nullable":true,"type":"long"}],"type":"struct"}' END AS schema_json,
       p_partkey % 50 = 0 AS is_corrupted, p_partkey AS seed
FROM @part@"""

# What each captured schema above holds, spelled out for the oracle side.
VIEWS["catalog_columns"] = """
SELECT bucket_prefix, file_path, seed, 'amt' AS column_name,
       CASE WHEN seed % 20 = 0 THEN 'string' WHEN seed % 30 = 0 THEN 'decimal(10,2)'
            ELSE 'decimal(18,2)' END AS data_type
FROM schema_catalog WHERE seed % 50 <> 0
UNION ALL
SELECT bucket_prefix, file_path, seed, 'id', 'bigint' FROM schema_catalog
WHERE seed % 50 <> 0 AND (seed % 33 <> 0 OR seed % 20 = 0 OR seed % 30 = 0)
UNION ALL
SELECT bucket_prefix, file_path, seed, 'extra', 'timestamp_ntz' FROM schema_catalog
WHERE seed % 50 <> 0 AND seed % 35 = 0 AND seed % 20 <> 0 AND seed % 30 <> 0 AND seed % 33 <> 0"""

# One candidate per customer; decided, created, reconciled and claimed by residue.
VIEWS["candidates"] = """
SELECT concat('run-', cast(c_custkey % 3 AS string)) AS execution_id,
       concat('bkt-', cast(c_nationkey % 2 AS string)) AS s3_bucket_name,
       concat('trusted/c_', cast(c_custkey AS string), '/') AS bucket_prefix,
       concat('c_', cast(c_custkey AS string)) AS table_name,
       c_custkey % 40 AS structured_file_count,
       CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN 'false' ELSE 'true' END
         AS candidate_for_managed_table_creation,
       CASE WHEN c_custkey % 5 = 0 THEN 'true' ELSE NULL END AS managed_table_created,
       cast(NULL AS string) AS error_message,
       CASE WHEN c_custkey % 10 = 0 THEN 'true' ELSE NULL END AS recon_job_run,
       cast(NULL AS string) AS recon_status, c_custkey AS seed
FROM @customer@"""

VIEWS["claims"] = """
SELECT execution_id, s3_bucket_name, bucket_prefix, table_name,
       CASE WHEN seed % 14 = 0 THEN 'done' ELSE 'picked_up_for_migration' END AS migration_status
FROM candidates WHERE seed % 7 = 0"""

VIEWS["mapping"] = """
SELECT table_name AS dataset_name, s3_bucket_name, bucket_prefix,
       'cat' AS dbx_catalog, concat('sch_', cast(seed % 4 AS string)) AS dbx_managed_table_schema
FROM candidates WHERE seed % 3 <> 0"""

# Mapping of the five inventory datasets, one of them unmapped.
VIEWS["dataset_mapping"] = """
SELECT DISTINCT concat('ds_', cast(o_orderkey % 5 AS string)) AS dataset_name,
       concat('bkt-', cast(o_orderkey % 5 % 2 AS string)) AS s3_bucket_name,
       concat('trusted/ds_', cast(o_orderkey % 5 AS string), '/') AS bucket_prefix,
       'cat' AS dbx_catalog, concat('sch_', cast(o_orderkey % 5 AS string)) AS dbx_managed_table_schema
FROM @orders@ WHERE o_orderkey % 5 <> 3"""

# Inventory reports: one family per customer group, one report per month.
VIEWS["reports"] = """
SELECT DISTINCT concat('bkt-', cast(o_custkey % 60 % 7 AS string)) AS bucket_name,
       concat('p', cast(o_custkey % 60 AS string), '/') AS prefix,
       concat('s3://inv/f_', cast(o_custkey % 60 AS string)) AS path,
       cast(cast(date_trunc('month', o_orderdate) AS date) AS string) AS name,
       o_orderkey % 2 AS half
FROM @orders@"""

VIEWS["report_list"] = """
SELECT bucket_name, prefix, path, name,
       CASE WHEN substr(name, 6, 2) IN ('01', '02', '03') THEN 'true'
            WHEN substr(name, 6, 2) IN ('04') THEN 'ignored' ELSE 'false' END AS processed,
       substr(name, 1, 4) AS runId
FROM reports WHERE half = 0 AND path <> 's3://inv/f_5'"""

# Batches of object copies, one per dataset; folder markers (41) and older versions (43).
VIEWS["src_objects"] = """
SELECT concat('batch-', substr(prefix, 12, 1)) AS s3_batch_copy_id, bucket, prefix,
       substr(key, length(prefix) + 1) AS rel_key, size, modified,
       cast(seed % 1000 AS string) AS etag, seed
FROM inv_src
UNION ALL
SELECT concat('batch-', substr(prefix, 12, 1)), bucket, prefix,
       concat('folder_', cast(seed AS string), '/'), 0, modified, 'm', seed
FROM inv_src WHERE seed % 41 = 0
UNION ALL
SELECT concat('batch-', substr(prefix, 12, 1)), bucket, prefix, substr(key, length(prefix) + 1),
       size + 5, modified - INTERVAL '9' DAY, 'old', seed
FROM inv_src WHERE seed % 43 = 0"""

# Batch 4 was copied without loss.
VIEWS["dest_objects"] = """
SELECT concat('batch-', substr(prefix, 12, 1)) AS s3_batch_copy_id, bucket, prefix,
       substr(key, length(prefix) + 1) AS rel_key, size, modified,
       cast(CASE WHEN seed % 37 = 0 THEN -1 ELSE seed % 1000 END AS string) AS etag, seed
FROM inv_dst WHERE prefix <> 'trusted/ds_4/'
UNION ALL
SELECT 'batch-4', 'bkt-copy', prefix, substr(key, length(prefix) + 1), size, modified,
       cast(seed % 1000 AS string), seed
FROM inv_src WHERE prefix = 'trusted/ds_4/'"""

VIEWS["src_current"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s3_batch_copy_id, rel_key
                                            ORDER BY modified DESC) AS nth FROM src_objects) v
WHERE nth = 1"""

VIEWS["object_pairs"] = """
SELECT coalesce(s.s3_batch_copy_id, d.s3_batch_copy_id) AS s3_batch_copy_id,
       coalesce(s.rel_key, d.rel_key) AS rel_key,
       s.size AS src_size, d.size AS dest_size, s.modified AS src_modified,
       d.modified AS dest_modified, s.etag AS src_etag, d.etag AS dest_etag,
       s.bucket AS src_bucket, d.bucket AS dest_bucket,
       s.prefix AS src_prefix, d.prefix AS dest_prefix,
       CASE WHEN d.rel_key IS NULL THEN 'EXISTS_IN_SRC_AND_BUT_NOT_IN_DEST'
            WHEN s.rel_key IS NULL THEN 'EXISTS_IN_DEST_AND_BUT_NOT_IN_SRC'
            WHEN s.modified > d.modified THEN 'FILES_IN_SRC_ARE_NEWER_THAN_DESTINATION'
            WHEN s.size <> d.size THEN 'FILES_IN_DEST_ARE_NEWER_THAN_SRC_AND_NOT_OF_SAME_SIZE'
            ELSE 'EXISTS_IN_SRC_AND_DEST_SAME' END AS status
FROM src_current s FULL JOIN dest_objects d
  ON s.s3_batch_copy_id = d.s3_batch_copy_id AND s.rel_key = d.rel_key
WHERE NOT ((s.rel_key IS NULL OR d.rel_key IS NULL)
           AND coalesce(s.rel_key, d.rel_key) LIKE '%/')"""

VIEWS["copy_mapping"] = """
SELECT DISTINCT concat('batch-', substr(prefix, 12, 1)) AS s3_batch_copy_id,
       bucket AS src_bucket_name, prefix AS src_prefix, 'bkt-copy' AS dest_bucket_name,
       prefix AS dest_prefix, 'run-9' AS runId, prefix <> 'trusted/ds_1/' AS enabled,
       cast(NULL AS timestamp) AS last_recon_timestamp, 'old' AS status
FROM inv_src"""

# Folder tree for copy planning: page addresses as paths, some as folder markers.
VIEWS["tree"] = """
SELECT DISTINCT path, 10 * length(path) AS size FROM (
SELECT concat('lake/', replace(replace(url, 'https://', ''), 'http://', '')) AS path FROM @pages@
UNION ALL
SELECT concat('lake/', cast(doc_id % 9 AS string), '/', lang, '/', source, '/',
              cast(doc_id % 4 AS string), '/', cast(doc_id AS string), '.txt') FROM @documents@
UNION ALL
SELECT concat('lake/empty_', cast(page_id % 20 AS string), '/') FROM @pages@
UNION ALL
SELECT concat('lake/', cast(page_id % 9 AS string), '/') FROM @pages@
UNION ALL
SELECT concat('lake/', cast(page_id % 9 AS string), '/none_', cast(page_id % 5 AS string), '/') FROM @pages@
UNION ALL
SELECT concat('lake/', cast(page_id % 9 AS string), '/en/void_', cast(page_id % 5 AS string), '/') FROM @pages@) t"""

# Copy pairs: folders of the tree at several depths, so some lie inside others.
VIEWS["copy_pairs"] = """
SELECT concat('s3://src/d_', cast(o_custkey % 300 AS string), '/',
              CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat('m_', cast(o_orderkey % 12 AS string), '/') END,
              CASE WHEN o_orderkey % 5 = 0 THEN concat('x_', cast(o_orderkey AS string)) ELSE '' END) AS src,
       concat('s3://dst/', cast(o_orderkey % 700 AS string), '/',
              CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE cast(o_custkey % 50 AS string) END) AS dst
FROM @orders@"""

VIEWS["outcomes"] = """
SELECT concat('job-', cast(user_id % 20 AS string)) AS job,
       CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_id % 9 = 0 THEN 'SKIPPED'
            ELSE 'SUCCESS' END AS status,
       cast(1 + event_id % 13 AS double) AS duration
FROM @events@"""

# Results of the six checks per customer's table; verdicts vary by residue.
VIEWS["results"] = """
SELECT concat('run-', cast(c_custkey % 3 AS string)) AS execution_id,
       concat('c_', cast(c_custkey AS string)) AS table_name, recon_type,
       CASE WHEN recon_type = 'data_read_error' THEN 'ERROR'
            WHEN c_custkey % 9 = 0 AND recon_type = 'ROW_COUNT' THEN 'FAIL'
            WHEN c_custkey % 7 = 0 AND recon_type = 'VERIFIED' THEN 'WARNING'
            WHEN c_custkey % 25 = 0 AND recon_type = 'CHECKSUM_VALIDATION' THEN 'ERROR'
            ELSE 'PASS' END AS status, c_custkey AS seed
FROM @customer@ JOIN (
  SELECT 'ROW_COUNT' AS recon_type UNION ALL SELECT 'COLUMN_COUNT' UNION ALL
  SELECT 'SCHEMA_VALIDATION' UNION ALL SELECT 'Partiton_Data_count' UNION ALL
  SELECT 'CHECKSUM_VALIDATION' UNION ALL SELECT 'VERIFIED' UNION ALL SELECT 'data_read_error') c
  ON (recon_type <> 'data_read_error' OR c_custkey % 17 = 0)
 AND (recon_type <> 'VERIFIED' OR c_custkey % 13 <> 0)
 AND (recon_type = 'data_read_error' OR c_custkey % 34 <> 0)"""


def _needed(names: list[str], body: str) -> list[str]:
    """Views a text uses, each after the views it is built from."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in order and re.search(rf"\b{name}\b", text) and text is not VIEWS[name]:
                visit(VIEWS[name])
                if name not in order:
                    order.append(name)
    visit(" ".join(names) + " " + body)
    return order


def oracle(body: str) -> str:
    """Query text for the oracle with the views it uses put in front."""
    ctes = [f"{name} AS ({VIEWS[name]})" for name in _needed([], body)]
    text = body.strip()
    if text[:5].upper() == "WITH ":
        ctes.append(text[5:].strip())
        sql = "WITH " + ",\n".join(ctes)
    else:
        sql = ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + text
    return re.sub(r"@(\w+)@", r"\1", sql)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One view as a frame over the Parquet files of a data folder."""
    ctes = [f"{n} AS ({VIEWS[n]})" for n in _needed([name], "")]
    sql = "WITH " + ",\n".join(ctes) + f"\nSELECT * FROM {name}"
    return spark.sql(re.sub(r"@(\w+)@", lambda m: f"parquet.`{sf_dir}/{m.group(1)}.parquet`", sql))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
