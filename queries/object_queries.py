"""Object inventories, copy planning, key decoding."""
from __future__ import annotations

from pyspark.sql import functions as F

from lakeproof.functions import paths
from lakeproof.operators import checksum as cs, copyplan, objects as ob
from lakeproof.session import cut_lineage
from queries.registry import query
from queries.views import table, view


def classified(spark, sf, compare="time"):
    return ob.classify(view(spark, sf, "src_objects"), view(spark, sf, "dest_objects"), compare)


_SHOWN = ["s3_batch_copy_id", "rel_key", "src_size", "dest_size", "src_modified", "dest_modified", "status"]


@query("object_diff", f"SELECT {', '.join(_SHOWN)} FROM object_pairs")
def object_diff(spark, sf):
    return classified(spark, sf).select(*_SHOWN)


@query("object_diff_etag", """
SELECT s.s3_batch_copy_id, s.rel_key, CASE WHEN d.rel_key IS NULL THEN 'EXISTS_IN_SRC_AND_BUT_NOT_IN_DEST'
  WHEN s.size = d.size AND s.etag = d.etag THEN 'EXISTS_IN_SRC_AND_DEST_SAME' ELSE 'EXISTS_IN_SRC_AND_DEST_BUT_NOT_SAME' END AS status
FROM src_current s LEFT JOIN dest_objects d ON s.s3_batch_copy_id = d.s3_batch_copy_id AND s.rel_key = d.rel_key""")
def object_diff_etag(spark, sf):
    return classified(spark, sf, "etag").select("s3_batch_copy_id", "rel_key", "status")


@query("object_copies", """
SELECT s3_batch_copy_id, rel_key, CAST(count(*) AS BIGINT) AS copies, max(modified) AS modified FROM src_objects GROUP BY 1, 2""")
def object_copies(spark, sf):
    return ob.current_objects(view(spark, sf, "src_objects")).select(
        "s3_batch_copy_id", "rel_key", "copies", "modified")


def with_content(spark, sf):
    """Classes after a content check that found the objects with another ETag broken."""
    found = cut_lineage(classified(spark, sf))  # used twice, as in the comparison plan
    broken = found.filter("status = 'EXISTS_IN_SRC_AND_DEST_SAME' AND src_etag <> dest_etag")
    return ob.with_checksums(found, broken)


_CONTENT = """p AS (SELECT *, CASE WHEN status = 'EXISTS_IN_SRC_AND_DEST_SAME' AND src_etag <> dest_etag
  THEN 'EXISTS_IN_SRC_AND_DESTINATION_BUT_DIFFERENT_CHECKSUM' ELSE status END AS st FROM object_pairs)"""


@query("object_checksum_class", f"WITH {_CONTENT} SELECT s3_batch_copy_id, rel_key, st AS status FROM p")
def object_checksum_class(spark, sf):
    return with_content(spark, sf).select("s3_batch_copy_id", "rel_key", "status")


@query("object_verdict", f"""WITH {_CONTENT}
SELECT s3_batch_copy_id, CAST(count(*) FILTER (st LIKE '%CHECKSUM') AS BIGINT) AS checksum_differences,
  CAST(count(*) FILTER (st <> 'EXISTS_IN_SRC_AND_DEST_SAME') AS BIGINT) AS differences,
  CASE WHEN count(*) FILTER (st LIKE '%CHECKSUM') > 0 THEN 'FAILED'
       WHEN count(*) FILTER (st <> 'EXISTS_IN_SRC_AND_DEST_SAME') > 0 THEN 'WARNING' ELSE 'SUCCESS' END AS status
FROM p WHERE NOT (s3_batch_copy_id = 'batch-3' AND st LIKE '%CHECKSUM') GROUP BY 1""")
def object_verdict(spark, sf):
    found = with_content(spark, sf)
    return ob.verdict(found.filter("NOT (s3_batch_copy_id = 'batch-3' AND status LIKE '%CHECKSUM')"))


_DIFFS = f"""{_CONTENT},
d AS (SELECT p.s3_batch_copy_id, 'run-9' AS runId, p.rel_key AS Key, coalesce(src_size, dest_size) AS Size,
  m.src_bucket_name AS src_bucket, m.src_prefix, m.dest_bucket_name, m.dest_prefix, st AS status,
  CASE WHEN st = 'EXISTS_IN_SRC_AND_BUT_NOT_IN_DEST' THEN 'Copy' ELSE 'Review' END AS sync_to_dest_bucket_status
  FROM p JOIN copy_mapping m ON p.s3_batch_copy_id = m.s3_batch_copy_id WHERE st <> 'EXISTS_IN_SRC_AND_DEST_SAME')"""


def diffs(spark, sf):
    found = ob.differences(with_content(spark, sf))
    return ob.diff_rows(found, view(spark, sf, "copy_mapping"), "run-9")


@query("object_actions", f"WITH {_DIFFS} SELECT * FROM d")
def object_actions(spark, sf):
    return diffs(spark, sf).drop("ETag", "lastModifiedDate", "time_stamp")


@query("object_report", f"""WITH {_DIFFS}
SELECT d.s3_batch_copy_id, d.runId, m.src_bucket_name, m.dest_bucket_name, m.status, d.status AS recon_status, CAST(count(*) AS BIGINT) AS objects
FROM d JOIN copy_mapping m ON d.s3_batch_copy_id = m.s3_batch_copy_id AND d.runId = m.runId AND m.enabled GROUP BY ALL""")
def object_report(spark, sf):
    return ob.diff_report(view(spark, sf, "copy_mapping"), diffs(spark, sf)).drop(
        "last_recon_timestamp", "time_stamp")


@query("object_status_summary", f"""WITH {_DIFFS},
g AS (SELECT s3_batch_copy_id, status, count(*) AS n FROM d GROUP BY 1, 2)
SELECT s3_batch_copy_id, concat('[', string_agg(concat('{{"status":"', status, '","count":', n, '}}'), ', ' ORDER BY status), ']') AS recon_status
FROM g GROUP BY 1""")
def object_status_summary(spark, sf):
    return ob.status_summary(diffs(spark, sf))


@query("object_current_differences", f"""WITH {_DIFFS}
SELECT d.s3_batch_copy_id, Key, d.status FROM d JOIN copy_mapping m USING (s3_batch_copy_id, runId)
WHERE m.enabled AND d.status = 'FILES_IN_SRC_ARE_NEWER_THAN_DESTINATION'""")
def object_current_differences(spark, sf):
    rows = ob.current_differences(view(spark, sf, "copy_mapping"), diffs(spark, sf),
                                  status="FILES_IN_SRC_ARE_NEWER_THAN_DESTINATION")
    return rows.select("s3_batch_copy_id", "Key", "status")


@query("sync_plan", f"""WITH {_DIFFS}
SELECT concat('s3://', src_bucket, '/', d.src_prefix, Key) AS src_key, concat('s3://', d.dest_bucket_name, '/', d.dest_prefix, Key) AS dest_key,
  CASE WHEN Key LIKE '%/' THEN 'dir' ELSE 'file' END AS type
FROM d JOIN copy_mapping m USING (s3_batch_copy_id, runId) WHERE m.enabled AND d.status = 'EXISTS_IN_SRC_AND_BUT_NOT_IN_DEST'""")
def sync_plan(spark, sf):
    return ob.sync_plan(ob.current_differences(view(spark, sf, "copy_mapping"), diffs(spark, sf)))


# Report rows are text; both sides of a batch sit in one details table.
_DETAILS = """SELECT bucket AS Bucket, replace(key, '=', '%3D') AS Key, cast(size AS string) AS Size,
  cast(modified AS string) AS LastModifiedDate, cast(seed AS string) AS ETag, prefix, 's3://inv' AS inventory_s3_location,
  CASE WHEN seed % 8 = 0 THEN 'ignore' ELSE 'false' END AS processed FROM inv_src"""


@query("object_side", f"""WITH det AS ({_DETAILS})
SELECT m.s3_batch_copy_id, concat('["', m.src_bucket_name, '","', m.src_prefix, '","', m.dest_bucket_name, '","', m.dest_prefix, '"]') AS pair,
  d.Bucket AS bucket, d.prefix, substr(d.Key, length(d.prefix) + 1) AS rel_key, CAST(d.Size AS BIGINT) AS size, d.ETag AS etag
FROM det d JOIN copy_mapping m ON d.Bucket = m.src_bucket_name AND d.prefix = m.src_prefix WHERE d.processed = 'false' AND m.enabled""")
def object_side(spark, sf):
    details = view(spark, sf, "inv_src").select(
        F.col("bucket").alias("Bucket"), F.expr("replace(key, '=', '%3D')").alias("Key"),
        F.col("size").cast("string").alias("Size"), F.col("modified").cast("string").alias("LastModifiedDate"),
        F.col("seed").cast("string").alias("ETag"), "prefix", F.lit("s3://inv").alias("inventory_s3_location"),
        F.expr("CASE WHEN seed % 8 = 0 THEN 'ignore' ELSE 'false' END").alias("processed"))
    mapping = ob.enabled_mappings(view(spark, sf, "copy_mapping")).withColumns({
        "src_inventory_s3_location": F.lit("s3://inv"), "src_inventory_name": F.lit("n")})
    return ob.side_objects(details, mapping, "src").drop("modified")


@query("checksum_sample", r"""
WITH s AS (SELECT *, regexp_extract(regexp_extract(rel_key, '([^/]*)$', 1), '^\.*[^.].*?(\.[^.]*)$', 1) AS file_type FROM object_pairs
  WHERE status = 'EXISTS_IN_SRC_AND_DEST_SAME' AND contains(rel_key, '.') AND src_size > 0)
SELECT s3_batch_copy_id, rel_key, file_type FROM s
WHERE ('0x' || substr(md5(rel_key), 1, 7))::BIGINT % 10000 < CASE WHEN lower(ltrim(file_type, '.')) = 'csv' THEN 5000 ELSE 500 END""")
def checksum_sample(spark, sf):
    same = classified(spark, sf).filter("status = 'EXISTS_IN_SRC_AND_DEST_SAME'")
    population = cs.sample_candidates(same, size="src_size")
    return cs.hash_sample(population, 0.05, {"csv": 0.5}).select("s3_batch_copy_id", "rel_key", "file_type")


def _units_sql(cut: int) -> str:
    return f"""
WITH r AS (SELECT substr(path, 6) AS rel, size FROM tree WHERE path LIKE 'lake/%'),
p AS (SELECT *, rel LIKE '%/' OR rel = '' AS marker, string_split(regexp_replace(rel, '/$', ''), '/') AS seg FROM r),
u AS (SELECT *, len(seg) AS lv, CASE WHEN len(seg) > {cut} THEN concat(array_to_string(seg[1:{cut}], '/'), '/') ELSE rel END AS unit FROM p),
g AS (SELECT unit, CASE WHEN unit LIKE '%/' THEN 'dir' ELSE 'file' END AS type, min(least(lv, {cut})) AS lv,
  CAST(sum(size) AS BIGINT) AS size, CAST(count(*) FILTER (NOT marker) AS BIGINT) AS files FROM u GROUP BY 1, 2)
SELECT concat('lake/', unit) AS path, concat('copy/', unit) AS dest_path, type, size, files FROM g
WHERE NOT (type = 'dir' AND lv < {cut} AND EXISTS (SELECT 1 FROM r WHERE r.rel <> g.unit AND starts_with(r.rel, g.unit)))"""


@query("copy_units", _units_sql(2))
def copy_units(spark, sf):
    return copyplan.copy_units(view(spark, sf, "tree"), "lake/", "copy/", 2)


@query("copy_units_deep", _units_sql(4))
def copy_units_deep(spark, sf):
    return copyplan.copy_units(view(spark, sf, "tree"), "lake/", "copy/", 3)


_FOLDERS = """f AS (SELECT 'src' AS side, rtrim(src, '/') AS folder FROM copy_pairs UNION ALL SELECT 'dst', rtrim(dst, '/') FROM copy_pairs)"""


@query("copy_pair_duplicates", f"""WITH {_FOLDERS}
SELECT side, folder, CAST(count(*) AS BIGINT) AS times FROM f GROUP BY 1, 2 HAVING count(*) > 1""")
def copy_pair_duplicates(spark, sf):
    return copyplan.duplicate_folders(view(spark, sf, "copy_pairs"))


@query("copy_pair_check", f"""WITH {_FOLDERS}, d AS (SELECT DISTINCT side, folder FROM f)
SELECT c.side, c.folder AS child, p.folder AS parent FROM d c JOIN d p
  ON c.side = p.side AND starts_with(c.folder, p.folder || '/')""")
def copy_pair_check(spark, sf):
    return copyplan.nested_folders(view(spark, sf, "copy_pairs"))


@query("copy_summary", """
SELECT job, CAST(count(*) FILTER (status = 'SUCCESS') AS BIGINT) AS copied, CAST(count(*) FILTER (status = 'FAILED') AS BIGINT) AS failed,
  CAST(count(*) FILTER (status = 'SKIPPED') AS BIGINT) AS skipped, sum(duration) AS total_seconds,
  round(sum(duration) / count(*) FILTER (status = 'SUCCESS'), 1) AS avg_seconds,
  round(count(*) FILTER (status = 'SUCCESS') * 60.0 / sum(duration), 1) AS copied_per_minute
FROM outcomes GROUP BY 1""")
def copy_summary(spark, sf):
    return ob.copy_summary(view(spark, sf, "outcomes"), ["job"])


# Keys with escapes, plus signs and stray percent signs, made from page addresses.
_KEYS = """SELECT page_id, concat(replace(replace(url, '/', '%2F'), '?', '%3F'), '+a%20b', CASE WHEN page_id % 3 = 0 THEN '%C3%A9' ELSE '' END) AS key FROM {pages}"""


@query("url_decode_keys", f"""WITH k AS ({_KEYS.format(pages='pages')})
SELECT page_id, replace(replace(replace(replace(key, '%2F', '/'), '%3F', '?'), '%20', ' '), '%C3%A9', 'é') AS object_name FROM k""")
def url_decode_keys(spark, sf):
    keys = spark.sql(_KEYS.format(pages=f"parquet.`{sf}/pages.parquet`"))
    return keys.select("page_id", paths.percent_decode("key").alias("object_name"))


@query("path_parts", r"""
WITH p AS (SELECT page_id, url, html, concat(url, '/') AS folder FROM pages)
SELECT page_id, regexp_extract(folder, '^(.*)/(.*)/', 1) AS family, regexp_extract(folder, '^(.*)/(.*)/', 2) AS run,
  concat_ws('/', 's3://inv', regexp_extract(url, '//([^/]+)', 1), 'daily') AS manifest_root,
  CASE WHEN starts_with(url, 'https://') THEN concat('s3://', substr(url, 9)) ELSE url END AS dest_path,
  CASE WHEN url LIKE '%/' THEN 'dir' ELSE 'file' END AS type, substr(html, 1, 1000) AS shortened
FROM p""")
def path_parts(spark, sf):
    pages = table(spark, sf, "pages")
    folder = F.concat("url", F.lit("/"))
    return pages.select(
        "page_id", paths.report_parent(folder).alias("family"), paths.report_run(folder).alias("run"),
        paths.manifest_root(F.lit("s3://inv"), F.regexp_extract("url", "//([^/]+)", 1), F.lit("daily")).alias("manifest_root"),
        paths.swap_root("url", "https://", "s3://").alias("dest_path"), paths.node_type("url").alias("type"),
        paths.short_text("html").alias("shortened"))
