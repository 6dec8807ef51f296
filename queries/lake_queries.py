"""Operators that read storage, over file trees Spark writes from the given tables.

Trees go to a fresh folder below the shared one; its path stands in for the bucket's scheme.
"""
from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof import PartitionSpec
from lakeproof.functions import paths
from lakeproof.operators import drift, inventory as inv, ledger, partitions as parts
from lakeproof.plans import migrate
from lakeproof.plans.compare import compare_batch, compare_buckets, ingest_reports
from lakeproof.plans.reconcile import reconcile_all, reconcile_pair
from lakeproof.plans.state import Tables, create_state
from lakeproof.session import cut_lineage, fresh_folder
from lakeproof.sources import bytes as by, footers, listing, storage, tables as tb
from lakeproof import schemas
from lakeproof.streaming.ingest import ingest_listings
from queries.registry import query
from queries.views import table, view


@dataclass
class Lake:
    """A written tree and what the plans need to work on it."""
    folder: str
    spec: PartitionSpec
    inventory: DataFrame
    tags: DataFrame

    @property
    def root(self) -> str:
        return f"{self.folder}/bkt/ds_a/"


def write_lake(spark: SparkSession, sf: str, drifted: bool = False) -> str:
    """Line items as partition folders; with ``drifted``, June has text quantities."""
    folder = fresh_folder(spark, "lake")
    rows = view(spark, sf, "recon_src")
    root = f"{folder}/bkt/ds_a"
    june = F.month("snapshot_date") == 6
    keys = ["run_id", "snapshot_date"]
    tb.write_partitioned(rows.filter(~june) if drifted else rows, root, keys)
    if drifted:
        text = rows.filter(june).withColumn("quantity", F.col("quantity").cast("string"))
        text.hint("rebalance", *keys).write.mode("append").partitionBy(*keys).parquet(root)
    return folder


def take(spark: SparkSession, sf: str, drifted: bool = False) -> Lake:
    folder = write_lake(spark, sf, drifted)
    spec = PartitionSpec(floor=None, scheme=f"{folder}/")
    mapping = spark.createDataFrame([("ds_a", "bkt", "ds_a/")],
                                    "dataset_name string, s3_bucket_name string, bucket_prefix string")
    found = listing.list_files(listing.dataset_roots(mapping, spec.scheme))
    none = spark.createDataFrame([], schemas.inventory(spec))
    rows = cut_lineage(inv.new_inventory(found, none, mapping, "run-1", spec))
    tags = rows.filter(F.col("snapshot_date").isNotNull()).select(
        F.lit("ds_a").alias("dataset_name"), "run_id", F.lit("snapshot_date").alias("run_tag_key"),
        F.col("snapshot_date").cast("string").alias("run_tag_value")).distinct()
    return Lake(folder, spec, rows, tags)


def capture(spark: SparkSession, lake: Lake) -> DataFrame:
    plan = parts.load_plan(lake.inventory, lake.tags, lake.spec)
    files = migrate.partition_files(lake.inventory, plan, lake.spec)
    return footers.capture_partitions(footers.capture_files(files), inv.DATASET)


def load(spark: SparkSession, lake: Lake):
    """Loads what can be loaded: (table, schema, status)."""
    plan = parts.load_plan(lake.inventory, lake.tags, lake.spec)
    catalog = cut_lineage(capture(spark, lake))
    latest = parts.latest_snapshot(plan, inv.DATASET, lake.spec)
    text = drift.effective_schemas(catalog, latest, lake.spec, inv.DATASET).first().schema_json
    schema = drift.read_schema(text, lake.spec)
    name = f"loaded_{uuid.uuid4().hex}"
    status = migrate.load_dataset(spark, plan, lake.inventory, schema, name, lake.root, lake.spec,
                                  location=f"{lake.folder}/managed")
    return name, schema, status


@query("lake_listing", """
SELECT DISTINCT 'parquet' AS extension, 'run_id, snapshot_date' AS partition_key, run_id, snapshot_date, false AS empty
FROM recon_src UNION ALL SELECT NULL, NULL, NULL, NULL, true""")
def lake_listing(spark, sf):
    """All objects of the tree; the marker file the writer leaves is one of them."""
    return take(spark, sf).inventory.select(
        "extension", "partition_key", "run_id", "snapshot_date", (F.col("size") == 0).alias("empty")).distinct()


@query("lake_schema_capture", """
SELECT run_id, snapshot_date, false AS is_corrupted, CASE WHEN month(snapshot_date) = 6 THEN '"string"' ELSE '"decimal(18,2)"' END AS quantity_type
FROM (SELECT DISTINCT run_id, snapshot_date FROM recon_src)""")
def lake_schema_capture(spark, sf):
    lake = take(spark, sf, drifted=True)
    return capture(spark, lake).select(
        paths.partition_value("file_path", "run_id").alias("run_id"),
        paths.partition_date("file_path", "snapshot_date").alias("snapshot_date"), "is_corrupted",
        F.regexp_extract("schema_json", r'"name": "quantity", "nullable": true, "type": ("[^"]*")', 1)
        .alias("quantity_type"))


@query("lake_load_status", """
SELECT run_id, snapshot_date, CASE WHEN month(snapshot_date) = 6 THEN 'failed' ELSE 'loaded' END AS load_status
FROM (SELECT DISTINCT run_id, snapshot_date FROM recon_src)""")
def lake_load_status(spark, sf):
    lake = take(spark, sf, drifted=True)
    return load(spark, lake)[2].select("run_id", "snapshot_date", "load_status")


@query("lake_load_and_remediate", """
SELECT run_id, snapshot_date, CAST(count(*) AS BIGINT) AS n, CAST(sum(quantity) AS DOUBLE) AS quantity,
  CAST(sum(l_orderkey) AS BIGINT) AS keys FROM recon_src GROUP BY 1, 2""")
def lake_load_and_remediate(spark, sf):
    """The managed table after loading and after casting the drifted partitions."""
    lake = take(spark, sf, drifted=True)
    name, schema, status = load(spark, lake)
    inventory = migrate.record_status(lake.inventory, status, lake.spec)
    mapping = spark.createDataFrame([("ds_a", "bkt", "ds_a/", "m")],
                                    "dataset_name string, s3_bucket_name string, bucket_prefix string, "
                                    "dbx_managed_table_schema string")
    failed = parts.failed_partitions(inventory, mapping, lake.spec)
    migrate.remediate_dataset(spark, failed, lake.inventory, schema, name, lake.root, lake.spec)
    return spark.table(name).groupBy("run_id", "snapshot_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").cast("double").alias("quantity"),
        F.sum("l_orderkey").alias("keys"))


@dataclass
class Migration:
    """State tables of one migration and the tree it reads; ``day`` writes more of it."""
    spark: SparkSession
    folder: str
    spec: PartitionSpec
    tables: Tables
    schema: str

    def write(self, rows: DataFrame, dataset: str = "ds_a", upper: bool = False) -> None:
        """Adds partition folders, with ``upper`` under the other spelling of the run id."""
        rows, run = (rows.withColumnRenamed("run_id", "RUN_ID"), "RUN_ID") if upper else (rows, "run_id")
        rows = rows.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))
        (rows.hint("rebalance", run, "snapshot_date").write.mode("append").partitionBy(run, "snapshot_date")
         .parquet(f"{self.folder}/bkt/{dataset}"))
        tags = rows.select(F.lit(dataset).alias("dataset_name"), F.col(run).alias("run_id"),
                           F.lit("snapshot_date").alias("run_tag_key"), F.col("snapshot_date").alias("run_tag_value"))
        tb.append_rows(tags.distinct(), self.tables.tags)

    def run(self, name: str) -> DataFrame:
        """Inventory, verdicts and load: one run of the migration."""
        migrate.take_inventory(self.spark, self.tables, name, f"{self.folder}/mapping", self.spec)
        migrate.assess_drift(self.spark, self.tables, "bkt", spec=self.spec)
        return migrate.load(self.spark, self.tables, self.spec)

    def table(self, dataset: str = "ds_a") -> DataFrame:
        return self.spark.table(f"{self.schema}.{dataset}")

    def result(self, df: DataFrame) -> DataFrame:
        """The result, kept, without the state tables."""
        kept = cut_lineage(df)
        self.spark.sql(f"DROP DATABASE {self.schema} CASCADE")
        return kept


def migration(spark: SparkSession, datasets: tuple[str, ...] = ("ds_a",)) -> Migration:
    """Empty state tables and the mapping file of some datasets."""
    folder, name = fresh_folder(spark, "migration"), f"migrated_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    spec, tables = PartitionSpec(floor=None, scheme=f"{folder}/"), Tables().within(name)
    create_state(spark, tables, spec)
    rows = [(d, "bkt", f"{d}/", "spark_catalog", name, None) for d in datasets]
    spark.createDataFrame(rows, schemas.MAPPING).coalesce(1).write.option("header", True).csv(f"{folder}/mapping")
    return Migration(spark, folder, spec, tables, name)


def _totals(df: DataFrame) -> DataFrame:
    return df.groupBy("run_id", "snapshot_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").cast("double").alias("quantity"), F.sum("l_orderkey").alias("keys"))


_TOTALS = """SELECT run_id, snapshot_date, CAST(count(*) AS BIGINT) AS n, CAST(sum(quantity) AS DOUBLE) AS quantity,
  CAST(sum(l_orderkey) AS BIGINT) AS keys FROM recon_src WHERE {} GROUP BY 1, 2"""


@query("lake_late_folder", _TOTALS.format("l_linenumber < 6 OR month(snapshot_date) = 3"))
def lake_late_folder(spark, sf):
    """Pairs of two folders each; files that come late into one folder of some pairs lose nothing."""
    lake, rows = migration(spark), view(spark, sf, "recon_src")
    lake.write(rows.filter("l_linenumber < 4"))
    lake.write(rows.filter("l_linenumber IN (4, 5)"), upper=True)
    lake.run("run-1")
    lake.write(rows.filter("l_linenumber > 5 AND month(snapshot_date) = 3"), upper=True)
    lake.run("run-2")
    return lake.result(_totals(lake.table()))


@query("lake_remediate_late", _TOTALS.format("l_linenumber < 6 OR month(snapshot_date) = 3 OR snapshot_date = (SELECT max(snapshot_date) FROM recon_src)"))
def lake_remediate_late(spark, sf):
    """Late files in loaded pairs after the read schema changed: repaired whole, nothing twice."""
    lake, rows = migration(spark), view(spark, sf, "recon_src")
    last = rows.agg(F.max("snapshot_date")).first()[0]
    newest = F.col("snapshot_date") == F.lit(last)
    lake.write(rows.filter(~newest & F.expr("l_linenumber < 6")))
    lake.run("run-1")
    lake.write(rows.filter(~newest & F.expr("l_linenumber > 5 AND month(snapshot_date) = 3")))
    lake.write(rows.filter(newest).withColumn("quantity", F.col("quantity").cast("string")))
    lake.run("run-2")
    migrate.remediate(spark, lake.tables, lake.spec)
    return lake.result(_totals(lake.table()))


@query("lake_ledger", """
SELECT run_id, snapshot_date, 2 AS folders, CAST(0 AS BIGINT) AS files_missing, month(snapshot_date) = 3 AS loaded_again FROM recon_src
WHERE l_linenumber < 6 GROUP BY 1, 2 HAVING count(*) FILTER (l_linenumber < 4) > 0 AND count(*) FILTER (l_linenumber > 3) > 0""")
def lake_ledger(spark, sf):
    """Per pair of two folders: known files the table lacks; whether a second load took it."""
    lake, rows = migration(spark), view(spark, sf, "recon_src")
    lake.write(rows.filter("l_linenumber < 4"))
    lake.write(rows.filter("l_linenumber IN (4, 5)"), upper=True)
    lake.run("run-1")
    lake.write(rows.filter("l_linenumber < 6 AND month(snapshot_date) = 3"))
    lake.run("run-2")
    taken, inventory = spark.table(lake.tables.ledger), spark.table(lake.tables.inventory)
    again = taken.groupBy("run_id", "snapshot_date").agg((F.count_distinct("load_id") > 1).alias("loaded_again"))
    report = ledger.ledger_report(inventory, taken, lake.spec).filter("folders = 2")
    return lake.result(report.join(again, ["run_id", "snapshot_date"]).select(
        "run_id", "snapshot_date", F.col("folders").cast("int").alias("folders"), "files_missing", "loaded_again"))


@query("lake_reconcile", """
WITH p AS (SELECT count(*) AS n FROM (SELECT DISTINCT run_id, snapshot_date FROM recon_src)),
l AS (SELECT count(*) AS n, count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_returnflag, quantity, price, ship_date)) AS d FROM recon_src
  WHERE (snapshot_date, run_id) = (SELECT (snapshot_date, run_id) FROM recon_src ORDER BY snapshot_date DESC, run_id DESC LIMIT 1))
SELECT 'ROW_COUNT' AS recon_type, 'PASS' AS status, CAST(count(*) AS VARCHAR) AS target_metrics, 0 AS metrics_compared FROM recon_src
UNION ALL SELECT 'COLUMN_COUNT', 'PASS', '9', 0
UNION ALL SELECT 'SCHEMA_VALIDATION', 'PASS', NULL, 9
UNION ALL SELECT 'Partiton_Data_count', 'PASS', CAST(n AS VARCHAR), 0 FROM p
UNION ALL SELECT 'CHECKSUM_VALIDATION', 'PASS', CAST(n AS VARCHAR), CAST(d AS INTEGER) FROM l
UNION ALL SELECT 'VERIFIED', 'PASS', NULL, 16""")
def lake_reconcile(spark, sf):
    """All checks between the folders and the managed table they were loaded into."""
    lake = take(spark, sf)
    name, schema, _ = load(spark, lake)
    source = tb.read_partitions(spark, lake.root, schema=schema, lenient=True)
    source = parts.source_rows(source, lake.tags, lake.inventory.withColumn("load_status", F.lit("loaded")),
                               "ds_a", lake.spec)
    rows = reconcile_pair(source, spark.table(name), "ds_a", "run-1", lake.spec)
    long_text = F.col("recon_type").isin("SCHEMA_VALIDATION", "VERIFIED")
    return rows.select("recon_type", "status", F.when(~long_text, F.col("target_metrics")).alias("target_metrics"),
                       "metrics_compared")


def damage(path: str) -> None:
    """Cuts a file to its first bytes, as a broken copy leaves it."""
    system, inner = storage.resolve(path)
    with system.open_output_stream(inner) as out:
        out.write(b"PAR1")


@query("lake_reconcile_all", """
WITH t AS (SELECT * FROM (VALUES ('ds_a'), ('ds_b')) v(table_name)), c AS (SELECT * FROM (VALUES ('ROW_COUNT'), ('COLUMN_COUNT'),
  ('SCHEMA_VALIDATION'), ('Partiton_Data_count'), ('CHECKSUM_VALIDATION'), ('VERIFIED')) v(recon_type)),
n AS (SELECT 'ds_a' AS table_name, count(*) AS n FROM recon_src WHERE l_linenumber = 1
  UNION ALL SELECT 'ds_b', count(*) FROM recon_src WHERE l_linenumber = 2 AND month(snapshot_date) IN (1, 2))
SELECT table_name, recon_type, CASE WHEN recon_type = 'ROW_COUNT' AND table_name = 'ds_a' THEN 'WARNING'
  WHEN table_name = 'ds_a' OR recon_type IN ('COLUMN_COUNT', 'SCHEMA_VALIDATION') THEN 'PASS' ELSE 'FAIL' END AS status,
  CASE WHEN recon_type = 'ROW_COUNT' THEN 1 END AS files_not_read, CASE WHEN recon_type = 'ROW_COUNT' THEN CAST(n AS VARCHAR) END AS target_rows,
  CASE WHEN table_name = 'ds_a' THEN 'PASS' ELSE 'FAIL' END AS verdict FROM t JOIN n USING (table_name), c""")
def lake_reconcile_all(spark, sf):
    """A migration of two datasets over state tables, each with a file that cannot be read.

    That of the first was never loaded, so both sides agree and only the number tells of it;
    that of the second is damaged after the load.
    """
    lake, rows = migration(spark, ("ds_a", "ds_b")), view(spark, sf, "recon_src")
    lake.write(rows.filter("l_linenumber = 1"))
    lake.write(rows.filter("l_linenumber = 2 AND month(snapshot_date) IN (1, 2)"), "ds_b")
    system, inner = storage.resolve(f"{lake.folder}/bkt/ds_a/run_id=R9/snapshot_date=1999-01-01")
    system.create_dir(inner)
    damage(f"{lake.folder}/bkt/ds_a/run_id=R9/snapshot_date=1999-01-01/part-0.parquet")
    tb.append_rows(spark.createDataFrame([("ds_a", "R9", "snapshot_date", "1999-01-01")], schemas.PARTITION_TAGS), lake.tables.tags)
    lake.run("run-1")
    held = spark.table(lake.tables.ledger).filter("bucket_prefix = 'ds_b/'")
    damage(held.agg(F.min("data_file")).first()[0])
    found = reconcile_all(spark, lake.tables, "bkt", spec=lake.spec, all_partitions=True, per_group=None, limit=None)
    verdict = spark.table(lake.tables.candidates).select("table_name", F.col("recon_status").alias("verdict"))
    counts = F.col("recon_type") == "ROW_COUNT"
    unread = F.regexp_extract("error_log", r"^(\d+) source files", 1)
    return lake.result(found.join(verdict, "table_name").select(
        "table_name", "recon_type", "status", F.when(counts, unread.try_cast("int")).alias("files_not_read"),
        F.when(counts, F.col("target_metrics")).alias("target_rows"), "verdict"))


@query("lake_rows_in_failed", """
SELECT run_id, snapshot_date, CAST(count(*) AS BIGINT) AS rows FROM recon_src WHERE month(snapshot_date) = 6 GROUP BY 1, 2""")
def lake_rows_in_failed(spark, sf):
    lake = take(spark, sf)
    schema = drift.read_schema('{"type": "struct", "fields": []}', lake.spec)
    failed = parts.partition_rows(parts.work_files(lake.inventory, lake.spec), lake.spec).filter(
        F.month("snapshot_date") == 6)
    return migrate.rows_in_failed(spark, failed, lake.root, schema, lake.spec)


def _write_texts(column: str):
    def run(batches):
        for batch in batches:
            for path, text in zip(batch["file"], batch[column]):
                system, inner = storage.resolve(path)
                system.create_dir(inner.rsplit("/", 1)[0])
                with system.open_output_stream(inner) as out:
                    out.write(text.encode())
            yield batch[["file"]]
    return run


@query("file_checksums", """
SELECT concat('doc_', doc_id, '.txt') AS rel_key, md5(text) AS src_md5,
  md5(CASE WHEN doc_id % 10 = 0 THEN concat(text, '!') ELSE text END) AS dest_md5, doc_id % 10 <> 0 AS checksum_valid FROM documents""")
def file_checksums(spark, sf):
    """Each document as a file on both sides, every tenth copy with a byte too many."""
    folder = fresh_folder(spark, "copy")
    docs = table(spark, sf, "documents")
    key = F.concat(F.lit("doc_"), "doc_id", F.lit(".txt"))
    broken = F.when(F.col("doc_id") % 10 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    for side, text in (("src", F.col("text")), ("dest", broken)):
        rows = docs.select(F.concat(F.lit(f"{folder}/{side}/d/"), key).alias("file"), text.alias("text"))
        rows.repartition(32).mapInPandas(_write_texts("text"), "file string").write.format("noop").mode("overwrite").save()
    sample = docs.select(
        F.lit("b").alias("s3_batch_copy_id"), key.alias("rel_key"), F.lit("src").alias("src_bucket"),
        F.lit("dest").alias("dest_bucket"), F.lit("d/").alias("src_prefix"), F.lit("d/").alias("dest_prefix"))
    found = by.compare_contents(sample, f"{folder}/")
    return found.select("rel_key", "src_md5", "dest_md5", "checksum_valid")


def _write_report(spark, folder: str, bucket: str, name: str, when: str, rows: DataFrame, kind: str) -> None:
    """One inventory report: data files below ``data/`` and a manifest that names them."""
    family = f"{bucket}/{name}"
    data = f"{folder}/{family}/data/{when}"
    writer = rows.write.option("header", False)
    if kind == "CSV":
        # Compressed text cannot be split: many files, so that reading spreads over tasks.
        writer.options(compression="gzip", maxRecordsPerFile=500_000).csv(data)
    else:
        writer.format(kind.lower()).save(data)
    ending = "gz" if kind == "CSV" else kind.lower()
    written = [e.path for e in storage.children(data) if e.path.endswith(ending)]
    system, inner = storage.resolve(f"{folder}/{family}/{when}/manifest.json")
    system.create_dir(inner.rsplit("/", 1)[0])
    document = {"fileFormat": kind, "fileSchema": ", ".join(rows.columns),
                "files": [{"key": f"{family}/data/{when}/" + p.rsplit("/", 1)[1], "size": 1, "MD5checksum": ""}
                          for p in written]}
    with system.open_output_stream(inner) as out:
        out.write(json.dumps(document, indent=1).encode())


def _report_rows(objects: DataFrame) -> DataFrame:
    return objects.select(
        F.col("bucket").alias("Bucket"), F.concat("prefix", "rel_key").alias("Key"),
        F.col("size").cast("string").alias("Size"),
        F.date_format("modified", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("LastModifiedDate"),
        F.col("etag").alias("ETag"), F.lit("true").alias("IsLatest"))


def _report_tree(spark, sf) -> tuple[str, DataFrame]:
    """Reports of both sides in two formats, each source with an older one; their mapping."""
    folder = fresh_folder(spark, "reports")
    source, dest = view(spark, sf, "src_objects"), view(spark, sf, "dest_objects")
    rows = _report_rows(source).withColumn("IsLatest", F.when(F.col("ETag") == "old", "false").otherwise(""))
    for bucket in ("bkt-0", "bkt-1"):  # the source buckets; each report covers several datasets
        mine = rows.filter(F.col("Bucket") == bucket)
        older = mine.withColumn("Size", F.lit("1"))
        _write_report(spark, folder, bucket, "daily", "2025-01-01T01-00Z", older, "CSV")
        _write_report(spark, folder, bucket, "daily", "2025-01-02T01-00Z", mine, "CSV")
    _write_report(spark, folder, "bkt-copy", "daily", "2025-01-02T01-00Z", _report_rows(dest), "Parquet")
    mapping = view(spark, sf, "copy_mapping").withColumns({
        "src_inventory_s3_location": F.lit(folder), "dest_inventory_s3_location": F.lit(folder),
        "src_inventory_name": F.lit("daily"), "dest_inventory_name": F.lit("daily"),
        "enabled": F.lit(True)})
    return folder, mapping


@query("report_ingest", """
SELECT s3_batch_copy_id, rel_key, src_size, dest_size, status FROM object_pairs""")
def report_ingest(spark, sf):
    """Discovery, manifests, data files and comparison, over reports in two formats."""
    _, mapping = _report_tree(spark, sf)
    reports = spark.createDataFrame([], schemas.REPORT_LIST)
    details = spark.createDataFrame([], schemas.REPORT_DETAILS)
    _, details = ingest_reports(spark, mapping, reports, details, "run-1")
    return compare_batch(details, mapping).select("s3_batch_copy_id", "rel_key", "src_size", "dest_size", "status")


def _compared(spark, sf) -> tuple[Tables, str, DataFrame]:
    """State tables after one whole comparison."""
    folder, mapping = _report_tree(spark, sf)
    name = f"compared_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    tables = Tables().within(name)
    create_state(spark, tables)
    typed = mapping.select(*[(F.col(f.name) if f.name in mapping.columns else F.lit(None))
                             .cast(f.dataType).alias(f.name) for f in schemas.COPY_MAPPING.fields])
    tb.append_rows(typed, tables.copies)
    return tables, folder, compare_buckets(spark, tables, "run-1")


_STORED = """
SELECT s3_batch_copy_id, rel_key AS Key, coalesce(src_size, dest_size) AS Size, status,
  CASE WHEN status = 'EXISTS_IN_SRC_AND_BUT_NOT_IN_DEST' THEN 'Copy' ELSE 'Review' END AS sync_to_dest_bucket_status
FROM object_pairs WHERE status <> 'EXISTS_IN_SRC_AND_DEST_SAME'"""


@query("bucket_compare_run", _STORED)
def bucket_compare_run(spark, sf):
    """A whole run over state tables; the stored differences."""
    tables, *_ = _compared(spark, sf)
    found = cut_lineage(spark.table(tables.differences).select(
        "s3_batch_copy_id", "Key", "Size", "status", "sync_to_dest_bucket_status"))
    spark.sql(f"DROP DATABASE {tables.copies.split('.')[0]} CASCADE")
    return found


@query("bucket_compare_mapping", """
SELECT s3_batch_copy_id, CASE WHEN count(*) FILTER (status <> 'EXISTS_IN_SRC_AND_DEST_SAME') > 0 THEN 'WARNING' ELSE 'SUCCESS' END AS status,
  'run-1' AS runId FROM object_pairs GROUP BY 1""")
def bucket_compare_mapping(spark, sf):
    """What the run writes into the mappings."""
    tables, *_ = _compared(spark, sf)
    found = cut_lineage(spark.table(tables.copies).select("s3_batch_copy_id", "status", "runId").distinct())
    spark.sql(f"DROP DATABASE {tables.copies.split('.')[0]} CASCADE")
    return found


@query("bucket_compare_second_run", """
SELECT r.runId, 'true' AS processed, CAST(sum(n) AS BIGINT) AS n FROM (VALUES ('run-1'), ('run-2')) r(runId),
  (SELECT count(*) AS n FROM dest_objects UNION ALL SELECT count(*) FROM src_objects WHERE etag <> 'old') GROUP BY 1""")
def bucket_compare_second_run(spark, sf):
    """A newer report of one bucket: both sides are read again, the first run's rows stay done."""
    tables, folder, _ = _compared(spark, sf)
    rows = _report_rows(view(spark, sf, "src_objects")).filter("Bucket = 'bkt-1' AND ETag <> 'old'")
    _write_report(spark, folder, "bkt-1", "daily", "2025-01-03T01-00Z", rows, "CSV")
    compare_buckets(spark, tables, "run-2")
    found = cut_lineage(spark.table(tables.details).groupBy("runId", "processed").agg(F.count("*").alias("n")))
    spark.sql(f"DROP DATABASE {tables.copies.split('.')[0]} CASCADE")
    return found


@query("streaming_inventory", """
SELECT 'run-1' AS execution_id, i.s3_bucket_name, i.bucket_prefix, key, extension, size, last_modified_time, partition_key, run_id, snapshot_date
FROM inventory i JOIN dataset_mapping m ON i.s3_bucket_name = m.s3_bucket_name AND i.bucket_prefix = m.bucket_prefix""")
def streaming_inventory(spark, sf):
    """Listings that arrive as files, taken in twice; the second time adds nothing."""
    folder = fresh_folder(spark, "stream")
    rows = view(spark, sf, "inv_src").select(
        F.col("bucket").alias("s3_bucket_name"), F.col("prefix").alias("bucket_prefix"),
        F.concat(F.lit("s3://"), "bucket", F.lit("/"), "key").alias("path"), "size",
        F.col("modified").alias("last_modified_time"))
    rows.repartition(4).write.parquet(f"{folder}/arrived")
    mapping = view(spark, sf, "dataset_mapping")
    for _ in range(2):
        ingest_listings(spark, f"{folder}/arrived", rows.schema, f"{folder}/inventory",
                        f"{folder}/state", mapping, "run-1", files_per_batch=3)
    return spark.read.parquet(f"{folder}/inventory").drop("load_status", "batch")
