"""Inventory, drift, load, reconciliation, remediation over a tree with known defects."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lakeproof import PartitionSpec
from lakeproof.plans import migrate, reconcile
from lakeproof.plans.state import Tables, create_state
from queries.views import view


@pytest.fixture(scope="module")
def lake(spark, sf, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("lake"))
    root = f"{folder}/bkt/trusted/ds_a"
    lines = view(spark, sf, "recon_src").drop("run_id", "snapshot_date").limit(400)
    lines = spark.createDataFrame(lines.collect(), lines.schema)
    days = [f"2024-01-0{i}" for i in range(1, 5)]
    for i, day in enumerate(days):
        part = lines.filter(F.col("l_orderkey") % 4 == i)
        if day == "2024-01-02":
            part = part.withColumn("quantity", F.col("quantity").cast("string"))
        part.coalesce(1).write.parquet(f"{root}/run_id=R1/snapshot_date={day}")
    broken = f"{root}/run_id=R1/snapshot_date=2024-01-09"
    os.makedirs(broken)
    with open(f"{broken}/part-0.parquet", "wb") as out:
        out.write(os.urandom(500))
    os.makedirs(f"{root}/run_id=R1/snapshot_date=2023-12-31")  # not tracked
    lines.coalesce(1).write.parquet(f"{root}/run_id=R1/snapshot_date=2023-12-30")
    csv = f"{folder}/mapping.csv"
    with open(csv, "w") as out:
        out.write("dataset_name,s3_bucket_name,bucket_prefix,dbx_catalog,dbx_managed_table_schema,datetime\n"
                  "ds_a,bkt,trusted/ds_a/,spark_catalog,e2e,\n")
    spec = PartitionSpec(scheme=f"{folder}/")
    spark.sql("CREATE DATABASE IF NOT EXISTS e2e")
    tables = Tables().within("e2e")
    create_state(spark, tables, spec)
    tags = [("ds_a", "R1", "SNAPSHOT_DATE", d) for d in [*days, "2024-01-09"]] + [
        ("ds_a", "R1", "snapshot_date", "no date"), ("ds_b", "R1", "snapshot_date", "2023-12-30")]
    spark.createDataFrame(tags, spark.table(tables.tags).schema).write.insertInto(tables.tags)
    return spec, tables, csv, folder


def test_whole_run(spark, lake):
    spec, tables, csv, folder = lake
    migrate.take_inventory(spark, tables, "run-1", csv, spec)
    inventory = spark.table(tables.inventory)
    names = {os.path.basename(r.key) for r in inventory.select("key").collect()}
    assert "_SUCCESS" in names and "part-0.parquet" in names
    assert not any(n.endswith(".crc") for n in names)
    data = inventory.filter("extension IS NOT NULL")
    assert data.count() == 6
    assert {r.snapshot_date for r in data.collect()} >= {dt.date(2024, 1, 1), dt.date(2024, 1, 9)}
    one = spark.table(tables.candidates).collect()
    assert [(r.table_name, r.structured_file_count, r.total_file_count) for r in one] == [("ds_a", 6, 11)]

    # a second inventory finds nothing new
    before = inventory.count()
    migrate.take_inventory(spark, tables, "run-1", csv, spec)
    assert spark.table(tables.inventory).count() == before
    assert spark.table(tables.mapping).count() == 1

    verdict = migrate.assess_drift(spark, tables, "bkt", spec=spec).collect()[0]
    assert (verdict.corrupted_files, verdict.total_non_corrupted_files) == (1, 4)
    assert not verdict.schema_consistent and verdict.partition_consistent
    assert spark.table(tables.candidates).first().candidate_for_managed_table_creation == "false"
    assert '"corrupted_files": 1' in spark.table(tables.candidates).first().schema_analysis_results

    status = {str(r.snapshot_date): r.load_status for r in migrate.load(spark, tables, spec).collect()}
    assert status == {"2024-01-01": "loaded", "2024-01-02": "failed", "2024-01-03": "loaded",
                      "2024-01-04": "loaded", "2024-01-09": "failed"}
    stored = spark.table(tables.inventory)
    assert stored.filter("load_status = 'failed'").filter("extension IS NOT NULL").count() == 2
    assert spark.table(tables.candidates).first().managed_table_created == "true"
    assert spark.table(tables.pending).count() == 0
    assert migrate.load(spark, tables, spec).count() == 0  # everything is claimed or done

    first = reconcile.reconcile_all(spark, tables, "bkt", spec=spec)
    by_type = {r.recon_type: r.status for r in first.collect()}
    assert by_type["ROW_COUNT"] == "FAIL"
    assert by_type["Partiton_Data_count"] == "FAIL"
    assert by_type["SCHEMA_VALIDATION"] == "PASS" and by_type["CHECKSUM_VALIDATION"] == "PASS"
    assert spark.table(tables.candidates).first().recon_status == "FAIL"

    log = migrate.remediate(spark, tables, spec).collect()[0]
    assert (log.partitions_attempted, log.partitions_remediated, log.partitions_failed) == (2, 1, 1)
    assert log.remediation_status == "FAIL" and "2024-01-09" in log.error_msg
    # one partition is still broken, so the verdict is not reopened
    assert spark.table(tables.candidates).first().recon_job_run == "true"
    assert spark.table("e2e.ds_a").filter("snapshot_date = date'2024-01-02'").count() > 0


def test_repaired_lake_passes(spark, lake):
    """Continues ``test_whole_run``: the broken file is delivered again, all checks pass."""
    spec, tables, _, folder = lake
    root = f"{folder}/bkt/trusted/ds_a/run_id=R1"
    good = spark.read.parquet(f"{root}/snapshot_date=2024-01-03")
    good.coalesce(1).write.mode("overwrite").parquet(f"{root}/snapshot_date=2024-01-09")
    log = migrate.remediate(spark, tables, spec).collect()[0]
    assert (log.partitions_attempted, log.partitions_remediated, log.partitions_failed) == (1, 0, 1)
    # the inventory still names the old file: a new inventory brings the new one
    migrate.take_inventory(spark, tables, "run-1", None, spec)
    fresh = spark.table(tables.inventory).filter("load_status IS NULL AND extension IS NOT NULL")
    assert sorted(str(r.snapshot_date) for r in fresh.collect()) == ["2023-12-30", "2024-01-09"]


def test_reconcile_all_statuses(spark, lake):
    _, tables, _, _ = lake
    stored = spark.table(tables.results)
    assert stored.count() == 6 and stored.select("table_name").distinct().count() == 1
