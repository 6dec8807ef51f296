"""Verdicts of whole runs: a clean table, unreadable sources and targets, repaired partitions."""
import pytest
from pyspark.sql import functions as F

from lakeproof import PartitionSpec
from lakeproof.plans import migrate, reconcile
from lakeproof.plans.state import Tables, create_state
from lakeproof.sources import tables as tb


@pytest.fixture(scope="module")
def state(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("recon"))
    rows = spark.range(300).select("id", (F.col("id") * 1.5).alias("amount"), F.concat(F.lit("n"), "id").alias("name"))
    for name in ("clean", "drifted"):
        for i in range(3):
            part = rows.filter(F.col("id") % 3 == i)
            if name == "drifted" and i == 0:
                part = part.withColumn("amount", F.col("amount").cast("string"))
            part.coalesce(1).write.parquet(f"{folder}/bkt/t/{name}/run_id=Ra/snapshot_date=2024-02-0{i + 1}")
    spec = PartitionSpec(scheme=f"{folder}/")
    spark.sql("CREATE DATABASE IF NOT EXISTS rec")
    tables = Tables().within("rec")
    create_state(spark, tables, spec)
    create_state(spark, tables, spec)  # nothing to do the second time
    csv = f"{folder}/m.csv"
    with open(csv, "w") as out:
        out.write("dataset_name,s3_bucket_name,bucket_prefix,dbx_catalog,dbx_managed_table_schema,datetime\n")
        for name in ("clean", "drifted"):
            out.write(f"{name},bkt,t/{name}/,spark_catalog,rec,\n")
    tags = [(n, "Ra", "snapshot_date", f"2024-02-0{i}") for n in ("clean", "drifted") for i in (1, 2, 3)]
    spark.createDataFrame(tags, spark.table(tables.tags).schema).write.insertInto(tables.tags)
    migrate.take_inventory(spark, tables, "run-1", csv, spec)
    migrate.assess_drift(spark, tables, "bkt", spec=spec)
    migrate.load(spark, tables, spec, bucket="bkt")
    return spec, tables


def verdicts(spark, tables):
    return {r.table_name: (r.recon_job_run, r.recon_status) for r in spark.table(tables.candidates).collect()}


def test_clean_table_passes_and_drifted_one_does_not(spark, state):
    spec, tables = state
    flags = {r.table_name: r.candidate_for_managed_table_creation for r in spark.table(tables.candidates).collect()}
    assert flags == {"clean": "true", "drifted": "false"}
    found = reconcile.reconcile_all(spark, tables, "bkt", spec=spec, extra=True)
    assert found.count() == 14
    assert {r.status for r in found.filter("table_name = 'clean'").collect()} == {"PASS"}
    assert verdicts(spark, tables) == {"clean": ("true", "PASS"), "drifted": ("true", "FAIL")}


def test_remediation_reopens_and_then_passes(spark, state):
    spec, tables = state
    log = migrate.remediate(spark, tables, spec, bucket="bkt", datasets=["drifted"]).collect()
    assert [(r.dataset_name, r.partitions_remediated, r.remediation_status) for r in log] == [("drifted", 1, "PASS")]
    assert verdicts(spark, tables)["drifted"][0] is None
    assert spark.table(tables.inventory).filter("load_status = 'failed'").count() == 0
    assert spark.table("rec.drifted").count() == 300 and spark.table("rec.drifted").filter("amount IS NULL").count() == 0
    again = reconcile.reconcile_all(spark, tables, "bkt", only_open=True, spec=spec)
    assert {r.table_name for r in again.collect()} == {"drifted"}
    assert verdicts(spark, tables)["drifted"] == ("true", "PASS")


def test_tables_that_cannot_be_read(spark, state):
    spec, tables = state
    mapping = spark.table(tables.mapping)
    extra = [("nosource", "bkt", "t/none/", "spark_catalog", "rec"), ("noprefix", "bkt", None, "spark_catalog", "rec")]
    rows = spark.createDataFrame(extra, mapping.drop("datetime").schema).withColumn("datetime", F.current_timestamp())
    tb.replace_table(mapping.unionByName(rows), tables.mapping)
    candidates = spark.table(tables.candidates)
    made = spark.createDataFrame([("run-2", "bkt", n, "true") for n in ("nosource", "noprefix")],
                                 "execution_id string, s3_bucket_name string, table_name string, managed_table_created string")
    tb.replace_table(candidates.unionByName(made, allowMissingColumns=True), tables.candidates)
    found = reconcile.reconcile_all(spark, tables, only=["nosource", "noprefix"], spec=spec)
    assert {(r.table_name, r.recon_type, r.status) for r in found.collect()} == {
        ("nosource", "data_read_error", "ERROR"), ("noprefix", "source_read_error", "ERROR")}
    assert verdicts(spark, tables)["nosource"] == ("true", "SKIPPED")
    assert verdicts(spark, tables)["noprefix"] == ("false", "FAIL")
    spark.sql("DROP TABLE rec.clean")
    gone = reconcile.reconcile_all(spark, tables, only=["clean"], spec=spec).collect()
    assert [(r.recon_type, r.status) for r in gone] == [("data_read_error", "ERROR")]
    assert verdicts(spark, tables)["clean"] == ("true", "SKIPPED")


def test_interrupted_run_is_settled(spark, state):
    """Load status left behind by a run that was cut off reaches the inventory."""
    spec, tables = state
    inventory = spark.table(tables.inventory)
    undone = inventory.withColumn("load_status", F.when(F.col("bucket_prefix") != "t/clean/", F.col("load_status")))
    tb.replace_table(undone, tables.inventory)
    left = spark.table(tables.inventory).filter("bucket_prefix = 't/clean/' AND snapshot_date IS NOT NULL").select(
        F.lit("p").alias("partition_path"), F.col("s3_bucket_name").alias("bucket_name"), "bucket_prefix", "run_id",
        "snapshot_date", F.lit("loaded").alias("load_status"), F.lit(None).cast("string").alias("was"))
    left.write.insertInto(tables.pending)
    migrate.settle(spark, tables, spec)
    assert spark.table(tables.pending).count() == 0
    assert spark.table(tables.inventory).filter("bucket_prefix = 't/clean/' AND load_status = 'loaded'").count() >= 3
