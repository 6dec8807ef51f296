"""Plans lose and double nothing: late files, stray folders, unlisted folders, shared batches."""
import os
import stat

import pytest
from pyspark.sql import functions as F

from lakeproof import PartitionSpec, schemas as S
from lakeproof.operators import ledger, objects as ob, partitions as parts
from lakeproof.plans import compare, migrate, reconcile
from lakeproof.plans.state import Tables, create_state
from lakeproof.sources import bytes as by, listing, storage, tables as tb
from lakeproof.streaming import ingest

SCHEMA = "id bigint, amt double, run_id string, snapshot_date date"
DAYS = [f"2024-01-0{i}" for i in range(1, 5)]


def write(spark, folder, low, high):
    spark.range(low, high).selectExpr("id", "cast(id as double) as amt").coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def lake(spark, tmp_path, request):
    """One dataset of four days of 50 rows, a stray folder beside them, state tables."""
    name = "loss_" + "".join(c for c in request.node.name if c.isalnum())
    root = f"{tmp_path}/bkt/trusted/ds_a"
    for i, day in enumerate(DAYS):
        write(spark, f"{root}/run_id=R1/snapshot_date={day}", 50 * i, 50 * i + 50)
    write(spark, f"{root}/loose", 900, 910)
    csv = f"{tmp_path}/mapping.csv"
    with open(csv, "w") as out:
        out.write("dataset_name,s3_bucket_name,bucket_prefix,dbx_catalog,dbx_managed_table_schema,datetime\n"
                  f"ds_a,bkt,trusted/ds_a/,spark_catalog,{name},\n")
    spec, tables = PartitionSpec(scheme=f"{tmp_path}/"), Tables().within(name)
    spark.sql(f"CREATE DATABASE {name}")
    create_state(spark, tables, spec)
    tags = [("ds_a", "R1", "snapshot_date", d) for d in DAYS]
    spark.createDataFrame(tags, spark.table(tables.tags).schema).write.insertInto(tables.tags)
    yield spec, tables, csv, root, f"{name}.ds_a"
    spark.sql(f"DROP DATABASE {name} CASCADE")


def run(spark, lake, name):
    spec, tables, csv, *_ = lake
    migrate.take_inventory(spark, tables, name, csv, spec)
    migrate.assess_drift(spark, tables, "bkt", spec=spec)
    return migrate.load(spark, tables, spec)


@pytest.mark.parametrize("batch", [5000, 2])
def test_stray_folder_and_any_number_of_folders(spark, lake, monkeypatch, batch):
    spec, tables, _, root, table = lake
    monkeypatch.setattr(tb.batches, "__defaults__", (batch,))
    assert run(spark, lake, "run-1").filter("load_status = 'loaded'").count() == 4
    index = reconcile.source_index(spark, tables, spark.table(tables.mapping), spec)
    assert reconcile.source_side(spark, index, "bkt", "trusted/ds_a/", spec).count() == 200
    got = {r.recon_type: r.status for r in reconcile.reconcile_all(spark, tables, spec=spec).collect()}
    assert got["ROW_COUNT"] == "PASS" and S.READ_ERROR not in got
    failed = spark.createDataFrame([(f"{root}/run_id=R1/snapshot_date={d}",) for d in DAYS[:3]], "partition_path string")
    schema = spark.table(table).schema
    counts = migrate.rows_in_failed(spark, failed, root, schema, spec).collect()
    assert sorted(r["rows"] for r in counts) == [50] * 3


def test_late_file_and_repeated_load_double_nothing(spark, lake):
    spec, tables, _, root, table = lake
    run(spark, lake, "run-1")
    assert spark.table(table).count() == 200
    write(spark, f"{root}/run_id=R1/snapshot_date={DAYS[1]}", 5000, 5010)
    migrate.take_inventory(spark, tables, "run-2", None, spec)
    plan = parts.load_plan(spark.table(tables.inventory), spark.table(tables.tags), spec)
    for _ in range(2):      # a second time as after a crash before the status was kept
        migrate.load_dataset(spark, plan, spark.table(tables.inventory), spark.table(table).schema, table, root, spec)
        days = {str(r.snapshot_date): r["count"] for r in spark.table(table).groupBy("snapshot_date").count().collect()}
        assert days == {d: 60 if d == DAYS[1] else 50 for d in DAYS}


def test_two_spellings_of_a_partition_load_together(spark, lake):
    spec, tables, _, root, table = lake
    write(spark, f"{root}/RUN_ID=R1/snapshot_date={DAYS[0]}", 7000, 7005)
    run(spark, lake, "run-1")
    assert spark.table(table).count() == 205


def test_a_folder_that_cannot_be_listed_is_found_later(spark, lake, monkeypatch):
    spec, tables, csv, root, _ = lake
    closed, real = f"snapshot_date={DAYS[2]}", storage.children
    monkeypatch.setattr(listing, "WAITS", (0.0,))

    def children(folder):
        if closed in folder and os.path.exists(f"{root}/closed"):
            raise PermissionError(folder)
        return real(folder)
    # Workers fork after the patch and share the marker file.
    monkeypatch.setattr(storage, "children", children)
    found = list(listing._lister(True)(iter([__import__("pandas").DataFrame([{"__folder": root}])])))
    assert not any(f["error"].notna().any() for f in found)
    open(f"{root}/closed", "w").close()
    rows = [r for f in listing._lister(True)(iter([__import__("pandas").DataFrame([{"__folder": root}])]))
            for r in f.to_dict("records")]
    wrong = [r for r in rows if r["error"]]
    assert len(wrong) == 1 and closed in wrong[0]["path"] and "PermissionError" in wrong[0]["error"]

    # Nothing is stored of a dataset with such a folder, so its mark does not hide files.
    monkeypatch.undo()
    listed = listing.list_files

    def broken(roots, **options):
        rows = listed(roots, **options).filter(~F.col("path").contains(closed))
        fault = roots.select("s3_bucket_name", "bucket_prefix", F.concat("path", F.lit(closed)).alias("path"),
                             F.lit("PermissionError").alias("error"))
        return rows.unionByName(fault, allowMissingColumns=True)
    monkeypatch.setattr(listing, "list_files", broken)
    unlisted = migrate.take_inventory(spark, tables, "run-1", csv, spec)
    assert [r.error for r in unlisted.collect()] == ["PermissionError"]
    assert spark.table(tables.inventory).count() == 0
    monkeypatch.undo()
    assert migrate.take_inventory(spark, tables, "run-2", None, spec).count() == 0
    assert spark.table(tables.inventory).filter(F.col("key").contains(closed) & F.col("extension").isNotNull()).count() == 1


def test_listing_fails_by_default(spark, tmp_path):
    if os.geteuid() == 0:
        bad = "unknown-scheme://x/y"
    else:
        bad = f"{tmp_path}/closed"
        os.makedirs(bad)
        os.chmod(bad, stat.S_IWUSR)
    roots = listing.roots_frame(spark, [bad])
    with pytest.raises(Exception, match="cannot list"):
        listing.list_files(roots, split_levels=0).collect()
    assert listing.list_files(roots, split_levels=1, errors="report").filter("error is not null").count() == 1
    assert listing.list_files(listing.roots_frame(spark, [f"{tmp_path}/absent"])).count() == 0


def test_claim_without_mapping_is_given_back(spark, lake):
    spec, tables, csv, *_ = lake
    migrate.take_inventory(spark, tables, "run-1", csv, spec)
    migrate.assess_drift(spark, tables, "bkt", spec=spec)
    tb.replace_table(spark.table(tables.mapping).filter("false"), tables.mapping)
    assert migrate.load(spark, tables, spec).count() == 0
    assert spark.table(tables.claims).count() == 0
    assert spark.table(tables.candidates).first().error_message == "Failed to Process"


def test_a_table_that_refuses_ends_the_search(spark):
    jobs = []

    def work(rows):
        jobs.append(len(rows))
        raise ValueError("no")
    rows = [[r] for r in spark.createDataFrame([(str(i),) for i in range(64)], "partition_path string").collect()]

    def refuse():
        raise ValueError("no")
    assert len(migrate._run_isolating(rows, work, refuse)) == 64 and jobs == [64]


def test_several_mappings_of_one_batch(spark):
    """Two folders with a file of the same name: the one missing at the destination is found."""
    mapping = spark.createDataFrame(
        [("b", "s3://inv", "src", p, "n", "s3://inv", "dst", p, "n", None, None, None, None, True) for p in ("A/", "B/")],
        S.COPY_MAPPING)
    rows = [("src", "A/p.parquet", "A/"), ("src", "B/p.parquet", "B/"), ("dst", "A/p.parquet", "A/")]
    details = spark.createDataFrame(
        [(b, k, "1", "2024-01-01 00:00:00", "e", p, "s3://inv", "false") for b, k, p in rows],
        "Bucket string, Key string, Size string, LastModifiedDate string, ETag string, prefix string, "
        "inventory_s3_location string, processed string")
    found = compare.compare_batch(details, mapping)
    assert sorted(r.status for r in found.collect()) == sorted([S.SAME, S.ONLY_SRC])
    stored = ob.diff_rows(ob.differences(found), mapping, "run").collect()
    assert [(r.Key, r.src_prefix, r.dest_prefix) for r in stored] == [("p.parquet", "B/", "B/")]


def test_unreadable_content_is_not_taken_as_equal(spark):
    found = spark.createDataFrame([("b", "k", S.SAME), ("b", "m", S.SAME)], "s3_batch_copy_id string, rel_key string, status string")
    contents = spark.createDataFrame([("b", "k", None), ("b", "m", True)],
                                     "s3_batch_copy_id string, rel_key string, checksum_valid boolean")
    got = ob.with_unread(ob.with_checksums(found, by.mismatched(contents)), by.unread(contents))
    assert {r.rel_key: r.status for r in got.collect()} == {"k": S.UNKNOWN, "m": S.SAME}
    assert ob.verdict(got).first().status == "WARNING"


def test_a_repeated_listing_adds_its_files_once(spark, tmp_path):
    entry = [("bkt", "ds/", "s3://bkt/ds/run_id=R1/snapshot_date=2024-01-01/a.parquet", "a.parquet", None, 1, ".parquet")]
    df = spark.createDataFrame(entry, S.LISTING).withColumn("last_modified_time", F.lit("2024-01-01").cast("timestamp"))
    mapping = spark.createDataFrame([("ds", "bkt", "ds/", "c", "s", None)], S.MAPPING)
    for _ in range(2):
        for _ in range(2):
            df.write.mode("append").parquet(f"{tmp_path}/in")
        ingest.ingest_listings(spark, f"{tmp_path}/in", S.LISTING, f"{tmp_path}/out", f"{tmp_path}/ck", mapping, "run")
        assert spark.read.parquet(f"{tmp_path}/out").count() == 1


def test_no_paths_are_no_rows(spark, tmp_path):
    write(spark, f"{tmp_path}/t/run_id=R1/snapshot_date=2024-01-01", 0, 5)
    schema = spark.createDataFrame([], SCHEMA).schema
    assert tb.read_partitions(spark, f"{tmp_path}/t", [], schema).count() == 0
    assert tb.read_partitions(spark, f"{tmp_path}/t", None, schema).count() == 5


def test_restriction_prunes_the_scan(spark, tmp_path):
    for day in DAYS:
        write(spark, f"{tmp_path}/t/run_id=R1/snapshot_date={day}", 0, 5)
    data = spark.read.parquet(f"{tmp_path}/t")
    keys = ["run_id", "snapshot_date"]
    one = parts.restrict(data, parts.latest_partitions(data, keys, 1), keys, at_most=1)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 5 and "PartitionFilters: []" not in plan and "2024-01-0" in plan


def drifted_day(spark, lake, day):
    """A day whose amounts are text."""
    _, tables, _, root, _ = lake
    spark.range(5).selectExpr("id", "'7' as amt").coalesce(1).write.parquet(f"{root}/run_id=R1/snapshot_date={day}")
    tags = spark.createDataFrame([("ds_a", "R1", "snapshot_date", day)], spark.table(tables.tags).schema)
    tags.write.insertInto(tables.tags)


def test_schemas_of_failed_partitions_are_stored(spark, lake):
    spec, tables, *_ = lake
    drifted_day(spark, lake, "2023-12-31")
    failed = run(spark, lake, "run-1").filter("load_status = 'failed'").collect()
    assert [str(r.snapshot_date) for r in failed] == ["2023-12-31"]
    outcome = {r.column_name.lower(): r for r in migrate.compare_failed_schemas(spark, tables, spec).collect()}
    assert outcome["amt"].partitions_mismatched == 1 and outcome["id"].ever_matched
    stored = {r.Base_Column_Name: r for r in spark.table(tables.comparison).collect()}
    assert stored["AMT"].Status == "FAIL" and stored["ID"].Status == "PASS" and stored["ID"].dataset_name == "ds_a"


def test_a_drifted_newest_partition_fails_the_older_ones(spark, lake):
    """The newest partition sets the read schema; the others are repaired to it afterwards."""
    spec, tables, *_, table = lake
    drifted_day(spark, lake, "2024-01-05")
    status = {str(r.snapshot_date): r.load_status for r in run(spark, lake, "run-1").collect()}
    assert status == {**dict.fromkeys(DAYS, "failed"), "2024-01-05": "loaded"}
    outcome = {r.column_name: r for r in migrate.compare_failed_schemas(spark, tables, spec).collect()}
    assert outcome["amt"].partitions_mismatched == 4 and outcome["id"].partitions_matched == 4
    migrate.remediate(spark, tables, spec)
    assert counts(spark, table) == {**dict.fromkeys(DAYS, 50), "2024-01-05": 5}


def counts(spark, table):
    return {str(r.snapshot_date): r["count"] for r in spark.table(table).groupBy("snapshot_date").count().collect()}


def states(spark, tables):
    return {(str(r.snapshot_date), r.load_status) for r in
            spark.table(tables.inventory).filter("partition_key is not null and extension is not null").collect()}


def test_a_late_file_in_one_of_several_folders_loses_nothing(spark, lake):
    """The pair is loaded again from all its folders, also those that were loaded before."""
    spec, tables, _, root, table = lake
    other = f"{root}/RUN_ID=R1/snapshot_date={DAYS[0]}"
    write(spark, other, 7000, 7050)
    run(spark, lake, "run-1")
    assert counts(spark, table) == {**dict.fromkeys(DAYS, 50), DAYS[0]: 100}
    write(spark, other, 7100, 7110)
    status = run(spark, lake, "run-2").collect()
    assert [(str(r.snapshot_date), r.load_status) for r in status] == [(DAYS[0], "loaded")]
    assert counts(spark, table) == {**dict.fromkeys(DAYS, 50), DAYS[0]: 110}
    report = {str(r.snapshot_date): r for r in ledger.ledger_report(
        spark.table(tables.inventory), spark.table(tables.ledger), spec).collect()}
    assert (report[DAYS[0]].folders, report[DAYS[0]].files, report[DAYS[0]].files_held) == (2, 3, 3)
    assert {r.files_missing for r in report.values()} == {0}


def test_a_pair_with_one_bad_folder_is_not_touched(spark, lake):
    spec, tables, _, root, table = lake
    other = f"{root}/RUN_ID=R1/snapshot_date={DAYS[0]}"
    write(spark, other, 7000, 7050)
    run(spark, lake, "run-1")
    with open(f"{other}/broken.parquet", "w") as out:
        out.write("no parquet")
    assert [r.load_status for r in run(spark, lake, "run-2").collect()] == ["failed"]
    assert counts(spark, table)[DAYS[0]] == 100
    migrate.remediate(spark, tables, spec)
    assert counts(spark, table)[DAYS[0]] == 100 and (DAYS[0], "failed") in states(spark, tables)
    os.unlink(f"{other}/broken.parquet")
    report = ledger.ledger_report(spark.table(tables.inventory), spark.table(tables.ledger), spec)
    assert report.filter("files_missing = 1").count() == 1


def test_remediation_takes_the_place_of_what_was_loaded(spark, lake):
    """A late file in a loaded day, whose read schema has changed meanwhile."""
    spec, tables, _, root, table = lake
    run(spark, lake, "run-1")
    write(spark, f"{root}/run_id=R1/snapshot_date={DAYS[1]}", 8000, 8010)
    drifted_day(spark, lake, "2024-01-05")
    status = {str(r.snapshot_date): r.load_status for r in run(spark, lake, "run-2").collect()}
    assert status[DAYS[1]] == "failed" and counts(spark, table)[DAYS[1]] == 50
    for _ in range(2):      # the second time as after a crash before the status was kept
        failed = parts.failed_partitions(spark.table(tables.inventory), spark.table(tables.mapping), spec)
        done = migrate.remediate_dataset(spark, failed.filter(F.col("snapshot_date") == DAYS[1]), spark.table(tables.inventory),
                                         spark.table(table).schema, table, root, spec)
        assert [r.load_status for r in done.collect()] == ["loaded"]
        assert counts(spark, table)[DAYS[1]] == 60
    migrate.remediate(spark, tables, spec)
    assert counts(spark, table) == {**dict.fromkeys(DAYS, 50), DAYS[1]: 60, "2024-01-05": 5}
    assert not any(status == "failed" for _, status in states(spark, tables))
    assert ledger.stale_pairs(spark.table(tables.inventory), spark.table(tables.ledger), spec).count() == 0


def test_files_of_two_schemas_in_one_folder_are_repaired_together(spark, lake):
    spec, tables, _, root, table = lake
    spark.range(3).selectExpr("id", "'9' as amt").coalesce(1).write.mode("append").parquet(
        f"{root}/run_id=R1/snapshot_date={DAYS[0]}")
    run(spark, lake, "run-1")
    assert DAYS[0] not in counts(spark, table)
    migrate.remediate(spark, tables, spec)
    assert counts(spark, table) == {**dict.fromkeys(DAYS, 50), DAYS[0]: 53}


def test_a_load_that_missed_a_file_is_found_and_repeated(spark, lake):
    """The ledger tells that the newest load of a pair lacks a file, whatever its status says."""
    spec, tables, _, root, table = lake
    run(spark, lake, "run-1")
    day = F.col("snapshot_date") == DAYS[2]
    lost = spark.table(tables.ledger).filter(~(day & F.col("data_file").contains("part-")))
    kept = spark.table(tables.ledger).filter(day).withColumn("data_file", F.lit("gone"))
    tb.replace_table(lost.unionByName(kept), tables.ledger)
    assert ledger.stale_pairs(spark.table(tables.inventory), spark.table(tables.ledger), spec).count() == 1
    plan = migrate.whole_plan(spark.table(tables.inventory), spark.table(tables.tags), spark.table(tables.ledger), spec)
    assert [str(r.snapshot_date) for r in plan.collect()] == [DAYS[2]]


def state_files(spark, table):
    """Data files of a state table by dataset prefix."""
    rows = spark.table(table).select("bucket_prefix", F.col("_metadata.file_path").alias("f")).distinct().collect()
    return {p: {r.f for r in rows if r.bucket_prefix == p} for p in {r.bucket_prefix for r in rows}}


def test_a_change_to_one_dataset_leaves_the_files_of_others(spark, lake, tmp_path):
    spec, tables, csv, root, table = lake
    other = root.replace("ds_a", "ds_b")
    write(spark, f"{other}/run_id=R1/snapshot_date={DAYS[0]}", 0, 20)
    with open(csv, "a") as out:
        out.write(f"ds_b,bkt,trusted/ds_b/,spark_catalog,{table.split('.')[0]},\n")
    spark.createDataFrame([("ds_b", "R1", "snapshot_date", DAYS[0])], spark.table(tables.tags).schema).write.insertInto(tables.tags)
    run(spark, lake, "run-1")
    before, ledger_before = state_files(spark, tables.inventory), state_files(spark, tables.ledger)
    n = spark.table(tables.inventory).filter("extension IS NOT NULL").count()
    write(spark, f"{root}/run_id=R1/snapshot_date={DAYS[1]}", 5000, 5010)
    assert [r.load_status for r in run(spark, lake, "run-2").collect()] == ["loaded"]
    after = state_files(spark, tables.inventory)
    assert after["trusted/ds_b/"] == before["trusted/ds_b/"] and not after["trusted/ds_a/"] & before["trusted/ds_a/"]
    assert state_files(spark, tables.ledger)["trusted/ds_b/"] == ledger_before["trusted/ds_b/"]
    assert spark.table(tables.inventory).filter("extension IS NOT NULL").count() == n + 1 and len(states(spark, tables)) == 4
    assert not any(status is None for _, status in states(spark, tables))
    one = tb.of_datasets(spark.table(tables.inventory), spark.createDataFrame([("bkt", "trusted/ds_b/")], "s3_bucket_name string, bucket_prefix string"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and one.select("bucket_prefix").distinct().count() == 1


def results(spark, lake, **options):
    spec, tables, *_ = lake
    return {r.recon_type: r for r in reconcile.reconcile_all(spark, tables, spec=spec, **options).collect()}


def test_source_files_that_are_not_read_are_counted(spark, lake):
    spec, tables, _, root, table = lake
    bad = f"{root}/run_id=R1/snapshot_date=2024-01-09"
    os.makedirs(bad)
    with open(f"{bad}/part-0.parquet", "w") as out:
        out.write("no parquet")
    spark.createDataFrame([("ds_a", "R1", "snapshot_date", "2024-01-09")], spark.table(tables.tags).schema).write.insertInto(tables.tags)
    run(spark, lake, "run-1")
    row = results(spark, lake)["ROW_COUNT"]     # both sides lack the file, so the counts agree
    assert (row.status, row.source_metrics, row.target_metrics) == ("WARNING", "200", "200")
    assert row.error_log.startswith("1 source files not read whole") and "2024-01-09/part-0.parquet skipped" in row.error_log
    folder = f"{root}/run_id=R1/snapshot_date={DAYS[0]}"
    name = next(n for n in os.listdir(folder) if n.endswith(".parquet"))
    for extra in os.listdir(folder):
        if extra.endswith(".crc"):
            os.unlink(f"{folder}/{extra}")
    with open(f"{folder}/{name}", "rb") as file:
        whole = file.read()
    # a damaged page: the footer reads, the rows do not
    with open(f"{folder}/{name}", "wb") as out:
        out.write(whole[:4] + os.urandom(len(whole) // 3) + whole[4 + len(whole) // 3:])
    assert results(spark, lake)["ROW_COUNT"].error_log.startswith("1 source files")
    assert results(spark, lake, decode=True)["ROW_COUNT"].error_log.startswith("2 source files")
    os.unlink(f"{folder}/{name}")
    write(spark, folder, 0, 1)      # another file in its place is not the one that is known
    row = results(spark, lake)["ROW_COUNT"]
    assert row.status == "FAIL" and row.error_log.startswith("2 source files")
    tb.replace_table(spark.table(tables.inventory).filter("snapshot_date <> date'2024-01-09' AND snapshot_date <> date'2024-01-01'"), tables.inventory)
    assert results(spark, lake)["ROW_COUNT"].error_log is None


def test_every_partition_and_column_can_be_checked(spark, lake):
    """A value changed in an older partition, which the default checks do not read."""
    spec, tables, _, root, table = lake
    run(spark, lake, "run-1")
    changed = spark.table(table).withColumn("amt", F.expr("if(id = 3, -1D, amt)"))
    rows = changed.filter(F.col("snapshot_date") == DAYS[0]).collect()
    tb.append_evolving(spark.createDataFrame(rows, changed.schema), table, spec, replace_partitions=True)
    got = results(spark, lake)
    assert got["CHECKSUM_VALIDATION"].status == got["VERIFIED"].status == "PASS"
    got = results(spark, lake, all_partitions=True, per_group=None, limit=None)
    assert got["CHECKSUM_VALIDATION"].status == got["VERIFIED"].status == "FAIL"
    assert got["CHECKSUM_VALIDATION"].metrics_different == 1 and DAYS[0] in got["CHECKSUM_VALIDATION"].summary


def test_second_file_with_another_schema_is_seen(spark, lake):
    spec, tables, csv, root, _ = lake
    spark.range(5).selectExpr("id", "'x' as amt").coalesce(1).write.mode("append").parquet(
        f"{root}/run_id=R1/snapshot_date={DAYS[3]}")
    migrate.take_inventory(spark, tables, "run-1", csv, spec)
    verdict = migrate.assess_drift(spark, tables, "bkt", spec=spec).first()
    assert not verdict.schema_consistent and not verdict.candidate_for_managed_table_creation
