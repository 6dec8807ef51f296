import datetime as dt
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof import PartitionSpec, schemas
from lakeproof.functions.types import canonical_schema
from lakeproof.plans.compare import compare_batch, finish_mapping, finish_reports, ingest_reports
from lakeproof.operators import drift, inventory as inv, objects as ob, partitions as parts_op
from lakeproof.plans import migrate
from lakeproof.sources import footers, listing, reports as rp, tables as tb


@pytest.fixture(scope="module")
def tree(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    for name in ("_SUCCESS", ".hidden", "a b.csv", "a%20b+c.parquet", "x/y/z/deep.bin", "x/top.bin", "x/y/mid.bin"):
        path = root / "bkt" / "ds" / name
        os.makedirs(path.parent, exist_ok=True)
        path.write_bytes(b"12345")
    os.makedirs(root / "bkt" / "ds" / "empty")
    return root


@pytest.mark.parametrize("levels", [0, 1, 2, 5])
def test_listing_is_whole_at_any_split(spark, tree, levels):
    roots = spark.createDataFrame([("ds", f"{tree}/bkt/ds/")], "bucket_prefix string, path string")
    found = listing.list_files(roots, split_levels=levels).collect()
    names = {r.path[len(f"{tree}/bkt/ds/"):]: r.extension for r in found}
    assert names == {"_SUCCESS": None, ".hidden": "hidden", "a b.csv": "csv", "a%20b+c.parquet": "parquet",
                     "x/y/z/deep.bin": "bin", "x/top.bin": "bin", "x/y/mid.bin": "bin"}
    assert {r["size"] for r in found} == {5} and all(r.last_modified_time for r in found)


def test_folders_and_missing_roots(spark, tree):
    roots = spark.createDataFrame([(f"{tree}/bkt/ds",), (f"{tree}/nowhere",)], "path string")
    paths = {r.path for r in listing.list_files(roots, folders=True).collect()}
    assert f"{tree}/bkt/ds/empty/" in paths and f"{tree}/bkt/ds/x/y/z/" in paths and len(paths) == 11


def test_footers_flag_unreadable_files(spark, tmp_path):
    good, nested = str(tmp_path / "p=1/good.parquet"), str(tmp_path / "p=2/nested.parquet")
    os.makedirs(tmp_path / "p=1"), os.makedirs(tmp_path / "p=2"), os.makedirs(tmp_path / "p=3")
    pq.write_table(pa.table({"B": pa.array([1], pa.decimal128(10, 2)), "a": pa.array([dt.datetime(2024, 1, 1)], pa.timestamp("us"))}), good)
    spark.sql("SELECT array(1) l, named_struct('x', 1L) s").coalesce(1).write.parquet(str(tmp_path / "w"))
    written = [f for f in os.listdir(tmp_path / "w") if f.endswith(".parquet")][0]
    os.link(tmp_path / "w" / written, nested)
    for name in ("p=3/bad.parquet", "p=2/empty.parquet"):
        (tmp_path / name).write_bytes(b"PAR1 not really" if "bad" in name else b"")
    files = spark.createDataFrame([(str(tmp_path / n),) for n in
                                   ("p=1/good.parquet", "p=2/nested.parquet", "p=2/empty.parquet", "p=3/bad.parquet", "p=3/none")],
                                  "data_file string")
    captured = footers.capture_files(files)
    by_file = {os.path.basename(r.data_file): r for r in captured.collect()}
    fields = {f["name"]: f["type"] for f in json.loads(by_file["good.parquet"].schema_json)["fields"]}
    assert fields["a"] == "timestamp_ntz" and list(fields) == ["a", "b"]
    assert '"array"' in by_file["nested.parquet"].schema_json
    assert all(by_file[n].is_corrupted and by_file[n].schema_json == "corrupted" and by_file[n].error_message
               for n in ("empty.parquet", "bad.parquet", "none"))
    parts = {r.file_path[-1]: (r.is_corrupted, r.schemas, r.files) for r in footers.capture_partitions(captured, []).collect()}
    assert parts == {"1": (False, 1, 1), "2": (True, 1, 2), "3": (True, 0, 2)}


def test_strict_and_lenient_reads(spark, tmp_path):
    root = str(tmp_path / "t")
    spark.sql("SELECT 1 v, 'R1' run_id, '2024-01-01' snapshot_date").write.partitionBy("run_id", "snapshot_date").parquet(root)
    os.makedirs(f"{root}/run_id=R1/snapshot_date=2024-01-02")
    with open(f"{root}/run_id=R1/snapshot_date=2024-01-02/x.parquet", "wb") as out:
        out.write(b"garbage garbage")
    schema = T.StructType().add("v", "integer").add("run_id", "string").add("snapshot_date", "date")
    assert tb.read_partitions(spark, root, schema=schema, lenient=True).count() == 1
    with pytest.raises(Exception):
        tb.read_partitions(spark, root, schema=schema).select("v").collect()
    one = tb.read_partitions(spark, root, [f"{root}/run_id=R1/snapshot_date=2024-01-01"], schema)
    assert one.columns == ["v", "run_id", "snapshot_date"] and str(one.first().snapshot_date) == "2024-01-01"


def test_append_adds_columns_and_replaces_partitions(spark):
    spec = PartitionSpec()
    spark.sql("CREATE DATABASE IF NOT EXISTS src_t")
    schema = T.StructType().add("v", "integer").add("run_id", "string").add("snapshot_date", "date")
    tb.create_table(spark, "src_t.evolving", schema, spec)
    tb.create_table(spark, "src_t.evolving", schema, spec)  # exists already
    assert tb.partition_columns_of(spark, "src_t.evolving") == ["run_id", "snapshot_date"]
    base = spark.sql("SELECT 1 V, 'R' run_id, date'2024-01-01' snapshot_date")
    tb.append_evolving(base, "src_t.evolving", spec)
    tb.append_evolving(base.withColumn("more", F.lit("x")), "src_t.evolving", spec)
    tb.append_evolving(base.drop("V"), "src_t.evolving", spec)
    got = {(r.v, r.more) for r in spark.table("src_t.evolving").collect()}
    assert got == {(1, None), (1, "x"), (None, None)}
    with pytest.raises(ValueError):
        tb.append_evolving(base.withColumn("V", F.lit("text")), "src_t.evolving", spec)
    for _ in range(2):  # a repeated load leaves one copy
        tb.append_evolving(base, "src_t.evolving", spec, replace_partitions=True)
    assert spark.table("src_t.evolving").count() == 1


def test_replace_table_survives_a_cut(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS src_t")
    spark.range(3).write.saveAsTable("src_t.state")
    tb.replace_table(spark.table("src_t.state").filter("id > 0"), "src_t.state")
    assert spark.table("src_t.state").count() == 2
    spark.sql("ALTER TABLE src_t.state RENAME TO src_t.state__next")  # as if cut off before the rename
    tb.ensure_table(spark, "src_t.state", spark.range(1).schema)
    assert spark.table("src_t.state").count() == 2
    tb.empty_like(spark.table("src_t.state"), "src_t.none")
    assert spark.table("src_t.none").count() == 0


def test_mapping_csv(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("dataset_name,s3_bucket_name,bucket_prefix,dbx_catalog,dbx_managed_table_schema,datetime\nd,b,p/,c,s,\n")
    row = tb.read_mapping(spark, str(path)).first()
    assert row.dataset_name == "d" and row.datetime is not None


def report(root, spark, bucket, when, rows, kind, columns="Bucket, Key, Size, LastModifiedDate, ETag"):
    family = f"{root}/{bucket}/daily"
    data = f"{family}/data/{when}"
    df = spark.createDataFrame(rows, ", ".join(f"{c.strip()} string" for c in columns.split(",")))
    writer = df.repartition(2).write
    (writer.option("compression", "gzip").csv if kind == "CSV" else writer.format(kind.lower()).save)(data)
    files = [f for f in os.listdir(data) if not f.startswith(("_", "."))]
    os.makedirs(f"{family}/{when}", exist_ok=True)
    os.makedirs(f"{family}/hive/dt=1", exist_ok=True)
    with open(f"{family}/{when}/manifest.json", "w") as out:
        json.dump({"fileFormat": kind, "fileSchema": columns, "version": "x",
                   "files": [{"key": f"{bucket}/daily/data/{when}/{f}", "size": 1, "MD5checksum": "m"} for f in files]}, out, indent=2)


@pytest.mark.parametrize("kind", ["CSV", "Parquet", "ORC"])
def test_reports_from_discovery_to_verdict(spark, tmp_path, kind):
    root = str(tmp_path)
    t = "2024-01-0{}T00:00:00.000Z"
    keys = [(f"p/k{i}", str(i), t.format(1), "e") for i in range(9)]
    report(root, spark, "s", "2025-01-01T01-00Z", [("s", "p/old", "1", t.format(1), "e")], kind)
    report(root, spark, "s", "2025-01-02T01-00Z", [("s", *k) for k in keys] + [("s", "other/k", "1", t.format(1), "e")], kind)
    report(root, spark, "d", "2025-01-02T01-00Z", [("d", "q/" + k[0][2:], *k[1:]) for k in keys[1:]], kind)
    mapping = spark.createDataFrame(
        [("b1", root, "s", "p/", "daily", root, "d", "q/", "daily", None, "r0", None, None, True)],
        schemas.COPY_MAPPING)
    none = spark.createDataFrame([], "Bucket string, Key string, Size string, LastModifiedDate string, ETag string, "
                                     "inventory_s3_location string, path string, name string, prefix string, processed string, runId string")
    reports, details = ingest_reports(spark, mapping, spark.createDataFrame([], schemas.REPORT_LIST), none, "r1")
    assert {r.name for r in reports.collect()} == {"2025-01-02T01-00Z"}
    assert details.count() == 17  # the other prefix is not kept
    found = compare_batch(details, mapping)
    assert {r.status: r["count"] for r in found.groupBy("status").count().collect()} == {schemas.SAME: 8, schemas.ONLY_SRC: 1}
    diffs = ob.differences(found)
    done = finish_mapping(mapping, ob.verdict(found), ob.status_summary(diffs), "r1").first()
    assert (done.status, done.runId) == ("WARNING", "r1") and '"count":1' in done.recon_status
    # a newer report of the same family retires what waits
    report(root, spark, "s", "2025-01-03T01-00Z", [("s", *k) for k in keys[:3]], kind)
    reports, details = ingest_reports(spark, mapping, reports, details, "r2")
    waiting = details.filter("processed = 'false' AND Bucket = 's'")
    assert waiting.count() == 3 and {r.name for r in waiting.collect()} == {"2025-01-03T01-00Z"}
    assert {r.processed for r in reports.filter("runId = 'r1:r2'").collect()} == {"ignored"}
    reports, details = finish_reports(reports, details, "r3")
    assert {(r.processed, r.runId) for r in reports.collect()} == {("ignored", "r1:r2"), ("true", "r3")}
    assert {r.processed for r in details.collect()} == {"ignore", "true"}


def test_no_new_reports(spark):
    with pytest.raises(LookupError):
        rp.manifest_files(spark, spark.createDataFrame([], schemas.REPORT_LIST))


def test_report_list_text(spark):
    text = '[{"file": "s3://i/b/n", "name": "2025/", "size": 0.0, "modificationTime": "2025-01-01T00:00:00Z"}, {"file": "f", "name": "2024/"}]'
    got = rp.decode_report_list(spark.createDataFrame([("b", text)], "bucket_name string, list_of_files string"))
    assert [(r.path, r.name, r["size"]) for r in got.collect()] == [("s3://i/b/n", "2025/", 0.0), ("f", "2024/", None)]


def lake_of(spark, tmp_path, parts):
    """A one-dataset lake from (day, frame) pairs: spec, inventory, plan."""
    spec = PartitionSpec(scheme=f"{tmp_path}/")
    for day, frame in parts:
        frame.coalesce(1).write.parquet(f"{tmp_path}/b/ds/run_id=R/snapshot_date={day}")
    mapping = spark.createDataFrame([("ds", "b", "ds/")], "dataset_name string, s3_bucket_name string, bucket_prefix string")
    found = listing.list_files(listing.dataset_roots(mapping, spec.scheme))
    rows = inv.new_inventory(found, spark.createDataFrame([], schemas.inventory(spec)), mapping, "r", spec).cache()
    return spec, rows, parts_op.partition_rows(parts_op.work_files(rows, spec), spec)


def test_nested_columns_load(spark, tmp_path):
    df = spark.sql("SELECT 1 v, array(named_struct('x', 1.5D)) l, map('k', 1L) m")
    spec, rows, plan = lake_of(spark, tmp_path, [("2024-01-01", df), ("2024-01-02", df.withColumn("v", F.lit("t")))])
    schema = df.schema.add("run_id", "string").add("snapshot_date", "date")
    spark.sql("CREATE DATABASE IF NOT EXISTS src_t")
    status = migrate.load_dataset(spark, plan, rows, schema, "src_t.nested", f"{tmp_path}/b/ds/", spec)
    assert {str(r.snapshot_date): r.load_status for r in status.collect()} == {"2024-01-01": "loaded", "2024-01-02": "failed"}
    assert spark.table("src_t.nested").first().m == {"k": 1}
    # the table's type is fixed: a schema that contradicts it loads nothing and fails every partition
    other = migrate.load_dataset(spark, plan, rows, drift.read_schema(
        '{"fields": [{"name": "v", "type": "string", "nullable": true}]}', spec), "src_t.nested", f"{tmp_path}/b/ds/", spec)
    assert {r.load_status for r in other.collect()} == {"failed"} and spark.table("src_t.nested").count() == 1


def test_widening_is_no_failure_and_bad_pages_are_isolated(spark, tmp_path):
    one = spark.range(2000).select(F.col("id").cast("int").alias("v"), F.expr("uuid()").alias("t"))
    spec, rows, plan = lake_of(spark, tmp_path, [(f"2024-01-0{i}", one) for i in range(1, 6)])
    # damage the data pages of one file: its footer still reads
    folder = tmp_path / "b" / "ds" / "run_id=R" / "snapshot_date=2024-01-03"
    name = next(n for n in os.listdir(folder) if n.endswith(".parquet"))
    content = bytearray((folder / name).read_bytes())
    content[4:4 + len(content) // 2] = os.urandom(len(content) // 2)
    (folder / name).write_bytes(bytes(content))
    for sidecar in os.listdir(folder):
        if sidecar.endswith(".crc"):
            os.unlink(folder / sidecar)
    schema = T.StructType().add("v", "long").add("t", "string").add("run_id", "string").add("snapshot_date", "date")
    status = migrate.load_dataset(spark, plan, rows, schema, "src_t.wide", f"{tmp_path}/b/ds/", spec)
    assert {str(r.snapshot_date)[-1]: r.load_status for r in status.collect()} == {
        "1": "loaded", "2": "loaded", "3": "failed", "4": "loaded", "5": "loaded"}
    assert spark.table("src_t.wide").count() == 8000


def test_partition_columns_from_data(spark, tmp_path):
    df = spark.sql("SELECT '7' v, 'inner' run_id")
    spec, rows, plan = lake_of(spark, tmp_path, [("2024-01-01", df)])
    base = T.StructType().add("v", "long").add("run_id", "string").add("snapshot_date", "date")
    spark.sql("CREATE DATABASE IF NOT EXISTS src_t")
    for source, want in (("path", "R"), ("data", "inner")):
        table = f"src_t.from_{source}"
        tb.create_table(spark, table, base, spec)
        done = migrate.remediate_dataset(spark, plan, rows, base, table, f"{tmp_path}/b/ds/", spec, partitions_from=source)
        assert done.first().load_status == "loaded"
        row = spark.table(table).first()
        assert (row.v, row.run_id, str(row.snapshot_date)) == (7, want, "2024-01-01")


def arrow_files(folder):
    """Files of other writers with types Spark maps in its own way."""
    when = [dt.datetime(2024, 1, 1)]
    tables = {
        "plain": pa.table({"B": [1], "a": ["x"], "d": [dt.date(2024, 1, 1)], "f": pa.array([1.0], pa.float32()), "z": [b"x"]}),
        "unsigned": pa.table({n: pa.array([1], t) for n, t in
                              (("u1", pa.uint8()), ("u2", pa.uint16()), ("u4", pa.uint32()), ("u8", pa.uint64()), ("i1", pa.int8()))}),
        "times": pa.table({"ntz": pa.array(when, pa.timestamp("us")), "ltz": pa.array(when, pa.timestamp("ms", "UTC"))}),
        "decimals": pa.table({"d": pa.array([1], pa.decimal128(20, 3)), "fixed": pa.array([b"ab"], pa.binary(2))}),
        "nested": pa.table({"l": [[1, 2]], "s": [{"x": 1, "y": ["a"]}], "m": pa.array([[("k", 1.5)]], pa.map_(pa.string(), pa.float64()))}),
        "required": pa.table({"r": [1]}, pa.schema([pa.field("r", pa.int64(), nullable=False)])),
        "coded": pa.table({"c": pa.array(["a", "b"]).dictionary_encode()}),
    }
    for name, table in tables.items():
        pq.write_table(table, f"{folder}/{name}.parquet")
    pq.write_table(pa.table({"t": pa.array(when, pa.timestamp("ns"))}), f"{folder}/int96.parquet",
                   use_deprecated_int96_timestamps=True)
    return [*tables, "int96"]


def test_footer_schema_is_what_spark_reads(spark, tmp_path):
    for name in arrow_files(tmp_path):
        path = f"{tmp_path}/{name}.parquet"
        assert canonical_schema(footers.footer_schema(path)) == canonical_schema(spark.read.parquet(path).schema), name
    df = spark.sql("SELECT 1 v, cast('a' AS varchar(3)) c, timestamp'2024-01-01' t, array(1) l, interval '1' day i")
    df.coalesce(1).write.parquet(f"{tmp_path}/own")
    own = next(f for f in os.listdir(f"{tmp_path}/own") if f.endswith(".parquet"))
    assert canonical_schema(footers.footer_schema(f"{tmp_path}/own/{own}")) == canonical_schema(spark.read.parquet(f"{tmp_path}/own").schema)
    pq.write_table(pa.table({"t": pa.array([1], pa.timestamp("ns"))}), f"{tmp_path}/nanos.parquet")
    with pytest.raises(ValueError, match="nanoseconds"):
        footers.footer_schema(f"{tmp_path}/nanos.parquet")


def test_stored_report_rows_stay_in_place(spark):
    """Families are counted and broadcast: retiring shuffles no stored rows, whatever their number."""
    from lakeproof.sources.reports import retire_details
    stored = spark.range(60).selectExpr("'b' AS Bucket", "'s3://i' AS inventory_s3_location",
                                        "concat('f', id % 3) AS path", "if(id < 30, 'false', 'true') AS processed")
    kept = retire_details(stored, stored.filter("path = 'f1'"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert kept.filter("processed = 'ignore'").select("path").distinct().collect()[0][0] == "f1"
    assert kept.filter("processed = 'ignore'").count() == 10 and kept.count() == 60


def test_report_files_follow_the_rows(spark, tmp_path):
    """Compressed data files cannot be split, so the number of them must grow with the rows."""
    import json
    from queries.lake_queries import _write_report
    _write_report(spark, str(tmp_path), "b", "daily", "t", spark.range(0, 1_100_000, 1, 1).selectExpr("'b' AS Bucket", "id AS Key"), "CSV")
    manifest = json.loads((tmp_path / "b/daily/t/manifest.json").read_text())
    assert len(manifest["files"]) == 3
