from pyspark.sql import functions as F

from lakeproof import PartitionSpec
from lakeproof.functions import numeric, paths


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).cast("string").alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first().x


def test_bucket_is_taken_literally(spark):
    assert one(spark, paths.object_key("p", "b"), p="s3://a.b/x/y", b="a.b") == "x/y"
    assert one(spark, paths.object_key("p", "b"), p="s3://aXb/x/y", b="a.b") == "s3://aXb/x/y"


def test_extension(spark):
    cases = {"a.parquet": "parquet", "a.tar.gz": "gz", "a": None, "a.": "", ".hidden": "hidden"}
    for name, want in cases.items():
        assert one(spark, paths.extension("n"), n=name) == want


def test_file_type(spark):
    cases = {"a/b.csv": ".csv", "a.b/c": "", "x": None, "d/.bashrc": "", "a.": ".", "t.tar.gz": ".gz", "..a.b": ".b"}
    for key, want in cases.items():
        assert one(spark, paths.file_type("k"), k=key) == want, key


def test_partition_key(spark):
    assert one(spark, paths.partition_key("k"), k="t/RUN_ID=R1/snapshot_date=2024-01-01/f") == "run_id, snapshot_date"
    assert one(spark, paths.partition_key("k"), k="t/loose/f") is None
    assert one(spark, paths.partition_key("k"), k="a-b=1/c.d=2/==x") == "b, d"


def test_partition_value_keeps_case(spark):
    assert one(spark, paths.partition_value("k", "run_id"), k="t/RUN_ID=Ra/x") == "Ra"
    assert one(spark, paths.partition_value("k", "run_id", lower=True), k="t/RUN_ID=Ra/x") == "ra"
    assert one(spark, paths.partition_value("k", "run_id"), k="t/x") is None


def test_dates_never_raise(spark):
    for key, want in {"snapshot_date=2024-01-31/f": "2024-01-31", "snapshot_date=2024-13-01/f": None, "f": None}.items():
        got = one(spark, paths.partition_date("k", "snapshot_date"), k=key)
        assert (str(got) if got else None) == want


def test_parent_and_dataset(spark):
    assert one(spark, paths.parent("k"), k="a/b/c") == "a/b"
    assert one(spark, paths.parent("k"), k="abc") == "abc"
    for prefix, want in {"t/ds_a/": "ds_a", "t/ds_a": "ds_a", "ds": "ds", "a//": "", "": ""}.items():
        assert one(spark, paths.dataset_name("p"), p=prefix) == want
    assert one(spark, paths.partition_path("b", "k"), b="bk", k="t/x=1/f") == "s3://bk/t/x=1"


def test_percent_decode(spark):
    cases = {"a%20b+c.parquet": "a b+c.parquet", "100%_x%41": "100%_xA", "plain": "plain", "%C3%A9": "é", "50%": "50%"}
    for key, want in cases.items():
        assert one(spark, paths.percent_decode("k"), k=key) == want


def test_structure(spark):
    assert one(spark, paths.partition_structure("p"), p="s3://b/t/z=1/a=2/f") == "a/z"
    assert one(spark, paths.partition_structure("p"), p="s3://b/t/f") == ""


def test_layout_guard(spark):
    spec = PartitionSpec()
    ok, twice = "/t/run_id=1/snapshot_date=2/f", "/t/run_id=1/snapshot_date=2/snapshot_date=3/f"
    assert one(spark, paths.hive_layout("p", spec), p=ok) is True
    assert one(spark, paths.hive_layout("p", spec), p=twice) is False
    assert one(spark, paths.hive_layout("p", spec), p="/t/snapshot_date=2/run_id=1/f") is False


def test_swap_root_only_at_start(spark):
    assert one(spark, paths.swap_root("p", "s3://a/", "s3://b/"), p="s3://a/x/s3://a/") == "s3://b/x/s3://a/"
    assert one(spark, paths.swap_root("p", "s3://a/", "s3://b/"), p="s3://c/x") == "s3://c/x"


def test_report_parts(spark):
    path = "s3://i/INV/bkt/name/2025-10-18T01-00Z/"
    assert one(spark, paths.report_parent("p"), p=path) == "s3://i/INV/bkt/name"
    assert one(spark, paths.report_run("p"), p=path) == "2025-10-18T01-00Z"


def test_tolerance_rules(spark):
    close = numeric.within_tolerance(F.col("a"), F.col("b"))
    cases = [("5", "5", True), ("abc", "abc", True), ("abc", "1", False), ("null", "", True), ("None", "0.0", True),
             ("100000", "100000.9", True), ("100000", "100001.1", False), ("1e-11", "0", True), ("0", "1", False),
             ("Infinity", "1", False), ("Infinity", "inf", True), ("NaN", "1", False), (" 7.50 ", "7.5", True),
             ("-5", "5", False)]
    for a, b, want in cases:
        assert one(spark, close, a=a, b=b) is want, (a, b)


def test_variance_and_megabytes(spark):
    v = numeric.variance_pct(F.lit(3), F.lit(4))
    assert spark.range(1).select(v.alias("x")).first().x == 33.33
    assert spark.range(1).select(numeric.variance_pct(F.lit(0), F.lit(4)).alias("x")).first().x == 0.0
    for total, want in ((1572864, 1.5), (None, 0.0), (float("nan"), 0.0), (float("inf"), 0.0)):
        got = spark.range(1).select(paths.megabytes(F.lit(total).cast("double")).alias("x")).first().x
        assert got == want
