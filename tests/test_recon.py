"""Properties: a table passes against itself; one defect flips exactly its checks."""
import pytest
from pyspark.sql import functions as F

from lakeproof import PartitionSpec
from lakeproof.operators import checksum as cs, partitions as parts, profile as pf, recon
from lakeproof.plans.reconcile import pair_checks, reconcile_pair, run_checks
from queries.views import view

SPEC = PartitionSpec(floor=None)
COLUMNS = SPEC.columns


@pytest.fixture(scope="module")
def data(spark, sf):
    lines = view(spark, sf, "recon_src").filter("l_orderkey < 300").withColumn("note", F.lit("x"))
    fixed = spark.createDataFrame(lines.collect(), lines.schema).cache()
    return fixed


def failing(source, target, **options):
    found = reconcile_pair(source, target, "t", "r", SPEC, extra=True, **options).collect()
    assert len(found) == 7
    return {r.recon_type for r in found if r.status != "PASS"}


def newest(data):
    return parts.restrict(data, parts.latest_partitions(data, COLUMNS, 1), COLUMNS, at_most=1)


def test_same_table_passes(data):
    assert failing(data, data) == set()
    assert failing(data, data, strict=True) == set()


def test_lost_partition(data):
    oldest = data.select(*COLUMNS).distinct().orderBy(*COLUMNS).limit(1)
    kept = data.join(oldest, COLUMNS, "left_anti").select(*data.columns)
    assert failing(data, kept) == {"ROW_COUNT", "Partiton_Data_count", "PARTITION_RECORD_COUNT"}


def test_changed_value_in_latest_partition(data):
    keys = newest(data).select("l_orderkey", "l_linenumber").limit(1).first()
    hit = (F.col("l_orderkey") == keys[0]) & (F.col("l_linenumber") == keys[1])
    changed = data.withColumn("note", F.when(hit, F.lit("y")).otherwise(F.col("note")))
    assert failing(data, changed) >= {"CHECKSUM_VALIDATION"}
    assert failing(data, changed) <= {"CHECKSUM_VALIDATION", "VERIFIED"}


def test_other_type_and_missing_column(data):
    assert failing(data, data.withColumn("l_partkey", F.col("l_partkey").cast("int"))) == {"SCHEMA_VALIDATION"}
    assert failing(data, data.drop("note")) >= {"COLUMN_COUNT", "SCHEMA_VALIDATION"}


def test_duplicates_need_strict(data):
    one = newest(data).limit(1)
    # the copy moves row counts; checksums only see it when multiplicities count
    more = data.unionByName(one)
    assert "CHECKSUM_VALIDATION" not in failing(data, more)
    assert "CHECKSUM_VALIDATION" in failing(data, more, strict=True)


def test_other_latest_partition_fails_strict(data):
    last = newest(data).select(*COLUMNS).distinct().first()
    without = data.filter(~((F.col("snapshot_date") == last[0]) & (F.col("run_id") == last[1])))
    assert "CHECKSUM_VALIDATION" in failing(data, without, strict=True)


def test_empty_side_is_skipped(data):
    found = {r.recon_type: r.status for r in reconcile_pair(data, data.limit(0), "t", "r", SPEC).collect()}
    assert found["CHECKSUM_VALIDATION"] == "SKIP" and found["VERIFIED"] == "SKIP"
    assert found["ROW_COUNT"] == "FAIL"
    assert found["COLUMN_COUNT"] == "PASS"


def test_zero_counts_are_kept(data):
    row = recon.row_count(recon.partition_counts(data.limit(0), data.limit(0), COLUMNS), "t", "r").first()
    assert (row.source_metrics, row.target_metrics, row.status) == ("0", "0", "PASS")


def test_moved_null_needs_strict(spark):
    a = spark.createDataFrame([("a", None, "b")], "x string, y string, z string")
    b = spark.createDataFrame([(None, "a", "b")], "x string, y string, z string")
    assert cs.compare_checksums(a, b, []).first().status == "PASS"
    assert cs.compare_checksums(a, b, [], strict=True).first().status == "FAIL"
    split = spark.createDataFrame([("a||b", "c")], "x string, y string")
    joined = spark.createDataFrame([("a", "b||c")], "x string, y string")
    assert cs.compare_checksums(split, joined, []).first().status == "PASS"
    assert cs.compare_checksums(split, joined, [], strict=True).first().status == "FAIL"


def test_mass_copies(spark):
    many = spark.range(0, 30000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("v"))
    found = cs.compare_checksums(many, many, [], strict=True).first()
    assert (found.source_record_count, found.source_distinct, found.status) == (30000, 20001, "PASS")
    other = cs.compare_checksums(many, many.filter("v <> -1"), [], strict=True).first()
    assert (other.unmatched_rows, other.matched_record_count, other.status) == (10000, 20000, "FAIL")


def test_nested_columns_are_hashed(spark):
    df = spark.sql("SELECT array(1, 2) a, named_struct('x', 1) s, map('k', 1) m")
    assert cs.compare_checksums(df, df, []).first().matched_record_count == 1
    with pytest.raises(ValueError):
        cs.row_checksum(df, [])


def test_profile_does_not_overflow(spark):
    big = spark.range(3).select(F.lit(9223372036854775807).alias("n"), F.lit(-2147483648).cast("int").alias("i"))
    values = {(r.column_name, r.stat): r.value for r in pf.profile(big, pf.picked(big, [])).collect()}
    assert values[("n", "abs_sum")] == "27670116110564327421"
    assert values[("i", "abs_sum")] == "6442450944"


def test_profile_of_nothing(spark):
    none = spark.createDataFrame([], "n long, s string")
    values = {(r.column_name, r.stat): r.value for r in pf.profile(none, pf.picked(none, [])).collect()}
    assert values[("n", "min")] == "null" and values[("n", "abs_sum")] == "0"


def test_mixed_case_columns_are_summed(spark):
    df = spark.createDataFrame([(1, "a")], "Num long, Txt string")
    assert ("num", "abs_sum") in {(r.column_name, r.stat) for r in pf.profile(df, pf.picked(df, [])).collect()}
    with pytest.raises(ValueError):
        pf.profile(spark.sql("SELECT 1 a, 2 A"), {"a": "int"})


def test_no_common_statistics_is_a_warning(spark):
    a, b = spark.range(1).toDF("x"), spark.range(1).toDF("y")
    assert recon.verify(a, b, [], "t", "r").first().status == "WARNING"
    none = spark.sql("SELECT true flag")
    assert recon.verify(none, none, [], "t", "r").first().status == "ERROR"


def test_latest_partitions_ties_and_nulls(spark):
    df = spark.createDataFrame([("d", "2024-01-02", "R1"), ("d", "2024-01-02", "R2"), ("d", "2024-01-01", "R9"),
                                ("e", "2023-01-01", "R1")], "ds string, snapshot_date string, run_id string")
    top = parts.latest_partitions(df, ["snapshot_date", "run_id"], 1, ["ds"]).collect()
    assert {(r.ds, r.run_id) for r in top} == {("d", "R2"), ("e", "R1")}
    with_null = df.unionByName(df.limit(1).withColumn("run_id", F.lit(None).cast("string")))
    keys = with_null.filter("run_id IS NULL").select("snapshot_date", "run_id")
    assert parts.restrict(with_null, keys, ["snapshot_date", "run_id"]).count() == 1


def test_two_spellings_of_a_date_repeat_no_row(spark):
    data = spark.createDataFrame([("R1", "2024-01-01", 1)], "run_id string, snapshot_date string, v int")
    tags = spark.createDataFrame([("ds", "R1", "snapshot_date", "2024-01-01"), ("ds", "R1", "SNAPSHOT_DATE", "2024-1-1")],
                                 "dataset_name string, run_id string, run_tag_key string, run_tag_value string")
    stored = spark.createDataFrame([("R1", "2024-01-01", "loaded", "parquet")] * 2,
                                   "run_id string, snapshot_date string, load_status string, extension string")
    assert parts.source_rows(data, tags, stored, "ds").count() == 1
    assert parts.source_rows(data, tags.limit(0), stored, "ds").count() == 1  # floor alone
    assert parts.source_rows(data, tags, stored, "ds", PartitionSpec(floor="2025-01-01")).count() == 0


def test_one_broken_check_stops_no_other(spark, data):
    def broken():
        return data.select(F.raise_error(F.lit("boom")).cast("string").alias("x"))
    checks = pair_checks(data, data, "t", "r", SPEC)
    checks[1] = ("COLUMN_COUNT", broken)
    got = {r.recon_type: r for r in run_checks(checks, spark, "t", "r").collect()}
    assert len(got) == 6 and got["COLUMN_COUNT"].status == "ERROR" and "boom" in got["COLUMN_COUNT"].error_log
    assert {r.status for r in got.values()} == {"PASS", "ERROR"}
    assert all(r.exec_duration > 0 for r in got.values())
    assert recon.rollup(run_checks(checks, spark, "t", "r")).first().recon_status == "FAIL"
