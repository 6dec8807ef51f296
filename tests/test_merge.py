import pytest
from pyspark.sql import functions as F

from lakeproof.operators import inventory as inv, merge
from lakeproof.operators.lookup import is_small, lookup
from lakeproof.plans import migrate


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame(
        [("a", 1, None), ("a", 2, "failed"), ("b", 1, "loaded"), (None, 1, None)], "k string, n int, st string")


def test_update_with_guard(target, spark, rows):
    source = spark.createDataFrame([("a", "new"), ("c", "x")], "k string, v string")
    got = merge.update_matched(target, source, ["k"], {"st": "v"}, F.col("t.st").isNull())
    assert rows(got) == sorted(
        [("a", 1, "new"), ("a", 2, "failed"), ("b", 1, "loaded"), (None, 1, None)], key=repr)
    assert got.columns == target.columns and got.schema["n"].dataType == target.schema["n"].dataType


def test_ambiguous_update_is_refused(target, spark):
    source = spark.createDataFrame([("a", "x"), ("a", "y")], "k string, v string")
    with pytest.raises(Exception, match="several source rows"):
        merge.update_matched(target, source, ["k"], {"st": "v"}).collect()
    # rows that match nothing may be repeated
    other = spark.createDataFrame([("z", "x"), ("z", "y")], "k string, v string")
    assert merge.update_matched(target, other, ["k"], {"st": "v"}).count() == 4


def test_update_expressions_see_both_sides(target, spark, rows):
    source = spark.createDataFrame([("b", 10)], "k string, add int")
    got = merge.update_matched(target, source, ["k"], {"n": F.col("t.n") + F.col("s.add")})
    assert ("b", 11, "loaded") in rows(got)


def test_merge_twice_is_merge_once(target, spark, rows):
    source = spark.createDataFrame([("a", 5, "x"), ("c", 6, "y")], "k string, n int, st string")
    once = merge.insert_absent(target, source, ["k"])
    assert rows(merge.insert_absent(once, source, ["k"])) == rows(once)
    assert once.count() == 5
    updated = merge.update_matched(target, source, ["k"], {"st": "st"})
    assert rows(merge.update_matched(updated, source, ["k"], {"st": "st"})) == rows(updated)


def test_delete_and_update_where_treat_unknown_as_false(target, rows):
    assert merge.delete_where(target, F.col("st") == "failed").count() == 3
    got = merge.update_where(target, F.col("st") == "failed", {"st": "again", "n": F.col("n") + 1})
    assert ("a", 3, "again") in rows(got) and (None, 1, None) in rows(got)


def test_supersede_then_mark_done(spark, rows):
    stored = spark.createDataFrame(
        [("b", "p", "f", "2024", "false", "r1"), ("b", "p", "g", "2024", "true", "r1")],
        "bucket_name string, prefix string, path string, name string, processed string, runId string")
    fresh = spark.createDataFrame([("b", "p", "f", "2025"), ("b", "p", "h", "2025")],
                                  "bucket_name string, prefix string, path string, name string")
    keys = ["bucket_name", "prefix", "path"]
    got = merge.supersede(stored, fresh, keys, "r2")
    assert rows(got, "path", "name", "processed", "runId") == sorted([
        ("f", "2024", "ignored", "r1:r2"), ("g", "2024", "true", "r1"),
        ("f", "2025", "false", "r2"), ("h", "2025", "false", "r2")], key=repr)
    done = merge.mark_done(got, fresh.filter("path = 'f'"), ["bucket_name", "path"], "r3")
    assert [r for r in rows(done, "path", "processed", "runId") if r[1] == "true"] == [
        ("f", "true", "r3"), ("g", "true", "r1")]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_gives_the_plain_join(spark, rows, how):
    many = spark.range(0, 500, 1, 7).select((F.col("id") % 5 * (F.col("id") % 3)).alias("k"), "id")
    table = spark.createDataFrame([(0, "hot"), (2, "two"), (9, "none")], "k long, v string")
    want = rows(many.join(table, ["k"], how))
    assert rows(lookup(many, table, ["k"], how)) == want
    assert rows(lookup(many, table, ["k"], how, small=True)) == want
    assert rows(lookup(many, table, ["k"], how, salt=1)) == want


def test_unmeasured_side_is_not_broadcast(spark):
    """A small file may hold many rows, and the copies for sub-keys are not in Spark's estimate."""
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()
    table = spark.range(10).withColumn("v", F.lit(1))
    for salt in (1, 32):
        assert "Broadcast" not in plan(lookup(spark.range(100), table, ["id"], "left", salt))
    assert "Broadcast" in plan(lookup(spark.range(100), table, ["id"], "left", small=True))
    candidates = spark.range(10).selectExpr(
        "'r' AS execution_id", "'b' AS s3_bucket_name", "concat('p', id, '/') AS bucket_prefix", "'t' AS table_name",
        "id AS total_file_count", "1.0D AS table_file_size_mb", "id AS structured_file_count",
        "cast(null AS string) AS candidate_for_managed_table_creation")
    upserted = plan(inv.upsert_candidates(candidates, candidates.drop("candidate_for_managed_table_creation"), "r2"))
    assert "Broadcast" not in upserted and "Generate" not in upserted


def test_lookup_refuses_other_joins(spark):
    with pytest.raises(ValueError):
        lookup(spark.range(1), spark.range(1), ["id"], "full_outer")


def test_is_small(spark):
    assert is_small(spark.range(10), 10) and not is_small(spark.range(11), 10)


def test_candidate_upsert_twice(spark, rows):
    files = spark.createDataFrame(
        [("b", "t/ds/", "parquet", 1048576, None), ("b", "t/ds/", None, 1048576, None), ("b", "t/e/", "csv", 1, "loaded")],
        "s3_bucket_name string, bucket_prefix string, extension string, size long, load_status string")
    empty = spark.createDataFrame([], "execution_id string, s3_bucket_name string, bucket_prefix string, table_name string, "
                                      "total_file_count long, table_file_size_mb double, structured_file_count long, "
                                      "candidate_for_managed_table_creation string, note string")
    metrics = inv.candidate_metrics(files)
    once = inv.upsert_candidates(empty, metrics, "r")
    assert rows(once) == [("r", "b", "t/ds/", "ds", 2, 2.0, 1, None, None)]
    assert rows(inv.upsert_candidates(once, metrics, "r2")) == rows(once)
    decided = once.withColumn("candidate_for_managed_table_creation", F.lit("true"))
    assert inv.upsert_candidates(decided, metrics, "r2").count() == 2


def test_high_water_mark_is_per_bucket(spark):
    listing = spark.createDataFrame(
        [("b1", "p", "k1", "2024-01-02"), ("b1", "p", "k2", "2024-01-01"), ("b2", "p", "k3", "2024-01-01")],
        "s3_bucket_name string, bucket_prefix string, key string, t string").withColumn(
        "last_modified_time", F.col("t").cast("timestamp"))
    stored = listing.filter("key = 'k2'")
    assert {r.key for r in inv.newer_files(listing, stored).collect()} == {"k1", "k3"}
    assert {r.key for r in inv.newer_files(listing, stored, late=True).collect()} == {"k1", "k3"}
    twin = listing.filter("key = 'k2'").withColumn("key", F.lit("k4"))
    late = inv.newer_files(listing.unionByName(twin), stored, late=True)
    assert {r.key for r in late.collect()} == {"k1", "k3", "k4"}


def test_one_failed_folder_fails_its_pair(spark, rows):
    stored = spark.createDataFrame([("b", "p", "R", "2024-01-01", None)],
                                   "s3_bucket_name string, bucket_prefix string, run_id string, snapshot_date string, load_status string")
    status = spark.createDataFrame([("b", "p", "R", "2024-01-01", "loaded"), ("b", "p", "R", "2024-01-01", "failed")],
                                   "bucket_name string, bucket_prefix string, run_id string, snapshot_date string, load_status string")
    assert migrate.record_status(stored, status).first().load_status == "failed"


def test_hot_key_is_spread(spark):
    """A third of all rows under one key: no task of the join gets a large share of them."""
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
             "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        rows_ = spark.range(0, 96000, 1, 96).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
        table = rows_.distinct().withColumn("v", F.lit(1))
        got = lookup(rows_, table, ["k"], "left").groupBy(F.spark_partition_id()).count()
        sizes = [r["count"] for r in got.collect()]
        assert sum(sizes) == 96000 and max(sizes) < 96000 * 0.08
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
