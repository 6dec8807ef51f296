import os

import pytest
from pyspark.sql import functions as F

from lakeproof import schemas as S
from lakeproof.operators import checksum as cs, copyplan, objects as ob
from lakeproof.sources import bytes as by

DDL = "s3_batch_copy_id string, bucket string, prefix string, rel_key string, size long, modified timestamp, etag string"


def objects(spark, entries, bucket="s", batch="b"):
    rows = [(batch, bucket, "p/", k, size, t, e) for k, size, t, e in entries]
    frame = spark.createDataFrame(rows, DDL.replace("modified timestamp", "modified string"))
    return frame.withColumn("modified", F.col("modified").cast("timestamp"))


@pytest.fixture(scope="module")
def found(spark):
    src = objects(spark, [("same", 1, "2024-01-01", "a"), ("gone", 1, "2024-01-01", "a"), ("newer", 1, "2024-01-03", "a"),
                          ("size", 1, "2024-01-01", "a"), ("dir/", 0, "2024-01-01", "a"), ("both/", 0, "2024-01-01", "a"),
                          ("timeless", 1, None, "a"), ("newersize", 9, "2024-01-03", "a")])
    dst = objects(spark, [("same", 1, "2024-01-01", "b"), ("newer", 1, "2024-01-02", "a"), ("size", 2, "2024-01-02", "a"),
                          ("extra", 1, "2024-01-01", "a"), ("edir/", 0, "2024-01-01", "a"), ("both/", 0, "2024-01-01", "a"),
                          ("timeless", 1, "2024-01-01", "a"), ("newersize", 1, "2024-01-02", "a")], "d")
    return src, dst


def test_classes(found):
    got = {r.rel_key: r.status for r in ob.classify(*found).collect()}
    assert got == {"same": S.SAME, "gone": S.ONLY_SRC, "newer": S.SRC_NEWER, "size": S.DEST_NEWER_OTHER_SIZE,
                   "extra": S.ONLY_DEST, "both/": S.SAME, "timeless": S.UNKNOWN, "newersize": S.SRC_NEWER}


def test_etag_rule(found):
    got = {r.rel_key: r.status for r in ob.classify(*found, compare="etag").collect()}
    assert got["same"] == S.NOT_SAME and got["dir/"] == S.ONLY_SRC and "extra" not in got
    assert got["newer"] == S.SAME


def test_keys_add_up(found):
    src, dst = found
    got = ob.classify(src.filter("rel_key NOT LIKE '%/'"), dst.filter("rel_key NOT LIKE '%/'"))
    counts = {r.status: r["count"] for r in got.groupBy("status").count().collect()}
    both = src.join(dst, ob.KEY).filter("rel_key NOT LIKE '%/'").count()
    assert sum(counts.values()) == counts[S.ONLY_SRC] + counts[S.ONLY_DEST] + both


def test_repeated_rows_of_a_key(spark, found):
    """A third of all rows under one key stays one row, whatever side repeats it."""
    src, dst = found
    old = objects(spark, [("same", 7, "2023-01-01", "z")] * 400)
    got = {r.rel_key: r for r in ob.classify(src.unionByName(old), dst).collect()}
    assert got["same"].status == S.SAME and got["same"].src_copies == 401 and len(got) == 8


def test_verdict_and_summary(spark, found):
    got = ob.classify(*found)
    assert ob.verdict(got).first().status == "WARNING"
    bad = got.filter("rel_key = 'same'")
    failed = ob.with_checksums(got, bad)
    assert ob.verdict(failed).first().status == "FAILED"
    assert ob.verdict(got.filter(F.col("status") == S.SAME)).first().status == "SUCCESS"
    assert ob.verdict(ob.classify(*found, compare="etag"), compare="etag").first().status == "FAILED"
    text = ob.status_summary(ob.differences(failed)).first().recon_status
    assert '{"status":"%s","count":1}' % S.OTHER_CHECKSUM in text and S.SAME not in text
    # a key that is not SAME keeps its class
    assert ob.with_checksums(got, got.filter("rel_key = 'newer'")).filter("rel_key = 'newer'").first().status == S.SRC_NEWER


def test_only_dest_rows_keep_their_buckets(spark, found):
    mapping = spark.createDataFrame([("b", "s", "p/", "d", "p/")],
                                    "s3_batch_copy_id string, src_bucket_name string, src_prefix string, "
                                    "dest_bucket_name string, dest_prefix string")
    rows = {r.Key: r for r in ob.diff_rows(ob.differences(ob.classify(*found)), mapping, "r").collect()}
    assert (rows["extra"].src_bucket, rows["extra"].dest_bucket_name) == ("s", "d")
    assert rows["gone"].sync_to_dest_bucket_status == "Copy" and rows["extra"].sync_to_dest_bucket_status == "Review"
    plan = ob.sync_plan(ob.diff_rows(ob.differences(ob.classify(*found)), mapping, "r")).collect()
    assert [tuple(r) for r in plan] == [("s3://s/p/gone", "s3://d/p/gone", "file")]


def test_samples_are_repeatable(spark):
    rows = spark.range(20000).select(F.lit("b").alias("s3_batch_copy_id"),
                                     F.concat(F.lit("k"), "id", F.when(F.col("id") % 2 == 0, ".csv").otherwise(".json")).alias("rel_key"),
                                     F.lit(1).alias("size"))
    population = cs.sample_candidates(rows)
    a = cs.hash_sample(population, 0.05, {".csv": 0.2})
    assert {r.rel_key for r in a.collect()} == {r.rel_key for r in cs.hash_sample(population.repartition(7), 0.05, {"csv": 0.2}).collect()}
    n = {r.file_type: r["count"] for r in a.groupBy("file_type").count().collect()}
    assert 1800 < n[".csv"] < 2200 and 400 < n[".json"] < 600
    random = cs.stratified_sample(population, 0.05).count()
    assert 800 < random < 1200
    assert cs.hash_sample(population, 0.0).count() == 0 and cs.hash_sample(population, 1.0).count() == 20000


def test_file_contents(spark, tmp_path):
    for side, tail in (("src", b"x"), ("dest", b"y")):
        os.makedirs(tmp_path / side / "p")
        (tmp_path / side / "p" / "equal a+b.bin").write_bytes(b"0" * 100)
        (tmp_path / side / "p" / "other.bin").write_bytes(b"0" * 100 + tail)
    (tmp_path / "src" / "p" / "alone.bin").write_bytes(b"1")
    sample = spark.createDataFrame(
        [("b", k, "src", "dest", "p/", "p/") for k in ("equal%20a+b.bin", "other.bin", "alone.bin")],
        "s3_batch_copy_id string, rel_key string, src_bucket string, dest_bucket string, src_prefix string, dest_prefix string")
    got = by.compare_contents(sample, f"{tmp_path}/")
    assert {r.rel_key: r.checksum_valid for r in got.collect()} == {
        "equal%20a+b.bin": True, "other.bin": False, "alone.bin": None}
    assert [r.rel_key for r in by.mismatched(got).collect()] == ["other.bin"]
    assert [r.rel_key for r in by.unread(got).collect()] == ["alone.bin"]


def test_copy_units(spark):
    tree = ["r/a/", "r/a/b/", "r/a/b/c/d/e.txt", "r/a/f.txt", "r/g.txt", "r/empty/", "r/h/i/", "r/", "r/h/j/k.txt"]
    df = spark.createDataFrame([(p, 1) for p in tree], "path string, size int")
    two = {r.path: r.type for r in copyplan.copy_units(df, "r/", "q/", 2).collect()}
    assert two == {"r/a/b/": "dir", "r/a/f.txt": "file", "r/g.txt": "file", "r/empty/": "dir", "r/h/i/": "dir", "r/h/j/": "dir"}
    three = {r.path: r.type for r in copyplan.copy_units(df, "r/", "q/", 3).collect()}
    assert three == {"r/a/b/c/d/": "dir", "r/a/f.txt": "file", "r/g.txt": "file", "r/empty/": "dir", "r/h/i/": "dir",
                     "r/h/j/k.txt": "file"}
    only_root = df.filter("path = 'r/'")
    assert [(r.path, r.dest_path) for r in copyplan.copy_units(only_root, "r/", "q/").collect()] == [("r/", "q/")]


def test_copy_pairs(spark):
    pairs = spark.createDataFrame([("s3://a/x/", "s3://d/1"), ("s3://a/x/y", "s3://d/2"), ("s3://a/xy", "s3://d/2/"),
                                   ("s3://b//z/w", "s3://e"), ("s3://b/z", "s3://e/f/g")], "src string, dst string")
    nested = {tuple(r) for r in copyplan.nested_folders(pairs).collect()}
    assert nested == {("src", "s3://a/x/y", "s3://a/x"), ("src", "s3://b/z/w", "s3://b/z"), ("dst", "s3://e/f/g", "s3://e")}
    assert {tuple(r) for r in copyplan.duplicate_folders(pairs).collect()} == {("dst", "s3://d/2", 2)}
    with pytest.raises(ValueError, match="duplicate"):
        copyplan.check_pairs(pairs)
    with pytest.raises(ValueError, match="nested"):
        copyplan.check_pairs(pairs.filter("dst <> 's3://d/2/'"))
    copyplan.check_pairs(pairs.limit(1))


def test_copy_summary_without_copies(spark):
    df = spark.createDataFrame([("FAILED", 0.0)], "status string, duration double")
    row = ob.copy_summary(df).first()
    assert (row.copied, row.failed, row.avg_seconds, row.copied_per_minute) == (0, 1, None, None)
