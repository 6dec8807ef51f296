import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakeproof.llm import sharding


def check(rows, want, shards, slack):
    got = sorted((r.doc_id or -1, r.size, r.text_crc32) for r in rows)
    assert got == sorted(((d or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in want))
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert set(by) <= set(range(shards))
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    ideal, most = sum(r.size for r in rows) / shards, max(r.size for r in rows)
    for s in range(shards):
        assert abs(sum(r.size for r in by[s]) - ideal) <= 2 * max(slack * ideal, most)


def test_documents(spark, sf, few):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(sharding.shard_by_bytes(docs).collect(), few, 8, sharding.TOLERANCE)


@pytest.mark.parametrize("same_id", [False, True])
def test_hot_text_and_hot_rows(spark, same_id):
    """Half of all rows have one text, or are one row again and again."""
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(1500)]
    rows += [(7 if same_id else 5000 + 3 * i, "a copy of one text") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sharding.shard_by_bytes(df).collect()
    check(got, rows, 8, sharding.TOLERANCE)
    if not same_id:     # neither order nor layout of the input matters
        again = sharding.shard_by_bytes(df.orderBy(F.desc("doc_id")).coalesce(2)).collect()
        assert sorted((r.doc_id, r.shard, r.slot) for r in got) == sorted((r.doc_id, r.shard, r.slot) for r in again)


def test_copies_stay_together_unless_a_border_must_cut_them(spark):
    rows = [(i, f"text {i % 400}") for i in range(4000)]
    got = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), tolerance=0.05).collect()
    shards = defaultdict(set)
    for r in got:
        shards[r.text_crc32].add(r.shard)
    assert sum(len(s) > 1 for s in shards.values()) == 0


def test_edges(spark, edge):
    want = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    check(sharding.shard_by_bytes(edge, carry=("text",)).collect(), want, 8, 1)
    assert sharding.shard_by_bytes(edge.where(F.lit(False))).count() == 0
    one = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert [(r.slot, r.size) for r in sharding.shard_by_bytes(one).collect()] == [(0, 2)]


def test_no_python_on_the_main_path(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = sharding.shard_by_bytes(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
