import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeproof.llm import ann
from lakeproof.llm.queries import QUERIES


def brute(rows, k, is_query):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v
            and all(map(math.isfinite, v)) and any(v)]
    size = max({len(v) for _, v in good}, key=[len(v) for _, v in good].count) if good else 0
    good = [(i, v) for i, v in good if len(v) == size]
    out = {}
    for n, (i, v) in enumerate(good):
        if is_query(i):
            scores = [(-float((v * w).sum()) / math.sqrt((v * v).sum()) / math.sqrt((w * w).sum()), j)
                      for j, w in good if j != i]
            out[n, i] = [(j, -s) for s, j in sorted(scores)[:k]]
    return out


def recall(got, want):
    by = defaultdict(list)
    for r in got:
        by[r.query_id].append((r.rank, r.vec_id, r.score))
    hit = total = 0
    for (_, i), near in want.items():
        rows = sorted(by[i])
        assert [r[0] for r in rows] == list(range(1, len(near) + 1))
        hit += len({r[1] for r in rows} & {j for j, _ in near})
        total += len(near)
        scores = dict(near)
        assert all(abs(s - scores[j]) < 1e-12 for _, j, s in rows if j in scores)
        assert rows == sorted(rows, key=lambda r: (-r[2], r[1]))
    assert set(by) == {i for (_, i), near in want.items() if near}
    return hit / total


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_recall_on_the_table(spark, folder):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = QUERIES["op4_posting_list_search"](spark, folder).collect()
    assert recall(got, brute(rows, 5, lambda i: i % 50 == 0)) >= 0.9


def test_recall_on_many_lists(spark, monkeypatch):
    """100,000 vectors with the mean and covariance of the given ones, in 625 lists."""
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("embedding").toArrow()
    given = ann.as_matrix(given.column(0).combine_chunks())
    n, k, every = 100_000, 5, 500
    vectors = np.random.default_rng(3).multivariate_normal(given.mean(0), np.cov(given.T), n).astype(np.float32)
    table = pa.table({"vec_id": pa.array(range(n), pa.int64()), "embedding": pa.array(list(vectors), pa.list_(pa.float32()))})
    pairs = []

    def watched(postings, probes, keep):
        a, b = (x.groupBy("list", "block").count() for x in (postings, probes))
        pairs.append(a.join(b.withColumnRenamed("count", "m"), ["list", "block"]).agg(F.sum(F.col("count") * F.col("m"))))
        return scanned(postings, probes, keep)
    scanned = ann.scanned
    monkeypatch.setattr(ann, "scanned", watched)
    got = defaultdict(set)
    for r in ann.nearest_vectors(spark.createDataFrame(table).repartition(16), F.col("vec_id") % every == 0, k).collect():
        got[r.query_id].add(r.vec_id)
    unit, asked = ann.unit(vectors.astype(float)), range(0, n, every)
    close = unit[asked] @ unit.T
    close[range(len(asked)), asked] = -2
    near = np.argpartition(-close, k - 1, axis=1)[:, :k].tolist()
    found = sum(len(got[i] & set(row)) for i, row in zip(asked, near, strict=True)) / k / len(asked)
    share = pairs[0].collect()[0][0] / n / len(asked)   # copies of a vector in several lists count each
    print(f"recall {found:.4f}, scanned share {share:.4f}")
    assert found >= 0.93 and share < 0.6


def test_hot_vector_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    r = random.Random(1)
    rows = [(i, [r.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(200)] + [(2000 + i, [2 * x for x in rows[9][1]]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(x.vec_id, list(x.embedding)) for x in df.collect()]
    got = ann.nearest_vectors(df, F.col("vec_id") % 10 == 0, 5).collect()
    assert recall(got, brute(rows, 5, lambda i: i % 10 == 0)) >= 0.9
    near = sorted((x.rank, x.vec_id) for x in got if x.query_id == 1050)
    assert [v for _, v in near] == [5, 1000, 1001, 1002, 1003]


def test_distinct_vectors_of_one_direction(spark):
    """More equal scores than are kept of a block: the smaller ids win."""
    r = random.Random(2)
    scales = [2.0 ** j for j in range(-30, 30)]
    r.shuffle(scales)
    rows = [(i, [s * x for x in (1.0, 0.5, -0.25, 3.0)]) for i, s in enumerate(scales)] + [(100, [1.0, 0.5, -0.25, 2.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest_vectors(df, F.col("vec_id").isin(7, 100), 5).orderBy("query_id", "rank").collect()
    want = brute(rows, 5, lambda i: i in (7, 100))
    assert [(x.query_id, x.vec_id) for x in got] == [(i, j) for (_, i), near in sorted(want.items()) for j, _ in near]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (100, None), (None, [1.0, 0.5]), (1, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("key", F.lit("x"))
    got = ann.nearest_vectors(df, F.col("vec_id") % 50 == 0, 5).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(0, 1), (0, 1), (0, 50), (50, 1), (50, 1), (50, 0)]
    one = df.where("vec_id = 0")
    assert ann.nearest_vectors(one, F.lit(True), 5).count() == 0
    assert ann.nearest_vectors(df.where(F.lit(False)), F.lit(True), 5).count() == 0
