import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeproof.llm import collocations

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, least, longest=5, top=2000):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i:i + size]] = max(inside[p[i:i + size]], a)
        rows = []
        for p, a in candidates.items():
            if 100 * inside[p] < 100 * a:
                score, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def got(df, **options):
    return sorted(tuple(r) for r in collocations.collocations(df, **options).collect())


@pytest.fixture(scope="module")
def pairs(spark, sf):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("lang", "text").collect()]


def test_documents(spark, sf, pairs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute(pairs, 100)
    assert want and got(docs) == want


def test_many_bundles_and_tiles(spark, pairs):
    """Few words a bundle, many tiles, small dense tables, a short list."""
    df = spark.createDataFrame(pairs, "lang string, text string").repartition(5)
    dense = collocations.DENSE
    want = brute(pairs, 4, top=300)
    assert want and got(df, least=4, top=300, bundle=3000, tile=500) == want
    assert collocations.DENSE == dense


def test_edges(spark, edge):
    rows = [("en", "A b. a B, a\tb! x"), (None, "a b a b a b"), ("und", "a b\x0ba b"), ("en", None), ("en", ""), ("fr", " \t "),
            ("en", "É b c É b c É b c"), ("en", "a b c d e f g " * 3), ("de", "w " * 50), ("de", "x y z x y z")]
    df = spark.createDataFrame(rows, "lang string, text string")
    both = edge.select(F.lit("long").alias("lang"), "text", "n", "score", "rank", "ids").unionByName(df, allowMissingColumns=True)
    all_rows = rows + [("long", r.text) for r in edge.select("text").collect()]
    for least in (1, 2, 3):
        assert got(both, least=least) == brute(all_rows, least)
    assert got(both, least=10**6) == []
    assert got(df.where(F.lit(False))) == []


def test_hot_pair_is_counted_once_a_bundle(spark):
    """A third of all texts repeat one passage."""
    rows = [("en", f"word{i % 50} of the week number {i % 7}, said again. " * 3) for i in range(600)]
    rows += [("en", "one very common passage of six words. " * 5)] * 300
    df = spark.createDataFrame(rows, "lang string, text string").repartition(6)
    assert got(df, least=20) == brute(rows, 20)


def test_dense_and_sparse_counts_agree():
    r = np.random.default_rng(1)
    for every in (1, 3, 8):
        left = r.integers(0, 5000, 20_000) // every * every + every // 2
        right = r.integers(0, 3000, 20_000) // every * every
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        times = r.integers(1, 1 << 30, 20_000)
        want = Counter()
        for k, t in zip(keys.tolist(), times.tolist()):
            want[k] += t
        found, totals = collocations.counted(keys, times, every)
        assert dict(zip(found.tolist(), totals.tolist())) == want and (np.diff(found.astype(np.int64)) > 0).all()


def test_scores_pass_64_bits(spark):
    """Numbers as a table of 100 TB would give them."""
    a, n, left, right = 10**11, 2 * 10**13, 3 * 10**11, 4 * 10**11
    sql = f"""(cast(1000 * {a}L as decimal(20, 0)) * cast({n}L as decimal(17, 0)))
              div (cast({left}L as decimal(18, 0)) * cast({right}L as decimal(18, 0)))"""
    assert spark.sql(f"select {sql}").first()[0] == 1000 * a * n // (left * right)
