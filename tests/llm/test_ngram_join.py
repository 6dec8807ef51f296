import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakeproof.llm import ngram_join as nj
from lakeproof.llm.common import TOGETHER, spread_join
from lakeproof.llm.queries import QUERIES


def sets_of(text, width):
    words = [w.decode() for w in (text or "").encode().lower().split()]
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def brute(rows, width, num, den):
    """Component (as the place of its first row) of each row, by comparing all pairs."""
    sets, root = [sets_of(t, width) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * den >= num * max(len(a), len(b)):
                same = len(a & b)
                if den * same >= num * (len(a) + len(b) - same):
                    x, y = find(i), find(j)
                    root[max(x, y)] = min(x, y)
    return sets, [find(i) for i in range(len(rows))]


def ids(rows, roots):
    least = {}
    for (doc, _), r in zip(rows, roots, strict=True):
        if doc is not None:
            least[r] = min(least.get(r, doc), doc)
    return [least.get(r) for r in roots]


def made(seed, groups=6, size=25):
    """Copies and near copies around the threshold, frequent passages, single documents."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6)))
    passage, out = [word() for _ in range(40)], []
    for _ in range(groups):
        base = [word() for _ in range(r.choice([12, 60, 150]))]
        for _ in range(size):
            text = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5, 9])):
                at = r.randrange(len(text))
                text[at:at + r.randint(0, 1)] = [word()]
            out.append(" ".join(text))
    for _ in range(80):
        out.append(" ".join(passage + [word() for _ in range(r.randint(0, 30))]))
        out.append(" ".join(word() for _ in range(r.randint(0, 12))))
    r.shuffle(out)
    return [(i * 3, t) for i, t in enumerate(out)]


@pytest.mark.parametrize(("width", "num", "frequent", "block"),
                         [(3, 90, 256, 2048), (3, 90, 4, 2048), (3, 90, 1, 8), (5, 80, 5, 16), (2, 70, 3, 10)])
def test_equals_brute_force(spark, width, num, frequent, block):
    rows = made(width * 100 + frequent)
    sets, roots = brute(rows, width, num, 100)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in nj.link_documents(df, width, num, 100, frequent=frequent, block=block).collect()}
    assert got == {d: (len(s), c) for (d, _), s, c in zip(rows, sets, ids(rows, roots), strict=True)}
    assert len(set(roots)) < len(rows) - 50


def test_query(spark, sf, few):
    rows = [tuple(r) for r in few]
    sets, roots = brute(rows, 3, 90, 100)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op5_ngram_jaccard_join"](spark, sf).collect()}
    assert got == {d: (len(s), c) for (d, _), s, c in zip(rows, sets, ids(rows, roots), strict=True)}


def test_one_document_of_each_group_stays(spark):
    rows = made(9)
    rows += [(i, None) for i in (2001, 2002)] + rows[:7]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string")
    first = sorted(dict.fromkeys(rows), key=lambda r: r[0])
    _, roots = brute(first, 5, 80, 100)
    want = [first[i] for i in range(len(first)) if roots[i] == i]
    got = nj.without_near_duplicates(df)
    assert got.columns == df.columns
    # Textless rows are in no group and all stay.
    texts = [(d, t) for d, t, _ in got.collect()]
    assert sorted(t for t in texts if t[1]) == sorted(t for t in want if t[1])
    assert sorted(d for d, t in texts if t is None) == [2001, 2002]


def test_edges(spark, edge):
    got = nj.link_documents(edge, 3, 90, 100)
    by = defaultdict(list)
    for r in got.collect():
        by[r.doc_id].append((r.n_shingles, r.component_id))
    assert by[5] == [(7, 1)] and by[1] == [(7, 1)] * 2 and by[2] == [(0, 2)] and by[3] == [(0, 3)] * 2
    assert sorted(by[None]) == [(0, None), (1, None)] and by[7] == [(1, 7)]
    assert got.count() == edge.count()
    assert nj.link_documents(edge.where(F.lit(False))).count() == 0
    assert nj.without_near_duplicates(edge.drop("text_hash")).count() == edge.count() - 2


def test_extra_columns_may_have_any_name(spark):
    df = spark.createDataFrame([(i, f"text number {i % 2} of some words", i, "h", "d", 1) for i in range(4)],
                               "doc_id long, text string, n_shingles int, _text_hash string, _doc string, whole int")
    got = nj.without_near_duplicates(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id, r.n_shingles, r._text_hash, r._doc, r.whole) for r in got.collect()) == [
        (0, 0, "h", "d", 1), (1, 1, "h", "d", 1)]


def test_a_hub_is_dealt_over_many_tasks(spark):
    """Rows of one key, and rows without a key, lie in many partitions; none is lost or doubled."""
    rows = spark.range(6000).selectExpr("id", "case when id % 3 = 0 then 7 when id % 3 = 1 then null else id end as key")
    side = spark.range(0, 6000, 2).selectExpr("id as key", "id * 10 as value").unionByName(
        spark.createDataFrame([(7, 70)], "key long, value long"))
    counts = rows.groupBy("key").agg(F.count("*").alias("n"))
    for how in ("inner", "left"):
        got = spread_join(rows, side, "key", counts, 6000, how)
        plain = rows.join(side, "key", how)
        assert sorted(map(str, got.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    hubs = counts.where(F.col("n") > TOGETHER).count()
    assert hubs == 2 and TOGETHER < 2000
