import hashlib
import re

import pytest
from pyspark.sql import functions as F

from lakeproof.llm import merkle

PARAGRAPH = re.compile(r"[^\n.!?]{1,256}[\n.!?]*|[\n.!?]+")


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def tree(text):
    groups, now = [], []
    for p in PARAGRAPH.findall(text):
        now.append((sha(p), len(p)))
        if now[-1][0][0] in "01":
            groups.append(now)
            now = []
    groups += [now] if now else []
    nodes = [(sha(",".join(f"{h}.{n}" for h, n in g)), [f"{h[:16]}.{n}" for h, n in g]) for g in groups]
    return sha("".join(h for h, _ in nodes)), [(h[:16], tuple(ls)) for h, ls in nodes]


def written(t):
    return t[0] + ":" + ";".join(f"{h}={','.join(ls)}" for h, ls in t[1])


def size(leaves):
    return sum(int(x.split(".")[1]) for x in leaves)


def alike(a, b):
    if a[0] == b[0]:
        return 1.0
    sa, sb = set(a[1]), set(b[1])
    same = sum(size(ls) for _, ls in sa & sb)
    la, lb = ({x for _, ls in s for x in ls} for s in (sa - sb, sb - sa))
    return 2.0 * (same + size(la & lb)) / (2 * same + size(la) + size(lb))


def brute(rows):
    """Texts without ties in id, in order."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0]))
    out = []
    for (doc, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        q = len(text) // 4
        edited = text[:len(text) - q] + after[:q]
        a, b, c = tree(text), tree(edited), tree(after)
        out.append((doc, len(text), sha(edited), written(a), written(b), alike(a, b), alike(a, c)))
    return out


def got(df):
    return [tuple(r)[:7] for r in merkle.fingerprints(df).collect()]


def test_documents(spark, sf, few):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = merkle.fingerprints(docs).collect()
    assert sorted(tuple(r)[:7] for r in rows) == sorted(brute([(r.doc_id, r.text) for r in few]))
    body = {r.doc_id: r.text for r in few}
    for r in rows:
        if r.fingerprint == r.edited_fingerprint:
            assert r.edit_start is None and r.edit_end is None
        else:   # the last quarter, back to where its first paragraph begins
            first = r.n_chars - r.n_chars // 4
            assert r.edit_end <= r.n_chars and body[r.doc_id][:r.edit_start] == body[r.doc_id][:first][:r.edit_start]
    assert sum(r.near_edited > 0.5 for r in rows if r.n_chars > 500) > 0.95 * sum(r.n_chars > 500 for r in rows)


def test_order_over_many_partitions(spark):
    rows = [((i * 7919) % 100_003, f"Text number {i}.\nIts second line! " * (i % 5)) for i in range(2000)]
    rows += [(200_000 + i, "A copy.\nOf one text.") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert sorted(got(df)) == sorted(brute(rows))


def test_edges(spark, edge):
    """Rows of one id and text count once; each of them gets the same result."""
    rows = [(r.doc_id, r.text or "") for r in edge.select("doc_id", "text").collect()]
    once = [r for r in dict.fromkeys(rows) if r[0] is not None]
    want = {r[0]: r for r in brute(once)}
    found = got(edge)
    assert len(found) == len(rows)
    last = max(d for d, _ in once)
    for r in found:
        if r[0] is not None and r[0] != last:   # the last one is followed by a row without id
            assert r == want[r[0]]
    assert sorted(r[1] for r in found if r[0] is None) == [0, len("no id here")]
    assert got(edge.where(F.lit(False))) == []
    one = spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")
    assert [r[2] for r in got(one)] == [sha("abcdefab")]
    empty = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [r[1:3] + r[5:] for r in got(empty)] == [(0, sha(""), 1.0, 1.0)] * 2


@pytest.mark.parametrize(("a", "b", "start", "end"), [
    ("One. Two. Three.", "One. 2. Three.", 4, 9), ("One. Two.", "One. Two. Three.", 9, 9),
    ("x. x. x. x.", "x. x. x.", 8, 11), ("", "One.", 0, 0), ("Same.", "Same.", None, None)])
def test_edit_is_located(spark, a, b, start, end):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    df = merkle.with_fingerprint(merkle.with_fingerprint(df, "a", "fa"), "b", "fb")
    row = merkle.with_edit(merkle.with_likeness(df, "fa", "fb", "near"), "fa", "fb", "start", "end").first()
    assert (row.start, row.end) == (start, end)
    assert row.near == alike(tree(a), tree(b))


def test_no_python_on_the_main_path(spark, sf):
    plan = merkle.fingerprints(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
