import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeproof.llm import quality_classifier as qc
from lakeproof.llm import quality_rules as qr
from lakeproof.llm import text_stats as ts
from lakeproof.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
BLANKS = " \t\n\x0b\x0c\r"


def brute_counts(text):
    words, word = [], ""
    for ch in (text or "") + " ":
        if ch in BLANKS:
            words += [word] if word else []
            word = ""
        else:
            word += ch
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {i + k for i in range(len(words) - 2) for k in range(3) if windows[tuple(words[i:i + 3])] > 1}
    lines, dup = [], 0
    for line in (text or "").split("\n"):
        if line.strip(BLANKS):
            dup += line in lines
            lines.append(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeated))


def test_counts_equal_brute_force(few):
    texts = [None, "", " \n ", "a b c a b c", "a b a b a b", "a a a a", "x\ny\nx\n x\n\n\n", "é漢 #|<", "a\xa0b",
             *(t[:4000] for _, t in few)]
    for text in texts:
        assert ts.counts(text)[:5] == brute_counts(text), repr(text)


@pytest.fixture(scope="module")
def labelled(spark):
    return {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_rules(spark, labelled):
    rows = QUERIES["op6_quality_rules"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        n_words, *_, repeated = want = brute_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (n_words < 50 or 100 * repeated > 50 * n_words)
        assert not (r.base_failed and r.kept)
    judged = [(labelled[r.doc_id], r.kept) for r in rows if r.doc_id in labelled and not r.base_failed]
    good, bad = [k for q, k in judged if q == 1], [k for q, k in judged if q == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_rules_edges(spark, edge, labels):
    got = qr.quality_rules(edge, labels)
    assert got.count() == edge.count()
    assert {r.doc_id for r in got.where("kept").collect()} == {4}
    none = qr.quality_rules(edge, labels.where(F.lit(False)))
    assert none.where("kept = base_failed").count() == 0
    assert qr.quality_rules(edge.where(F.lit(False)), labels).count() == 0


def test_forest_isolates_outliers():
    import numpy as np
    rng = np.random.default_rng(1)
    rows = rng.normal(0, 1, (2000, 4))
    forest = qr.Forest(rows, 64)
    inner, outer = forest.score(rng.normal(0, 1, (200, 4))), forest.score(np.full((5, 4), 9.0))
    assert outer.min() > np.quantile(inner, 0.99)
    assert math.isclose(qr.mean_path(256), 10.24, abs_tol=0.05)


def test_rules_reject_junk_of_other_kinds(spark, labelled):
    """Junk that the given bad rows do not show: digits, repeated short lines, another script."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rules = qr.fit(ts.statistics(docs).cache(), labels)
    r = random.Random(4)

    def digits(text):
        return "".join(r.choice("0123456789") if c not in BLANKS and r.random() < 0.64 else c for c in text)

    def short_lines(text):
        n = len([line for line in text.split("\n") if line.strip(BLANKS)])
        return text + "".join("\n" + r.choice(["home", "menu", "next", "login"]) for _ in range(3 * n + 8))

    def script(text):
        return "".join(chr(0x4E00 + ord(c) * 37 % 5000) if c.isalpha() else c for c in text)
    good = [t.text for t in docs.collect() if labelled.get(t.doc_id) == 1]
    good = [t for t, kept in zip(good, rules.judge(ts.count_table(good))[2], strict=True) if kept][:200]
    for change in (digits, short_lines, script):
        failed, _, kept = rules.judge(ts.count_table([change(t) for t in good]))
        share = (~kept)[~failed].mean()
        print(f"{change.__name__}: {(~failed).sum()} pass the base rules, {share:.3f} of them rejected")
        assert share >= 0.9


def test_classifier_on_held_out_rows(spark, labelled):
    rows = QUERIES["op7_quality_classifier"](spark, SF).collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    seen = [(labelled[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in labelled]
    good, bad = [s for q, s, _ in seen if q == 1], [s for q, s, _ in seen if q == 0]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad)
    assert auc >= 0.95
    assert sum(p == q for q, _, p in seen) >= 0.93 * len(seen)


def test_held_out_labels_and_other_columns_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(qc.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    a = {r.doc_id: r.score for r in qc.quality_scores(docs, labels).collect()}
    b = {r.doc_id: r.score for r in qc.quality_scores(other, turned).collect()}
    assert all(abs(a[d] - b[d]) < 1e-9 for d in a)


def test_classifier_edges(spark, edge, labels):
    got = qc.quality_scores(edge, labels)
    assert got.count() == edge.count() and got.where("score is null or predicted is null").count() == 0
    assert {r.score for r in qc.quality_scores(edge, labels.where(F.lit(False))).collect()} == {0.5}
    assert qc.quality_scores(edge.where(F.lit(False)), labels).count() == 0
