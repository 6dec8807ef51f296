"""Order-free digests: equal to the strict check, cheap for equal tables, exact on damage."""
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeproof.operators import checksum as cs, digest as dg

BY = ["p"]
SCHEMA = "p string, a long, t string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute(source, target):
    counts = Counter(source)
    counts.subtract(target)
    parts = {p for p, *_ in source + target}
    return {p: "FAIL" if any(n for r, n in counts.items() if r[0] == p) else "PASS" for p in parts}, \
        sum(1 for n in counts.values() if n)


ROWS = st.lists(st.tuples(st.sampled_from([None, "", "x", "y"]), st.one_of(st.none(), st.integers(0, 3)),
                          st.one_of(st.none(), st.sampled_from(["", "u", "||"]))), max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, ROWS, st.booleans())
def test_same_verdict_as_counting(spark, one, other, same):
    other = list(reversed(one)) if same else other
    source, target = frame(spark, one), frame(spark, other)
    verdicts, n = brute(one, other)
    assert {r.p: r.status for r in dg.compare_partitions(source, target, BY, BY).collect()} == verdicts
    rows = dg.differing_rows(source, target, BY, BY).collect()
    assert len(rows) == n and all(r.src != r.tgt for r in rows)


def test_descent_names_the_rows(spark):
    rows = [(f"d{i % 5}", i, f"t{i % 7}") for i in range(3000)]
    damaged = [r if r[1] % 1000 else (r[0], r[1], "other") for r in rows if r[1] != 77] + [rows[5], rows[5]]
    source, target = frame(spark, rows), frame(spark, damaged)
    verdicts = dg.compare_partitions(source, target, BY, BY)
    strict = cs.compare_checksums(source, target, BY, by=BY, strict=True)
    want = {r.p: (r.source_record_count, r.target_record_count, r.status) for r in strict.collect()}
    assert {r.p: (r.source_record_count, r.target_record_count, r.status) for r in verdicts.collect()} == want
    assert {p for p, v in want.items() if v[2] == "FAIL"} == {"d0", "d2"}
    found = dg.differing_rows(source, target, BY, BY, verdicts)
    here = {(r.a, r.src, r.tgt) for r in dg.with_rows(source, found, BY, BY).collect()}
    assert here == {(0, 1, 0), (1000, 1, 0), (2000, 1, 0), (77, 1, 0), (5, 1, 3)}
    there = {(r.a, r.t) for r in dg.with_rows(target, found.filter("src = 0"), BY, BY).collect()}
    assert there == {(0, "other"), (1000, "other"), (2000, "other")}


def test_first_pass_shuffles_sums_only(spark, tmp_path):
    frame(spark, [(f"d{i % 5}", i, "t") for i in range(500)]).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    plan = dg.compare_partitions(df, df, BY, BY)._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.rindex("Exchange"):]
    assert "partial_count" in first and "partial_sum" in first     # folded before any exchange
    equal = dg.differing_rows(df, df, BY, BY)
    assert equal.count() == 0


@pytest.mark.parametrize("strict", [True, False])
def test_empty_and_one_sided(spark, strict):
    none, some = frame(spark, []), frame(spark, [("x", 1, None), ("x", None, "1")])
    assert dg.compare_partitions(none, none, BY, BY, strict).count() == 0
    row = dg.compare_partitions(some, none, BY, BY, strict).first()
    assert (row.status, row.source_record_count, row.target_record_count) == ("FAIL", 2, 0)
    assert dg.differing_rows(some, none, BY, BY, strict=strict).agg(F.sum("src")).first()[0] == 2


def test_widespread_damage_is_compared_in_one_shuffle(spark):
    """No digest pass and no join with digest ranges where counts differ almost everywhere."""
    rows = [(f"d{i % 5}", i, "t") for i in range(2000)]
    source, target = frame(spark, rows), frame(spark, [r for r in rows if r[1] % 7])
    found = dg.differing_rows(source, target, BY, BY)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "conv(" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert found.count() == sum(1 for r in rows if not r[1] % 7)


def test_changed_values_everywhere(spark):
    """Equal counts, every row changed: the ranges hold all rows, so they are not joined."""
    rows = [("x" if i % 2 else None, i, "t") for i in range(2000)]
    source, target = frame(spark, rows), frame(spark, [(p, a, "u") for p, a, _ in rows])
    for verdicts in (None, dg.compare_partitions(source, target, BY, BY)):
        found = dg.differing_rows(source, target, BY, BY, verdicts)
        assert "range" not in found._jdf.queryExecution().executedPlan().toString()
        assert found.agg(F.sum("src"), F.sum("tgt")).first()[:] == (2000, 2000)


def test_second_pass_folds(spark, monkeypatch):
    """The number of ranges follows the rows, so a small partition is not cut into 4,096."""
    asked = []
    real = dg.compare_digests
    monkeypatch.setattr(dg, "compare_digests", lambda *a: asked.append(a[4]) or real(*a))
    rows = [("x", i, "t") for i in range(3000)]
    target = [(p, a, "u" if a == 9 else t) for p, a, t in rows]
    found = dg.differing_rows(frame(spark, rows), frame(spark, target), BY, BY)
    assert found.count() == 2 and asked == [dg.FIRST, 1]
