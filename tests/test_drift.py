import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.functions.types import canonical_schema, captured_columns, normal_type
from lakeproof.operators import drift


def catalog(spark, rows):
    return spark.createDataFrame(rows, "bucket_prefix string, execution_id string, file_path string, schema_json string, is_corrupted boolean")


A, B = '{"fields": []}', '{"fields": [1]}'


def test_verdicts(spark):
    found = {r.bucket_prefix: r for r in drift.drift_verdict(catalog(spark, [
        ("ok", "r", "p/x=1/f", A, False), ("ok", "r", "p/x=2/f", A, False),
        ("schema", "r", "p/x=1/f", A, False), ("schema", "r", "p/x=2/f", B, False),
        ("layout", "r", "p/x=1/f", A, False), ("layout", "r", "p/y=2/f", A, False),
        ("bad", "r", "p/x=1/f", A, False), ("bad", "r", "p/x=2/f", "corrupted", True),
        ("all", "r", "p/x=1/f", "corrupted", True)])).collect()}
    flags = {k: (r.candidate_for_managed_table_creation, r.schema_consistent, r.partition_consistent) for k, r in found.items()}
    assert flags == {"ok": (True, True, True), "schema": (False, False, True), "layout": (False, True, False),
                     "bad": (False, True, True), "all": (False, True, True)}
    assert json.loads(found["bad"].schema_analysis_results) == {
        "total_non_corrupted_files": 1, "corrupted_files": 1, "schema_consistent": True, "partition_consistent": True}
    assert found["bad"].schema_analysis_results == (
        '{"total_non_corrupted_files": 1, "corrupted_files": 1, "schema_consistent": true, "partition_consistent": true}')


def test_baseline_is_the_smallest_path_in_any_case(spark):
    rows = [("p", "r", "B/f", B, False), ("p", "r", "a/f", A, False), ("p", "r", "0/f", "corrupted", True)]
    assert drift.baseline(catalog(spark, rows)).first().baseline_schema == A
    timed = catalog(spark, rows).withColumn("at", F.when(F.col("schema_json") == B, 1).otherwise(2))
    assert drift.baseline(timed, order="at").first().baseline_schema == B


def test_canonical_schema():
    schema = T.StructType([T.StructField("B", T.LongType(), False), T.StructField("a", T.ArrayType(T.DecimalType(10, 2)))])
    text = canonical_schema(schema)
    assert json.loads(text)["fields"][0]["name"] == "a"
    again = drift.read_schema(text)
    assert [f.name for f in again.fields] == ["a", "b", "run_id", "snapshot_date"]
    assert again["a"].dataType == T.ArrayType(T.DecimalType(10, 2)) and not again["b"].nullable


def test_nested_types_are_captured(spark):
    schema = T.StructType([T.StructField("m", T.MapType(T.StringType(), T.LongType())), T.StructField("t", T.TimestampNTZType())])
    df = spark.createDataFrame([(canonical_schema(schema),)], "schema_json string")
    found = {r.column_name: r.data_type for r in captured_columns(df, []).collect()}
    assert found["t"] == "timestamp_ntz" and '"map"' in found["m"]


def test_tokens(spark):
    cases = {"LongType()": "bigint", "int64": "bigint", "DecimalType(10,2)": "decimal(10,2)", "decimal128(5, 1)": "decimal(5,1)",
             "timestamp[us, tz=UTC]": "timestamp", "TimestampNTZType()": "timestamp_ntz", "str": None, "interval": None,
             "ArrayType": None, "array<int>": "array<int>", " BOOL ": "boolean"}
    rows = spark.createDataFrame([(k,) for k in cases], "token string").select("token", normal_type("token").alias("t"))
    assert {r.token: r.t for r in rows.collect()} == cases


def test_align(spark):
    df = spark.createDataFrame([("1", "x", 5), ("n/a", "y", 6)], "ID string, Extra string, small int")
    base = T.StructType([T.StructField("id", T.LongType()), T.StructField("small", T.LongType()), T.StructField("gone", T.DateType())])
    got = drift.align(df, base, lenient=True)
    assert got.columns == ["id", "small"] and [tuple(r) for r in got.collect()] == [(1, 5), (None, 6)]
    assert drift.align(df, base, lenient=True, fill_missing=True).columns == ["id", "small", "gone"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        drift.align(df, base).collect()
    assert {r.column_name: r.lost for r in drift.lost_values(df, base).collect()} == {"id": 1, "small": 0}
    assert drift.lost_values(df, df.schema).count() == 0


def test_newest_readable_schema(spark):
    rows = [("p", "r", "p/run_id=R1/snapshot_date=2024-01-01/", A, False),
            ("p", "r", "p/run_id=R1/snapshot_date=2024-01-02/", "corrupted", True)]
    wanted = spark.sql("SELECT 'p' bucket_prefix, 'R1' run_id, date'2024-01-01' snapshot_date "
                       "UNION ALL SELECT 'p', 'R1', date'2024-01-02'")
    found = drift.latest_readable_schemas(catalog(spark, rows), wanted).collect()
    assert [(r.schema_json, str(r.snapshot_date)) for r in found] == [(A, "2024-01-01")]


def test_nested_values_meet_by_name(spark):
    """Structs, arrays and maps; nulls stay null, missing fields are null, extra ones go."""
    raw = spark.sql("""SELECT 1 id, named_struct('b', '7', 'a', 'x', 'extra', 1) s, array(named_struct('y', 1, 'x', 'one'), NULL) l,
        map('3', named_struct('q', '1.5')) m, map('k', 1) bad
        UNION ALL SELECT 2, NULL, NULL, NULL, NULL
        UNION ALL SELECT 3, named_struct('b', 'no', 'a', NULL, 'extra', 2), array(), map(), map()""")
    base = T.StructType.fromDDL("id int, s struct<A: string, B: int, c: date>, l array<struct<x: string, y: bigint>>, "
                                "m map<int, struct<q: double>>, bad map<int, int>")
    rows = {r.id: r for r in drift.align(raw, base, lenient=True).collect()}
    assert rows[1].s.asDict() == {"A": "x", "B": 7, "c": None} and rows[1].m[3].q == 1.5 and rows[1].bad is None
    assert [None if x is None else x.asDict() for x in rows[1].l] == [{"x": "one", "y": 1}, None]
    assert rows[2].s is None and rows[2].l is None and rows[2].m is None
    assert rows[3].s.asDict() == {"A": None, "B": None, "c": None} and rows[3].l == [] and rows[3].m == {} and rows[3].bad == {}
    lost = {r.column_name: r.lost for r in drift.lost_values(raw, base).collect()}
    assert lost == {"s": 1, "l": 0, "m": 0, "bad": 1}
    assert drift.align(raw, base, lenient=True).schema["s"].dataType.names == ["A", "B", "c"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        drift.align(raw, base).select("s").collect()
