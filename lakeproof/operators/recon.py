"""Reconciliation checks.  Each yields rows in the layout of the result table.

Nothing is collected: both sides are aggregated, tagged and folded by Spark.  Partition
counts (one pass per side over the partition columns) feed three checks, so the data is
read once for them.
"""
from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof import schemas
from lakeproof.functions.numeric import TOLERANCE_PCT, variance_pct
from lakeproof.operators import checksum as cs
from lakeproof.operators import profile as pf
from lakeproof.operators.merge import update_matched

SHOWN = 3  # mismatches named in a summary; the count is always complete


def pass_if(condition: Column) -> Column:
    return F.when(condition, F.lit("PASS")).otherwise(F.lit("FAIL"))


def one_row(*frames: DataFrame) -> DataFrame:
    """Folds frames of at most one row each into one row, without a cross join."""
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def result_rows(df: DataFrame, recon_type: str, status: Column, source: Column, target: Column,
                summary: Column, table: Column | str, execution_id: str, compared=0, matched=0,
                different=0, error: Column | None = None) -> DataFrame:
    """Result-table rows from one aggregated row per table."""
    def column(value) -> Column:
        return value if isinstance(value, Column) else F.lit(value)
    values = {
        "execution_id": F.lit(execution_id), "table_name": column(table),
        "recon_type": F.lit(recon_type), "exec_timestamp": F.current_timestamp(),
        "exec_duration": F.lit(0.0), "status": status, "source_metrics": source,
        "target_metrics": target, "metrics_compared": column(compared),
        "metrics_matched": column(matched), "metrics_different": column(different),
        "summary": summary, "error_log": F.lit(None) if error is None else error}
    return df.select(*[values[f.name].cast(f.dataType).alias(f.name)
                       for f in schemas.RECON_RESULTS.fields])


def error_result(spark: SparkSession, table: str, recon_type: str, message: str,
                 execution_id: str, status: str = "ERROR") -> DataFrame:
    """A result row for a check that could not run (status SKIP: had nothing to do)."""
    summary = F.lit(f"{recon_type}: {status} - {message}")
    return result_rows(spark.range(1), recon_type, F.lit(status), F.lit(None), F.lit(None),
                       summary, table, execution_id, error=F.lit(message))


# --- partition counts and the checks built on them ---------------------------------

def partition_counts(source: DataFrame, target: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per partition on either side; a partition absent on one side counts 0 there."""
    def tagged(df: DataFrame, in_source: int) -> DataFrame:
        n = F.count(F.lit(1))
        return df.groupBy(*columns).agg((n * in_source).alias("source_count"),
                                        (n * (1 - in_source)).alias("target_count"))
    both = tagged(source, 1).unionByName(tagged(target, 0))
    return both.groupBy(*columns).agg(F.sum("source_count").alias("source_count"),
                                      F.sum("target_count").alias("target_count"))


def partition_differences(counts: DataFrame) -> DataFrame:
    """Counts with difference, variance in percent and verdict per partition."""
    s, t = F.col("source_count"), F.col("target_count")
    return (counts.withColumn("difference", F.abs(s - t))
            .withColumn("variance_pct", variance_pct(s, t))
            .withColumn("status", pass_if(s == t)))


def row_count_totals(counts: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return counts.agg(F.coalesce(F.sum("source_count"), zero).alias("source"),
                      F.coalesce(F.sum("target_count"), zero).alias("target"))


def _count_result(totals: DataFrame, recon_type: str, label: str, table, execution_id) -> DataFrame:
    equal = F.col("source") == F.col("target")
    s, t = F.col("source").cast("string"), F.col("target").cast("string")
    same = F.concat(F.lit(f"{label} matches: Source="), s, F.lit(", Target="), t)
    gap = F.abs(F.col("source") - F.col("target")).cast("string")
    other = F.concat(F.lit(f"{label} difference: "), gap, F.lit(" (Source="), s,
                     F.lit(", Target="), t, F.lit(")"))
    return result_rows(totals, recon_type, pass_if(equal), s, t,
                       F.when(equal, same).otherwise(other), table, execution_id)


def row_count(counts: DataFrame, table: str, execution_id: str) -> DataFrame:
    return _count_result(row_count_totals(counts), "ROW_COUNT", "Row count", table, execution_id)


def _partition_text(columns: list[str]) -> Column:
    values = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("null")))
              for c in columns]
    return F.concat_ws(", ", *values)


def _first_few(df: DataFrame, columns: list[str], text: Column, name: str) -> DataFrame:
    """One row: the first few texts in partition order, joined."""
    few = df.orderBy(*columns).limit(SHOWN).select(F.struct(*columns, text.alias("text")).alias("r"))
    texts = F.transform(F.array_sort(F.collect_list("r")), lambda r: r["text"])
    return few.agg(F.array_join(texts, "; ").alias(name))


def partition_set_totals(counts: DataFrame) -> DataFrame:
    """Distinct partitions per side and those on one side only."""
    s, t = F.col("source_count") > 0, F.col("target_count") > 0
    return counts.agg(F.count_if(s).alias("source"), F.count_if(t).alias("target"),
                      F.count_if(s & ~t).alias("missing_in_target"),
                      F.count_if(t & ~s).alias("missing_in_source"))


def partition_set(counts: DataFrame, columns: list[str], table: str,
                  execution_id: str) -> DataFrame:
    """Same distinct partitions on both sides; the differences go to summary and log."""
    text = F.concat(F.lit("("), _partition_text(columns), F.lit(")"))
    row = one_row(
        partition_set_totals(counts),
        _first_few(counts.filter(F.col("target_count") == 0), columns, text, "only_source"),
        _first_few(counts.filter(F.col("source_count") == 0), columns, text, "only_target"))
    equal = (F.col("missing_in_target") == 0) & (F.col("missing_in_source") == 0)
    s, t = F.col("source").cast("string"), F.col("target").cast("string")
    head = F.concat(F.lit("Source distinct partition count = "), s,
                    F.lit(", managed table distinct partition count = "), t, F.lit(". "))
    detail = F.concat(
        F.lit("Missing in target: "), F.col("missing_in_target").cast("string"), F.lit(" ["),
        F.col("only_source"), F.lit("]. Missing in source: "),
        F.col("missing_in_source").cast("string"), F.lit(" ["), F.col("only_target"), F.lit("]."))
    return result_rows(
        row, "Partiton_Data_count", pass_if(equal), s, t,
        F.when(equal, F.concat(head, F.lit("All partitions match.")))
        .otherwise(F.concat(head, F.lit("Partition mismatch detected. "), detail)),
        table, execution_id, error=F.when(~equal, detail))


def partition_record_count(counts: DataFrame, columns: list[str], table: str,
                           execution_id: str) -> DataFrame:
    """Equal row counts in every partition; absent counts as 0."""
    differ = F.col("source_count") != F.col("target_count")
    text = F.concat(_partition_text(columns), F.lit(": Source="), F.col("source_count").cast("string"),
                    F.lit(", Target="), F.col("target_count").cast("string"))
    row = one_row(counts.agg(F.count(F.lit(1)).alias("total"), F.count_if(differ).alias("different")),
                  _first_few(counts.filter(differ), columns, text, "shown"))
    total, different = F.col("total"), F.col("different")
    matched = total - different
    more = F.when(different > SHOWN, F.concat(
        F.lit("; and "), (different - SHOWN).cast("string"), F.lit(" more partitions"))).otherwise("")
    summary = F.when(different == 0, F.concat(
        F.lit("All "), total.cast("string"), F.lit(" partitions have matching record counts"))
    ).otherwise(F.concat(
        F.lit("Partition record count differences: "), matched.cast("string"), F.lit("/"),
        total.cast("string"), F.lit(" partitions match - Mismatched: ["), F.col("shown"), more,
        F.lit("]")))
    return result_rows(row, "PARTITION_RECORD_COUNT", pass_if(different == 0),
                       total.cast("string"), total.cast("string"), summary, table, execution_id,
                       total, matched, different)


# --- columns and schemas -----------------------------------------------------------

def column_totals(source: DataFrame, target: DataFrame, by: list[str]) -> DataFrame:
    """Width of each table on both sides, from column descriptors of all tables."""
    tagged = source.select(*by, F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(
        target.select(*by, F.lit(0).alias("s"), F.lit(1).alias("t")))
    return tagged.groupBy(*by).agg(F.sum("s").alias("source"), F.sum("t").alias("target"))


def column_count(source: DataFrame, target: DataFrame, execution_id: str,
                 by: str = "table_name") -> DataFrame:
    return _count_result(column_totals(source, target, [by]), "COLUMN_COUNT", "Column count",
                         F.col(by), execution_id)


def schema_differences(source: DataFrame, target: DataFrame, by: list[str]) -> DataFrame:
    """Columns of both sides by lower-cased name, each with its kind of difference."""
    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select(*by, F.lower("column_name").alias("column_name"),
                         F.col("data_type").alias(f"{tag}_type"))
    pair = side(source, "source").join(side(target, "target"), [*by, "column_name"], "full_outer")
    s, t = F.col("source_type"), F.col("target_type")
    decimals = F.startswith(s, F.lit("decimal")) & F.startswith(t, F.lit("decimal"))
    kind = (F.when(s.isNull(), F.lit("MISSING_IN_SOURCE"))
            .when(t.isNull(), F.lit("MISSING_IN_TARGET"))
            .when(s == t, F.lit("MATCH"))
            .when(decimals, F.lit("PRECISION_MISMATCH"))
            .otherwise(F.lit("TYPE_MISMATCH")))
    return pair.withColumn("kind", kind)


def schema_check(source: DataFrame, target: DataFrame, execution_id: str,
                 by: str = "table_name") -> DataFrame:
    """No missing column, no other type, no other precision.

    Lists are per table and no longer than the table is wide.
    """
    s, t = F.col("source_type"), F.col("target_type")
    typed = F.concat(F.col("column_name"), F.lit(" (src: "), s, F.lit(", tgt: "), t, F.lit(")"))
    kinds = [("MISSING_IN_SOURCE", "Missing in source", F.col("column_name"), 3),
             ("MISSING_IN_TARGET", "Missing in target", F.col("column_name"), 3),
             ("TYPE_MISMATCH", "Type mismatches", typed, 2),
             ("PRECISION_MISMATCH", "Precision mismatches", typed, 2)]

    def listed(type_column: Column) -> Column:
        entry = F.when(type_column.isNotNull(), F.struct("column_name", type_column.alias("type")))
        return F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry))))

    found = schema_differences(source, target, [by]).groupBy(by).agg(
        F.count(F.lit(1)).alias("compared"), F.count_if(F.col("kind") == "MATCH").alias("matched"),
        listed(s).alias("source_columns"), listed(t).alias("target_columns"),
        *[F.array_sort(F.collect_list(F.when(F.col("kind") == kind, text))).alias(kind)
          for kind, _, text, _ in kinds])
    parts = []
    for kind, label, _, shown in kinds:
        names = F.array_join(F.transform(F.slice(kind, 1, shown),
                                         lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", ")
        dots = F.when(F.size(kind) > shown, F.lit("...")).otherwise(F.lit(""))
        parts.append(F.when(F.size(kind) > 0, F.concat(
            F.lit(f"{label}: "), F.size(kind).cast("string"), F.lit(" columns ["), names,
            F.lit("]"), dots)))
    equal = F.col("compared") == F.col("matched")
    fine = F.lit("Schema matches completely: All columns, types, and precision/scale are identical")
    summary = F.when(equal, fine).otherwise(
        F.concat(F.lit("Schema differences found: "), F.concat_ws(" | ", *parts)))
    return result_rows(found, "SCHEMA_VALIDATION", pass_if(equal), F.col("source_columns"),
                       F.col("target_columns"), summary, F.col(by), execution_id,
                       F.col("compared"), F.col("matched"), F.col("compared") - F.col("matched"))


def partition_columns(sides: DataFrame, execution_id: str, table: str = "table_name",
                      source: str = "source_columns", target: str = "target_columns") -> DataFrame:
    """Partition column names missing on either side, from two lists per table."""
    s = F.array_sort(F.transform(F.split(source, "\\s*,\\s*"), F.lower))
    t = F.array_sort(F.transform(F.split(target, "\\s*,\\s*"), F.lower))
    named = sides.select(table, s.alias("s"), t.alias("t")).withColumns({
        "missing_src": F.array_except("t", "s"), "missing_tgt": F.array_except("s", "t")})
    equal = (F.size("missing_src") == 0) & (F.size("missing_tgt") == 0)
    detail = F.concat(F.lit("Missing in source: ["), F.array_join("missing_src", ", "),
                      F.lit("], missing in target: ["), F.array_join("missing_tgt", ", "), F.lit("]"))
    summary = F.when(equal, F.lit("Partition columns match")).otherwise(detail)
    return result_rows(named, "PARTITION_COLUMNS", pass_if(equal), F.array_join("s", ", "),
                       F.array_join("t", ", "), summary, F.col(table), execution_id)


def note_files(rows: DataFrame, account: DataFrame) -> DataFrame:
    """A result row that also tells how many source files were not read whole.

    Then PASS becomes WARNING, and the number stands first in ``error_log``.  ``account`` has
    a row per file with ``data_file, footer_rows, rows_read, state``.
    """
    bad = F.col("state") != "read"
    counted = account.agg(
        F.count_if(bad).alias("bad_files"),
        F.sum(F.when(bad, F.col("footer_rows") - F.col("rows_read"))).alias("missing"),
        F.min(F.when(bad, F.concat("data_file", F.lit(" "), "state"))).alias("first"))
    n, lost = F.col("bad_files"), F.coalesce(F.col("missing").cast("string"), F.lit("an unknown number"))
    note = F.when(n > 0, F.concat(n.cast("string"), F.lit(" source files not read whole, rows missing by their footers: "),
                                  lost, F.lit("; first: "), F.col("first")))
    both = one_row(rows, counted.select("bad_files", note.alias("note")))
    noted = both.withColumns({
        "status": F.when((n > 0) & (F.col("status") == "PASS"), F.lit("WARNING")).otherwise(F.col("status")),
        "error_log": F.when(n > 0, F.concat_ws("; ", "note", "error_log")).otherwise(F.col("error_log"))})
    return noted.select(*rows.columns)


def digest_check(verdicts: DataFrame, table: str, execution_id: str) -> DataFrame:
    """Checksums of all partitions, from the verdicts of ``digest.compare_partitions``."""
    bad = F.col("status") == "FAIL"
    columns = [c for c in verdicts.columns if c not in ("source_record_count", "target_record_count", "status")]
    name = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("null"))) for c in columns])
    counted = verdicts.agg(
        F.count(F.lit(1)).alias("partitions"), F.count_if(bad).alias("bad"),
        F.coalesce(F.sum("source_record_count"), F.lit(0)).alias("s"),
        F.coalesce(F.sum("target_record_count"), F.lit(0)).alias("t"), F.min(F.when(bad, name)).alias("first"))
    n, total = F.col("bad"), F.col("partitions")
    summary = F.concat(total.cast("string"), F.lit(" partitions compared by digest, "), n.cast("string"),
                       F.lit(" differ"), F.coalesce(F.concat(F.lit("; first: "), F.col("first")), F.lit("")))
    return result_rows(counted, "CHECKSUM_VALIDATION", pass_if(n == 0), F.col("s").cast("string"),
                       F.col("t").cast("string"), summary, table, execution_id, total, total - n, n)


# --- checksums and profiles --------------------------------------------------------

def _values_json(values: dict) -> str:
    return json.dumps({k: str(v) for k, v in values.items()})


def checksum(source: DataFrame, target: DataFrame, exclude: list[str], table: str,
             execution_id: str, source_partition: dict | None = None,
             target_partition: dict | None = None, strict: bool = False) -> DataFrame:
    """Row checksums of the latest partition of each side.

    Strict compares multiplicities and fails when the sides chose different partitions.
    """
    verdict = cs.compare_checksums(source, target, exclude, strict=strict)
    same_partition = source_partition == target_partition
    status = F.col("status")
    if strict and not same_partition:
        status = F.lit("FAIL")
    s, t = F.col("source_record_count").cast("string"), F.col("target_record_count").cast("string")
    summary = F.concat(
        F.lit('{"partition": ' + _values_json(source_partition or {})
              + ', "source_partition_record_count": '), s,
        F.lit(', "target_partition_record_count": '), t, F.lit("}"))
    note = None if same_partition else F.lit(
        f"latest partitions differ: source {source_partition}, target {target_partition}")
    return result_rows(verdict, "CHECKSUM_VALIDATION", status, s, t, summary, table, execution_id,
                       F.col("source_distinct"), F.col("matched_record_count"),
                       F.col("source_distinct") - F.col("matched_record_count"), error=note)


def verified(compared: DataFrame, columns: list[str], table: str, execution_id: str,
             partitions: list[dict] | None = None) -> DataFrame:
    """Verdict over compared profile statistics.  WARNING when there is none in common."""
    name = F.concat_ws(".", "column_name", "stat")
    value = F.concat(name, F.lit("="), F.col("source_value"))
    apart = F.concat(name, F.lit("(src="), F.col("source_value"), F.lit(",tgt="),
                     F.col("target_value"), F.lit(")"))
    near = F.concat(name, F.lit("~"), F.col("source_value"), F.lit("("),
                    F.format_string("%.6f%%", F.col("difference_pct")), F.lit(")"))
    good, close = F.col("matched"), F.coalesce(F.col("difference_pct"), F.lit(0.0)) > 0

    def texts(condition: Column, text: Column) -> Column:
        return F.array_sort(F.collect_list(F.when(condition, text)))

    def json_of(value_column: str) -> Column:
        entries = F.array_sort(F.collect_list(F.struct(name.alias("k"), F.col(value_column).alias("v"))))
        return F.to_json(F.map_from_entries(entries))

    row = compared.agg(
        F.count(F.lit(1)).alias("compared"), F.count_if(good).alias("matched"),
        texts(good & ~close, value).alias("exact"), texts(good & close, near).alias("near"),
        texts(~good, apart).alias("apart"), json_of("source_value").alias("source"),
        json_of("target_value").alias("target"))
    used = "; ".join("(" + ", ".join(f"{k}={v}" for k, v in p.items()) + ")" for p in partitions or [])
    used = f"Partitions [{len(partitions)}]: {used}" if partitions else ""
    total, matched = F.col("compared"), F.col("matched")
    rate = F.format_string("%.1f", matched * 100.0 / total)

    def part(label: str, array: str) -> Column:
        return F.when(F.size(array) > 0, F.concat(
            F.lit(f"{label} ["), F.size(array).cast("string"), F.lit("]: "), F.array_join(array, ", ")))

    summary = F.when(total == 0, F.lit(f"No common statistics to compare | {used}")).otherwise(
        F.concat_ws(" | ", F.concat(
            F.lit("Stats: "), matched.cast("string"), F.lit("/"), total.cast("string"),
            F.lit(" match ("), rate, F.lit("%)")),
            F.lit(f"Columns [{len(columns)}]: {', '.join(columns)}"), F.lit(used),
            part("Matched", "exact"), part("Tolerance-Matched", "near"), part("Unmatched", "apart")))
    status = (F.when(total == 0, F.lit("WARNING")).when(total > matched, F.lit("FAIL"))
              .otherwise(F.lit("PASS")))
    return result_rows(row, "VERIFIED", status, F.col("source"), F.col("target"), summary, table,
                       execution_id, total, matched, total - matched)


def verify(source: DataFrame, target: DataFrame, exclude: list[str], table: str,
           execution_id: str, partitions: list[dict] | None = None,
           tolerance_pct: float = TOLERANCE_PCT, per_group: int = pf.PER_GROUP,
           limit: int | None = 8) -> DataFrame:
    """Profiles both sides over the columns picked from the source and compares them.

    ``per_group`` columns of each type group and ``limit`` in all; None for every one.
    """
    columns = pf.picked(source, exclude, per_group, limit)
    if not columns:
        return error_result(source.sparkSession, table, "VERIFIED",
                            "No suitable columns found for verification", execution_id)
    have = {c.lower() for c in target.columns}
    if not have & set(columns):
        return verified(_no_statistics(source.sparkSession), list(columns), table, execution_id,
                        partitions)
    compared = pf.compare_profiles(pf.profile(source, columns), pf.profile(target, columns),
                                   tolerance_pct=tolerance_pct)
    return verified(compared, list(columns), table, execution_id, partitions)


def _no_statistics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "column_name string, stat string, source_value string, target_value string, "
            "matched boolean, difference_pct double")


# --- verdict per table -------------------------------------------------------------

def rollup(results: DataFrame, expected: tuple[str, ...] = schemas.EXPECTED_CHECKS) -> DataFrame:
    """Did every expected check run, and what is the verdict, per execution and table."""
    seen = results.groupBy("execution_id", "table_name").agg(
        F.collect_set("recon_type").alias("recon_types"), F.collect_set("status").alias("statuses"))
    missing = F.size(F.array_except(F.array(*[F.lit(c) for c in expected]), F.col("recon_types")))
    unread = F.array_contains("recon_types", schemas.READ_ERROR)
    clean = ~F.array_contains("statuses", "FAIL") & ~F.array_contains("statuses", "ERROR")
    ran = (missing == 0) | unread
    return seen.select(
        "execution_id", "table_name", F.when(ran, F.lit("true")).otherwise(F.lit("false")).alias("job_run"),
        F.when(ran & clean, F.lit("PASS")).when(ran & unread, F.lit("SKIPPED"))
        .otherwise(F.lit("FAIL")).alias("recon_status"))


def merge_rollup(candidates: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Verdicts into the candidate table, stamped with the present time."""
    return update_matched(
        candidates, verdicts, ["execution_id", "table_name"],
        {"recon_job_run": "job_run", "recon_status": "recon_status",
         "recon_execution_time": F.current_timestamp()})


def for_display(results: DataFrame, size: int = 1000) -> DataFrame:
    """Results with long texts shortened; the stored rows stay whole."""
    return results.withColumns({c: F.substring(c, 1, size) for c in ("summary", "error_log")})
