"""Comparing two buckets by their inventory reports."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.operators import checksum as cs, objects as ob
from lakeproof.operators.lookup import is_small
from lakeproof.operators.merge import mark_done, update_matched, update_where
from lakeproof.schemas import ONLY_SRC, SAME
from lakeproof.plans.state import Tables
from lakeproof.session import cut_lineage
from lakeproof.sources import bytes as by, reports as rp, tables as tb


def both_sides(mapping: DataFrame) -> DataFrame:
    """Manifest roots of source and destination of every mapping."""
    return ob.mapping_side(mapping, "src").unionByName(ob.mapping_side(mapping, "dest"))


def ingest_reports(spark: SparkSession, mapping: DataFrame, report_list: DataFrame,
                   details: DataFrame, run: str, header: bool = False,
                   relative_to: str = "location") -> tuple[DataFrame, DataFrame]:
    """Finds the newest reports and reads them: new work list and new details."""
    found = rp.report_folders(both_sides(mapping))
    refreshed = cut_lineage(rp.refresh_report_list(report_list, found, run))
    waiting = refreshed.filter(F.col("processed") == "false")
    rows = cut_lineage(rp.read_reports(spark, rp.manifest_files(spark, waiting), run, header, relative_to))
    kept = rp.retire_details(details, rows)
    return refreshed, kept.unionByName(rows, allowMissingColumns=True)


def compare_batch(details: DataFrame, mapping: DataFrame, compare: str = "time",
                  check_content: bool = False, fraction: float = 0.05,
                  fractions: dict[str, float] | None = None, repeatable: bool = True,
                  scheme: str = "s3://") -> DataFrame:
    """Classified keys of all mappings in one plan, with sampled content checks if wanted."""
    found = ob.classify(ob.side_objects(details, mapping, "src"),
                        ob.side_objects(details, mapping, "dest"), compare)
    if not check_content:
        return found
    found = cut_lineage(found)
    population = cs.sample_candidates(found.filter(F.col("status") == SAME), size="src_size")
    sample = (cs.hash_sample(population, fraction, fractions) if repeatable
              else cs.stratified_sample(population, fraction, fractions))
    contents = cut_lineage(by.compare_contents(sample, scheme))
    wrong, unread = by.mismatched(contents), by.unread(contents)
    return ob.with_unread(ob.with_checksums(found, wrong, is_small(wrong)), unread, is_small(unread))


def finish_reports(report_list: DataFrame, details: DataFrame, run: str) -> tuple[DataFrame, DataFrame]:
    """Marks the compared reports and their rows as processed."""
    waiting = report_list.filter(F.col("processed") == "false")
    done = mark_done(report_list, waiting, ["bucket_name", "path"], run)
    return done, update_where(details, F.col("processed") == "false", {"processed": "true"})


def finish_mapping(mapping: DataFrame, verdicts: DataFrame, summary: DataFrame, run: str) -> DataFrame:
    """Verdict, detail and time of the run into the enabled mappings."""
    outcome = verdicts.select("s3_batch_copy_id", F.col("status").alias("new_status")).join(
        summary.withColumnRenamed("recon_status", "detail"), ["s3_batch_copy_id"], "left")
    detail = F.coalesce(F.col("s.detail"), F.lit('{"status": "SUCCESS"}'))
    return update_matched(
        mapping, outcome, ["s3_batch_copy_id"],
        {"status": "new_status", "recon_status": detail, "runId": F.lit(run),
         "last_recon_timestamp": F.current_timestamp()}, F.col("t.enabled"))


def compare_buckets(spark: SparkSession, tables: Tables, run: str, batch: str | None = None,
                    header: bool = False, relative_to: str = "location", **options) -> DataFrame:
    """One whole run over the state tables; returns the verdict of each batch.

    Newest reports are found and read (rows of older ones that still wait are retired), every
    mapped pair is compared, differences are stored, reports and rows are marked as done, and
    the mappings get verdict and detail.  ``options`` are those of ``compare_batch``.
    """
    mapping = cut_lineage(ob.enabled_mappings(spark.table(tables.copies), batch))
    reports, details = ingest_reports(spark, mapping, spark.table(tables.reports),
                                      spark.table(tables.details), run, header, relative_to)
    tb.replace_table(reports, tables.reports)
    tb.replace_table(details, tables.details)
    # Stored once: classes, differences and verdicts are all read from it.
    found = cut_lineage(compare_batch(spark.table(tables.details), mapping, **options))
    differing = ob.differences(found)
    tb.append_rows(ob.diff_rows(differing, mapping, run), tables.differences)
    verdicts = cut_lineage(ob.verdict(found, compare=options.get("compare", "time")))
    summary = cut_lineage(ob.status_summary(differing))
    reports, details = finish_reports(spark.table(tables.reports), spark.table(tables.details), run)
    tb.replace_table(reports, tables.reports)
    tb.replace_table(details, tables.details)
    tb.replace_table(finish_mapping(spark.table(tables.copies), verdicts, summary, run), tables.copies)
    return verdicts


def plan_sync(spark: SparkSession, tables: Tables, batch: str | None = None,
              scheme: str = "s3://") -> DataFrame:
    """Copies still to be made, from the stored differences of each mapping's current run."""
    rows = ob.current_differences(spark.table(tables.copies), spark.table(tables.differences), batch, ONLY_SRC)
    return ob.sync_plan(rows, scheme)
