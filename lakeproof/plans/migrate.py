"""Lake to managed tables: inventory, drift verdict, load, remediation.

Each step is a few Spark jobs over all datasets or all partitions of a dataset.  The only
loops on the driver run over datasets and over bounded batches of partition paths.
"""
from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof import schemas
from lakeproof.functions import paths
from lakeproof.functions.types import canonical_schema, captured_columns
from lakeproof.operators import drift, inventory as inv, ledger, partitions as parts
from lakeproof.operators.lookup import is_small, lookup
from lakeproof.operators.merge import update_matched
from lakeproof.plans.state import Tables
from lakeproof.session import SPARK_ERRORS, cut_lineage
from lakeproof.sources import footers, listing, tables as tb
from lakeproof.spec import DEFAULT, PartitionSpec

LOG = logging.getLogger(__name__)

# Column types that the Parquet reader widens by itself.
WIDENS = {("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("smallint", "int"),
          ("smallint", "bigint"), ("int", "bigint"), ("float", "double"), ("int", "double")}


# --- inventory ---------------------------------------------------------------------

def take_inventory(spark: SparkSession, tables: Tables, execution_id: str,
                   mapping_csv: str | None = None, spec: PartitionSpec = DEFAULT,
                   late: bool = False) -> DataFrame:
    """Adds new mappings and new files, then refreshes the candidates of their datasets.

    Nothing is stored of a dataset with a folder that could not be listed, so its mark stays
    where it was and the next run finds its files.  Returns those datasets with the errors.
    ``late`` also takes files of the very time of the mark that are not stored yet.
    """
    if mapping_csv is not None:
        incoming = tb.read_mapping(spark, mapping_csv)
        tb.replace_table(inv.add_mappings(spark.table(tables.mapping), incoming), tables.mapping)
    mapping, stored = spark.table(tables.mapping), spark.table(tables.inventory)
    # The listing is fixed before anything is stored: storage may change under a retry.
    found = cut_lineage(listing.list_files(listing.dataset_roots(mapping, spec.scheme), errors="report"))
    unlisted = cut_lineage(found.filter(F.col("error").isNotNull()).select(*inv.DATASET, "path", "error"))
    known = found.filter(F.col("error").isNull()).drop("error")
    if not unlisted.isEmpty():
        wrong = cut_lineage(unlisted.select(*inv.DATASET).distinct())
        LOG.warning("%d folders could not be listed", unlisted.count())
        known = lookup(known, wrong, inv.DATASET, "left_anti", small=is_small(wrong))
    rows = cut_lineage(inv.new_inventory(known, stored, mapping, execution_id, spec, late))
    touched = cut_lineage(rows.select(*inv.DATASET).distinct())
    tb.append_rows(rows, tables.inventory)
    fresh = tb.of_datasets(spark.table(tables.inventory), touched)
    metrics = inv.candidate_metrics(fresh)
    tb.replace_table(inv.upsert_candidates(spark.table(tables.candidates), metrics, execution_id),
                     tables.candidates)
    return unlisted


# --- drift -------------------------------------------------------------------------

def partition_files(inventory: DataFrame, plan: DataFrame, spec: PartitionSpec) -> DataFrame:
    """Data files of planned partitions."""
    files = inventory.filter(F.col("extension").isNotNull()).select(
        *inv.DATASET, paths.partition_path("s3_bucket_name", "key", spec.scheme).alias("partition_path"),
        F.concat(F.lit(spec.scheme), "s3_bucket_name", F.lit("/"), "key").alias("data_file")).distinct()
    keys = [*inv.DATASET, "partition_path"]
    return lookup(files, plan.select(*keys).distinct(), keys, "left_semi")


def assess_drift(spark: SparkSession, tables: Tables, bucket: str, low: int = 0,
                 high: int = 1 << 62, spec: PartitionSpec = DEFAULT) -> DataFrame:
    """Captures schemas of blessed partitions of eligible datasets and stores the verdicts."""
    eligible = inv.eligible_candidates(spark.table(tables.candidates), bucket, low, high)
    run = eligible.select("execution_id", *inv.DATASET).distinct()
    inventory = spark.table(tables.inventory)
    plan = parts.load_plan(inventory, spark.table(tables.tags), spec)
    plan = lookup(plan, run.select(*inv.DATASET), inv.DATASET, "left_semi")
    captured = footers.capture_files(partition_files(inventory, plan, spec))
    # Footers are read once; a row per partition is little.
    found = cut_lineage(footers.capture_partitions(captured, inv.DATASET))
    catalog = run.join(found, inv.DATASET, "inner").withColumn("run_timestamp", F.current_timestamp())
    catalog = cut_lineage(catalog.select(*[F.col(c) for c in schemas.SCHEMA_CATALOG.names]))
    tb.append_rows(catalog, tables.catalog)
    mixed = run.join(found.filter("schemas > 1").select(*inv.DATASET).distinct(), inv.DATASET, "inner")
    verdict = cut_lineage(drift.drift_verdict(catalog, mixed=mixed))
    tb.replace_table(drift.merge_verdict(spark.table(tables.candidates), verdict), tables.candidates)
    return verdict


# --- load --------------------------------------------------------------------------

def _any_null(data_type: str) -> Column:
    """A nested type's text without regard to what inside it may be null."""
    return F.regexp_replace(data_type, '"(containsNull|valueContainsNull|nullable)":\\s*(true|false)',
                            '"$1":true')


def unloadable(captured: DataFrame, schema: T.StructType) -> DataFrame:
    """Partition paths with an unreadable file or a column the read schema cannot take."""
    wanted = captured.sparkSession.createDataFrame([(canonical_schema(schema),)], "schema_json string")
    expected = captured_columns(wanted, []).select("column_name", _any_null("data_type").alias("wanted"))
    files = captured.groupBy("partition_path", "is_corrupted", "schema_json").agg(F.count(F.lit(1)))
    kinds = files.filter(~F.col("is_corrupted")).select("schema_json").distinct()
    pair = F.concat_ws(">", "data_type", "wanted")
    clash = (captured_columns(kinds.withColumn("text", F.col("schema_json")), ["text"])
             .withColumn("data_type", _any_null("data_type")).join(expected, ["column_name"], "inner")
             .filter((F.col("data_type") != F.col("wanted"))
                     & ~pair.isin(*[f"{a}>{b}" for a, b in sorted(WIDENS)]))
             .select(F.col("text").alias("schema_json")).distinct())
    drifted = lookup(files, clash, ["schema_json"], "left_semi").select("partition_path")
    return files.filter("is_corrupted").select("partition_path").unionByName(drifted).distinct()


# Files that one partition of the table is made of.
Unit = list[Row]


def _run_isolating(units: list[Unit], work: Callable[[list[Row]], None],
                   probe: Callable[[], None]) -> list[Row]:
    """Runs one job over many partitions; on failure halves the batch to find the bad ones.

    A failed job leaves nothing behind, so a half can run again.  Returns the failures.
    ``probe`` appends no rows; if that fails as well, the table refuses and the search ends.
    """
    rows = [r for unit in units for r in unit]
    try:
        work(rows)
        return []
    except (*SPARK_ERRORS, ValueError) as error:
        LOG.warning("could not take %d files from %s on: %s", len(rows), rows[0].partition_path, error)
        if len(units) == 1:
            return rows
    try:
        probe()
    except (*SPARK_ERRORS, ValueError) as error:
        LOG.warning("the table takes nothing: %s", error)
        return rows
    half = len(units) // 2
    return _run_isolating(units[:half], work, probe) + _run_isolating(units[half:], work, probe)


def _each_batch(files: DataFrame, work: Callable[[list[Row]], None], spec: PartitionSpec,
                probe: Callable[[], None]) -> list[Row]:
    """Bounded batches of files; all files of one partition pair stay together."""
    failed: list[Row] = []
    pair = [spec.run, spec.date]
    ordered = files.orderBy(*pair, "data_file")
    units = (list(same) for _, same in groupby(ordered.toLocalIterator(), key=lambda r: tuple(r[c] for c in pair)))
    for batch in tb.batches(units, weight=len):
        failed += _run_isolating(batch, work, probe)
    return failed


def _read_files(spark: SparkSession, root: str, rows: list[Row], schema: T.StructType) -> DataFrame:
    """Just these files in one frame; folders may spell the partition columns differently."""
    ordered = sorted(rows, key=lambda r: tb.layout(r.partition_path))
    reads = [tb.read_partitions(spark, root, [r.data_file for r in same], schema)
             for _, same in groupby(ordered, key=lambda r: tb.layout(r.partition_path))]
    return reduce(DataFrame.unionByName, reads)


def _failed_pairs(spark: SparkSession, rows: list[Row], spec: PartitionSpec) -> DataFrame:
    kind = T.StructType([f for f in schemas.ledger(spec).fields if f.name in (spec.run, spec.date)])
    return spark.createDataFrame(list({(r[spec.run], r[spec.date]) for r in rows}), kind)


def load_dataset(spark: SparkSession, plan: DataFrame, inventory: DataFrame, schema: T.StructType,
                 table: str, root: str, spec: PartitionSpec = DEFAULT,
                 replace_partitions: bool = True, location: str | None = None,
                 captured: DataFrame | None = None) -> DataFrame:
    """Loads planned partitions into the managed table; load status per partition.

    A pair is loaded whole, the inventoried files of all its folders in one write, and takes
    the place of what the table had of it: neither a late file nor a repeated load loses or
    doubles rows.  A pair with one folder that cannot be read is not touched.  Without
    ``replace_partitions`` only files that wait are appended.

    Footers tell beforehand which partitions cannot be read (``captured``: the files of the
    planned pairs with their footers, else read here); all others go through one strict read
    and one write per batch.
    """
    plan = cut_lineage(plan)
    pair = [spec.run, spec.date]
    if captured is None:
        files = ledger.pair_files(inventory, plan, spec, not replace_partitions)
        captured = cut_lineage(footers.capture_files(files))
    tb.create_table(spark, table, schema, spec, location)
    if tb.fits(spark.table(table).schema, schema):
        folders = unloadable(captured, schema)
        bad = captured.join(folders, ["partition_path"], "left_semi").select(*pair).distinct()
    else:   # nothing can be appended
        bad = plan.select(*pair).distinct()
    bad = cut_lineage(bad)
    good = captured.join(bad, pair, "left_anti").select(*pair, "partition_path", "data_file")

    def append(rows: list[Row]) -> None:
        tb.append_evolving(_read_files(spark, root, rows, schema), table, spec, replace_partitions)

    nothing = spark.createDataFrame([], schema)
    late = _each_batch(good, append, spec, lambda: tb.append_evolving(nothing, table, spec))
    failed = bad.unionByName(_failed_pairs(spark, late, spec)).distinct()
    status = plan.join(failed.withColumn("bad", F.lit(True)), pair, "left")
    return cut_lineage(status.select(
        "partition_path", F.col("s3_bucket_name").alias("bucket_name"), "bucket_prefix",
        spec.run, spec.date,
        F.when(F.col("bad"), F.lit("failed")).otherwise(F.lit("loaded")).alias("load_status")))


def record_status(inventory: DataFrame, status: DataFrame, spec: PartitionSpec = DEFAULT,
                  guard: Column | None = None, small: bool = False) -> DataFrame:
    """Load status into inventory rows that have none yet (or that meet ``guard``).

    Several folders of one partition pair count as loaded only when all are.
    """
    keys = [*inv.DATASET, spec.run, spec.date]
    whole = F.bool_and(F.col("load_status") == "loaded")
    one = status.withColumnRenamed("bucket_name", "s3_bucket_name").groupBy(*keys).agg(
        F.when(whole, F.lit("loaded")).otherwise(F.lit("failed")).alias("load_status"))
    waiting = F.col("t.load_status").isNull() if guard is None else guard
    return update_matched(inventory, one, keys, {"load_status": "load_status"}, waiting, small=small)


def finish_load(candidates: DataFrame, loaded: DataFrame) -> DataFrame:
    """Marks the managed tables of the loaded datasets as created."""
    return update_matched(candidates, loaded.select(*inv.DATASET).distinct(), inv.DATASET,
                          {"managed_table_created": F.lit("true")},
                          F.col("t.managed_table_created").isNull())


def note_errors(candidates: DataFrame, failed: DataFrame) -> DataFrame:
    """Notes on uncreated candidates that their dataset could not be processed."""
    return update_matched(candidates, failed.select(*inv.DATASET).distinct(), inv.DATASET,
                          {"error_message": F.lit("Failed to Process")},
                          F.col("t.managed_table_created").isNull())


def release(claims: DataFrame, returned: DataFrame) -> DataFrame:
    """Claims without the returned ones."""
    keys = ["execution_id", *inv.DATASET]
    return lookup(claims, returned.select(*keys).distinct(), keys, "left_anti")


def settle(spark: SparkSession, tables: Tables, spec: PartitionSpec = DEFAULT) -> None:
    """Merges pending load status into inventory and candidates, all datasets at once.

    Status is appended as each dataset finishes and merged once per run; of the inventory only
    the datasets with pending status are read and written.  Runs first as well, for what a run that
    was cut off has left.
    """
    pending = cut_lineage(spark.table(tables.pending))
    if pending.isEmpty():
        return
    small = is_small(pending)
    first, again = pending.filter(F.col("was").isNull()), pending.filter(F.col("was") == "failed")
    touched = pending.select(F.col("bucket_name").alias("s3_bucket_name"), "bucket_prefix").distinct()
    inventory = record_status(tb.of_datasets(spark.table(tables.inventory), touched), first, spec, small=small)
    inventory = record_status(inventory, again, spec, F.col("t.load_status") == "failed", small)
    tb.replace_touched(inventory, tables.inventory)
    loaded = first.withColumnRenamed("bucket_name", "s3_bucket_name")
    tb.replace_table(finish_load(spark.table(tables.candidates), loaded), tables.candidates)
    tb.empty_like(pending, tables.pending)


def _of(df: DataFrame, row: Row) -> DataFrame:
    """Rows of one dataset."""
    return df.filter((F.col("s3_bucket_name") == row.s3_bucket_name)
                     & (F.col("bucket_prefix") == row.bucket_prefix))


def whole_plan(inventory: DataFrame, tags: DataFrame, taken: DataFrame,
               spec: PartitionSpec = DEFAULT) -> DataFrame:
    """Blessed partitions that wait, and those whose newest load lacks a file that counts as loaded."""
    waiting = parts.load_plan(inventory, tags, spec)
    stale = parts.blessed_partitions(ledger.stale_pairs(inventory, taken, spec), tags, spec)
    return waiting.unionByName(stale.select(*waiting.columns)).distinct()


def load(spark: SparkSession, tables: Tables, spec: PartitionSpec = DEFAULT,
         replace_partitions: bool = True, **limits) -> DataFrame:
    """Claims open candidates and loads each claimed dataset; returns status per partition.

    ``limits`` are those of ``partitions.claimable``: bucket and range of file counts.  A
    dataset that fails, or has nothing to load, gives its claim back; the others go on.
    """
    settle(spark, tables, spec)
    claims = cut_lineage(parts.claim(spark.table(tables.candidates), spark.table(tables.claims), **limits))
    tb.append_rows(claims, tables.claims)
    # Plan, footers and read schemas of all claimed datasets at once; the loop only appends.
    mine = claims.select(*inv.DATASET).distinct()
    small, inventory = is_small(mine), tb.of_datasets(spark.table(tables.inventory), mine)
    plan = cut_lineage(lookup(whole_plan(inventory, spark.table(tables.tags), tb.of_datasets(spark.table(tables.ledger), mine), spec),
                              mine, inv.DATASET, "left_semi", small=small))
    files = cut_lineage(ledger.pair_files(inventory, plan, spec, not replace_partitions))
    captured = cut_lineage(footers.capture_files(files))
    catalog = lookup(spark.table(tables.catalog), mine, inv.DATASET, "left_semi", small=small)
    found = drift.latest_readable_schemas(catalog, plan, spec, inv.DATASET)
    targets = parts.table_targets(spark.table(tables.mapping), spec.scheme)
    # A claim without a mapping fails like any other and is given back.
    work = (claims.join(targets, inv.DATASET, "left")
            .join(found.select(*inv.DATASET, "schema_json"), inv.DATASET, "left"))
    out = spark.createDataFrame([], schemas.load_status(spec))
    failed, returned = [], []
    for row in work.toLocalIterator():
        key = (row.execution_id, row.s3_bucket_name, row.bucket_prefix)
        part = _of(plan, row)
        if row.managed_table_name is None:
            LOG.warning("no mapping for %s", row.bucket_prefix)
            failed.append(key)
            returned.append(key)
            continue
        if part.isEmpty():
            returned.append(key)
            continue
        try:
            if row.schema_json is None:
                raise LookupError("no captured schema")
            status = load_dataset(spark, part, inventory, drift.read_schema(row.schema_json, spec),
                                  row.managed_table_name, row.root_path, spec, replace_partitions,
                                  captured=_of(captured, row))
        except (*SPARK_ERRORS, LookupError, ValueError) as error:
            LOG.warning("could not load %s: %s", row.bucket_prefix, error)
            failed.append(key)
            returned.append(key)
            continue
        done = status.filter("load_status = 'loaded'").withColumnRenamed("bucket_name", "s3_bucket_name")
        tb.append_rows(ledger.taken(_of(files, row), done, row.execution_id, "load", spec), tables.ledger)
        tb.append_rows(status.withColumn("was", F.lit(None).cast("string")), tables.pending)
        out = out.unionByName(status)
    settle(spark, tables, spec)
    keys = "execution_id string, s3_bucket_name string, bucket_prefix string"
    if failed:
        tb.replace_table(note_errors(spark.table(tables.candidates),
                                     spark.createDataFrame(failed, keys)), tables.candidates)
    if returned:
        tb.replace_table(release(spark.table(tables.claims),
                                 spark.createDataFrame(returned, keys)), tables.claims)
    return out


# --- remediation -------------------------------------------------------------------

def remediate_dataset(spark: SparkSession, failed: DataFrame, inventory: DataFrame,
                      base: T.StructType, table: str, root: str, spec: PartitionSpec = DEFAULT,
                      lenient: bool = False, fill_missing: bool = False,
                      partitions_from: str = "path", captured: DataFrame | None = None) -> DataFrame:
    """Casts failed partitions to the base schema and loads them; outcome per partition.

    A pair is repaired whole: the inventoried files of all its folders, each cast from the
    schema of its own footer, are written at once and take the place of what the table had of
    the pair, so that neither a repeated repair nor a pair loaded before doubles rows.  A pair
    with a file that cannot be read is not touched.

    The partition columns come from the path, or with ``partitions_from="data"`` from the
    files where those hold them; since such files may name any partition, those are appended,
    and refused where the table already has the partition.
    """
    failed = cut_lineage(failed)
    pair = [spec.run, spec.date]
    if captured is None:
        captured = footers.capture_files(ledger.pair_files(inventory, failed, spec))
    captured = cut_lineage(captured)
    bad = captured.filter("is_corrupted").select(*pair).distinct()
    good = captured.join(bad, pair, "left_anti").select(*pair, "partition_path", "data_file", "schema_json")
    nothing = spark.createDataFrame([], base)

    def append(rows: list[Row]) -> None:
        aligned = []
        for text, same in groupby(sorted(rows, key=lambda r: r.schema_json), key=lambda r: r.schema_json):
            if partitions_from == "data":
                raw = tb.read_as_stored(spark, [r.data_file for r in same], drift.stored_schema(text), spec)
            else:
                raw = _read_files(spark, root, list(same), drift.read_schema(text, spec))
            aligned.append(drift.align(raw, base, lenient, fill_missing))
        data = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)
        if partitions_from == "data":
            held = spark.table(table).select(*pair).distinct()
            if not data.select(*pair).distinct().join(held, pair, "left_semi").isEmpty():
                raise ValueError("the table already has a partition that the files name")
        tb.append_evolving(data, table, spec, partitions_from != "data")

    late = _each_batch(good, append, spec, lambda: tb.append_evolving(nothing, table, spec))
    failures = bad.unionByName(_failed_pairs(spark, late, spec)).distinct()
    done = failed.join(failures.withColumn("bad", F.lit(True)), pair, "left")
    return cut_lineage(done.select(
        *failed.columns, F.when(F.col("bad"), F.lit("failed")).otherwise(F.lit("loaded")).alias("load_status")))


def remediation_summary(outcome: DataFrame) -> DataFrame:
    """Attempted, remediated and failed partitions per dataset, in the log's layout."""
    bad = F.col("load_status") != "loaded"
    counts = outcome.groupBy(*inv.DATASET, "dataset_name").agg(
        F.max("execution_id").alias("execution_id"),
        F.count(F.lit(1)).alias("partitions_attempted"),
        F.count_if(~bad).alias("partitions_remediated"), F.count_if(bad).alias("partitions_failed"),
        F.min(F.when(bad, F.col("partition_path"))).alias("first_failed"))
    n = F.col("partitions_failed")
    values = {
        "remediation_attempted_time": F.current_timestamp(),
        "remediation_status": F.when(n == 0, F.lit("PASS")).otherwise(F.lit("FAIL")),
        "error_msg": F.when(n > 0, F.concat(n.cast("string"), F.lit(" partitions failed, first: "),
                                            F.col("first_failed")))}
    full = counts.withColumns(values)
    return full.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                         for f in schemas.REMEDIATION_LOG.fields])


def reopen(candidates: DataFrame, summary: DataFrame) -> DataFrame:
    """Reopens reconciliation of datasets whose partitions were all remediated."""
    clean = summary.filter((F.col("partitions_failed") == 0)
                           & (F.col("partitions_remediated") == F.col("partitions_attempted")))
    keys = clean.select("execution_id", F.col("dataset_name").alias("table_name")).distinct()
    return update_matched(candidates, keys, ["execution_id", "table_name"],
                          {"recon_job_run": F.lit(None)})


def base_schemas(spark: SparkSession, tables: Tables, datasets: DataFrame,
                 spec: PartitionSpec = DEFAULT) -> DataFrame:
    """Schema of the newest loaded and tracked partition of each dataset."""
    small = is_small(datasets)
    loaded = lookup(parts.work_files(spark.table(tables.inventory), spec, F.col("load_status") == "loaded"),
                    datasets, inv.DATASET, "left_semi", small=small)
    tracked = parts.blessed_partitions(parts.partition_rows(loaded, spec), spark.table(tables.tags), spec)
    catalog = lookup(spark.table(tables.catalog), datasets, inv.DATASET, "left_semi", small=small)
    return drift.latest_readable_schemas(catalog, tracked, spec, inv.DATASET)


def compare_failed_schemas(spark: SparkSession, tables: Tables, spec: PartitionSpec = DEFAULT,
                           bucket: str | None = None, datasets: list[str] | None = None) -> DataFrame:
    """Column types of failed partitions against the base schema, stored; outcome per column."""
    settle(spark, tables, spec)
    failed = cut_lineage(parts.failed_partitions(spark.table(tables.inventory),
                                                 spark.table(tables.mapping), spec, bucket, datasets))
    mine = cut_lineage(failed.select(*inv.DATASET).distinct())
    catalog = lookup(spark.table(tables.catalog), mine, inv.DATASET, "left_semi", small=is_small(mine))
    base = base_schemas(spark, tables, mine, spec).select(*inv.DATASET, "schema_json")
    report = cut_lineage(drift.type_report(catalog, failed, base, inv.DATASET, spec))
    tb.append_rows(drift.comparison_rows(report), tables.comparison)
    return drift.column_outcome(report, inv.DATASET)


def remediate(spark: SparkSession, tables: Tables, spec: PartitionSpec = DEFAULT,
              bucket: str | None = None, datasets: list[str] | None = None, **options) -> DataFrame:
    """Repairs failed partitions of every dataset that has a base schema."""
    settle(spark, tables, spec)
    failed = cut_lineage(parts.failed_partitions(spark.table(tables.inventory),
                                                 spark.table(tables.mapping), spec, bucket, datasets))
    mine = failed.select(*inv.DATASET).distinct()
    inventory = tb.of_datasets(spark.table(tables.inventory), mine)
    files = cut_lineage(ledger.pair_files(inventory, failed, spec))
    captured = cut_lineage(footers.capture_files(files))
    found = base_schemas(spark, tables, mine, spec)
    targets = parts.table_targets(spark.table(tables.mapping), spec.scheme)
    # A dataset without a schema is skipped whole: it has no row here.
    work = mine.join(targets, inv.DATASET, "inner").join(
        found.select(*inv.DATASET, "schema_json"), inv.DATASET, "inner")
    log = spark.createDataFrame([], schemas.REMEDIATION_LOG)
    for row in work.toLocalIterator():
        try:
            outcome = remediate_dataset(spark, _of(failed, row), inventory,
                                        drift.read_schema(row.schema_json, spec),
                                        row.managed_table_name, row.root_path, spec,
                                        captured=_of(captured, row), **options)
        except (*SPARK_ERRORS, ValueError) as error:
            LOG.warning("could not remediate %s: %s", row.bucket_prefix, error)
            continue
        newest = outcome.agg(F.max("execution_id")).first()[0]
        done = outcome.filter("load_status = 'loaded'")
        tb.append_rows(ledger.taken(_of(files, row), done, newest, "remediate", spec), tables.ledger)
        status = outcome.withColumnRenamed("s3_bucket_name", "bucket_name").withColumn("was", F.lit("failed"))
        tb.append_rows(status.select(*schemas.pending_status(spec).names), tables.pending)
        log = log.unionByName(cut_lineage(remediation_summary(outcome)))
    settle(spark, tables, spec)
    tb.replace_table(reopen(spark.table(tables.candidates), log), tables.candidates)
    tb.append_rows(log, tables.remediation)
    return log


def rows_in_failed(spark: SparkSession, failed: DataFrame, root: str, schema: T.StructType,
                   spec: PartitionSpec = DEFAULT) -> DataFrame:
    """Rows sitting in failed partitions, counted per partition in one read.

    Only the failed folders are named to the reader.
    """
    keys = [spec.run, spec.date]
    data = tb.read_folders(spark, root, failed, schema, lenient=True)
    return data.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
