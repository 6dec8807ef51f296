"""Storage inventory reports: discovery, manifests, data files."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof import schemas
from lakeproof.functions import paths
from lakeproof.operators.lookup import SALT, is_small, lookup
from lakeproof.operators.merge import supersede, update_matched
from lakeproof.session import cut_lineage
from lakeproof.sources.listing import list_files
from lakeproof.sources.tables import batches

NOT_REPORTS = ("hive", "data")  # fixed values: folders beside the reports


def report_folders(sides: DataFrame) -> DataFrame:
    """Reports found below each manifest root: (family path, run name, size, time).

    ``sides`` has bucket_name, prefix, inventory_s3_location and manifest_path.
    """
    roots = sides.select("bucket_name", "prefix", "inventory_s3_location",
                         F.col("manifest_path").alias("path")).distinct()
    found = list_files(roots, split_levels=1).filter(F.col("file_name") == "manifest.json")
    return found.select(
        "bucket_name", "prefix", "inventory_s3_location", paths.report_parent("path").alias("path"),
        F.col("size").cast("double").alias("size"), paths.report_run("path").alias("name"),
        F.col("last_modified_time").alias("modificationTime")
    ).filter(~F.col("name").isin(*NOT_REPORTS))


def decode_report_list(rows: DataFrame, column: str = "list_of_files") -> DataFrame:
    """Report entries from a JSON text that lists them, one row each."""
    entries = F.from_json(F.col(column), T.ArrayType(schemas.REPORT_ENTRY))
    others = [c for c in rows.columns if c != column]
    return (rows.select(*others, F.explode(entries).alias("e"))
            .select(*others, F.col("e.file").alias("path"), "e.size", "e.name", "e.modificationTime"))


def latest_reports(reports: DataFrame) -> DataFrame:
    """The newest report per family path; names are times, so the largest name wins.

    Prefixes that share a family each keep their row.  Each map task keeps one row per
    group before the shuffle.
    """
    family = [c for c in ("bucket_name", "prefix", "path") if c in reports.columns]
    rank = F.row_number().over(Window.partitionBy(*family).orderBy(F.desc("name")))
    return reports.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def refresh_report_list(stored: DataFrame, reports: DataFrame, run: str) -> DataFrame:
    """Work list after discovery: older waiting reports ignored, the newest ones waiting."""
    return supersede(stored, latest_reports(reports), ["bucket_name", "prefix", "path"], run)


def manifest_files(spark: SparkSession, waiting: DataFrame, jpath: str = "manifest.json") -> DataFrame:
    """Data files of the waiting reports with format and schema text.

    One read for all manifests, one manifest per waiting report.
    """
    named = waiting.withColumn("manifest", F.concat_ws("/", "path", "name", F.lit(jpath)))
    listed = (r.manifest for r in named.select("manifest").distinct().toLocalIterator())
    reads = [spark.read.option("multiLine", True).schema(schemas.MANIFEST).json(files)
             .withColumn("manifest", _plain(F.input_file_name())) for files in batches(listed)]
    if not reads:
        raise LookupError("no new inventory reports to process")
    documents = reduce(DataFrame.unionByName, reads)
    keyed = named.withColumn("manifest", _plain(F.col("manifest")))
    entries = documents.select("manifest", "fileFormat", "fileSchema", F.explode("files").alias("f"))
    return keyed.join(entries, ["manifest"], "inner").select(
        *waiting.columns, "fileFormat", "fileSchema", F.col("f.key").alias("file_key"),
        F.col("f.size").alias("file_size"), F.col("f.MD5checksum").alias("file_md5"))


def _plain(path):
    """A path without the scheme spellings Spark and users mix."""
    return F.regexp_replace(path, "^file:/*", "/")


def read_reports(spark: SparkSession, files: DataFrame, run: str, header: bool = False,
                 relative_to: str = "location", salt: int = SALT) -> DataFrame:
    """Rows of all data files, all columns as text, in the layout of the details table.

    One read per format and schema, whatever the number of files.  Keys are relative to the
    report location or, with ``relative_to="bucket"``, to the bucket.
    """
    root = (F.col("inventory_s3_location") if relative_to == "location"
            else F.concat(F.lit("s3://"), F.col("bucket_name")))
    located = files.withColumn("data_file", F.concat_ws("/", root, "file_key"))
    kinds = located.select("fileFormat", "fileSchema").distinct().collect()
    parts = []
    for kind in kinds:
        same = located.filter((F.col("fileFormat") == kind.fileFormat)
                              & F.col("fileSchema").eqNullSafe(F.lit(kind.fileSchema)))
        names = [r.data_file for r in same.select("data_file").distinct().toLocalIterator()]
        columns = [c.strip() for c in (kind.fileSchema or "").split(",")]
        if kind.fileFormat.upper() == "CSV":
            text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
            rows = spark.read.schema(text).option("header", header).csv(names)
        else:
            rows = spark.read.format(kind.fileFormat.lower()).load(names)
            rows = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
        rows = rows.withColumn("data_file", _plain(F.input_file_name()))
        owners = same.select(
            _plain(F.col("data_file")).alias("data_file"), "bucket_name", "prefix",
            "inventory_s3_location", "path", "name").distinct()
        owners = cut_lineage(owners)
        parts.append(lookup(rows, owners, ["data_file"], "inner", salt, is_small(owners)).drop("data_file"))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if "IsLatest" in rows.columns:
        rows = rows.filter(paths.current_version("IsLatest"))
    return (rows.filter(paths.has_prefix("Key", F.col("prefix"))).drop("bucket_name")
            .withColumn("processed", F.lit("false")).withColumn("runId", F.lit(run)))


def retire_details(details: DataFrame, incoming: DataFrame) -> DataFrame:
    """Waiting rows of an older report of the same family, marked ``ignore``.

    Families are few beside their rows; counted and broadcast, they leave the stored rows where
    they are.
    """
    keys = ["Bucket", "inventory_s3_location", "path"]
    families = cut_lineage(incoming.select(*keys).distinct())
    return update_matched(details, families, keys, {"processed": F.lit("ignore")},
                          F.col("t.processed") == "false", small=is_small(families))
