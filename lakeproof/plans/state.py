"""Names of the state tables used by the plans."""
from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import SparkSession

from lakeproof import schemas
from lakeproof.sources.tables import ensure_table
from lakeproof.spec import DEFAULT, PartitionSpec


@dataclass(frozen=True)
class Tables:
    mapping: str = "dataset_mapping"
    inventory: str = "file_inventory"
    candidates: str = "candidates"
    tags: str = "partition_tags"
    catalog: str = "parquet_schemas"
    claims: str = "migration_status"
    pending: str = "pending_load_status"
    ledger: str = "partition_ledger"
    results: str = "recon_results"
    remediation: str = "recon_remediation"
    comparison: str = "schema_comparison_results"
    copies: str = "copy_mapping"
    reports: str = "inventory_reports"
    details: str = "inventory_report_rows"
    differences: str = "object_differences"

    def within(self, schema: str) -> "Tables":
        return Tables(**{f.name: f"{schema}.{getattr(self, f.name)}" for f in fields(self)})


def create_state(spark: SparkSession, tables: Tables, spec: PartitionSpec = DEFAULT) -> None:
    """Creates the state tables that do not exist yet.

    Inventory and ledger grow with the files of the lake; they are kept by dataset, so that a
    change to one dataset leaves the files of the others as they are.
    """
    for name, schema in ((tables.inventory, schemas.inventory(spec)), (tables.ledger, schemas.ledger(spec))):
        ensure_table(spark, name, schema, by_dataset=True)
    for name, schema in ((tables.mapping, schemas.MAPPING),
                         (tables.candidates, schemas.CANDIDATES), (tables.tags, schemas.PARTITION_TAGS),
                         (tables.catalog, schemas.SCHEMA_CATALOG), (tables.claims, schemas.CLAIMS),
                         (tables.pending, schemas.pending_status(spec)),
                         (tables.results, schemas.RECON_RESULTS),
                         (tables.remediation, schemas.REMEDIATION_LOG),
                         (tables.comparison, schemas.SCHEMA_COMPARISON),
                         (tables.copies, schemas.COPY_MAPPING), (tables.reports, schemas.REPORT_LIST),
                         (tables.details, schemas.REPORT_DETAILS),
                         (tables.differences, schemas.DIFFERENCES)):
        ensure_table(spark, name, schema)
