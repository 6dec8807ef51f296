"""All registered queries."""
from queries import (drift_queries, inventory_queries, lake_queries,  # noqa: F401
                     object_queries, recon_queries)
from queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
