"""Migration assurance on Spark: inventory, drift, load, reconciliation, object diff.

Every operator is a function from DataFrames to a DataFrame (or from Columns to a
Column).  No module keeps a global session.
"""
from lakeproof.spec import PartitionSpec

__all__ = ["PartitionSpec"]
