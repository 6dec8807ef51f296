"""Parameters shared by the operators."""
from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PartitionSpec:
    """Names of the partition pair of a dataset and the oldest date of interest."""

    run: str = "run_id"
    date: str = "snapshot_date"
    floor: str | None = "2020-01-01"
    scheme: str = "s3://"

    @property
    def columns(self) -> list[str]:
        """Newest-first sort order of partitions: date before run id."""
        return [self.date, self.run]

    @property
    def key_text(self) -> str:
        """Text of ``partition_key`` for a key laid out as run id, then date."""
        return f"{self.run}, {self.date}"


DEFAULT = PartitionSpec()
