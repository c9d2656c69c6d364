"""Table writes for states, increments and snapshots.

All writes are plain DataFrame writes of parquet partitioned by the column
that identifies the unit being replaced (``segment``, ``source_key``), with
dynamic partition overwrite: re-running a segment replaces that segment only,
so a retried job or a replayed micro-batch leaves the same files behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import segments as SG


def _write(df: DataFrame, path: str, partition_by: list[str]) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def write_state(state: DataFrame, path: str) -> None:
    """Current state partitioned by source (a source slice is one folder)."""
    _write(state, path, ["source_key"])


def write_increments(changes: DataFrame, path: str, granularity: str = SG.DAILY) -> None:
    """Increment tables of every segment present in ``changes``, one folder per segment."""
    _write(SG.increment_table(changes, granularity), path, ["segment"])


def write_segment_snapshot(changes: DataFrame, segment: str, path: str, granularity: str = SG.DAILY) -> None:
    """Snapshot of the state at the start of ``segment`` (events strictly
    before it), written under ``segment=<id>``."""
    fmt = "yyyyMMdd" if granularity == SG.DAILY else "yyyyMMddHH"
    start = F.to_timestamp_ntz(F.lit(segment), F.lit(fmt))
    snap = SG.snapshot_at(changes, start).withColumn("segment", F.lit(segment))
    _write(snap, path, ["segment"])
