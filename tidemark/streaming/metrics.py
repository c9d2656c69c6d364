"""Metrics of a running stream: one row a micro-batch, from which progress and alerts are derived.

``metered`` wraps what a stream does with a batch.  After the batch is done it
writes ``(batch_id, batch_end, n_rows, last_ts)``: when the batch ended, how many
changes it had and the newest of their times.  An empty batch (a fetch that brought
nothing) has a row too.  A replay overwrites its batch's row.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ROW = "batch_id long, batch_end timestamp_ntz, n_rows long, last_ts timestamp_ntz"


def metered(process: Callable[[DataFrame, int], None], path: str, clock: Callable[[int], str] | None = None) -> Callable[[DataFrame, int], None]:
    """``process`` for ``foreachBatch`` that also notes each batch; ``clock`` tells when a batch ended (default: the
    wall clock, in UTC)."""
    now_of = clock or (lambda _: datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f"))

    def run(batch: DataFrame, batch_id: int) -> None:
        process(batch, batch_id)
        row = batch.agg(F.count(F.lit(1)).alias("n_rows"), F.max("exec_time").alias("last_ts"))
        row = row.select(F.lit(batch_id).cast("long").alias("batch_id"), F.lit(now_of(batch_id)).cast("timestamp_ntz").alias("batch_end"), "n_rows", "last_ts")
        row.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return run


def batch_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that a metered stream has written, for ``monitor.metrics_of_batches``."""
    return spark.read.schema(_ROW).option("recursiveFileLookup", "true").parquet(path)
