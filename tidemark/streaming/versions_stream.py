"""Cell versions kept by a stream: each micro-batch adds its own newest versions.

A batch writes the ``version_records`` of its changes, at most ``n`` a cell, to a
folder of its own; a replay writes the same again.  A reader takes the newest of
all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import apply as A
from tidemark.operators import audit as AU
from tidemark.streaming.records import RECORDS, run_of, shuffles_follow


def run_versions_stream(stream: DataFrame, root: str, checkpoint: str, n: int, keys_col: str | None = None, available_now: bool = True):
    """Keep the last ``n`` versions of every cell; returns the streaming query."""
    run = run_of(checkpoint)
    least = int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def fold(batch: DataFrame, batch_id: int) -> None:
        shuffles_follow(batch, least)
        records = AU.version_records(A.contributions(A.with_row_keys(batch, keys_col)), n)
        records.write.mode("overwrite").parquet(f"{root}/run={run}/batch={batch_id}")

    w = stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")).start()


def current_versions(spark: SparkSession, root: str, n: int) -> DataFrame:
    """``cell_versions`` of all that the stream has read."""
    records = spark.read.schema(RECORDS).option("recursiveFileLookup", "true").parquet(root)
    return AU.versions_of(A.dealt(records).distinct(), n, A.wipes_of(records))
