"""A feed of serialized entries decoded inside the stream: changes go to the apply records, what is no entry to a
dead-letter folder.

Both outputs of a micro-batch overwrite their own folders, so a replay after a
failure leaves the same behind.  The lines of a micro-batch are parsed once and kept
until both are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.decode import changes_of, read_entries, rejects_of
from tidemark.streaming.records import run_of, shuffles_follow, start, write_batch

_REJECT = "value string, reason string"


def run_feed_stream(spark: SparkSession, source_dir: str, state_root: str, dead_letters: str, checkpoint: str,
                    max_files_per_trigger: int = 1, available_now: bool = True, source_prefix: str = "", **apply_kw):
    """Start the stream over text files of one entry a line; returns the streaming query.  ``apply_kw``: as for
    ``records.write_batch``."""
    run = run_of(checkpoint)
    start(spark, state_root, run)
    spark.createDataFrame([], _REJECT).write.mode("overwrite").parquet(f"{dead_letters}/run={run}/batch=-1")

    least = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def fold(lines: DataFrame, batch_id: int) -> None:
        shuffles_follow(lines, least)
        entries = read_entries(lines).persist()
        try:
            rejects_of(entries).write.mode("overwrite").parquet(f"{dead_letters}/run={run}/batch={batch_id}")
            write_batch(changes_of(entries, source_prefix), batch_id, state_root, run, **apply_kw)
        finally:
            entries.unpersist()

    src = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(source_dir)
    w = src.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")).start()


def read_dead_letters(spark: SparkSession, dead_letters: str) -> DataFrame:
    """``(value, reason)`` of every line that was no entry."""
    return spark.read.schema(_REJECT).option("recursiveFileLookup", "true").parquet(dead_letters)
