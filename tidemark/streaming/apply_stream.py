"""Continuous change apply with Structured Streaming.

``readStream`` of change-log files -> ``foreachBatch(write_batch)``; the
stream checkpoint replaces the reference's ack.  A replayed batch overwrites
its own folders, and records are reduced when read, so delivery is effectively
exactly-once.  With ``snapshots`` the batch whose changes open a time segment
also writes the state as of that segment's start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.joins import join_small
from tidemark.operators.mapping import route_changes
from tidemark.schema import CHANGELOG
from tidemark.streaming.records import current_state, run_of, shuffles_follow, start, write_batch


def change_stream(spark: SparkSession, source_dir: str, fmt: str = "parquet", max_files_per_trigger: int = 1) -> DataFrame:
    """Streaming DataFrame over change-log files with the fixed schema."""
    return spark.readStream.schema(CHANGELOG).format(fmt).option("maxFilesPerTrigger", max_files_per_trigger).load(source_dir)


def route_batch(batch: DataFrame, mapping_path: str) -> DataFrame:
    """Changes of mapped sources only, against the mapping table as it is now.

    The mapping is re-read for every micro-batch, so a source registered
    after a CREATE TABLE (or removed after its key was dropped) takes effect
    from the next batch on, without restarting the stream.
    """
    mapping = batch.sparkSession.read.parquet(mapping_path)
    return route_changes(batch, mapping).drop("destination")


def run_apply_stream(spark: SparkSession, source_dir: str, state_root: str, checkpoint: str,
                     max_files_per_trigger: int = 1, available_now: bool = True, fmt: str = "parquet",
                     mapping_path: str | None = None, **apply_kw):
    """Start the apply stream; with ``available_now`` it processes what is
    there in micro-batches and stops.  With ``mapping_path`` only mapped
    sources are applied, under their logical keys.  ``apply_kw`` may name a
    ``granularity`` of segments and a folder for ``snapshots`` (see
    ``records.write_batch``).  Returns the streaming query."""
    run = run_of(checkpoint)
    start(spark, state_root, run)
    kw = {"keys_col": "keys", **apply_kw} if mapping_path is not None else apply_kw

    least = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def fold(batch: DataFrame, batch_id: int) -> None:
        shuffles_follow(batch, least)
        if mapping_path is not None:
            batch = route_batch(batch, mapping_path)
        write_batch(batch, batch_id, state_root, run, **kw)

    w = change_stream(spark, source_dir, fmt, max_files_per_trigger).writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


def apply_stream_once(spark: SparkSession, source_dir: str, state_root: str, checkpoint: str, **kw) -> DataFrame:
    """Run the stream to the end of the available files; return the state."""
    q = run_apply_stream(spark, source_dir, state_root, checkpoint, available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return current_state(spark, state_root)


def read_snapshots(spark: SparkSession, snapshots: str) -> DataFrame:
    """All snapshots of a stream: ``(segment, source_key, row_key, cells, version)``."""
    return spark.read.schema("source_key string, row_key string, cells map<string,string>, version long, segment string").parquet(snapshots)


def states_by_destination(spark: SparkSession, state_root: str, mapping: DataFrame) -> DataFrame:
    """The stream's state with the destination that each source is mapped to."""
    return join_small(current_state(spark, state_root), mapping.select("source_key", "destination"), "source_key", "inner")
