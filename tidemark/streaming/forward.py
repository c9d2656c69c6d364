"""Forwarding sink: change entries as JSON, one topic per destination."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.mapping import forward_filter


def forward_json(changes: DataFrame, mapping: DataFrame, now: str, instance: str) -> DataFrame:
    """``(topic, source_key, seq, value)``: every change newer than its
    source's registration time (``now`` for an unmapped source) serialized
    as one JSON object, on the topic named after the instance."""
    f = forward_filter(changes, mapping, now)
    payload = F.to_json(F.struct("database", "table", F.col("exec_time").cast("string").alias("exec_time"), "op", "ddl", "seq", "before", "after"))
    return f.select(F.lit(instance).alias("topic"), "source_key", "seq", payload.alias("value"))


def write_forward_stream(stream: DataFrame, mapping_path: str, instance: str, path: str, checkpoint: str,
                         clock: Callable[[int], str] | None = None, available_now: bool = True):
    """Streaming form: JSON lines of each micro-batch in ``<path>/batch=<id>/topic=<instance>`` (a Kafka sink takes
    the same ``(topic, value)`` frame when its connector is on the class path).

    The mapping is read anew for every micro-batch, and an unmapped source is taken to be registered at the time of
    the look-up: the wall clock, or what ``clock`` gives for the batch id (a replay then forwards the same again).
    """
    now_of = clock or (lambda _: datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f"))

    def forward(batch: DataFrame, batch_id: int) -> None:
        mapping = batch.sparkSession.read.parquet(mapping_path)
        out = forward_json(batch, mapping, now_of(batch_id), instance).select("topic", "value")
        out.write.mode("overwrite").partitionBy("topic").json(f"{path}/batch={batch_id}")

    w = stream.writeStream.foreachBatch(forward).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")).start()


def read_forwarded(spark: SparkSession, path: str) -> DataFrame:
    """``(value, batch, topic)`` of everything that a stream forwarded."""
    return spark.read.schema("value string, batch long, topic string").json(path)
