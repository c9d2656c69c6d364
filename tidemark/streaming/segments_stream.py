"""Segment close by watermark: the streaming form of time segments.

In a stream, a segment (day or hour) is closed once the event-time
watermark passes its end: no cooperating instance has to signal, and events
later than the allowed lateness are dropped instead of re-opening an old
segment.  Counts per closed segment are a windowed aggregation in append
mode, so each segment is emitted exactly once, when it closes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.segments import DAILY, increment_records, increments_of, segment_id
from tidemark.streaming.records import run_of

_EPOCH = "1970-01-01 00:00:00"


def event_time(ntz: str) -> F.Column:
    """Watermarks need TIMESTAMP; take the NTZ wall clock as UTC through epoch
    microseconds, so windows align to NTZ midnights in any session zone."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), F.col(ntz)))


def closed_segment_counts(stream: DataFrame, lateness: str = "1 hour", granularity: str = DAILY) -> DataFrame:
    """``(source_key, segment, op, n_events)`` per segment, emitted when the
    watermark (max event time seen - ``lateness``) passes the segment end."""
    width = "1 day" if granularity == DAILY else "1 hour"
    agg = (
        stream.withColumn("_event_time", event_time("exec_time"))
        .withWatermark("_event_time", lateness)
        .groupBy("source_key", F.window("_event_time", width).alias("win"), "op")
        .agg(F.count(F.lit(1)).alias("n_events"))
    )
    start_ntz = F.timestamp_add("MICROSECOND", F.unix_micros(F.col("win.start")), F.lit(_EPOCH).cast("timestamp_ntz"))
    return agg.select("source_key", segment_id(start_ntz, granularity).alias("segment"), "op", "n_events")


def run_closed_segment_counts(stream: DataFrame, path: str, checkpoint: str, lateness: str = "1 hour",
                              granularity: str = DAILY, available_now: bool = True):
    """Write closed segments as parquet (append: one write per closed segment)."""
    w = (closed_segment_counts(stream, lateness, granularity).writeStream.outputMode("append").format("parquet")
         .option("path", path).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def late_events(query) -> int:
    """Rows that the watermark has kept out so far, from the query's progress
    reports (Spark keeps the latest of them)."""
    return sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])


def barrier_counts(streams: list[DataFrame], lateness: str = "1 hour", granularity: str = DAILY) -> DataFrame:
    """``(segment, n_inputs, n_events, elected)`` over several live inputs, emitted when the slowest input's
    watermark passes the segment's end.

    Each input has a watermark of its own; united, the smallest of them holds (Spark's default policy for several
    watermarks, ``spark.sql.streaming.multipleWatermarkPolicy`` = min), so a segment is ready once every input
    has moved on.  ``elected`` is the input whose first event in the segment comes first (ties: the smallest).
    """
    width = "1 day" if granularity == DAILY else "1 hour"
    united = None
    for i, stream in enumerate(streams):
        one = stream.select(event_time("exec_time").alias("_event_time"), F.lit(i).alias("input")).withWatermark("_event_time", lateness)
        united = one if united is None else united.unionByName(one)
    agg = united.groupBy(F.window("_event_time", width).alias("win")).agg(
        F.approx_count_distinct("input").alias("n_inputs"), F.count(F.lit(1)).alias("n_events"), F.min(F.struct("_event_time", "input"))["input"].alias("elected"))
    start_ntz = F.timestamp_add("MICROSECOND", F.unix_micros(F.col("win.start")), F.lit(_EPOCH).cast("timestamp_ntz"))
    return agg.select(segment_id(start_ntz, granularity).alias("segment"), "n_inputs", "n_events", "elected")


_CLOSED = "segment string, n_inputs long, n_events long, elected int"


def run_barrier(streams: list[DataFrame], path: str, checkpoint: str, lateness: str = "1 hour", granularity: str = DAILY, available_now: bool = True):
    """Write the segments that each micro-batch closes to ``<path>/closed_in=<batch>``; a replay overwrites its own."""
    spark = streams[0].sparkSession
    if spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy", "min") != "min":
        raise ValueError("a barrier needs spark.sql.streaming.multipleWatermarkPolicy = min")
    spark.createDataFrame([], _CLOSED).write.mode("overwrite").parquet(f"{path}/closed_in=-1")

    def close(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/closed_in={batch_id}")

    w = barrier_counts(streams, lateness, granularity).writeStream.outputMode("append").foreachBatch(close).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()


def closed_segments(spark: SparkSession, path: str) -> DataFrame:
    """Closed segments with the micro-batch that closed them."""
    return spark.read.schema(f"{_CLOSED}, closed_in long").parquet(path)


_INCREMENTS = "segment string, source_key string, row_key string, name string, seq long, value string"


def run_increment_stream(stream: DataFrame, root: str, checkpoint: str, granularity: str = DAILY, available_now: bool = True, **kw):
    """Keep the increment tables of a stream: each micro-batch writes its own
    increment records, a replay the same ones again (see ``records``)."""
    spark, run = stream.sparkSession, run_of(checkpoint)
    spark.createDataFrame([], _INCREMENTS).write.mode("overwrite").parquet(f"{root}/run={run}/batch=-1")

    def fold(batch: DataFrame, batch_id: int) -> None:
        increment_records(batch, granularity, **kw).write.mode("overwrite").parquet(f"{root}/run={run}/batch={batch_id}")

    w = stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def current_increments(spark: SparkSession, root: str) -> DataFrame:
    """Increment tables as of now, open segments included."""
    return increments_of(spark.read.schema(_INCREMENTS).option("recursiveFileLookup", "true").parquet(root))
