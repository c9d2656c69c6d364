"""Monitoring as data: batch metrics, progress, idle and lag alerts.

A stream is seen as a sequence of fixed-interval batches.  Per batch the
number of changes and the newest ``exec_time`` are aggregated from the change
log (distributed); empty batches are idle.  Running state over the batch
sequence (last exec time, last busy batch) uses ``running_max``, so no single
task ever holds the whole sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ordered import previous_row, running_max

DAY_OF_MINUTES = 1440


def idle_gaps(changes: DataFrame, seconds: int) -> DataFrame:
    """Where a source was silent for at least ``seconds``: each event, in ``seq``
    order, that comes so long after the one before it.  No grid of batches is
    made, so a far-off time stamp costs nothing."""
    prev = previous_row(changes.select("source_key", "seq", "exec_time"), ["source_key"], "seq", ["exec_time"])
    gap = F.timestamp_diff("SECOND", F.col("prev_exec_time"), F.col("exec_time"))
    return prev.withColumn("idle_seconds", gap).where(F.col("idle_seconds") >= seconds).select("source_key", "seq", F.col("prev_exec_time").alias("idle_since"), "exec_time", "idle_seconds")


def batch_metrics(spark: SparkSession, changes: DataFrame, interval_seconds: int = 60, block_size: int = DAY_OF_MINUTES) -> DataFrame:
    """``(batch_id, batch_start, batch_end, n_rows, last_ts, last_exec_time, last_busy)``
    over the grid of batches spanning the log (empty batches included)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    secs = F.timestamp_diff("SECOND", epoch, F.col("exec_time"))  # NTZ arithmetic: no session time zone involved
    bounds = changes.agg(F.min(secs).alias("lo"), F.max(secs).alias("hi")).first()
    if bounds is None or bounds["lo"] is None:
        return spark.createDataFrame([], "batch_id long, batch_start timestamp_ntz, batch_end timestamp_ntz, n_rows long, "
                                         "last_ts timestamp_ntz, last_exec_time timestamp_ntz, last_busy long")
    t0 = (bounds["lo"] // interval_seconds) * interval_seconds
    n = (bounds["hi"] - t0) // interval_seconds + 1
    per = changes.groupBy(F.floor((secs - F.lit(t0)) / F.lit(interval_seconds)).alias("batch_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("exec_time").alias("last_ts")
    )
    grid = spark.range(0, n).withColumnRenamed("id", "batch_id")
    g = grid.join(per, "batch_id", "left").select(
        "batch_id",
        F.timestamp_add("SECOND", F.lit(t0) + F.col("batch_id") * interval_seconds, epoch).alias("batch_start"),
        F.timestamp_add("SECOND", F.lit(t0) + (F.col("batch_id") + 1) * interval_seconds, epoch).alias("batch_end"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        "last_ts",
        F.when(F.col("n_rows") > 0, F.col("batch_id")).alias("busy_id"),
    )
    r = running_max(g, "batch_id", ["last_ts", "busy_id"], block_size)
    return r.select(
        "batch_id", "batch_start", "batch_end", "n_rows", "last_ts",
        F.col("run_last_ts").alias("last_exec_time"), F.col("run_busy_id").alias("last_busy"),
    )


def metrics_of_batches(rows: DataFrame, block_size: int = DAY_OF_MINUTES) -> DataFrame:
    """The metrics frame from rows ``(batch_id, batch_end, n_rows, last_ts)`` that a running stream wrote, one a
    micro-batch (``streaming.metrics``)."""
    g = rows.select("batch_id", F.lit(None).cast("timestamp_ntz").alias("batch_start"), "batch_end", "n_rows", "last_ts",
                    F.when(F.col("n_rows") > 0, F.col("batch_id")).alias("busy_id"))
    r = running_max(g, "batch_id", ["last_ts", "busy_id"], block_size)
    return r.select("batch_id", "batch_start", "batch_end", "n_rows", "last_ts",
                    F.col("run_last_ts").alias("last_exec_time"), F.col("run_busy_id").alias("last_busy"))


def with_sleeping(metrics: DataFrame, idle_threshold: int) -> DataFrame:
    """Add ``idle_pos`` (position inside the current run of empty batches) and
    ``sleeping_batches``: the idle counter after the batch; it counts empty
    batches, and is reset by a busy batch or by an idle alert, which fires
    when it exceeds ``idle_threshold`` (positions k * (threshold + 1))."""
    pos = F.when(F.col("n_rows") > 0, F.lit(0)).otherwise(F.col("batch_id") - F.coalesce(F.col("last_busy"), F.lit(-1)))
    return metrics.withColumn("idle_pos", pos).withColumn("sleeping_batches", F.col("idle_pos") % F.lit(idle_threshold + 1))


def progress(metrics: DataFrame, idle_threshold: int) -> DataFrame:
    """Heartbeat rows: last exec time seen and the idle counter per batch."""
    return with_sleeping(metrics, idle_threshold).select("batch_id", "n_rows", "last_exec_time", "sleeping_batches")


def idle_alerts(metrics: DataFrame, idle_threshold: int) -> DataFrame:
    """Batches where more than ``idle_threshold`` consecutive empty batches were seen."""
    s = with_sleeping(metrics, idle_threshold)
    return s.where((F.col("idle_pos") > 0) & (F.col("sleeping_batches") == 0)).select("batch_id", "batch_start", "idle_pos")


def lag_alerts(metrics: DataFrame, idle_threshold: int, threshold_seconds: int, check_every: int, ignored_hours: list[int]) -> DataFrame:
    """Lag checks every ``check_every`` batches at the batch end: delay = check
    time - last exec time.  A delay >= threshold while not idle is reported;
    ``alert`` is false inside the ignored hours (logged, not sent)."""
    s = with_sleeping(metrics, idle_threshold).where((F.col("batch_id") + 1) % F.lit(check_every) == 0)
    delay_us = F.timestamp_diff("MICROSECOND", F.col("last_exec_time"), F.col("batch_end"))
    hour = F.hour("batch_end")
    return s.where((delay_us >= F.lit(threshold_seconds * 1_000_000)) & (F.col("sleeping_batches") == 0)).select(
        "batch_id", F.col("batch_end").alias("check_time"), F.floor(delay_us / F.lit(1_000_000)).alias("delay_seconds"),
        hour.cast("long").alias("hour"), (~hour.isin(*ignored_hours)).alias("alert"),
    )
