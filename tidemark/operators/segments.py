"""Time segments: segment ids, segment changes, increment tables, snapshots,
and the readiness barrier across cooperating instances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.cells import is_written, written_value
from tidemark.operators import apply as A
from tidemark.operators.ordered import previous_row
from tidemark.schema import IMAGE, STATUS_COLUMN

# Segment formats of the two switch frequencies.
DAILY, HOURLY = "daily", "hourly"
SEGMENT_FORMAT = {DAILY: "yyyyMMdd", HOURLY: "yyyyMMddHH"}


def segment_id(ts: Column | str, granularity: str = DAILY) -> Column:
    """``daily`` -> yyyyMMdd, anything else -> yyyyMMddHH."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, SEGMENT_FORMAT.get(granularity, SEGMENT_FORMAT[HOURLY]))


def segment_counts(changes: DataFrame, granularity: str = DAILY) -> DataFrame:
    """Events per (source, segment, op)."""
    return changes.groupBy("source_key", segment_id("exec_time", granularity).alias("segment"), "op").agg(F.count(F.lit(1)).alias("n_events"))


def segment_changes(changes: DataFrame, granularity: str = DAILY, blocks: int | None = None) -> DataFrame:
    """Events that open a new segment: newer than the previous event of the
    same source (in ``seq`` order) and in another segment.  An out-of-order
    event across a boundary re-opens it, as the previous-event rule implies."""
    prev = previous_row(changes.select("source_key", "seq", "exec_time"), ["source_key"], "seq", ["exec_time"], blocks=blocks)
    seg = segment_id("exec_time", granularity)
    pseg = segment_id("prev_exec_time", granularity)
    return prev.where(
        F.col("prev_exec_time").isNotNull() & (F.col("exec_time") > F.col("prev_exec_time")) & (seg != pseg)
    ).select("source_key", "seq", seg.alias("segment"), pseg.alias("prev_segment"))


def increment_table(changes: DataFrame, granularity: str = DAILY, keys_col: str | None = None, clean: bool = True) -> DataFrame:
    """Per (segment, source_key, row_key): the newest written value of every
    cell among the segment's events (a DELETE writes its non-null
    before-image) and ``final_status``: the mark of the newest INSERT/DELETE,
    else UPDATED (an UPDATE marks only a row not yet in the segment's table).
    """
    return increments_of(increment_records(changes, granularity, keys_col, clean))


def increment_records(changes: DataFrame, granularity: str = DAILY, keys_col: str | None = None, clean: bool = True) -> DataFrame:
    """Newest value per ``(segment, source_key, row_key, name)`` with its ``seq``;
    unions of such records, of parts of a log in any order, are records again."""
    keyed = A.with_row_keys(changes, keys_col).where(F.col("row_key").isNotNull())
    op = F.col("op")
    img = F.when(op == "DELETE", F.coalesce("before", F.array().cast(IMAGE))).otherwise(F.coalesce("after", F.array().cast(IMAGE)))
    cells = F.transform(
        F.filter(img, lambda c: is_written(c, op)),
        lambda c: F.struct(F.lower(c["name"]).alias("name"), written_value(c, clean).alias("value")),
    )
    mark = F.when(op == "INSERT", "INSERTED").when(op == "DELETE", "DELETED")
    items = F.concat(cells, F.array(F.struct(F.lit(STATUS_COLUMN).alias("name"), mark.alias("value"))))
    rows = (
        keyed.where(op.isin("INSERT", "UPDATE", "DELETE"))
        .select(segment_id("exec_time", granularity).alias("segment"), "source_key", "row_key", "seq", F.explode(items).alias("c"))
        .where(F.col("c.value").isNotNull())
        .groupBy("segment", "source_key", "row_key", F.col("c.name").alias("name"))
        .agg(F.max(F.struct("seq", F.col("c.value").alias("value"))).alias("m"))
    )
    return rows.select("segment", "source_key", "row_key", "name", "m.seq", "m.value")


def increments_of(records: DataFrame) -> DataFrame:
    """Increment tables of (unions of) increment records."""
    rows = records.groupBy("segment", "source_key", "row_key", "name").agg(F.max(F.struct("seq", "value")).alias("m"))
    return rows.groupBy("segment", "source_key", "row_key").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("name").alias("key"), F.col("m.value").alias("value")))).alias("cells")
    ).withColumn("cells", F.map_concat(F.map_filter("cells", lambda k, v: k != STATUS_COLUMN),
                                        F.create_map(F.lit(STATUS_COLUMN), F.coalesce(F.col("cells")[STATUS_COLUMN], F.lit("UPDATED")))))


def snapshot_at(changes: DataFrame, boundary: str | Column, **kw) -> DataFrame:
    """State of every table as of ``boundary``: the apply closed form over the
    events strictly before it (exact, whatever arrived later)."""
    b = F.lit(boundary).cast("timestamp_ntz") if isinstance(boundary, str) else boundary
    return A.apply_changes(changes.where(F.col("exec_time") < b), **kw)


def segment_ready(signals: DataFrame, instances: int) -> DataFrame:
    """Barrier over signal rows ``(segment, instance, ready_at)``: a segment is
    ready once at least ``instances`` distinct instances signalled; the first
    to signal is elected (ties: smallest instance name)."""
    first = signals.groupBy("segment", "instance").agg(F.min("ready_at").alias("ready_at"))
    return first.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n_instances"),
        (F.count(F.lit(1)) >= F.lit(instances)).alias("ready"),
        F.max("ready_at").alias("ready_at"),
        F.min(F.struct("ready_at", "instance"))["instance"].alias("elected"),
    )


def reset_signal(signals: DataFrame, segment: str) -> DataFrame:
    """Signals without those of one segment."""
    return signals.where(F.col("segment") != F.lit(segment))
