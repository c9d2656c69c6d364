"""Change records of a stream in plain parquet folders, reduced when read.

The records are those of ``tidemark.operators.apply``: ``(source_key, row_key,
tag, name, seq, value)``, with the time segment of the change they come from.
Their reduction is associative, commutative and idempotent, so a micro-batch
only adds its own reduced records, and a reader reduces all it reads.

* ``<root>/log/run=<run>/batch=<id>``: a batch overwrites what is there, so a
  replay after a failure writes the same records again.  ``run`` stands for the
  stream's checkpoint, so a new checkpoint or a second stream on the same root,
  whose batch ids begin at 0 again, writes folders of its own.
* ``<root>/base/run=<run>/batch=<id>/covered=<s>``: a batch that opens a segment
  also reduces all records of its run in earlier segments, the last base and
  the log since, into a new base.  A reader takes each run's last base and only
  what it does not cover, so reading follows the state and the newest segment,
  not the history.  Late changes stay in the log until the next base.
* ``<root>/opened/run=<run>/batch=<id>``: the segments that a batch opened,
  written last.  Batches are judged by those before them, replays too.
* Records keep the source, row key, column name and ``seq`` they were written
  with; schema events are records too (tag ``event``): columns and sources
  renamed, columns dropped, keys changed, sources stopped.  They are folded when
  the state is read (``schema_apply.fold_events``), with all events known then.
  Records on both sides of an event that touches their column or source are
  reduced apart.  Changes of one source are expected in ``seq`` order across
  batches around its schema events, as a change stream delivers them.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import apply as A
from tidemark.operators import schema_apply as SA
from tidemark.operators.ddl import DDL_OPS
from tidemark.operators.joins import fetched, join_small
from tidemark.operators.segments import DAILY, segment_id
from tidemark.session import ensure_checkpoint_dir

RECORDS = "source_key string, row_key string, tag string, name string, seq long, value string"
_COLUMNS = [c.split()[0] for c in RECORDS.split(", ")]
_LOGGED = f"{RECORDS}, segment string"
NO_SEGMENT = ""  # of changes without a time: before all segments


def run_of(checkpoint: str) -> str:
    """A folder name for the stream with this checkpoint."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()


def start(spark: SparkSession, root: str, run: str) -> None:
    """Make the root readable before the first batch."""
    for part, schema in (("log", _LOGGED), ("base", RECORDS), ("opened", "segment string, based boolean")):
        folder = "/covered=none" if part == "base" else ""
        spark.range(0).selectExpr(*[f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in schema.split(", ")]).write.mode("overwrite").parquet(f"{root}/{part}/run={run}/batch=-1{folder}")


def shuffles_follow(batch: DataFrame, least: int) -> None:
    """Shuffles of this micro-batch get tasks that follow its files, ``least`` at least; the setting is of the session
    that a stream copies for itself."""
    batch.sparkSession.conf.set("spark.sql.shuffle.partitions", A.tasks_for(batch, least))


def reduce_by_epoch(records: DataFrame, events: DataFrame, by: list[str]) -> DataFrame:
    """Records reduced per ``by`` value, those on both sides of an event that touches them apart."""
    columns = SA.column_events_of(events).select("source_key", "name", "seq")
    sources = SA.source_renames(events).select(F.explode(F.array("old", "new")).alias("source_key"), "at.seq")
    sources = sources.union(events.where(F.col("effect").isin("rekey", "stop")).select("source_key", "seq"))
    of_column = columns.groupBy("source_key", "name").agg(F.collect_set("seq").alias("column_times"))
    of_source = sources.groupBy("source_key").agg(F.collect_set("seq").alias("source_times"))

    def before(times: str) -> Column:
        return F.coalesce(F.size(F.filter(times, lambda t: t < F.col("seq"))), F.lit(0))

    placed = join_small(join_small(records, of_column, ["source_key", "name"], "left"), of_source, "source_key", "left")
    placed = placed.withColumn("epoch", F.struct(before("column_times").alias("c"), before("source_times").alias("s")))
    newest = placed.groupBy(*A.REDUCED_SORT, *by, "epoch").agg(F.max(F.struct("seq", "value")).alias("m"))
    return newest.select(*A.REDUCED_KEY, F.col("m.seq").alias("seq"), F.col("m.value").alias("value"), *by)


def _reduced(records: DataFrame, by: list[str]) -> DataFrame:
    newest = records.groupBy(*A.REDUCED_SORT, *by).agg(F.max(F.struct("seq", "value")).alias("m"))
    return newest.select(*A.REDUCED_KEY, F.col("m.seq").alias("seq"), F.col("m.value").alias("value"), *by)


def batch_records(changes: DataFrame, granularity: str = DAILY, **apply_kw) -> DataFrame:
    """The reduced records of one batch with their segment."""
    segment = F.coalesce(segment_id("exec_time", granularity), F.lit(NO_SEGMENT))
    changes = changes.withColumn("segment", segment)
    keyed = A.with_row_keys(changes, apply_kw.get("keys_col"), apply_kw.get("connector", "+"), apply_kw.get("reverse", True))
    contrib = A.contributions(keyed, apply_kw.get("keep_old_key", False), apply_kw.get("clean", True), carry=["segment"])
    schema_changes = changes.where(F.col("op").isin(*DDL_OPS) & F.col("ddl").isNotNull())
    events = fetched(SA.schema_events(schema_changes))
    if events is None:
        ensure_checkpoint_dir(changes.sparkSession)
        events = SA.schema_events(schema_changes).checkpoint()
    if events.isEmpty():
        return _reduced(contrib, ["segment"])
    rows = reduce_by_epoch(contrib, events, ["segment"])
    told = F.to_json(F.struct(*[c for c in SA.EVENT_COLUMNS if c not in ("source_key", "seq")]))
    note = events.select("source_key", F.lit("").alias("row_key"), F.lit("event").alias("tag"), F.lit(None).cast("string").alias("name"), "seq", told.alias("value"))
    times = schema_changes.select("source_key", "seq", "segment").distinct()
    return rows.unionByName(note.join(times, ["source_key", "seq"]))


def write_batch(changes: DataFrame, batch_id: int, root: str, run: str, granularity: str = DAILY, snapshots: str | None = None, **apply_kw) -> None:
    """Records of one batch; a base where it opens a segment; with ``snapshots`` also the state at the
    start of each segment that it opens, as ``<snapshots>/segment=<s>``."""
    spark = changes.sparkSession
    at = f"run={run}/batch={batch_id}"

    batch_records(changes, granularity, **apply_kw).write.mode("overwrite").parquet(f"{root}/log/{at}")
    log = spark.read.schema(_LOGGED).parquet(f"{root}/log/{at}").where(F.col("segment") != NO_SEGMENT)
    here = {r["segment"] for r in log.select("segment").distinct().collect()}  # days or hours
    earlier = _opened(spark, root).where((F.col("run") == run) & (F.col("batch") < batch_id))
    last, base = earlier.agg(F.max("segment"), F.max(F.when(F.col("based"), F.struct("batch", "segment")))).first()
    opened = sorted(s for s in here if last is None or s > last)
    based = opened if last is not None else opened[1:]  # nothing is older than a run's first segment
    based = based if snapshots else based[-1:]
    key = {k: apply_kw[k] for k in ("connector", "reverse") if k in apply_kw}
    for s in based:
        records = _all(spark, root, [] if base is None else [(run, *base)], run, batch_id, s)
        events = records.where("tag = 'event'")
        events = None if events.isEmpty() else events
        rows = _reduced(A.dealt(records), []) if events is None else reduce_by_epoch(A.dealt(records.where("tag <> 'event'")), _events(events), []).unionByName(events.distinct())
        rows.write.mode("overwrite").parquet(f"{root}/base/{at}/covered={s}")
        base = (batch_id, s)
        if snapshots:
            _state(spark.read.schema(RECORDS).parquet(f"{root}/base/{at}/covered={s}"), **key, reduced=events is None).write.mode("overwrite").parquet(f"{snapshots}/segment={s}")
    if opened:
        noted = pa.table({"segment": opened, "based": [s in based for s in opened]})
        spark.createDataFrame(noted).coalesce(1).write.mode("overwrite").parquet(f"{root}/opened/{at}")


def _log(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(f"{_LOGGED}, run string, batch long").parquet(f"{root}/log")


def _opened(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("segment string, based boolean, run string, batch long").parquet(f"{root}/opened")


def _all(spark: SparkSession, root: str, bases: list[tuple[str, int, str]], run: str | None = None, last_batch: int = 0, before: str = "") -> DataFrame:
    """Bases ``(run, batch, segment)`` and the batches that they do not cover; of one run, the records of its
    batches up to ``last_batch`` in segments before ``before`` only."""
    log = _log(spark, root)
    base = spark.read.schema(f"{RECORDS}, run string, batch long, covered string").parquet(f"{root}/base")
    if run is not None:
        log = log.where((F.col("run") == run) & (F.col("batch") <= last_batch) & (F.col("segment") < before))
    chosen = F.lit(False)
    for of, batch, segment in bases:
        log = log.where((F.col("run") != of) | (F.col("batch") > batch) | ((F.col("batch") == batch) & (F.col("segment") >= segment)))
        chosen = chosen | ((F.col("run") == of) & (F.col("batch") == batch) & (F.col("covered") == segment))
    return log.select(*_COLUMNS).unionByName(base.where(chosen).select(*_COLUMNS))


def _events(records: DataFrame) -> DataFrame:
    told = records.select("source_key", "seq", F.from_json("value", SA.EVENT).alias("e"))
    return told.select("source_key", "seq", "e.*").distinct()


def _state(records: DataFrame, connector: str = "+", reverse: bool = True, reduced: bool = False) -> DataFrame:
    """``reduced``: no events are among the records, and no two of them are of one key."""
    if reduced:
        return A.materialize(A.dealt(records), A.wipes_of(records))
    events = _events(records.where("tag = 'event'"))
    wipes = records.where("tag = 'wipe'").select("source_key", "seq")
    return SA.fold_events(A.dealt(records.where("tag <> 'event'")), events, wipes, connector, reverse)


def read_records(spark: SparkSession, root: str) -> DataFrame:
    """Records whose reduction is the state: each run's last base and what it does not cover."""
    last = _opened(spark, root).where("based").groupBy("run").agg(F.max(F.struct("batch", "segment")).alias("m"))
    return _all(spark, root, [(r["run"], *r["m"]) for r in last.collect()])  # a row for each run


def current_state(spark: SparkSession, root: str, connector: str = "+", reverse: bool = True) -> DataFrame:
    """Materialized state ``(source_key, row_key, cells, version)``, schema events folded in."""
    return _state(read_records(spark, root), connector, reverse)
