"""Partitioned writes replace only their own segment."""

import uuid

from helpers import random_log, state_as_dict, to_df
from pyspark.sql import functions as F

from tidemark.operators import apply as A
from tidemark.operators import segments as SG
from tidemark.session import scratch_path
from tidemark.sinks import write_increments, write_segment_snapshot, write_state


def _log(spark):
    import datetime

    rows = random_log(300, 12, 31)
    for r in rows:
        r["exec_time"] = datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=r["seq"] % 96)
    return to_df(spark, rows)


def test_increments_written_per_segment_and_rewritten_in_place(spark):
    df = _log(spark)
    path = scratch_path(spark, f"t-inc-{uuid.uuid4().hex}")
    write_increments(df, path)
    write_increments(df.where(F.date_format("exec_time", "yyyyMMdd") == "20240102"), path)  # re-run one day
    back = spark.read.parquet(path)
    exp = SG.increment_table(df)
    assert back.count() == exp.count()
    assert sorted(str(r[0]) for r in back.select("segment").distinct().collect()) == sorted(r[0] for r in exp.select("segment").distinct().collect())


def test_snapshot_and_state_writes(spark):
    df = _log(spark)
    snap_path = scratch_path(spark, f"t-snap-{uuid.uuid4().hex}")
    write_segment_snapshot(df, "20240103", snap_path)
    write_segment_snapshot(df, "20240103", snap_path)  # idempotent
    back = spark.read.parquet(snap_path).where("segment = 20240103").drop("segment")
    exp = SG.snapshot_at(df, "2024-01-03 00:00:00")
    assert state_as_dict(back) == state_as_dict(exp)
    state_path = scratch_path(spark, f"t-state-{uuid.uuid4().hex}")
    write_state(A.apply_changes(df), state_path)
    assert state_as_dict(spark.read.parquet(state_path)) == state_as_dict(A.apply_changes(df))
