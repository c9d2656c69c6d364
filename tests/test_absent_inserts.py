"""Insert-if-absent roll-ups see truncations and key changes, in batch and in a stream."""

import uuid

from helpers import cell, to_df

from tidemark.operators import rollup as R
from tidemark.session import scratch_path
from tidemark.streaming.rollup_stream import current_rollup, run_rollup_stream


def _row(op, seq, key=None, old=None):
    def image(k):
        return [cell("id", str(k), key=True), cell("g", "x"), cell("v", "0.9")]

    before = image(old if old is not None else key) if op in ("UPDATE", "DELETE") else None
    after = image(key) if op in ("INSERT", "UPDATE") else None
    return dict(source_key="db.t", database="db", table="t", exec_time=None, op=op, ddl=None, seq=seq, before=before, after=after)


TRUNCATED = [_row("INSERT", 1, 1), _row("TRUNCATE", 2), _row("INSERT", 3, 2), _row("INSERT", 4, 1)]
REKEYED = [_row("INSERT", 1, 1), _row("UPDATE", 2, 2, old=1), _row("INSERT", 3, 1), _row("INSERT", 4, 2)]
DROPPED = [_row("INSERT", 1, 1), _row("ERASE", 2), _row("INSERT", 3, 1), _row("INSERT", 4, 1)]


def _counts(spark, rows):
    df = to_df(spark, rows)
    batch = R.rollup_count_stream(df, ["g"], "d").first()["count"]
    got = [batch, float(R.rollup_sum_stream(df, ["g"], ["v"], "d").first()["v_accumulation"])]
    for width in (1, 2):  # rows a micro-batch
        r = _streamed(spark, [rows[i:i + width] for i in range(0, len(rows), width)]).first()
        got += [r["count"], float(r["v_accumulation"])]
    return got


def _streamed(spark, parts):
    run = scratch_path(spark, f"t-absent-{uuid.uuid4().hex}")
    for part in parts:
        to_df(spark, part).coalesce(1).write.mode("append").parquet(f"{run}/in")
    run_rollup_stream(spark, f"{run}/in", f"{run}/rollup", f"{run}/ckpt", ["g"], ["v"]).awaitTermination()
    return current_rollup(spark, f"{run}/rollup", ["g"], ["v"], "d")


def test_truncate_drop_and_key_change(spark):
    assert _counts(spark, TRUNCATED) == [3, 2.7, 3, 2.7, 3, 2.7]
    assert _counts(spark, REKEYED) == [2, 1.8, 2, 1.8, 2, 1.8]
    assert _counts(spark, DROPPED) == [2, 1.8, 2, 1.8, 2, 1.8]


def test_empty_and_schema_only_logs(spark):
    empty = to_df(spark, [])
    assert R.rollup_count_stream(empty, ["g"], "d").collect() == []
    assert _streamed(spark, [[_row("TRUNCATE", 1)]]).collect() == []
