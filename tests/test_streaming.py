"""The streaming apply equals the batch apply for any file split, replay or order."""

import uuid

import pytest
from helpers import fold_schema_log, random_log, schema_log, state_as_dict, to_df

from tidemark.operators import apply as A
from tidemark.session import scratch_path
from tidemark.streaming.apply_stream import apply_stream_once
from tidemark.streaming.records import current_state, start, write_batch


@pytest.mark.parametrize("files,per_trigger", [(1, 1), (10, 3)])
def test_stream_equals_batch(spark, files, per_trigger):
    rows = random_log(500, 30, 5, sources=("db.t", "db.u"))
    df = to_df(spark, rows)
    run = scratch_path(spark, f"t-stream-{uuid.uuid4().hex}")
    df.repartition(files).write.parquet(f"{run}/in")
    got = apply_stream_once(spark, f"{run}/in", f"{run}/state", f"{run}/ckpt", max_files_per_trigger=per_trigger)
    assert state_as_dict(got) == state_as_dict(A.apply_changes(df))


def _state(spark, name):
    root = scratch_path(spark, f"t-{name}-{uuid.uuid4().hex}")
    start(spark, root, "r")
    return root


def test_replayed_and_reordered_batches(spark):
    rows = random_log(400, 20, 9)
    df = to_df(spark, rows)
    root = _state(spark, "state")
    parts = [to_df(spark, rows[i::3]) for i in range(3)]
    for i, part in ((0, 2), (1, 0), (1, 0), (2, 1), (3, 1)):  # a replay, and the same data under a new id
        write_batch(parts[part], i, root, "r")
    assert state_as_dict(current_state(spark, root)) == state_as_dict(A.apply_changes(df))


def test_a_second_stream_adds_to_the_same_state(spark):
    rows = random_log(300, 20, 21)
    run = scratch_path(spark, f"t-two-{uuid.uuid4().hex}")
    for i in range(2):  # batch ids begin at 0 in both
        to_df(spark, rows[i::2]).write.parquet(f"{run}/in{i}")
        got = apply_stream_once(spark, f"{run}/in{i}", f"{run}/state", f"{run}/ckpt{i}")
    assert state_as_dict(got) == state_as_dict(A.apply_changes(to_df(spark, rows)))


def test_column_names_that_are_used_again(spark):
    from helpers import cell

    def row(seq, **values):
        return dict(source_key="db.t", database="db", table="t", exec_time=None, op="INSERT" if values else "ALTER", ddl=None, seq=seq, before=None,
                    after=[cell("id", "1", key=True), *(cell(k, v) for k, v in values.items())] if values else None)

    def ddl(seq, text):
        return {**row(seq), "ddl": f"alter table t {text}"}

    cases = [
        ([row(1, a="x", b="y"), ddl(2, "drop column b"), ddl(3, "change a b int")], {"b": "x"}),
        ([row(1, a="x", b="y"), ddl(2, "change a c int"), ddl(3, "change b a int"), ddl(4, "change c b int")], {"a": "y", "b": "x"}),
        ([row(1, a="x"), ddl(2, "change a b int"), row(3, a="new"), ddl(4, "drop column b")], {"a": "new"}),
    ]
    for rows, want in cases:
        for width in (1, 9):
            root = _state(spark, "names")
            for i in range(0, len(rows), width):
                write_batch(to_df(spark, rows[i:i + width]), i, root, "r")
            (got,) = current_state(spark, root).collect()
            assert got.cells == {"id": "1", **want}


def test_stream_routes_through_mapping_reread_per_batch(spark):
    from tidemark.streaming.apply_stream import run_apply_stream

    rows = random_log(300, 20, 13, sources=("db.t", "db.u"))
    df = to_df(spark, rows)
    run = scratch_path(spark, f"t-route-{uuid.uuid4().hex}")
    df.repartition(4).write.parquet(f"{run}/in")
    mapping = spark.createDataFrame([("db.t", "dest_t", ["id"])], "source_key string, destination string, keys array<string>")
    mapping.write.parquet(f"{run}/mapping")
    q = run_apply_stream(spark, f"{run}/in", f"{run}/state", f"{run}/ckpt", max_files_per_trigger=2, mapping_path=f"{run}/mapping")
    q.awaitTermination()
    got = state_as_dict(current_state(spark, f"{run}/state"))
    assert got == state_as_dict(A.apply_changes(df.where("source_key = 'db.t'")))
    assert all(k[0] == "db.t" for k in got)


def test_watermark_closes_segments_and_drops_late_events(spark):
    import datetime

    from tidemark.streaming.apply_stream import change_stream
    from tidemark.streaming.segments_stream import late_events, run_closed_segment_counts

    def rows(day, hour, n, seq0):
        out = random_log(n, 5, seq0)
        for i, r in enumerate(out):
            r["op"] = "INSERT" if r["op"] not in ("INSERT", "UPDATE", "DELETE") else r["op"]
            r["after"] = r["after"] or r["before"]
            r["exec_time"] = datetime.datetime(2024, 1, day, hour) + datetime.timedelta(seconds=i)
            r["seq"] = seq0 * 100000 + i
        return out

    run = scratch_path(spark, f"t-wm-{uuid.uuid4().hex}")
    on_time = rows(2, 12, 30, 1)
    later = rows(5, 12, 10, 2)
    later2 = rows(5, 13, 5, 4)
    # Day 2 again, arriving after a micro-batch whose watermark (day 5, 11:00)
    # already closed day 2's window: Spark drops these rows as late.
    late = rows(2, 8, 7, 3)
    for part in (on_time, later, later2, late):
        to_df(spark, part).coalesce(1).write.mode("append").parquet(f"{run}/in")
    q = run_closed_segment_counts(change_stream(spark, f"{run}/in", max_files_per_trigger=1), f"{run}/out", f"{run}/ckpt")
    q.awaitTermination()
    got = spark.read.parquet(f"{run}/out")
    day2 = sum(r.n_events for r in got.where("segment = '20240102'").collect())
    assert day2 == len(on_time)  # the late day-2 events were dropped, the segment emitted once
    assert late_events(q) > 0  # and counted
    assert got.where("segment = '20240105'").count() == 0  # still open: watermark not past its end


def _rollup_rows():
    rows = sorted(random_log(300, 12, 41), key=lambda r: r["seq"])
    assert any(r["op"] == "TRUNCATE" for r in rows)
    for r in rows:
        for c in r["after"] or r["before"] or []:
            if c["name"] == "c":
                c.update(value=str(len(c["value"] or "")) if not c["is_null"] else None)
    return rows


def test_rollup_stream_equals_batch_rollups_over_restarts(spark):
    from tidemark.operators import rollup as R
    from tidemark.streaming.rollup_stream import current_rollup, run_rollup_stream

    rows = _rollup_rows()
    run = scratch_path(spark, f"t-rollup-{uuid.uuid4().hex}")
    for part in (rows[:100], rows[100:200], rows[200:]):  # the stream ends after each part and starts again
        to_df(spark, part).coalesce(1).write.mode("append").parquet(f"{run}/in")
        run_rollup_stream(spark, f"{run}/in", f"{run}/rollup", f"{run}/ckpt", ["a"], ["c"]).awaitTermination()
    df = to_df(spark, rows)
    got = {(r["a"], r["count"], r["c_accumulation"]) for r in current_rollup(spark, f"{run}/rollup", ["a"], ["c"], "d").collect()}
    sums = {r["a"]: r["c_accumulation"] for r in R.rollup_sum_stream(df, ["a"], ["c"], "d").collect()}
    counts = {r["a"]: r["count"] for r in R.rollup_count_stream(df, ["a"], "d").collect()}
    assert got == {(a, counts[a], sums[a]) for a in counts}


def test_rollup_stream_looks_up_its_own_keys_only(spark):
    """The rows that a batch's stateful operator touches follow the batch, not what came before."""
    from helpers import cell

    from tidemark.streaming.rollup_stream import current_rollup, run_rollup_stream

    def insert(seq, key):
        return dict(source_key="db.t", database="db", table="t", exec_time=None, op="INSERT", ddl=None, seq=seq, before=None, after=[cell("id", str(key), key=True), cell("g", "x")])

    run = scratch_path(spark, f"t-lookup-{uuid.uuid4().hex}")
    for batch in range(6):  # 40 new keys and 10 that the batch before brought
        first = batch * 40
        part = [insert(batch * 1000 + i, k) for i, k in enumerate([*range(first, first + 40), *range(max(0, first - 10), first)])]
        to_df(spark, part).coalesce(1).write.mode("append").parquet(f"{run}/in")
    loaded = spark.createDataFrame([("db.t", "0+db.t"), ("db.t", "1+db.t"), ("db.u", "2+db.u")], "source_key string, row_key string")
    q = run_rollup_stream(spark, f"{run}/in", f"{run}/rollup", f"{run}/ckpt", ["g"], [], loaded=loaded)
    q.awaitTermination()
    touched = [o["numRowsUpdated"] for p in q.recentProgress for o in p["stateOperators"] if p["numInputRows"]]
    assert touched == [40] + [50] * 5
    assert [r["count"] for r in current_rollup(spark, f"{run}/rollup", ["g"], [], "d").collect()] == [238]  # two were loaded before


def _timed(rows, per_day):
    import datetime

    for i, r in enumerate(sorted(rows, key=lambda r: r["seq"])):
        r["exec_time"] = datetime.datetime(2024, 1, 1) + datetime.timedelta(days=i // per_day, minutes=i % per_day)
    return sorted(rows, key=lambda r: r["seq"])


def test_snapshots_of_crossed_days_equal_snapshot_at(spark):
    from tidemark.operators.segments import snapshot_at
    from tidemark.streaming.apply_stream import read_snapshots

    rows = _timed(random_log(240, 15, 3), 40)  # six days
    del rows[80:120]  # the third has no changes
    root, snaps = _state(spark, "snap"), scratch_path(spark, f"t-snaps-{uuid.uuid4().hex}")
    for i, part in enumerate((rows[:30], rows[30:90], rows[90:95], rows[95:])):
        for _ in range(2):  # every batch is replayed
            write_batch(to_df(spark, part), i, root, "r", snapshots=snaps)
    got: dict = {}
    for r in read_snapshots(spark, snaps).collect():
        got.setdefault(r.segment, {})[(r.source_key, r.row_key)] = dict(r.cells)
    days = ["20240102", "20240104", "20240105", "20240106"]
    assert set(got) <= set(days) and len(got) > 1
    for day in days:
        assert got.get(day, {}) == state_as_dict(snapshot_at(to_df(spark, rows), f"{day[:4]}-{day[4:6]}-{day[6:]} 00:00:00")), day
    assert state_as_dict(current_state(spark, root)) == state_as_dict(A.apply_changes(to_df(spark, rows)))


def test_a_base_takes_the_place_of_older_batches(spark):
    rows = _timed(random_log(200, 10, 11), 40)  # five days, one a batch
    late = dict(rows[0], seq=10**9, op="DELETE", before=rows[0]["after"] or rows[0]["before"], after=None, ddl=None)
    root = _state(spark, "base")
    sizes = []
    for i in range(5):
        write_batch(to_df(spark, rows[i * 40:(i + 1) * 40]), i, root, "r")
        sizes.append(len([f for f in _records_read(spark, root) if "/log/" in f and "batch=-1" not in f]))
    assert max(sizes) <= sizes[1] + 8  # files of the newest batch only, whatever came before
    write_batch(to_df(spark, [late]), 5, root, "r")  # of the first day
    assert state_as_dict(current_state(spark, root)) == state_as_dict(A.apply_changes(to_df(spark, [*rows, late])))


def _records_read(spark, root):
    from pyspark.sql import functions as F

    from tidemark.streaming.records import read_records

    return {r[0] for r in read_records(spark, root).select(F.input_file_name()).distinct().collect()}


def test_barrier_waits_for_the_slowest_input(spark):
    import datetime

    from tidemark.streaming.apply_stream import change_stream
    from tidemark.streaming.segments_stream import closed_segments, run_barrier

    def rows(day, n, seq0):
        out = random_log(n, 5, seq0)
        for i, r in enumerate(out):
            r["exec_time"] = datetime.datetime(2024, 1, day, 12) + datetime.timedelta(seconds=i)
        return out

    run = scratch_path(spark, f"t-barrier-{uuid.uuid4().hex}")
    for i, days in enumerate(([1, 4, 6], [1, 2, 6])):
        for d in days:
            to_df(spark, rows(d, 10 + i, d + 10 * i)).coalesce(1).write.mode("append").parquet(f"{run}/in{i}")
    streams = [change_stream(spark, f"{run}/in{i}") for i in range(2)]
    run_barrier(streams, f"{run}/out", f"{run}/ckpt").awaitTermination()
    got = {r.segment: (r.n_inputs, r.n_events, r.elected, r.closed_in) for r in closed_segments(spark, f"{run}/out").collect()}
    # day 4 is long over for the first input when the second is still at day 2
    assert got == {"20240101": (2, 21, 0, 2), "20240102": (1, 11, 1, 3), "20240104": (1, 10, 0, 3)}


def test_stream_folds_renames_keys_and_stops_like_the_batch(spark):
    import random as _random

    from tidemark.operators.schema_apply import apply_log

    r = _random.Random(12)
    for case, widths in enumerate(((1 << 30, 25), (40,))):
        rows = schema_log(r)
        want = state_as_dict(apply_log(to_df(spark, rows)))
        assert want == fold_schema_log(rows)
        for width in widths:
            root = _state(spark, "schema")
            for i in range(0, len(rows), width):
                write_batch(to_df(spark, rows[i:i + width]), i, root, "r")
            assert state_as_dict(current_state(spark, root)) == want, (case, width)


def test_stream_folds_column_events_like_the_batch_apply(spark):
    import random as _random

    from helpers import cell

    from tidemark.operators.schema_apply import apply_with_schema

    rnd = _random.Random(8)
    rows, seq = [], 0
    for step in range(90):
        seq += 10
        k = rnd.randrange(6)
        op = rnd.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"])
        img = [cell("id", str(k), key=True), cell("a", f"a{step}"), cell("p", f"p{step}")]
        before, after = (img, None) if op == "DELETE" else (None, img)
        rows.append(dict(source_key="db.t", database="db", table="t", exec_time=None, op=op, ddl=None, seq=seq, before=before, after=after))
    for s, text in [(305, "alter table t change a b int"), (605, "alter table t change b c int"), (805, "alter table t drop column p")]:
        rows.append(dict(source_key="db.t", database="db", table="t", exec_time=None, op="ALTER", ddl=text, seq=s, before=None, after=None))
    rows.sort(key=lambda r: r["seq"])
    root = scratch_path(spark, f"t-colstream-{uuid.uuid4().hex}")
    chunks = [rows[i:i + 25] for i in range(0, len(rows), 25)]
    start(spark, root, "r")
    for i, part in enumerate(chunks):
        write_batch(to_df(spark, part), i, root, "r")
    assert state_as_dict(current_state(spark, root)) == state_as_dict(apply_with_schema(to_df(spark, rows)))
