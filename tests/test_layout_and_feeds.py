"""Range layout and pages, as-of routing, versions, decoded feeds, forwarding with the clock, metrics of a real stream."""

import datetime
import json
import random
import uuid

import pytest
from helpers import cell, random_log, state_as_dict, to_df
from pyspark.sql import functions as F

from tidemark.operators import apply as A
from tidemark.operators import audit as AU
from tidemark.operators import load as L
from tidemark.operators import mapping as M
from tidemark.operators import monitor as MON
from tidemark.session import scratch_path


def _run(spark, name):
    return scratch_path(spark, f"t-{name}-{uuid.uuid4().hex}")


def test_a_key_is_looked_up_in_one_sorted_region(spark):
    path = _run(spark, "ranges")
    state = spark.range(2000).select(F.lit("s.t").alias("source_key"), F.sha1(F.col("id").cast("string")).alias("row_key"), "id")
    L.write_ranges(state, path, 7)
    splits = sorted(L.range_splits(spark, path).collect(), key=lambda r: r.start_key)
    assert 5 <= len(splits) <= 7 and sum(r.n_rows for r in splits) == 2000
    assert all(a.end_key < b.start_key for a, b in zip(splits, splits[1:], strict=False))
    for r in splits:  # sorted inside
        keys = [x.row_key for x in L.read_ranges(spark, path).where(F.col("region") == r.region).select("row_key").collect()]
        assert keys == sorted(keys) and (keys[0], keys[-1]) == (r.start_key, r.end_key)
    found = L.look_up(spark, path, splits[3].start_key)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 1 and f"(region#" in plan.split("PartitionFilters:")[1].split("]")[0] and "EqualTo(row_key" in plan
    assert L.look_up(spark, path, "~").count() == 0


def test_pages_are_balanced_and_pushed_down(spark):
    path = _run(spark, "pages")
    spark.range(4000).select(F.when(F.col("id") % 50 != 0, F.col("id") * F.col("id") - 1000).alias("k")).write.parquet(path)
    df = spark.read.parquet(path)
    pages = L.read_pages(df, "k", 8)
    sizes = {r.page: r["count"] for r in pages.groupBy("page").count().collect()}
    assert sum(sizes.values()) == 4000 and sizes.pop(max(sizes)) == 80 and max(sizes.values()) <= 2 * min(sizes.values())
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(k") >= 7 and plan.count("LessThan(k") >= 7
    for values in ([], [5], [None]):
        few = spark.createDataFrame([(v,) for v in values], "k long")
        assert sorted((r.k for r in L.read_pages(few, "k", 4).collect()), key=str) == values


def test_changes_take_the_mapping_of_their_time(spark):
    r = random.Random(3)
    day = lambda n: datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=n)
    sources = ["s.a", "s.b", "s.c", "s.d"]
    log, live, held = [], {}, {s: [] for s in sources}
    for n in range(1, 25):
        op, s, t = r.choice(["add", "add", "remove", "rename"]), r.choice(sources[:3]), r.choice(sources[:3])
        log.append((n, op, s, t if op == "rename" else None, f"d{n}", [f"k{n}"], day(4 * n)))
        if op == "add":
            live[s] = f"d{n}"
        elif op == "remove":
            live.pop(s, None)
        elif s in live and s != t:
            live[t] = live.pop(s)
        elif s == t:
            log.pop()
            continue
        for x in sources:
            held[x].append((day(4 * n), live.get(x)))
    log.append((99, "add", "s.d", None, "dd", None, day(7)))
    held["s.d"] = [(day(7), "dd")]
    events = spark.createDataFrame(log, "seq long, op string, source_key string, new_source_key string, destination string, keys array<string>, at timestamp_ntz")
    rows = [(s, i, day(i / 3)) for i in range(300) for s in sources]
    changes = spark.createDataFrame(rows, "source_key string, seq long, exec_time timestamp_ntz")
    got = {(x.source_key, x.seq): x.destination for x in M.route_as_of(changes, M.mapping_history(events)).collect()}
    want = {}
    for s, i, at in rows:
        known = [d for t, d in held[s] if t <= at]
        if known and known[-1]:
            want[s, i] = known[-1]
    assert got == want and len({d for d in got.values()}) > 5
    assert M.route_as_of(changes, M.mapping_history(events.limit(0))).count() == 0


def test_versions_of_unions_and_truncations(spark):
    rows = random_log(300, 8, 5)
    assert any(x["op"] == "TRUNCATE" for x in rows)
    whole = AU.cell_versions(to_df(spark, rows), n=3)
    parts = [AU.version_records(A.contributions(A.with_row_keys(to_df(spark, rows[i::3]))), 3) for i in (2, 0, 1, 0)]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    key = lambda x: (x.row_key, x.name, x.version, x.value, x.seq)
    assert sorted(map(key, AU.versions_of(merged.distinct(), 3).collect())) == sorted(map(key, whole.collect()))
    newest = {(x.row_key, x.name): x.value for x in whole.collect() if x.version == 1}
    state = state_as_dict(A.apply_changes(to_df(spark, rows)))
    assert {(k, c): v for (_, k), cells in state.items() for c, v in cells.items()} == newest


def _entry(**kw):
    base = {"entry_type": "ROWDATA", "event_type": "INSERT", "database": "db", "table": "t", "execute_time": 1704067200000, "log_file": 1, "offset": 5,
            "rows": [{"after": [cell("id", "1", key=True)]}]}
    return json.dumps({**base, **kw})


LINES = [
    (_entry(), None),
    (_entry(event_type="QUERY", table=None, rows=None, ddl="set x"), None),
    (_entry(entry_type="TRANSACTIONBEGIN", event_type=None, rows="x"), None),
    (_entry(rows="oops"), "rows are no list of images"),
    (_entry(rows=[None]), "a row without images"),
    (_entry(rows=[]), "no rows"),
    (_entry(rows=[{"after": [cell("id", "1", key=True)]}, {"x": 1}]), "a row without images"),
    (_entry(database=None), "no database"),
    (_entry(table=""), "no table"),
    (_entry(offset=2**40), "out of range"),
    (_entry(log_file=2**20), "out of range"),
    (_entry(offset="five"), "a number is none"),
    (_entry(execute_time="noon"), "a number is none"),
    (_entry(offset=None), "no offset"),
    ("{", "not JSON"),
]


def test_lines_that_are_no_entries(spark):
    from tidemark.sources.decode import decode_changes, decode_rejects

    df = spark.createDataFrame([(t,) for t, _ in LINES], "value string")
    assert sorted((r.value, r.reason) for r in decode_rejects(df).collect()) == sorted(x for x in LINES if x[1])
    got = decode_changes(df).collect()
    assert sorted(r.op for r in got) == ["INSERT", "QUERY"] and all(r.source_key and r.exec_time for r in got if r.op == "INSERT")


def test_a_feed_restarts_where_it_ended(spark):
    from tidemark.sources.decode import encode_entries
    from tidemark.streaming.apply_stream import current_state
    from tidemark.streaming.decode_stream import read_dead_letters, run_feed_stream

    rows = random_log(120, 9, 8)
    for i, r in enumerate(rows):
        r["exec_time"] = datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=i)
    run = _run(spark, "feed")
    rejects = [x for x in LINES if x[1]]
    for i in range(2):
        lines = encode_entries(to_df(spark, rows[i::2])).union(spark.createDataFrame([(t,) for t, _ in rejects[i::2]], "value string"))
        lines.coalesce(1).write.mode("append").text(f"{run}/in")
        run_feed_stream(spark, f"{run}/in", f"{run}/state", f"{run}/dead", f"{run}/ckpt").awaitTermination()
    assert state_as_dict(current_state(spark, f"{run}/state")) == state_as_dict(A.apply_changes(to_df(spark, rows)))
    assert sorted(r.value for r in read_dead_letters(spark, f"{run}/dead").collect()) == sorted(t for t, _ in rejects)


def test_forwarding_looks_at_clock_and_mapping_in_each_batch(spark):
    from tidemark.streaming.apply_stream import change_stream
    from tidemark.streaming.forward import read_forwarded, write_forward_stream

    rows = random_log(60, 5, 17, sources=("db.t",))
    for i, r in enumerate(rows):
        r["exec_time"], r["seq"] = datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=i), i
    run = _run(spark, "forward")
    for part, mapped in ((rows[:30], False), (rows[30:], True)):
        known = [("db.t", "dest", datetime.datetime(2024, 1, 2, 12))] if mapped else []
        spark.createDataFrame(known, "source_key string, destination string, registered_at timestamp_ntz").coalesce(1).write.mode("overwrite").parquet(f"{run}/mapping")
        to_df(spark, part).coalesce(1).write.mode("append").parquet(f"{run}/in")
        write_forward_stream(change_stream(spark, f"{run}/in"), f"{run}/mapping", "inst", f"{run}/out", f"{run}/ckpt", clock=lambda _: "2024-01-01 20:00:00").awaitTermination()
    got = read_forwarded(spark, f"{run}/out").select("batch", F.get_json_object("value", "$.seq").cast("int").alias("seq")).collect()
    assert sorted((r.batch, r.seq) for r in got) == [(0, i) for i in range(21, 30)] + [(1, i) for i in range(37, 60)]


@pytest.mark.parametrize("replayed", [False, True])
def test_metrics_have_a_row_for_each_batch(spark, replayed):
    from tidemark.streaming.metrics import batch_rows, metered

    path, seen = _run(spark, "metrics"), []
    rows = random_log(30, 5, 4)
    for i, r in enumerate(rows):
        r["exec_time"] = datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=i)
    process = metered(lambda batch, i: seen.append((i, batch.count())), path, clock=lambda i: f"2024-01-01 0{i}:00:00")
    for i, part in enumerate((rows[:10], [], [], rows[10:])):
        for _ in range(1 + replayed):
            process(to_df(spark, part), i)
    got = sorted(tuple(r) for r in MON.progress(MON.metrics_of_batches(batch_rows(spark, path)), 1).collect())
    at = lambda m: datetime.datetime(2024, 1, 1, 0, m)
    assert got == [(0, 10, at(9), 0), (1, 0, at(9), 1), (2, 0, at(9), 0), (3, 20, at(29), 0)]
    assert [r.batch_id for r in MON.idle_alerts(MON.metrics_of_batches(batch_rows(spark, path)), 1).collect()] == [2]
