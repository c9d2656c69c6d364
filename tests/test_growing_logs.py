"""Tasks, landed files and state rows follow the size of a log: no task grows with it."""

import uuid

from helpers import cell, to_df
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sources import fixtures as FX
from tidemark.streaming.apply_stream import change_stream


def _log(spark, seqs):
    return to_df(spark, [dict(source_key="db.t", database="db", table="t", exec_time=None, op="INSERT", ddl=None, seq=s, before=None,
                              after=[cell("id", str(s), key=True), cell("g", "x")]) for s in seqs])


def _micro_batches(spark, path, each, run):
    seen = []
    q = change_stream(spark, path, max_files_per_trigger=each).writeStream.foreachBatch(lambda df, i: seen.append(sorted(r.seq for r in df.select("seq").collect())))
    q.option("checkpointLocation", f"{run}/ckpt").trigger(availableNow=True).start().awaitTermination()
    return seen


def test_a_chunk_lands_as_many_files_and_is_one_micro_batch(spark, monkeypatch):
    monkeypatch.setattr(FX, "ROWS_PER_FILE", 20)
    run = scratch_path(spark, f"t-land-{uuid.uuid4().hex}")
    seqs = [*range(100), 198, *range(200, 300)]  # the second of three chunks has one row
    each = FX.write_in_seq_order(_log(spark, seqs), f"{run}/in", chunks=3)
    assert each >= 5 and len(spark.read.parquet(f"{run}/in").inputFiles()) == 3 * each
    assert max(r["count"] for r in spark.read.parquet(f"{run}/in").groupBy(F.input_file_name()).count().collect()) <= 60
    assert _micro_batches(spark, f"{run}/in", each, run) == [list(range(100)), [198], list(range(200, 300))]


def test_tasks_of_a_log_and_files_of_a_part_follow_its_rows(spark, monkeypatch):
    monkeypatch.setattr(FX, "ROWS_PER_TASK", 50)
    log = FX.spread(_log(spark, range(2000)), 2000)
    per_task = [r["count"] for r in log.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) >= 35 and max(per_task) <= 100 and sum(per_task) == 2000
    monkeypatch.setattr(FX, "ROWS_PER_FILE", 50)
    path = scratch_path(spark, f"t-parts-{uuid.uuid4().hex}")
    assert FX.write_shuffled(log, path, 4, 2000) == 10 and len(spark.read.parquet(path).inputFiles()) == 40


def test_a_bucket_of_row_keys_is_one_state_row(spark):
    from tidemark.streaming.rollup_stream import buckets_for, current_rollup, run_rollup_stream

    assert buckets_for(10) == 64 and buckets_for(10**7) == 10**4
    run = scratch_path(spark, f"t-buckets-{uuid.uuid4().hex}")
    for seqs in (range(100), range(50, 150)):
        _log(spark, seqs).coalesce(1).write.mode("append").parquet(f"{run}/in")
    q = run_rollup_stream(spark, f"{run}/in", f"{run}/rollup", f"{run}/ckpt", ["g"], [], buckets=3)
    q.awaitTermination()
    assert [o["numRowsUpdated"] for p in q.recentProgress for o in p["stateOperators"] if p["numInputRows"]] == [3, 3]
    assert [r["count"] for r in current_rollup(spark, f"{run}/rollup", ["g"], [], "d").collect()] == [150]


def test_sorts_of_records_tell_rows_apart_by_their_row_key(spark, capsys):
    from tidemark.operators import apply as A
    from tidemark.operators import audit as AU

    log = _log(spark, [1, 2, 2])
    for df in (A.apply_changes(log), AU.cell_versions(log, 2)):
        df.explain()
        sorts = [x for x in capsys.readouterr().out.splitlines() if " Sort [" in x]
        assert sorts and all(" Sort [row_key" in x for x in sorts if "row_key" in x)
    assert A.apply_changes(log).columns == ["source_key", "row_key", "cells", "version"]


def test_a_line_of_a_feed_is_parsed_once(spark):
    from tidemark.sources.decode import decode_changes, decode_rejects

    lines = spark.createDataFrame([("{",), (None,)], "value string")
    for df in (decode_changes(lines), decode_rejects(lines)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert sorted(decode_rejects(lines).collect(), key=str) == [("{", "not JSON"), (None, "not JSON")]


def test_chunks_land_without_a_sort_or_a_second_shuffle(spark, monkeypatch):
    monkeypatch.setattr(FX, "ROWS_PER_FILE", 20)
    monkeypatch.setattr(FX, "_staged", None)  # a copy of the whole log by chunk
    path = scratch_path(spark, f"t-once-{uuid.uuid4().hex}")
    each = FX.write_in_seq_order(FX.spread(_log(spark, range(200)), 200), path, chunks=2)
    assert each >= 5 and sorted(r.seq for r in spark.read.parquet(path).select("seq").collect()) == list(range(200))


def test_a_snapshot_does_not_reduce_its_base_again(spark, monkeypatch):
    from tidemark.operators import apply as A
    from tidemark.streaming import records as REC

    def no(records):
        raise AssertionError("a base is reduced")

    monkeypatch.setattr(A, "reduce_contributions", no)
    run = scratch_path(spark, f"t-base-{uuid.uuid4().hex}")
    REC.start(spark, f"{run}/state", "r")
    log = _log(spark, [1, 2, 3]).withColumn("exec_time", F.expr("cast('2024-01-01' as timestamp_ntz) + make_interval(0, 0, 0, cast(seq as int))"))
    REC.write_batch(log, 0, f"{run}/state", "r", snapshots=f"{run}/snapshots")
    got = spark.read.parquet(f"{run}/snapshots").select(F.col("segment").cast("string"), F.col("cells")["id"].alias("id")).collect()
    assert sorted((r.segment, r.id) for r in got) == [("20240103", "1"), ("20240104", "1"), ("20240104", "2")]


def test_a_listing_does_not_sort_the_changes(spark, capsys):
    from tidemark.operators import load as L

    log = _log(spark, range(50)).unionByName(to_df(spark, [
        dict(source_key="db.t", database="db", table="t", exec_time=None, op="DELETE", ddl=None, seq=99, before=[cell("Z", "1", key=True), cell("id", "1", key=True)], after=None),
        dict(source_key="db.u", database="db", table="u", exec_time=None, op="QUERY", ddl="x", seq=1, before=None, after=None)]))
    listing = L.source_listing(log)
    listing.explain()
    plan = capsys.readouterr().out.splitlines()
    sorts, hashed = ([i for i, x in enumerate(plan) if word in x] for word in (" Sort [", " HashAggregate("))
    assert hashed and max(sorts, default=-1) < min(hashed)  # what is sorted is what the hash aggregate left
    assert sorted(map(tuple, listing.collect())) == [("db.t", "db", "t", ["id", "z"]), ("db.u", "db", "u", [])]


def _landed(spark, name, seqs):
    run = scratch_path(spark, f"t-{name}-{uuid.uuid4().hex}")
    FX.write_shuffled(_log(spark, seqs), f"{run}/in", 1, len(seqs))
    return run


def test_shuffles_of_a_micro_batch_follow_its_files(spark, monkeypatch, capsys):
    from tidemark.operators import apply as A
    from tidemark.streaming import apply_stream as STR

    seen, write = [], STR.write_batch

    def spied(batch, *a, **kw):
        seen.append(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        write(batch, *a, **kw)

    monkeypatch.setattr(STR, "write_batch", spied)
    monkeypatch.setattr(A, "TASKS_PER_READ", 50)
    run = _landed(spark, "follow", range(40))
    state = STR.apply_stream_once(spark, f"{run}/in", f"{run}/state", f"{run}/ckpt")
    assert seen == ["50"] and spark.conf.get("spark.sql.shuffle.partitions") == "8"  # the stream's session, not the user's
    state.explain()
    shuffles = [x for x in capsys.readouterr().out.splitlines() if "Exchange hashpartitioning(" in x]
    assert len(shuffles) == 1 and "REPARTITION_BY_NUM" in shuffles[0] and "hashpartitioning(row_key" in shuffles[0]
    assert sorted(int(r.cells["id"]) for r in state.collect()) == list(range(40))


def test_versions_are_cut_in_one_pass_before_the_shuffle(spark, monkeypatch, capsys):
    from tidemark.operators import apply as A
    from tidemark.operators import audit as AU
    from tidemark.streaming import versions_stream as VS

    log = to_df(spark, [dict(source_key="db.t", database="db", table="t", exec_time=None, op=op, ddl=None, seq=s, before=row if op == "DELETE" else None,
                             after=None if op == "DELETE" else row)
                        for s, op in ((1, "DELETE"), (2, "INSERT"), (3, "UPDATE"), (3, "UPDATE"), (4, "UPDATE"), (4, "UPDATE"))
                        for row in [[cell("id", "7", key=True), cell("g", f"v{s}")]]])
    records = AU.version_records(A.contributions(A.with_row_keys(log)), 2)
    records.explain()
    plan = capsys.readouterr().out
    assert plan.count("Generate explode") == 1 and plan.count("Exchange ") == 1 and plan.count("WindowGroupLimit") == 2
    assert sorted((r.tag, r.name or "", r.seq) for r in records.collect()) == [
        ("cell", "g", 3), ("cell", "g", 4), ("cell", "id", 3), ("cell", "id", 4), ("del", "", 1), ("live", "", 4)]
    run = scratch_path(spark, f"t-cut-{uuid.uuid4().hex}")
    log.write.parquet(f"{run}/in")
    VS.run_versions_stream(change_stream(spark, f"{run}/in"), f"{run}/out", f"{run}/ckpt", 2).awaitTermination()
    got = VS.current_versions(spark, f"{run}/out", 2)
    assert sorted((r.name, r.version, r.value) for r in got.collect()) == [("g", 1, "v4"), ("g", 2, "v3"), ("id", 1, "7"), ("id", 2, "7")]


def test_events_land_as_the_changes_of_their_log(spark, monkeypatch):
    monkeypatch.setattr(FX, "ROWS_PER_FILE", 10)
    run = scratch_path(spark, f"t-events-{uuid.uuid4().hex}")
    kinds = ["signup", "view", "error", "click"]
    spark.createDataFrame([(i, i % 7, kinds[i % 4], i / 4, f"p{i}") for i in [*range(100), 5]], "event_id long, user_id long, event_type string, value double, props string").withColumn(
        "ts", F.lit("2024-01-01").cast("timestamp")).coalesce(1).write.parquet(f"{run}/events.parquet")
    assert FX.write_events(spark, run, f"{run}/in", 2) == 11  # two changes a row at most
    log, landed = FX.events_changelog(spark, run), spark.read.parquet(f"{run}/in")
    assert landed.columns == log.columns and len(landed.inputFiles()) >= 15
    assert sorted(map(str, landed.collect())) == sorted(map(str, log.collect()))
