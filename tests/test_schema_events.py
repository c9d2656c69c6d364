"""Schema events on states, mapping renames, and pages and sums that lose nothing."""

import datetime

from helpers import cell, to_df

from tidemark.operators import load as L
from tidemark.operators import mapping as M
from tidemark.operators import rollup as R
from tidemark.operators import schema_apply as SA
from tidemark.operators import schema_events as SE


def test_rename_column_over_another(spark):
    state = spark.createDataFrame([("s.t", "1", {"a": "x", "b": "y"}), ("s.t", "2", {"b": "z"}), ("s.u", "3", {"a": "q"})], "source_key string, row_key string, cells map<string,string>")
    got = {r.row_key: r.cells for r in SE.rename_column(state, "s.t", "a", "B").collect()}
    assert got == {"1": {"b": "x"}, "2": {"b": "z"}, "3": {"a": "q"}}


def test_mapping_renames_carry_what_was_mapped(spark):
    at = datetime.datetime(2024, 1, 1)
    rows = [
        (1, "add", "a", None, "d1", ["k"], at),
        (2, "rename", "a", "b", None, None, at),
        (3, "rename", "nobody", "c", "d9", None, at),
        (4, "add", "a", None, "d2", None, at),
        (5, "rename", "b", "c", None, None, at),
        (6, "add", "plain", None, "d3", None, at),
        (7, "remove", "plain", None, None, None, at),
        (8, "add", "other", None, "d4", None, at),
    ]
    log = spark.createDataFrame(rows, "seq long, op string, source_key string, new_source_key string, destination string, keys array<string>, at timestamp_ntz")
    got = {r.source_key: (r.destination, r["keys"]) for r in M.mapping_state(log).collect()}
    assert got == {"a": ("d2", None), "c": ("d1", ["k"]), "other": ("d4", None)}
    assert M.mapping_state(log.limit(0)).collect() == []


def test_pages_hold_every_row(spark):
    for keys in ([-1, 0, 5, None], [0], [-7, -3]):
        df = spark.createDataFrame([(k,) for k in keys], "k long")
        assert sorted((r.k for r in L.paged(df, "k", 3).collect()), key=str) == sorted(keys, key=str)
        assert sum(r.n_rows for r in L.page_summary(df, "k", 3).collect()) == len(keys)


def test_sums_keep_fractions(spark):
    df = spark.createDataFrame([("g", 0.9, "0.9", 1), ("g", 0.9, "1.25", 2)], "g string, x double, s string, n int")
    r = R.rollup_sum(df, ["g"], ["x", "s", "n"], "d").first()
    assert (float(r.x_accumulation), float(r.s_accumulation), r.n_accumulation) == (1.8, 2.15, 3)


def _row(seq, source="db.t", key="id", ddl=None, op=None, **values):
    image = [cell(k, v, key=k == key) for k, v in values.items()] or None
    return dict(source_key=source, database="db", table=source.split(".")[1], exec_time=None, op=op or ("ALTER" if ddl else "INSERT"), ddl=ddl, seq=seq, before=None, after=image)


def test_rename_rekey_and_stop_follow_seq(spark):
    rows = [
        _row(1, id="1", c="x"),
        _row(2, ddl="rename table t to u", op="RENAME"),
        _row(3, source="db.u", id="2", c="x", v="late"),
        _row(4, source="db.u", ddl="alter table u drop primary key, add primary key (c)"),
        _row(5, source="db.u", key="c", id="3", c="x"),
        _row(6, source="db.w", id="1"),
        _row(7, source="db.w", ddl="alter table w drop primary key"),
        _row(8, source="db.w", id="2"),
    ]
    got = {(r.source_key, r.row_key): (r.cells, r.version) for r in SA.apply_log(to_df(spark, rows)).collect()}
    assert got == {("db.u", "x+db.u"): ({"id": "3", "c": "x", "v": "late"}, 5)}
    before = SA.apply_log(to_df(spark, rows[:3])).collect()
    assert {(r.source_key, r.row_key) for r in before} == {("db.u", "1+db.u"), ("db.u", "2+db.u")}


def test_tables_are_told_apart_by_when_they_had_a_name(spark):
    rows = [
        _row(1, source="db.a", id="1", x="old"),
        _row(2, source="db.b", id="2", x="gone"),
        _row(3, source="db.b", ddl="drop table b", op="ERASE"),
        _row(4, source="db.a", ddl="rename table a to b", op="RENAME"),
        _row(5, source="db.b", ddl="alter table b change x y int"),
        _row(6, source="db.a", id="3", x="another table"),
    ]
    got = {(r.source_key, r.row_key): r.cells for r in SA.apply_log(to_df(spark, rows)).collect()}
    assert got == {("db.b", "1+db.b"): {"id": "1", "y": "old"}, ("db.a", "3+db.a"): {"id": "3", "x": "another table"}}


def test_a_key_change_without_columns_leaves_keys_alone(spark):
    rows = [_row(1, id="1", c="x"), _row(2, ddl="alter table t drop primary key, add primary key"), _row(3, id="2", c="x")]
    assert {r.row_key for r in SA.apply_log(to_df(spark, rows)).collect()} == {"1+db.t", "2+db.t"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_plan_does_not_grow_with_key_changes(spark):
    def log(events):
        rows = [_row(1, id="1", c="x"), _row(99, id="2", c="x")]
        return to_df(spark, rows + [_row(10 + i, ddl=f"alter table t drop primary key, add primary key ({'c' if i % 2 else 'id'})") for i in range(events)])

    one, ten = (SA.apply_log(log(n)) for n in (1, 10))
    assert _plan(one).count("Aggregate") == _plan(ten).count("Aggregate") and len(_plan(ten)) < 1.2 * len(_plan(one))
    assert {r.row_key for r in ten.collect()} == {"x+db.t", "2+db.t"}


def test_logical_keys_in_capitals(spark):
    from tidemark.operators import apply as A

    log = to_df(spark, [_row(1, User_ID="7", v="x"), _row(2, User_ID="7", v="y"), _row(3, User_ID="8", v="z")])
    for name in ("User_ID", "user_id", "USER_ID"):
        mapping = spark.createDataFrame([("db.t", "dest", [name])], "source_key string, destination string, keys array<string>")
        assert {r.row_key: r.cells["v"] for r in M.apply_routed(log, mapping).collect()} == {"7+db.t": "y", "8+db.t": "z"}
    assert A.apply_changes(log).count() == 0  # without them no column is a key


def test_sums_are_exact_or_refused(spark):
    import decimal

    import pytest

    tiny = spark.createDataFrame([("g", 4e-11, "0.000000000000000001")] * 10, "g string, x double, s string")
    r = R.rollup_sum(tiny, ["g"], ["x", "s"], "d").first()
    assert (r.x_accumulation, r.s_accumulation) == (decimal.Decimal("4e-10"), decimal.Decimal("1e-17"))
    mixed = spark.createDataFrame([("g", 1e19), ("g", 3.0), ("g", -0.25), ("g", None), ("h", None)], "g string, x double")
    assert {r.g: r.x_accumulation for r in R.rollup_sum(mixed, ["g"], ["x"], "d").collect()} == {"g": decimal.Decimal("10000000000000000002.75"), "h": None}
    for value, kind in ((1e-19, "double"), (1e30, "double"), (float("nan"), "double"), ("0.0000000000000000001", "string"), ("many", "string")):
        odd = spark.createDataFrame([("g", value)], f"g string, x {kind}")
        with pytest.raises(Exception):
            R.rollup_sum(odd, ["g"], ["x"], "d").collect()
        if value != "many":
            assert R.rollup_sum(odd, ["g"], ["x"], "d", sum_as="double").count() == 1
