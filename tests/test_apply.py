"""Closed-form apply against a sequential fold, and its algebraic properties."""

import pytest
from helpers import random_log, sequential_fold, state_as_dict, to_df

from tidemark.operators import apply as A


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_closed_form_equals_sequential_fold(spark, seed):
    rows = random_log(400, 25, seed, sources=("db.t", "db.u"))
    got = state_as_dict(A.apply_changes(to_df(spark, rows)))
    assert got == sequential_fold(rows)


def test_hot_key_log(spark):
    rows = random_log(600, 30, 7, hot_key=3)
    got = state_as_dict(A.apply_changes(to_df(spark, rows)))
    assert got == sequential_fold(rows)


def test_replay_and_split_and_shuffle(spark):
    rows = random_log(300, 20, 11)
    whole = state_as_dict(A.apply_changes(to_df(spark, rows)))

    def reduced(part):
        keyed = A.with_row_keys(to_df(spark, part))
        return A.reduce_contributions(A.contributions(keyed))

    # split into three micro-batches, with the middle one replayed, in reverse order
    parts = [rows[:100], rows[100:200], rows[200:]]
    acc = None
    for p in [parts[2], parts[1], parts[1], parts[0]]:
        r = reduced(p)
        acc = r if acc is None else A.reduce_contributions(acc.unionByName(r))
    assert state_as_dict(A.materialize(acc)) == whole


def test_null_rules(spark):
    from helpers import cell

    rows = [
        dict(source_key="s.t", database="s", table="t", exec_time=None, op="INSERT", ddl=None, seq=1, before=None,
             after=[cell("id", "12", key=True), cell("a", "x"), cell("b", "y"), cell("c", None, null=True)]),
        dict(source_key="s.t", database="s", table="t", exec_time=None, op="UPDATE", ddl=None, seq=2, before=None,
             after=[cell("id", "12", key=True, updated=False), cell("a", None, null=True, updated=False), cell("b", None, null=True, updated=True)]),
    ]
    got = state_as_dict(A.apply_changes(to_df(spark, rows)))
    # reversed key, connector, source key; null kept old, null+updated became ''
    assert got == {("s.t", "21+s.t"): {"id": "12", "a": "x", "b": ""}}


def test_key_change_deletes_old_key_unless_kept(spark):
    from helpers import cell

    rows = [
        dict(source_key="s.t", database="s", table="t", exec_time=None, op="INSERT", ddl=None, seq=1, before=None,
             after=[cell("id", "1", key=True), cell("a", "x")]),
        dict(source_key="s.t", database="s", table="t", exec_time=None, op="UPDATE", ddl=None, seq=2,
             before=[cell("id", "1", key=True), cell("a", "x")], after=[cell("id", "2", key=True), cell("a", "x")]),
    ]
    df = to_df(spark, rows)
    assert set(state_as_dict(A.apply_changes(df))) == {("s.t", "2+s.t")}
    assert set(state_as_dict(A.apply_changes(df, keep_old_key=True))) == {("s.t", "1+s.t"), ("s.t", "2+s.t")}


def test_logical_keys_from_mapping_override_key_flags(spark):
    from helpers import cell

    from tidemark.operators.mapping import route_changes

    rows = [
        dict(source_key="s.t", database="s", table="t", exec_time=None, op="INSERT", ddl=None, seq=1, before=None,
             after=[cell("id", "7", key=True), cell("Region", "eu"), cell("v", "x")]),
        dict(source_key="s.t", database="s", table="t", exec_time=None, op="INSERT", ddl=None, seq=2, before=None,
             after=[cell("id", "7", key=True), cell("Region", "us"), cell("v", "y")]),
    ]
    mapping = spark.createDataFrame([("s.t", "dest", ["region", "id"])], "source_key string, destination string, keys array<string>")
    routed = route_changes(to_df(spark, rows), mapping)
    got = state_as_dict(A.apply_changes(routed, keys_col="keys"))
    # logical key (id, region) in name order: values "7", "eu" -> reversed "ue+7"
    assert got == {("s.t", "ue+7+s.t"): {"id": "7", "region": "eu", "v": "x"}, ("s.t", "su+7+s.t"): {"id": "7", "region": "us", "v": "y"}}
    # with the key flags only, both inserts hit the same row
    assert set(state_as_dict(A.apply_changes(to_df(spark, rows)))) == {("s.t", "7+s.t")}
