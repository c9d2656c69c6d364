"""Column schema events folded into the apply, against a sequential fold."""

import random

from helpers import cell, sequential_fold, state_as_dict, to_df

from tidemark.operators.schema_apply import apply_with_schema


def ddl_row(seq, text):
    return dict(source_key="db.t", database="db", table="t", exec_time=None, op="ALTER", ddl=text, seq=seq, before=None, after=None)


def fold_with_columns(rows):
    """Sequential fold where ALTER rows rename or drop a column of every row."""
    state = {}
    for ch in sorted(rows, key=lambda r: r["seq"]):
        if ch["op"] != "ALTER":
            part = sequential_fold([ch])
            for k, v in part.items():
                state.setdefault(k, {}).update(v)
            if ch["op"] == "DELETE":
                state.pop(("db.t", next(iter(sequential_fold([dict(ch, op="INSERT", after=ch["before"])])))[1]), None)
            continue
        words = ch["ddl"].split()
        for cells in state.values():
            if words[3] == "drop":
                cells.pop(words[-1], None)
            elif words[-3] in cells:
                cells[words[-2]] = cells.pop(words[-3])
    return state


def test_rename_chain_and_drop(spark):
    rnd = random.Random(4)
    rows = []
    seq = 0
    for step in range(120):
        seq += 10
        k = rnd.randrange(8)
        op = rnd.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"])
        img = [cell("id", str(k), key=True), cell("a", f"a{step}"), cell("p", f"p{step}")]
        if op == "DELETE":
            rows.append(dict(source_key="db.t", database="db", table="t", exec_time=None, op=op, ddl=None, seq=seq, before=img, after=None))
        else:
            rows.append(dict(source_key="db.t", database="db", table="t", exec_time=None, op=op, ddl=None, seq=seq, before=None, after=img))
    rows += [
        ddl_row(305, "alter table t change a b int"),
        ddl_row(605, "alter table t change b c int"),
        ddl_row(805, "alter table t drop column p"),
    ]
    got = state_as_dict(apply_with_schema(to_df(spark, rows)))
    assert got == fold_with_columns(rows)
    some = next(iter(got.values()))
    assert "b" not in some
