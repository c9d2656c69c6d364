"""Property test: for generated change logs the closed form equals the fold."""

from helpers import cell, sequential_fold, state_as_dict, to_df
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import apply as A

value = st.one_of(st.none(), st.sampled_from(["x", "y", "", "a\tb"]))
image = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), value, st.booleans()), max_size=3)
change = st.tuples(st.sampled_from(["INSERT", "UPDATE", "DELETE", "TRUNCATE"]), st.integers(0, 3), image)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(change, min_size=1, max_size=25), st.randoms(use_true_random=False))
def test_closed_form_matches_fold(spark, changes, rnd):
    seqs = rnd.sample(range(1, 1000), len(changes))
    rows = []
    for (op, k, cells), s in zip(changes, seqs):
        img = [cell("id", str(k), key=True)] + [cell(n, v, null=v is None, updated=u) for n, v, u in dict((n, (n, v, u)) for n, v, u in cells).values()]
        base = dict(source_key="db.t", database="db", table="t", exec_time=None, ddl=None, seq=s)
        if op == "TRUNCATE":
            rows.append(dict(base, op=op, before=None, after=None))
        elif op == "DELETE":
            rows.append(dict(base, op=op, before=img, after=None))
        else:
            rows.append(dict(base, op=op, before=None, after=img))
    got = state_as_dict(A.apply_changes(to_df(spark, rows)))
    exp = {k: {n: v.replace("\t", " ") for n, v in c.items()} for k, c in sequential_fold(rows).items()}  # values are cleaned
    assert got == exp
