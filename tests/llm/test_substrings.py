import pyarrow as pa
import pytest
from cases import NULL_ID, awkward, frame, rows_of, same, substrings_brute
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import substrings as S


@pytest.mark.parametrize("seed", [1, 3])
def test_against_brute_force(spark, seed):
    rows = awkward(seed)
    got = S.dedup_substrings(frame(spark, rows))
    same(rows_of(got, "doc_id", "text", "n_words", "n_removed"), substrings_brute(rows))


def test_empty_table_and_short_texts(spark):
    assert S.dedup_substrings(frame(spark, [])).collect() == []
    rows = [(1, "a b c"), (2, "a b c"), (3, None)]
    same(rows_of(S.dedup_substrings(frame(spark, rows)), "doc_id", "text", "n_words", "n_removed"), substrings_brute(rows))


def local(rows, split=1):
    """The steps between the shuffles, without Spark; rows dealt to ``split`` map tasks."""
    docs = [(NULL_ID if i is None else i, n, t or "") for n, (i, t) in enumerate(rows)]

    def batch(part):
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in part], pa.int64()), pa.array([d[1] for d in part], pa.int64()), pa.array([d[2] for d in part], pa.string())], names=["_id", "_fp", "_text"])

    runs = [b for k in range(split) for b in S.anchors(iter([batch(docs[k::split])])) if docs[k::split]]
    by_row: dict = {}
    for b in S.shared_prefixes(iter(runs)):
        for r in b.to_pylist():
            by_row.setdefault(r["_fp"], []).append({k: r[k] for k in ("s0", "s1", "key", "n")})
    part = [d for d in docs if d[1] in by_row]
    if not part:
        return {d[1]: [] for d in docs}
    kind = pa.list_(pa.struct([("s0", pa.int32()), ("s1", pa.int32()), ("key", pa.int64()), ("n", pa.int32())]))
    b = batch(part)
    b = pa.RecordBatch.from_arrays([*b.columns, pa.array([by_row[d[1]] for d in part], kind)], names=[*b.schema.names, "runs"])
    gone = S.second_round(S.trees(S.contents(iter([b]))))
    spans: dict = {d[1]: [] for d in docs}
    for g in gone:
        for r in g.to_pylist():
            spans[r["_fp"]].append((r["s0"], r["s1"]))
    return spans


def check_local(rows, split):
    spans = local(rows, split)
    for n, (_, _, _, removed) in enumerate(substrings_brute(rows)):
        words = set()
        for a, b in spans[n]:
            words.update(range(a, b + S.WINDOW))
        assert len(words) == removed


@pytest.mark.parametrize("split", [1, 4])
def test_hot_prefixes_take_a_second_round(monkeypatch, split):
    monkeypatch.setattr(S, "HOT", 2)
    monkeypatch.setattr(S, "CHUNK_WORDS", 300)
    rows = [(i, t) for i, (_, t) in enumerate(awkward(5, 80))]
    check_local(rows, split)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c " * 9, "a b " * 11]), max_size=12).map(" ".join), max_size=6), st.integers(1, 3))
def test_periodic_texts(texts, split):
    check_local(list(enumerate(texts)), split)
