import pytest
from cases import awkward, frame, lines_brute, rows_of, same

from tidemark.llm import lines


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = awkward(seed)
    got = lines.dedup_lines(frame(spark, rows))
    same(rows_of(got, "doc_id", "text", "n_lines", "n_dropped"), lines_brute(rows))


def test_empty_table_and_carry(spark):
    assert lines.dedup_lines(frame(spark, [])).collect() == []
    out = lines.dedup_lines(frame(spark, [(1, "one long line here\nx"), (2, "One Long LINE here\ny")]), carry=True)
    assert sorted((r.doc_id, r.text, r["_row"]["_text"]) for r in out.collect()) == [(1, "one long line here\nx", "y"), (2, "y", "y")]


def test_hot_line_is_split_and_bitmaps_are_sparse(spark):
    rows = [(i, "the very common line\n" + f"only in document {i}") for i in range(2000)]
    docs = frame(spark, rows)
    maps = {r["_id"]: r["keep"] for r in lines.keep_bitmaps(docs).collect()}
    assert len(maps) == 1999 and 0 not in maps
    assert all(len(m) == 1 and m[0]["word"] == 0 and m[0]["bits"] == ~1 for m in maps.values())
    same(rows_of(lines.dedup_lines(docs), "doc_id", "text", "n_lines", "n_dropped"), lines_brute(rows))


def test_no_python_in_the_plan(spark):
    out = lines.dedup_lines(frame(spark, awkward()))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_only_blanks_are_trimmed(spark):
    rows = [(1, "most of the time of"), (2, "most of the time o"), (3, "funny proof"), (4, "unny proo"), (5, "f23456789f"), (6, "f23456789f")]
    rows += [(7, "a page that ends\x0c\n\x0cbegins a page"), (8, "a page that ends\nbegins a page\x0c"), (9, "\x0c234567890"), (10, "\x0c234567890")]
    got = rows_of(lines.dedup_lines(frame(spark, rows)), "doc_id", "text", "n_lines", "n_dropped")
    same(got, lines_brute(rows))
    assert {i for i, _, _, dropped in got if dropped} == {6, 8}
