"""Scalar building blocks."""

from pyspark.sql import functions as F

from tidemark.functions.cells import clean_value
from tidemark.functions.keys import row_key_from_columns


def test_substring_index_literals(spark):
    df = spark.createDataFrame([(n,) for n in [0, 1, 2, 3, -1, -2, -3]], "n int")
    got = [r[0] for r in df.select(F.expr("substring_index('yixiaxia', 'ia', n)")).collect()]
    assert got == ["", "yix", "yixiax", "yixiaxia", "", "xia", "yixiaxia"]


def test_row_key_reverses_joined_keys(spark):
    df = spark.createDataFrame([("12", "34")], "a string, b string")
    got = df.select(row_key_from_columns(["b", "a"], F.lit("db.t"))).first()[0]
    assert got == "43+21+db.t"
    plain = df.select(row_key_from_columns(["a", "b"], F.lit("db.t"), reverse=False)).first()[0]
    assert plain == "12+34+db.t"


def test_clean_value_collapses_control_runs(spark):
    df = spark.createDataFrame([("a\r\n\tb\x01c",)], "s string")
    assert df.select(clean_value(F.col("s"))).first()[0] == "a b c"
