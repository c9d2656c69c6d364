"""Roll-ups: SUM and COUNT tables per group, batch and insert-if-absent.

All are ``groupBy().agg()`` (partial aggregation before the shuffle); the
result is written, never collected.  Group columns are always sorted by name
to build the roll-up row key, in batch and in stream form alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import DEFAULT_CONNECTOR, row_key_from_columns
from tidemark.operators import apply as A
from tidemark.operators.ordered import previous_row
from tidemark.schema import SOURCE_WIPE_OPS

# Names of the roll-up columns.
SUM_SUFFIX = "_accumulation"
COUNT_COLUMN = "count"
# Texts and floating-point columns are added up as exact decimals of this type, unless the caller names another.
SUM_TYPE = "decimal(38,18)"
# Whole doubles up to this size are added up as BIGINT: 2 ** 43 of them cannot overflow.
_SMALL = float(1 << 20)


def summed(df: DataFrame, column: str, sum_as: str = SUM_TYPE) -> Column:
    """The exact sum of a column, whatever the order: whole numbers and decimals in
    their own type, anything else as ``sum_as``.  A value that this type cannot hold
    exactly ends the job with its name; ``sum_as="double"`` adds up approximately."""
    x, kind = F.col(column), df.schema[column].dataType
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        return F.sum(x)
    if sum_as == "double":
        return F.sum(x.cast("double"))
    as_typed, number = x.cast(sum_as), x.cast("double")
    misfit = F.raise_error(F.concat(F.lit(f"{column}: "), x.cast("string"), F.lit(f" does not fit {sum_as}; name another type to add up as")))
    exact = as_typed.cast("double") == number
    if isinstance(kind, T.StringType):
        scale = int(sum_as.rstrip(")").split(",")[1]) if "," in sum_as else 0
        return F.sum(F.when(x.isNull() | F.trim(x).rlike(f"^[+-]?[0-9]*([.][0-9]{{0,{scale}}}0*)?$") | exact, as_typed).otherwise(misfit.cast(sum_as)))
    small = (F.abs(number) <= _SMALL) & (number == F.floor(number))
    whole = F.sum(F.when(small, number.cast("bigint")))
    rest = F.sum(F.when(~small, F.when(exact, as_typed).otherwise(misfit.cast(sum_as))))
    return F.coalesce(whole.cast(sum_as) + F.coalesce(rest, F.lit(0).cast(sum_as)), rest).cast(sum_as)


def _keyed(df: DataFrame, groups: list[str], dest: str, connector: str, reverse: bool) -> DataFrame:
    g = sorted(groups, key=str.lower)
    return df.withColumn("row_key", row_key_from_columns(g, F.lit(dest), connector, reverse)).select("row_key", *g, *[c for c in df.columns if c not in g])


def rollup_sum(df: DataFrame, groups: list[str], columns: list[str], dest: str, connector: str = DEFAULT_CONNECTOR, reverse: bool = True, sum_as: str = SUM_TYPE) -> DataFrame:
    """``<col>_accumulation`` = exact SUM of each column per group (``summed``)."""
    agg = df.groupBy(*groups).agg(*[summed(df, c, sum_as).alias(c + SUM_SUFFIX) for c in columns])
    return _keyed(agg, groups, dest, connector, reverse)


def rollup_count(df: DataFrame, groups: list[str], dest: str, connector: str = DEFAULT_CONNECTOR, reverse: bool = True) -> DataFrame:
    """``count`` = number of rows per group."""
    agg = df.groupBy(*groups).agg(F.count(F.lit(1)).alias(COUNT_COLUMN))
    return _keyed(agg, groups, dest, connector, reverse)


def rollup_paged(df: DataFrame, page_col: str, page_size: int, groups: list[str], columns: list[str], dest: str, **kw) -> DataFrame:
    """Page-wise partial sums added up: ``groupBy(page, g)`` then ``groupBy(g)``."""
    lo = df.select(F.min(page_col)).scalar()
    paged = df.withColumn("_page", F.floor((F.col(page_col) - lo) / F.lit(page_size)))
    parts = paged.groupBy("_page", *groups).agg(*[summed(df, c, kw.get("sum_as", SUM_TYPE)).alias(c) for c in columns])
    return rollup_sum(parts, groups, columns, dest, **kw)


def absent_inserts(changes: DataFrame, fields: list[str], keys_col: str | None = None, blocks: int | None = None) -> DataFrame:
    """INSERT events that hit an absent row: the row has no earlier event, its
    previous event (by ``seq``) was a DELETE or an UPDATE that gave the row
    another key, or its source was truncated or dropped since.  Returns
    ``(source_key, row_key, seq, *fields)`` with the inserted (written) values
    of ``fields``; only these columns travel through the ordering shuffle."""
    prev = previous_row(row_events(changes, fields, keys_col), ["source_key", "row_key"], "seq", ["op"], blocks=blocks)
    hits = prev.where(F.col("op") == "INSERT")
    since = F.get(F.filter("wipes", lambda w: (w < F.col("seq")) & (w > F.col("prev_seq"))), 0)
    absent = F.col("prev_op").isNull() | (F.col("prev_op") == "DELETE") | since.isNotNull()
    return hits.join(wipe_times(changes), "source_key", "left").where(absent).select("source_key", "row_key", "seq", *fields)


def row_events(changes: DataFrame, fields: list[str], keys_col: str | None = None) -> DataFrame:
    """``(source_key, row_key, seq, op, *fields)``: one event per row key that a
    change touches; an UPDATE that changes the key deletes the old one."""
    from tidemark.functions.cells import image_to_map

    keyed = A.with_row_keys(changes, keys_col).where(F.col("op").isin("INSERT", "UPDATE", "DELETE"))
    cells = F.when(F.col("op") == "INSERT", image_to_map(F.col("after"), F.col("op")))
    old = F.when(F.col("old_row_key") != F.col("row_key"), F.struct(F.col("old_row_key").alias("row_key"), F.lit("DELETE").alias("op")))
    touched = F.explode(F.array_compact(F.array(F.struct("row_key", "op"), old))).alias("e")
    slim = keyed.select("source_key", "seq", *[cells[f.lower()].alias(f) for f in fields], touched)
    return slim.where(F.col("e.row_key").isNotNull()).select("source_key", F.col("e.row_key").alias("row_key"), "seq", F.col("e.op").alias("op"), *fields)


def wipe_times(changes: DataFrame) -> DataFrame:
    """``(source_key, wipes)``: when each source was truncated or dropped (schema events, few per source)."""
    wiped = changes.where(F.col("op").isin(*SOURCE_WIPE_OPS))
    return wiped.groupBy("source_key").agg(F.sort_array(F.collect_set("seq")).alias("wipes"))


def rollup_sum_stream(changes: DataFrame, groups: list[str], columns: list[str], dest: str, **kw) -> DataFrame:
    """SUM roll-up fed by INSERTs of absent rows only (UPDATE/DELETE never count)."""
    ins = absent_inserts(changes, list(dict.fromkeys([*groups, *columns])))
    return rollup_sum(ins.select(*groups, *columns), groups, columns, dest, **kw)


def rollup_count_stream(changes: DataFrame, groups: list[str], dest: str, **kw) -> DataFrame:
    """COUNT roll-up fed by INSERTs of absent rows only."""
    ins = absent_inserts(changes, groups)
    return rollup_count(ins.select(*groups), groups, dest, **kw)
