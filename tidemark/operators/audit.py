"""Per-change views: column audits, written cells, cell versions, op summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.cells import image_to_map
from tidemark.operators import apply as A
from tidemark.operators.joins import join_small
from tidemark.schema import IGNORED_OPS, IMAGE, ROW_OPS, SCHEMA_OPS

def column_audit(changes: DataFrame) -> DataFrame:
    """One row per changed column: UPDATE -> updated columns with before and
    after value; INSERT -> after value only; DELETE -> before value only.
    Values are whole, whatever their length."""
    op = F.col("op")
    before = F.coalesce("before", F.array().cast(IMAGE))
    after = F.coalesce("after", F.array().cast(IMAGE))
    before_map = F.map_from_entries(F.transform(before, lambda c: F.struct(c["name"].alias("k"), c["value"].alias("v"))))

    def val(c: Column) -> Column:
        return F.when(~F.coalesce(c["is_null"], F.lit(False)), c["value"])

    upd = F.transform(
        F.filter(after, lambda c: F.coalesce(c["updated"], F.lit(False))),
        lambda c: F.struct(c["name"].alias("column_name"), before_map[c["name"]].alias("before_value"), val(c).alias("after_value")),
    )
    ins = F.transform(after, lambda c: F.struct(c["name"].alias("column_name"), F.lit(None).cast("string").alias("before_value"), val(c).alias("after_value")))
    dele = F.transform(before, lambda c: F.struct(c["name"].alias("column_name"), val(c).alias("before_value"), F.lit(None).cast("string").alias("after_value")))
    items = F.when(op == "UPDATE", upd).when(op == "INSERT", ins).when(op == "DELETE", dele)
    return changes.select("source_key", "seq", "op", F.explode(items).alias("a")).select(
        "source_key", "seq", "op", F.col("a.column_name").alias("column_name"),
        F.col("a.before_value").alias("before_value"), F.col("a.after_value").alias("after_value"),
    )


def written_cells(changes: DataFrame, clean: bool = True) -> DataFrame:
    """Written after-cells of INSERT/UPDATE rows as ``(source_key, seq, name, value)``."""
    iu = changes.where(F.col("op").isin("INSERT", "UPDATE"))
    m = image_to_map(F.col("after"), F.col("op"), clean)
    return iu.select("source_key", "seq", F.explode(m).alias("name", "value"))


def top_by_seq(df: DataFrame, group: list[str], n: int) -> DataFrame:
    """The ``n`` newest rows (by ``seq``) per group, ranked 1..n as ``version``.

    Spark keeps at most ``n`` rows of a group in every task before the shuffle
    (its window group limit), so no task holds a hot group's history.
    """
    newest = Window.partitionBy(*group).orderBy(F.col("seq").desc())
    return df.withColumn("version", F.row_number().over(newest).cast("long")).where(F.col("version") <= n)


_VERSIONED = [*A.STATE_KEY, "tag", "name", "seq", "value"]


def version_records(contrib: DataFrame, n: int) -> DataFrame:
    """What the last ``n`` versions need of contributions: each cell's ``n`` newest, each row's newest markers and
    each source's newest truncation.  Of a union of such records these records again, in any order and with replays."""
    # Markers are records without a name, so one window does for both; among equals, a rank counts different records.
    newest = Window.partitionBy(*A.STATE_SORT, "tag", "name").orderBy(F.col("seq").desc(), F.col("value"))
    ranked = contrib.select(*_VERSIONED).withColumn("_rank", F.dense_rank().over(newest)).where(F.col("_rank") <= n)
    return ranked.where((F.col("tag") == "cell") | (F.col("_rank") == 1)).select(*_VERSIONED).distinct()


def versions_of(records: DataFrame, n: int, wipes: DataFrame | None = None) -> DataFrame:
    """The last ``n`` versions of every cell of every live row from ``version_records``; ``wipes``: as for ``materialize``."""
    low = F.lit(-(2**63))
    rows = (
        records.where(F.col("tag").isin("del", "live"))
        .groupBy(*A.STATE_SORT)
        .agg(F.max(F.when(F.col("tag") == "del", F.col("seq"))).alias("del_seq"), F.max(F.when(F.col("tag") == "live", F.col("seq"))).alias("live_seq"))
    )
    rows = join_small(rows, A.wipes_of(records) if wipes is None else wipes, "source_key", "left").withColumn("floor", F.greatest(F.coalesce("del_seq", low), F.coalesce("wipe_seq", low)))
    rows = rows.where(F.col("live_seq") > F.col("floor")).select(*A.STATE_KEY, "floor")
    newest = top_by_seq(records.where("tag = 'cell'").select(*A.STATE_KEY, "name", "seq", "value"), [*A.STATE_SORT, "name"], n)
    return newest.join(rows, A.STATE_KEY).where(F.col("seq") > F.col("floor")).drop("floor")


def cell_versions(changes: DataFrame, n: int = 1, keys_col: str | None = None) -> DataFrame:
    """The last ``n`` versions of every cell of every live row, newest = 1;
    versions older than the row's newest delete, or its source's newest
    truncation, are gone with the row.

    Cells are ranked first; a delete cuts a cell's versions off from below, so
    only the at most ``n`` newest of each cell meet their row's markers."""
    return versions_of(A.contributions(A.with_row_keys(changes, keys_col)), n, A.source_wipes(changes))


def op_class(op: Column) -> Column:
    return (
        F.when(op.isin(*ROW_OPS), "row")
        .when(op.isin(*IGNORED_OPS), "ignored")
        .when(op.isin(*SCHEMA_OPS), "schema")
        .otherwise("other")
    )


def op_summary(changes: DataFrame) -> DataFrame:
    """Events per op with its dispatch class (row / schema / ignored / other)."""
    return changes.groupBy("op").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("source_key").alias("n_sources")
    ).withColumn("op_class", op_class(F.col("op")))
