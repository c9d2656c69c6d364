"""Initial load: full and paged scans, shard unions, key checks, load plans."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import DEFAULT_CONNECTOR, row_key_from_columns
from tidemark.operators import apply as A
from tidemark.operators.joins import join_small
from tidemark.schema import IMAGE


def initial_load(df: DataFrame, source: str, keys: list[str], fields: list[str] | None = None,
                 connector: str = DEFAULT_CONNECTOR, reverse: bool = True, clean: bool = True) -> DataFrame:
    """State rows ``(source_key, row_key, cells)`` of a full table scan.

    ``fields`` restricts the stored columns (empty/None = all); only they and
    the keys are read, so the scan's ReadSchema holds nothing else.  Null
    values are skipped, names lower-cased, values cleaned.
    """
    if not keys:
        raise ValueError(f"{source}: every loaded table needs a key")
    wanted = list(fields) if fields else list(df.columns)
    cols = list(dict.fromkeys([*wanted, *keys]))
    rows = df.select(*cols)
    return A.state_from_rows(rows, source, keys, {c: F.col(c).cast("string") for c in wanted}, connector, reverse, clean)


def load_records(df: DataFrame, source: str, keys: list[str], fields: list[str] | None = None, seq: int | Column = 0, **kw) -> DataFrame:
    """An initial load as reduced records at ``seq``, for ``apply.apply_on``: the hand-over to the change log."""
    return A.records_of_state(initial_load(df, source, keys, fields, **kw), seq)


def reload_records(df: DataFrame, source: str, keys: list[str], seq: Column, fields: list[str] | None = None, **kw) -> DataFrame:
    """A reload as records: everything the source held up to ``seq`` goes, the rows are there from ``seq`` + 1 on."""
    wipe = df.sparkSession.range(1).select(
        F.lit(source).alias("source_key"), F.lit("").alias("row_key"), F.lit("wipe").alias("tag"),
        F.lit(None).cast("string").alias("name"), seq.cast("long").alias("seq"), F.lit(None).cast("string").alias("value"))
    return load_records(df, source, keys, fields, seq.cast("long") + 1, **kw).unionByName(wipe)


def page_bounds(df: DataFrame, column: str) -> tuple:
    """``coalesce(min, 0)`` and ``coalesce(max, 0)`` as scalar subqueries."""
    lo = df.select(F.coalesce(F.min(column), F.lit(0))).scalar()
    hi = df.select(F.coalesce(F.max(column), F.lit(0))).scalar()
    return lo, hi


def paged(df: DataFrame, column: str, page_size: int) -> DataFrame:
    """Every row with ``page = floor((c - min) / size)``; pages are
    ``[min + i*size, min + (i+1)*size)``, wherever ``min`` lies.  Rows with a
    null key are a page of their own, whose number and bounds are null."""
    lo, hi = page_bounds(df, column)
    return (
        df.withColumn("page", F.floor((F.col(column) - lo) / F.lit(page_size)).cast("long"))
        .withColumn("page_lo", lo + F.col("page") * page_size)
        .withColumn("page_hi", lo + (F.col("page") + 1) * page_size)
        .withColumn("n_pages", F.ceil((hi - lo + 1) / F.lit(page_size)).cast("long"))
    )


def page_summary(df: DataFrame, column: str, page_size: int) -> DataFrame:
    """One row per non-empty page: bounds, row count and the page count."""
    p = paged(df, column, page_size)
    return p.groupBy("page", "page_lo", "page_hi", "n_pages").agg(F.count(F.lit(1)).alias("n_rows"))


def shard_union(tables: dict[str, DataFrame], pattern: str, keys: list[str], connector: str = DEFAULT_CONNECTOR, reverse: bool = True) -> DataFrame:
    """All tables whose ``database.table`` matches ``pattern`` as one frame,
    tagged with ``source_key`` and ``row_key``; missing columns are null."""
    rx = re.compile(pattern)
    picked = [(name, df) for name, df in sorted(tables.items()) if rx.search(name)]
    if not picked:
        raise ValueError(f"no table matches {pattern!r}")
    out = None
    for name, df in picked:
        tagged = df.withColumn("source_key", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    rk = row_key_from_columns(keys, F.col("source_key"), connector, reverse)
    return out.withColumn("row_key", rk)


def key_check(df: DataFrame, keys: list[str], name: str, connector: str = DEFAULT_CONNECTOR, reverse: bool = True) -> DataFrame:
    """Key quality of a table: rows, rows with a null key column, key values
    held by more than one row, and row keys shared by different key values
    (the connector inside key values makes them collide)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    rk = row_key_from_columns(keys, F.lit(name), connector, reverse)
    collisions = per_key.groupBy(rk.alias("rk")).agg(F.count(F.lit(1)).alias("m")).where("m > 1").select(F.count(F.lit(1)))
    return per_key.agg(
        F.lit(name).alias("table_name"),
        F.sum("n").cast("long").alias("n_rows"),
        F.coalesce(F.sum(F.when(any_null, F.col("n"))), F.lit(0)).cast("long").alias("n_null_keys"),
        F.count(F.when(F.col("n") > 1, 1)).cast("long").alias("n_dup_keys"),
    ).withColumn("n_collisions", collisions.scalar())


def load_plan(wanted: DataFrame, mapping: DataFrame) -> DataFrame:
    """Per wanted source: ``load`` (not mapped yet), ``reload`` (mapped and
    flagged reinitialize) or ``skip`` (mapped)."""
    m = mapping.select("source_key", F.lit(True).alias("_mapped"), F.coalesce("reinitialize", F.lit(False)).alias("_re"))
    j = join_small(wanted.select("source_key").distinct(), m, "source_key", "left")
    return j.select(
        "source_key",
        F.when(F.col("_mapped").isNull(), "load").when(F.col("_re"), "reload").otherwise("skip").alias("action"),
    )


def write_ranges(state: DataFrame, path: str, regions: int, key: str = "row_key") -> None:
    """Lay rows out in at most ``regions`` contiguous key ranges (sampled bounds, like
    pre-split regions): each range is one folder ``rows/region=<n>`` whose file is
    sorted by key, and the split points are stored as ``splits``."""
    r = state.repartitionByRange(regions, key).withColumn("region", F.spark_partition_id())
    r.sortWithinPartitions("region", key).write.mode("overwrite").partitionBy("region").parquet(f"{path}/rows")
    rows = state.sparkSession.read.parquet(f"{path}/rows")
    splits = rows.groupBy("region").agg(F.min(key).alias("start_key"), F.max(key).alias("end_key"), F.count(F.lit(1)).alias("n_rows"))
    splits.coalesce(1).write.mode("overwrite").parquet(f"{path}/splits")


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a range layout with their ``region``."""
    return spark.read.parquet(f"{path}/rows")


def range_splits(spark: SparkSession, path: str) -> DataFrame:
    """``(region, start_key, end_key, n_rows)`` as stored with the rows."""
    return spark.read.parquet(f"{path}/splits")


def look_up(spark: SparkSession, path: str, value: str, key: str = "row_key") -> DataFrame:
    """The rows of one key: the split points tell the one region whose folder is opened, and the
    key's equality, pushed to its sorted file, the row groups."""
    hits = range_splits(spark, path).where(F.lit(value).between(F.col("start_key"), F.col("end_key"))).select("region").collect()  # one, or none
    return read_ranges(spark, path).where(F.col("region").isin([r["region"] for r in hits]) & (F.col(key) == F.lit(value)))


def page_predicates(df: DataFrame, column: str, pages: int) -> list[str]:
    """One range predicate a page over a numeric column, with about equally many rows in each however the
    values are spread; null keys are a page of their own.  ``spark.read.jdbc(predicates=...)`` takes them as they are."""
    at = df.approxQuantile(column, [i / pages for i in range(1, pages)], 1 / (8 * pages)) if pages > 1 else []
    whole = df.schema[column].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    cuts = sorted({int(x) if whole else x for x in at})
    if not cuts:
        return [f"`{column}` IS NOT NULL", f"`{column}` IS NULL"]
    inner = [f"`{column}` >= {a} AND `{column}` < {b}" for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return [f"`{column}` < {cuts[0]}", *inner, f"`{column}` >= {cuts[-1]}", f"`{column}` IS NULL"]


def read_pages(df: DataFrame, column: str, pages: int) -> DataFrame:
    """Every row of a stored table with its ``page``, page by page: each is a scan of its own with its bounds
    pushed down, so pages are read apart and row groups outside them are skipped."""
    parts = [df.where(F.expr(p)).withColumn("page", F.lit(i)) for i, p in enumerate(page_predicates(df, column, pages))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def source_listing(changes: DataFrame) -> DataFrame:
    """Sources seen in a change log with their physical key columns (the
    images' key flags, ascending name order; empty when none is flagged)."""
    img = F.coalesce(F.col("after"), F.col("before"))
    names = F.array_sort(F.transform(F.filter(F.coalesce(img, F.array().cast(IMAGE)),
                                              lambda c: F.coalesce(c["is_key"], F.lit(False))), lambda c: F.lower(c["name"])))
    # Different lists first: a task keeps those of each source in a hash table, while a maximum of arrays sorts all its
    # changes.  ``max_by``, as the optimizer takes a distinct below ``max`` out.
    seen = changes.select("source_key", "database", "table", names.alias("names")).distinct()
    return seen.groupBy("source_key", "database", "table").agg(F.max_by("names", "names").alias("physical_keys"))


def resolve_groups(listing: DataFrame, rules: DataFrame) -> DataFrame:
    """Assign sources to table groups: a rule names its tables explicitly, or
    else gives a pattern; logical keys of the rule win over physical keys.
    ``rules``: ``(group_name, database, tables ARRAY, pattern, logical_keys ARRAY)``."""
    j = join_small(listing, rules, "database", "inner")
    explicit = F.coalesce(F.size("tables"), F.lit(0)) > 0
    hit = F.when(explicit, F.array_contains("tables", F.col("table"))).otherwise(F.rlike(F.col("table"), F.col("pattern")))
    keys = F.coalesce(F.col("logical_keys"), F.col("physical_keys"))
    return j.where(hit).select(
        "source_key", "group_name", F.array_join(keys, ",").alias("key_list"),
        F.when(F.col("logical_keys").isNotNull(), "logical").otherwise("physical").alias("key_origin"),
    )
