"""Schema events applied to a state ``(source_key, row_key, cells, ...)``.

Each is a projection or filter of the affected source's slice; the slice is
found by equality on ``source_key`` (a partition column of the stored
state, so the scan is pruned), never by a pattern over row keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import DEFAULT_CONNECTOR, row_key_from_values


def source_slice(state: DataFrame, source: str) -> DataFrame:
    """Rows of one source."""
    return state.where(F.col("source_key") == F.lit(source))


def _on_source(state: DataFrame, source: str, changed: Column, col: str = "cells") -> DataFrame:
    hit = F.col("source_key") == F.lit(source)
    return state.withColumn(col, F.when(hit, changed).otherwise(F.col(col)))


def drop_column(state: DataFrame, source: str, column: str) -> DataFrame:
    """Remove one cell from every row of a source."""
    c = column.lower()
    return _on_source(state, source, F.map_filter("cells", lambda k, v: k != F.lit(c)))


def rename_column(state: DataFrame, source: str, old: str, new: str) -> DataFrame:
    """Move a cell to a new (lower-cased) name, in place of a cell that has it;
    same name = no-op."""
    o, n = old.lower(), new.lower()
    if o == n:
        return state
    has = F.map_contains_key("cells", o)
    rest = F.filter(F.map_entries("cells"), lambda e: (e["key"] != o) & (~has | (e["key"] != n)))
    moved = F.transform(F.filter(F.map_entries("cells"), lambda e: e["key"] == o), lambda e: F.struct(F.lit(n).alias("key"), e["value"].alias("value")))
    return _on_source(state, source, F.map_from_entries(F.concat(rest, moved)))


def rekey(state: DataFrame, source: str, keys: list[str], connector: str = DEFAULT_CONNECTOR, reverse: bool = True) -> DataFrame:
    """New row keys for every row of a source from its cells, key columns in
    ascending name order (after a primary-key change)."""
    ks = sorted(k.lower() for k in keys)
    vals = F.array(*[F.coalesce(F.col("cells")[k], F.lit("")) for k in ks])
    new = row_key_from_values(vals, F.col("source_key"), connector, reverse)
    return state.withColumn("row_key", F.when(F.col("source_key") == F.lit(source), new).otherwise(F.col("row_key")))


def rename_source(state: DataFrame, old: str, new: str, keys: list[str], connector: str = DEFAULT_CONNECTOR, reverse: bool = True) -> DataFrame:
    """Rows of ``old`` move to source ``new`` with recomputed row keys."""
    hit = F.col("source_key") == F.lit(old)
    moved = state.withColumn("source_key", F.when(hit, F.lit(new)).otherwise(F.col("source_key")))
    return rekey(moved, new, keys, connector, reverse) if keys else moved


def truncate_source(state: DataFrame, source: str) -> DataFrame:
    """Every row of a source removed (TRUNCATE / DROP TABLE on a state)."""
    return state.where(F.col("source_key") != F.lit(source))


def stop_source(state: DataFrame, mapping: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Primary key dropped without replacement: the source's slice is
    deleted and its mapping removed, so later changes are not routed."""
    return truncate_source(state, source), mapping.where(F.col("source_key") != F.lit(source))
