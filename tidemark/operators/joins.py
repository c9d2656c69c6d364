"""Joins against configuration-sized tables (mappings, rules, source lists, schema events)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What is broadcast at most, on the strength of its fetched rows.
BROADCAST_MAX_ROWS = 100_000
BROADCAST_MAX_BYTES = 32 << 20


def fetched(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame | None:
    """The table computed once, as rows of the driver, if it has at most ``max_rows`` rows
    and ``BROADCAST_MAX_BYTES``; else None."""
    rows = small.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows or rows.nbytes > BROADCAST_MAX_BYTES:
        return None
    return small.sparkSession.createDataFrame(rows, small.schema)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner", max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Join ``big`` with a table expected to be small.

    If the small side can be ``fetched``, those very rows are broadcast;
    otherwise the planner's join over the whole side (with adaptive skew
    handling) is used.
    """
    rows = fetched(small, max_rows)
    return big.join(small if rows is None else F.broadcast(rows), on, how)
