"""Skew-safe "previous row" lookup over an ordered log.

``lag(x) OVER (PARTITION BY g ORDER BY s)`` puts every row of one group in
one task; a single source (or row key) may hold a third of a change log.
``previous_row`` cuts the order column into quantile blocks first:

1. block bounds = approximate quantiles of ``s``, one for so many rows a task
   (``ROWS_PER_BLOCK``), so blocks follow the data and not a constant;
2. ``lag`` inside ``(g, block)``: no group is larger than one block;
3. the last row of every ``(g, block)`` (a map-side combined aggregate) is
   looked up for the first row of the next non-empty block of ``g``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BLOCK = 500_000
TREE_BOUNDS = 256  # up to so many bounds are compared in generated code, beyond them by Spark's Bucketizer


def blocks_for(df: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> int:
    return max(1, -(-df.count() // rows_per_block))


def _block_bounds(df: DataFrame, order: str, blocks: int) -> list[float]:
    if blocks < 2:
        return []
    probs = [i / blocks for i in range(1, blocks)]
    qs = df.select(F.col(order).cast("double").alias("o")).approxQuantile("o", probs, 1.0 / (4 * blocks))
    return sorted({q for q in qs if q is not None})


def _block_of(value: Column, bounds: list[float], first: int = 0) -> Column:
    """The number of bounds at or below a value, as a tree of comparisons."""
    if not bounds:
        return F.lit(first)
    mid = len(bounds) // 2
    return F.when(value < bounds[mid], _block_of(value, bounds[:mid], first)).otherwise(_block_of(value, bounds[mid + 1 :], first + mid + 1))


def with_block(df: DataFrame, order: str, blocks: int | None = None) -> DataFrame:
    """Add ``_blk``: index of the quantile block of ``order``; ``blocks`` defaults to one for ``ROWS_PER_BLOCK`` rows."""
    bounds = _block_bounds(df, order, blocks_for(df) if blocks is None else blocks)
    if len(bounds) <= TREE_BOUNDS:
        return df.withColumn("_blk", _block_of(F.col(order).cast("double"), bounds))
    from pyspark.ml.feature import Bucketizer

    cut = Bucketizer(splits=[-math.inf, *bounds, math.inf], inputCol="_order", outputCol="_at", handleInvalid="keep")
    return cut.transform(df.withColumn("_order", F.col(order).cast("double"))).withColumn("_blk", F.col("_at").cast("int")).drop("_order", "_at")


def previous_row(df: DataFrame, by: list[str], order: str, cols: list[str], prefix: str = "prev_", blocks: int | None = None) -> DataFrame:
    """Add ``prefix+c`` for ``c`` in ``[order, *cols]``: values of the previous
    row of the same ``by`` group in ``order`` (null for the first row).

    A linear plan: the last row of every ``(by, block)`` is a map-side
    combined aggregate, lagged over the few blocks of its group; it is joined
    to the rows on ``(by, block)``, and that join's shuffle is exactly the
    partitioning the in-block ``lag`` window needs, so the window adds none.
    """
    fields = [order, *cols]
    b = with_block(df, order, blocks)
    rec = F.struct(*[F.col(c) for c in fields])
    tails = (
        b.groupBy(*by, "_blk")
        .agg(F.max(rec).alias("_tail"))
        .withColumn("_prev_tail", F.lag("_tail").over(Window.partitionBy(*by).orderBy("_blk")))
        .where(F.col("_prev_tail").isNotNull())
        .select(*by, "_blk", "_prev_tail")
    )
    w = Window.partitionBy(*by, "_blk").orderBy(order)
    out = b.join(tails, [*by, "_blk"], "left").withColumn("_prev", F.coalesce(F.lag(rec).over(w), F.col("_prev_tail")))
    return out.select(*df.columns, *[F.col("_prev")[c].alias(prefix + c) for c in fields])


def running_max(df: DataFrame, order: str, cols: list[str], block_size: int, prefix: str = "run_") -> DataFrame:
    """Add ``prefix+c`` = max of ``c`` over all rows with ``order`` <= this
    row's (one global order, e.g. a batch sequence).

    Rows are cut into blocks of ``block_size`` consecutive ``order`` values;
    a window runs inside each block, and the maxima of earlier blocks (one
    row per block, ``block_size`` times fewer rows) are carried in by a
    prefix over the block table.
    """
    b = df.withColumn("_blk", F.floor(F.col(order) / F.lit(block_size)))
    inner = Window.partitionBy("_blk").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for c in cols:
        b = b.withColumn("_in_" + c, F.max(c).over(inner))
    blocks = b.groupBy("_blk").agg(*[F.max(c).alias("_bm_" + c) for c in cols])
    before = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_blk", *[F.max("_bm_" + c).over(before).alias("_pre_" + c) for c in cols])
    j = b.join(blocks, "_blk", "left")
    return j.select(*df.columns, *[F.greatest(F.col("_in_" + c), F.col("_pre_" + c)).alias(prefix + c) for c in cols])
