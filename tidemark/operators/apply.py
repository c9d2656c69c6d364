"""Change apply: the current state of every table after a change log.

The sequential fold of the change log (INSERT = upsert of written cells,
UPDATE = cell-wise merge, DELETE = remove the row) has a closed form that
depends only on ``seq``:

* per row key ``floor`` = newest DELETE (or source TRUNCATE/DROP) seq;
* the row exists iff some INSERT/UPDATE is newer than ``floor``;
* each cell = newest written value, kept only if newer than ``floor``.

It is computed in two aggregation levels:

1. ``contributions`` explodes every change into small records
   ``(source_key, row_key, tag, name, seq, value)``; ``reduce_contributions``
   keeps the newest record per ``(source_key, row_key, tag, name)``.  This is a
   plain ``max(struct(seq, value))`` so Spark combines map-side before the
   shuffle: a hot row key costs one record per map task, not one per change.
   The reduced records are also the mergeable streaming state: the union of
   two reductions, reduced again, equals the reduction of the union, in any
   order and with any replays.
2. ``materialize`` finds each row key's floor with a window over its
   reduced records (bounded by the number of columns), keeps the cells above
   it and builds the cell map in the same partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.cells import is_written, written_value
from tidemark.functions.keys import DEFAULT_CONNECTOR, row_key
from tidemark.operators.joins import join_small
from tidemark.schema import IMAGE, SOURCE_WIPE_OPS

STATE_KEY = ["source_key", "row_key"]
REDUCED_KEY = ["source_key", "row_key", "tag", "name"]
# The same keys in the order that tasks sort by: rows are told apart by the first bytes of a row key, while all rows
# of a source share its name, so that every comparison would have to read both strings.
STATE_SORT = ["row_key", "source_key"]
REDUCED_SORT = ["row_key", "tag", "name", "source_key"]
# Tasks that reduce records, for each that reads them: one reads at most ``spark.sql.files.maxPartitionBytes``, and a
# change makes several records.
TASKS_PER_READ = 4


def _image(c: str) -> Column:
    return F.coalesce(F.col(c), F.array().cast(IMAGE))


def with_row_keys(changes: DataFrame, keys_col: str | None = None, connector: str = DEFAULT_CONNECTOR, reverse: bool = True) -> DataFrame:
    """Add ``row_key`` (from the after-image, the before-image for DELETE) and
    ``old_row_key`` (the before-image key of an UPDATE).

    ``keys_col`` names an ARRAY<STRING> column of logical key columns (e.g.
    joined from the mapping); without it the images' ``is_key`` flags decide.
    """
    keys = F.col(keys_col) if keys_col else None
    src = F.col("source_key")
    op = F.col("op")
    img = F.when(op == "DELETE", _image("before")).otherwise(_image("after"))
    return changes.withColumns({
        "row_key": row_key(img, src, keys, connector, reverse),
        "old_row_key": F.when(op == "UPDATE", row_key(_image("before"), src, keys, connector, reverse)),
    })


def _marker(tag: str) -> Column:
    """A marker travels in an image-shaped struct with a null name; the tag
    rides in ``value`` so markers and cells explode together."""
    return F.struct(
        F.lit(None).cast("string").alias("name"), F.lit(False).alias("is_key"), F.lit(False).alias("updated"),
        F.lit(False).alias("is_null"), F.lit(tag).alias("value"),
    )


def contributions(keyed: DataFrame, keep_old_key: bool = False, clean: bool = True, carry: list[str] | None = None) -> DataFrame:
    """Explode keyed changes into ``(source_key, row_key, tag, name, seq, value)`` and the columns to ``carry``.

    tags: ``live`` (an INSERT/UPDATE touched the row), ``del`` (a DELETE, or
    the old key of a key-changing UPDATE unless ``keep_old_key``), ``cell``
    (a written cell), ``wipe`` (TRUNCATE/DROP of the whole source, row_key '').
    Rows without a key are ignored, as the reference ignores them.  One
    ``explode`` of (after-image ++ markers); everything after it is plain
    column expressions inside whole-stage codegen.
    """
    op = F.col("op")
    rk = F.col("row_key")
    iu = op.isin("INSERT", "UPDATE")
    markers = [
        F.when(iu, _marker("live")),
        F.when(op == "DELETE", _marker("del")),
        F.when(op.isin(*SOURCE_WIPE_OPS), _marker("wipe")),
    ]
    if not keep_old_key:
        old = F.col("old_row_key")
        markers.append(F.when((op == "UPDATE") & old.isNotNull() & (old != rk), _marker("oldkey")))
    items = F.concat(F.when(iu, _image("after")).otherwise(F.array().cast(IMAGE)), F.array(*markers))
    carry = carry or []
    x = keyed.select("source_key", "seq", "op", "row_key", "old_row_key", *carry, F.explode(items).alias("c")).where(F.col("c").isNotNull())
    c = F.col("c")
    marker = c["name"].isNull()
    kind = c["value"]
    tag = F.when(marker, F.when(kind == "oldkey", F.lit("del")).otherwise(kind)).otherwise(F.lit("cell"))
    out_rk = F.when(marker & (kind == "oldkey"), F.col("old_row_key")).when(marker & (kind == "wipe"), F.lit("")).otherwise(rk)
    return x.where(marker | is_written(c, op)).select(
        "source_key",
        out_rk.alias("row_key"),
        tag.alias("tag"),
        F.when(~marker, F.lower(c["name"])).alias("name"),
        "seq",
        F.when(~marker, written_value(c, clean)).alias("value"),
        *carry,
    ).where(F.col("row_key").isNotNull())


def tasks_for(stored: DataFrame, least: int | None = None) -> int:
    """Tasks for a shuffle of stored rows: ``least``, by default as many as the session has, or more as the rows' files
    grow.  The plan of ``stored`` may hold scans, filters and unions, so that asking runs no job."""
    if least is None:
        least = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, TASKS_PER_READ * stored.rdd.getNumPartitions())


def dealt(records: DataFrame) -> DataFrame:
    """Stored, reduced records dealt by row key to tasks that follow their files: what is grouped by more than the row
    key afterwards, and windows over it, stay in these tasks."""
    return records.repartition(tasks_for(records), *STATE_SORT)


def reduce_contributions(contrib: DataFrame) -> DataFrame:
    """Newest record per ``(source_key, row_key, tag, name)`` (map-side combined)."""
    return (
        contrib.groupBy(*REDUCED_SORT)
        .agg(F.max(F.struct("seq", "value")).alias("m"))
        .select(*REDUCED_KEY, F.col("m.seq").alias("seq"), F.col("m.value").alias("value"))
    )


def source_wipes(changes: DataFrame) -> DataFrame:
    """Newest TRUNCATE / DROP TABLE ``seq`` per source, straight from the log
    (the op filter reaches the scan; no explode or cell aggregation)."""
    return changes.where(F.col("op").isin(*SOURCE_WIPE_OPS)).groupBy("source_key").agg(F.max("seq").alias("wipe_seq"))


def wipes_of(records: DataFrame) -> DataFrame:
    """As ``source_wipes``, from stored records; ask them, not a reduction of them, so that only wipes are read."""
    return records.where("tag = 'wipe'").groupBy("source_key").agg(F.max("seq").alias("wipe_seq"))


def materialize(reduced: DataFrame, wipes: DataFrame | None = None) -> DataFrame:
    """State rows ``(source_key, row_key, cells MAP, version)`` from reduced records.

    Source-wide wipes ``(source_key, wipe_seq)`` come from ``source_wipes``,
    ``wipes_of`` or, when not given, from the reduced ``wipe`` records.  They
    hold one row per source and are joined through ``join_small``, so the
    reduced records are never shuffled by source.
    """
    rows = reduced.where(F.col("tag") != "wipe")
    wipes = wipes_of(reduced) if wipes is None else wipes
    low = F.lit(-(2**63))
    per_key = Window.partitionBy(*STATE_SORT)
    floor = F.greatest(F.coalesce(F.max(F.when(F.col("tag") == "del", F.col("seq"))).over(per_key), low), F.coalesce("wipe_seq", low))
    ranked = (
        join_small(rows, wipes, "source_key", "left")
        .withColumns({"_floor": floor, "version": F.max(F.when(F.col("tag") == "live", F.col("seq"))).over(per_key)})
        .where((F.col("version") > F.col("_floor")) & ((F.col("tag") == "live") | ((F.col("tag") == "cell") & (F.col("seq") > F.col("_floor")))))
    )
    return ranked.groupBy(*STATE_SORT).agg(
        F.map_from_entries(F.collect_list(F.when(F.col("tag") == "cell", F.struct("name", "value")))).alias("cells"),
        F.max("version").alias("version"),
    ).select(*STATE_KEY, "cells", "version")


def records_of_state(state: DataFrame, seq: int | Column) -> DataFrame:
    """Reduced records of loaded state rows, as if every row had been inserted at ``seq``."""
    at = F.lit(seq).cast("long") if isinstance(seq, int) else seq
    rows = state.select("source_key", "row_key", at.alias("seq"), F.explode(F.concat(
        F.array(F.struct(F.lit("live").alias("tag"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("value"))),
        F.transform(F.map_entries("cells"), lambda e: F.struct(F.lit("cell").alias("tag"), F.lower(e["key"]).alias("name"), e["value"].alias("value"))),
    )).alias("r"))
    return rows.select("source_key", "row_key", "r.tag", "r.name", "seq", "r.value")


def apply_on(records: DataFrame, changes: DataFrame, keys_col: str | None = None, connector: str = DEFAULT_CONNECTOR, reverse: bool = True,
             keep_old_key: bool = False, clean: bool = True) -> DataFrame:
    """State after ``changes`` on top of records, e.g. of an initial load: cells that an UPDATE leaves alone keep
    their loaded value, and deletes and truncations of loaded rows take effect."""
    keyed = with_row_keys(changes, keys_col, connector, reverse)
    wipes = wipes_of(records).unionByName(source_wipes(changes)).groupBy("source_key").agg(F.max("wipe_seq").alias("wipe_seq"))
    return materialize(reduce_contributions(records.unionByName(contributions(keyed, keep_old_key, clean))), wipes)


def apply_changes(
    changes: DataFrame,
    keys_col: str | None = None,
    connector: str = DEFAULT_CONNECTOR,
    reverse: bool = True,
    keep_old_key: bool = False,
    clean: bool = True,
) -> DataFrame:
    """Current state after a change log: ``(source_key, row_key, cells, version)``."""
    keyed = with_row_keys(changes, keys_col, connector, reverse)
    return materialize(reduce_contributions(contributions(keyed, keep_old_key, clean)), source_wipes(changes))


def to_columns(state: DataFrame, columns: list[str], extra: list[str] | None = None) -> DataFrame:
    """Typed view of a state: one STRING column per cell name."""
    return state.select(*(extra if extra is not None else ["row_key"]), *[F.col("cells").getItem(c.lower()).alias(c) for c in columns])


def state_from_rows(rows: DataFrame, src: str | Column, key_cols: list[str], value_cols: dict[str, Column] | None = None,
                    connector: str = DEFAULT_CONNECTOR, reverse: bool = True, clean: bool = True) -> DataFrame:
    """State rows from a relational table (the initial load's shape)."""
    from tidemark.functions.cells import clean_value
    from tidemark.functions.keys import row_key_from_columns

    src_col = F.lit(src) if isinstance(src, str) else src
    cols = value_cols or {c: F.col(c).cast("string") for c in rows.columns}
    entries = F.array(*[F.struct(F.lit(n.lower()).alias("key"), (clean_value(v) if clean else v).alias("value")) for n, v in cols.items()])
    return rows.select(
        src_col.alias("source_key"),
        row_key_from_columns(key_cols, src_col, connector, reverse).alias("row_key"),
        F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())).alias("cells"),
    )
