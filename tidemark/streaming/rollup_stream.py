"""Insert-if-absent roll-ups maintained by a stream.

Whether an INSERT hits an absent row depends on the row's previous event, which
may be in any earlier micro-batch.  Spark's stateful operator keeps the last
event of every row key (its ``seq`` and kind), a state row for each bucket of row
keys, so a micro-batch looks up the buckets of its own keys only and reads no records of
earlier batches:

1. every event that touches a row key meets the key's last event, from the state
   or from the same batch (in ``seq`` order); INSERTs come out with it;
2. a row is absent if that event was a DELETE or an UPDATE to another key, or
   its source was truncated or dropped since, or there was none and the row is
   not among the ``loaded`` ones;
3. the partial SUM / COUNT per group of the batch's absent inserts is written as
   a delta ``<root>/delta/run=<run>/batch=<id>``, its truncations beside it.

The state is the stream's own, in its checkpoint: a replay starts from the same
version and overwrites the same folders.  The current roll-up is the sum of the
deltas (sums and counts are associative).  Changes of one row key are expected in
``seq`` order across micro-batches, as a change stream delivers them.  A hot
row key's events of one batch meet in one task, as Arrow batches in turn.  A call of
the operator costs about 1 ms, an event some microseconds, so with about 1000 row keys
a bucket (``buckets_for``) the calls weigh little; the number of buckets is fixed for
the life of a checkpoint.  At scale, set ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB one.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import row_key_from_columns
from tidemark.operators.joins import join_small
from tidemark.operators.rollup import SUM_TYPE, row_events, summed
from tidemark.schema import CHANGELOG, ROW_OPS, SOURCE_WIPE_OPS
from tidemark.streaming.records import run_of


_FIRST = -(2**63)  # stands for the place of an event that there was not


# Unless the caller knows better: enough for some 10 ** 8 row keys.
BUCKETS = 1 << 16
KEYS_PER_BUCKET = 1000


def buckets_for(keys: int) -> int:
    """Buckets for a stream that is to hold about so many row keys."""
    return max(64, -(-keys // KEYS_PER_BUCKET))


def _meet_last(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """INSERTs of one bucket of row keys with the event before them; the state keeps each key's newest event.

    Plain lists: a bucket has few events in a batch, and most of a frame's cost is making it."""
    rows, columns = [], []
    for part in parts:
        part = part.drop(columns="_bucket")
        columns = list(part.columns)
        rows += zip(*(part[c].tolist() for c in columns), strict=True)
    source, row, seq, op = (columns.index(c) for c in ("source_key", "row_key", "seq", "op"))
    rows.sort(key=lambda r: r[seq])
    last = pickle.loads(state.get[0]) if state.exists else {}
    out = []
    for r in rows:
        of = (r[source], r[row])
        if r[op] == "INSERT":
            out.append((*r, *last.get(of, (_FIRST, ""))))
        last[of] = (int(r[seq]), r[op])
    state.update((pickle.dumps(last, pickle.HIGHEST_PROTOCOL),))
    if out:
        yield pd.DataFrame(out, columns=[*columns, "prev_seq", "prev_op"])


def inserts_with_last(changes: DataFrame, fields: list[str], keys_col: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Of a stream of changes: its INSERTs ``(source_key, row_key, seq, op, *fields, prev_seq, prev_op)`` and,
    as rows without a row key, its truncations."""
    slim = row_events(changes.where(F.col("op").isin(*ROW_OPS)), fields, keys_col)
    schema = ", ".join(["source_key string, row_key string, seq long, op string", *(f"`{f}` string" for f in fields), "prev_seq long, prev_op string"])
    slim = slim.withColumn("_bucket", F.pmod(F.xxhash64("source_key", "row_key"), F.lit(buckets)).cast("int"))
    met = slim.groupBy("_bucket").applyInPandasWithState(_meet_last, schema, "last binary", "append", "NoTimeout")
    wipes = changes.where(F.col("op").isin(*SOURCE_WIPE_OPS)).select("source_key", F.lit(None).cast("string").alias("row_key"), "seq", "op")
    return met.unionByName(wipes, allowMissingColumns=True)


def absent(inserts: DataFrame, wipes: DataFrame, loaded: DataFrame | None = None) -> DataFrame:
    """The INSERTs whose row was absent.  ``wipes``: ``(source_key, seq)``; ``loaded``: ``(source_key, row_key)``."""
    times = wipes.groupBy("source_key").agg(F.sort_array(F.collect_set("seq")).alias("wipes"))
    since = F.get(F.filter("wipes", lambda w: (w < F.col("seq")) & (w > F.col("prev_seq"))), 0)
    known = F.lit(False)
    if loaded is not None:
        inserts = inserts.join(loaded.select("source_key", "row_key").distinct().withColumn("_known", F.lit(True)), ["source_key", "row_key"], "left")
        known = F.coalesce("_known", F.lit(False))
    gone = ((F.col("prev_op") == "") & ~known) | (F.col("prev_op") == "DELETE") | since.isNotNull()
    return join_small(inserts, times, "source_key", "left").where(gone)


def run_rollup_stream(spark: SparkSession, source_dir: str, root: str, checkpoint: str, groups: list[str], columns: list[str],
                      max_files_per_trigger: int = 1, loaded: DataFrame | None = None, available_now: bool = True, buckets: int = BUCKETS):
    """Start the stream; returns the streaming query.  ``buckets``: see ``buckets_for``."""
    run, wiped = run_of(checkpoint), "source_key string, seq long"
    spark.createDataFrame([], _delta_schema(groups, columns)).write.mode("overwrite").parquet(f"{root}/delta/run={run}/batch=-1")
    spark.createDataFrame([], wiped).write.mode("overwrite").parquet(f"{root}/wipes/run={run}/batch=-1")

    def fold(rows: DataFrame, batch_id: int) -> None:
        at = f"run={run}/batch={batch_id}"
        rows = rows.persist()  # both writes read it; the state is updated once
        try:
            rows.where("row_key is null").select("source_key", "seq").coalesce(1).write.mode("overwrite").parquet(f"{root}/wipes/{at}")
            wipes = rows.sparkSession.read.schema(wiped).option("recursiveFileLookup", "true").parquet(f"{root}/wipes")  # schema events
            hits = absent(rows.where("row_key is not null"), wipes, loaded)
            part = hits.groupBy(*groups).agg(F.count(F.lit(1)).alias("count"), *[summed(hits, c).alias(c) for c in columns])
            part.write.mode("overwrite").parquet(f"{root}/delta/{at}")
        finally:
            rows.unpersist()

    src = spark.readStream.schema(CHANGELOG).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir)
    out = inserts_with_last(src, list(dict.fromkeys([*groups, *columns])), buckets=buckets)
    w = out.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")).start()


def _delta_schema(groups: list[str], columns: list[str]) -> str:
    return ", ".join([*(f"{x} string" for x in groups), "count long", *(f"{c} {SUM_TYPE}" for c in columns)])


def current_rollup(spark: SparkSession, root: str, groups: list[str], columns: list[str], dest: str,
                   sum_suffix: str = "_accumulation") -> DataFrame:
    """Roll-up table: deltas added up, keyed like the batch roll-ups."""
    g = sorted(groups, key=str.lower)
    deltas = spark.read.schema(_delta_schema(groups, columns)).option("recursiveFileLookup", "true").parquet(f"{root}/delta")
    agg = deltas.groupBy(*g).agg(F.sum("count").cast("long").alias("count"), *[F.sum(c).alias(c + sum_suffix) for c in columns])
    return agg.select(row_key_from_columns(g, F.lit(dest)).alias("row_key"), *g, "count", *[c + sum_suffix for c in columns])
