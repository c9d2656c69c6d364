"""Apply with schema events folded in, in ``seq`` order, for batches and streams alike.

Records keep the source, row key and column names they were written under; what
schema events make of them later is resolved when they are read, from the event
table alone, which is tiny next to the records:

* **Tables.** A name stands for one table between two RENAMEs that touch it.
  A record's *table* is its source name with the number of renames of that name
  before it; renames lead from table to table, the last one gives the name that
  rows end under.  Pairs of one statement act one after another.
* **Columns.** The first column event on a cell's name after the cell decides its
  fate: DROP COLUMN removes it, a rename moves it to the new name, where the next
  event decides again.
* **Keys.** Key changes number the generations of a table.  Each record is of the
  generation that its ``seq`` falls in; generation by generation, for all tables
  at once, the rows are reduced and go on under keys from their cells.
* **Stops.** The records of a table that lost its key without another are left out.

Chains of events are followed by pointer doubling; records meet the events in one
look-up, a broadcast join behind a size check.  The plan of a round of keys is
the same for any number of events, and rounds are written to the shared folder.
TRUNCATE / DROP TABLE are records (source tombstones) and hold for their table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import DEFAULT_CONNECTOR, joined_key
from tidemark.operators import apply as A
from tidemark.operators.ddl import DDL_OPS, ddl_changelog
from tidemark.operators.joins import fetched, join_small
from tidemark.schema import SOURCE_WIPE_OPS
from tidemark.session import ensure_checkpoint_dir, scratch_path

# Effects of schema events that change rows written before them.
COLUMN_EFFECTS = ("drop_column", "rename_column")
TABLE_EFFECTS = ("rename_source", "rekey", "stop")
EVENT = "effect string, old_name string, new_name string, key_list string, clause_no long"
EVENT_COLUMNS = ["source_key", "seq", *[c.split()[0] for c in EVENT.split(", ")]]


def schema_events(changes: DataFrame) -> DataFrame:
    """The sub-changes of a log's DDL statements that change rows: ``EVENT_COLUMNS``."""
    ddl = ddl_changelog(changes.where(F.col("op").isin(*DDL_OPS)))
    ddl = ddl.where(F.col("effect").isin(*COLUMN_EFFECTS, *TABLE_EFFECTS) & ((F.col("effect") != "rekey") | F.col("key_list").isNotNull()))
    return ddl.select(*EVENT_COLUMNS)


def column_events(changes: DataFrame) -> DataFrame:
    """``(source_key, name, seq, dropped, new_name)`` for every column event."""
    return column_events_of(schema_events(changes))


def column_events_of(events: DataFrame) -> DataFrame:
    """The column events among schema events."""
    return events.where(F.col("effect").isin(*COLUMN_EFFECTS)).select(
        "source_key",
        F.lower("old_name").alias("name"),
        "seq",
        (F.col("effect") == "drop_column").alias("dropped"),
        F.lower("new_name").alias("new_name"),
    )


def _ends(links: DataFrame) -> DataFrame:
    """``(node, end)`` of chains given as ``(node, next)``: the distance covered doubles each round."""
    ensure_checkpoint_dir(links.sparkSession)
    at = links.select("node", F.col("next").alias("end")).checkpoint()
    while True:
        far = at.select(F.col("node").alias("end"), F.col("end").alias("further"))
        new = at.join(far, "end", "left").select("node", "end", "further").checkpoint()
        if new.where("further is not null").isEmpty():
            return at
        at = new.select("node", F.coalesce("further", "end").alias("end"))


def column_fates(events: DataFrame) -> DataFrame:
    """Final fate of every column event: ``(source_key, name, seq, dropped, final_name)``."""
    by_name = events.groupBy("source_key", "name").agg(F.sort_array(F.collect_list(F.struct("seq", "dropped", "new_name"))).alias("evs"))
    node = F.struct("source_key", "name", "seq")
    links = (
        events.where("not dropped").select("source_key", node.alias("node"), "seq", F.col("new_name").alias("name"))
        .join(by_name, ["source_key", "name"])
        .withColumn("next_seq", F.get(F.filter("evs", lambda e: e["seq"] > F.col("seq")), 0)["seq"])
        .where("next_seq is not null")
        .select("node", F.struct("source_key", "name", F.col("next_seq").alias("seq")).alias("next"))
    )
    last = events.withColumn("node", node).join(_ends(links), "node", "left").withColumn("end", F.coalesce("end", "node"))
    fate = events.select(node.alias("end"), F.col("dropped").alias("gone"), F.col("new_name").alias("final_name"))
    return last.select("source_key", "name", "seq", "end").join(fate, "end").select("source_key", "name", "seq", F.col("gone").alias("dropped"), "final_name")


def remap_cells(contrib: DataFrame, fates: DataFrame) -> DataFrame:
    """Cells renamed or removed by the first column event after them."""
    table = fates.groupBy("source_key", "name").agg(F.sort_array(F.collect_list(F.struct("seq", "dropped", "final_name"))).alias("fates"))
    j = join_small(contrib, table, ["source_key", "name"], "left")
    first = F.get(F.filter("fates", lambda e: e["seq"] > F.col("seq")), 0)
    j = j.withColumn("_f", F.when(F.col("fates").isNotNull() & (F.col("tag") == "cell"), first))
    return j.where(F.col("_f").isNull() | ~F.col("_f.dropped")).select(
        "source_key", "row_key", "tag",
        F.coalesce(F.col("_f.final_name"), F.col("name")).alias("name"),
        "seq", "value",
    )


def apply_with_schema(changes: DataFrame, keys_col: str | None = None, **kw) -> DataFrame:
    """Current state after a log holding row changes and schema events, columns
    and truncations only (``apply_log`` has them all)."""
    keyed = A.with_row_keys(changes.where(F.col("op").isin("INSERT", "UPDATE", "DELETE")), keys_col)
    contrib = A.contributions(keyed, kw.get("keep_old_key", False), kw.get("clean", True))
    fates = column_fates(column_events(changes))
    return A.materialize(A.reduce_contributions(remap_cells(contrib, fates)), A.source_wipes(changes))


def source_renames(events: DataFrame) -> DataFrame:
    """``(old, new, at)`` of every RENAME TABLE pair; ``at`` is its place, statement and clause."""
    database = F.substring_index("source_key", ".", 1)

    def full(name: str) -> Column:
        return F.when(F.col(name).contains("."), F.col(name)).otherwise(F.concat(database, F.lit("."), F.col(name)))

    pairs = events.where("effect = 'rename_source'").select(full("old_name").alias("old"), full("new_name").alias("new"), F.struct("seq", "clause_no").alias("at"))
    return pairs.where("old <> new").distinct()


# A table inside the fold: the name and how many renames touched that name before.
_TABLE = "{name} || '\\u0000' || {times}"


def _tables(renames: DataFrame) -> DataFrame:
    """``(source_key, touched, lasts)`` of every name in a rename: when it was touched, and for the tables
    that it stood for, in order, the table that their rows end in."""
    touched = renames.select(F.explode(F.array("old", "new")).alias("source_key"), "at").groupBy("source_key").agg(F.sort_array(F.collect_set("at")).alias("touched"))
    old = renames.join(touched.withColumnRenamed("source_key", "old"), "old").withColumn("before", F.size(F.filter("touched", lambda t: t < F.col("at")))).drop("touched")
    both = old.join(touched.withColumnRenamed("source_key", "new"), "new").withColumn("after", F.size(F.filter("touched", lambda t: t <= F.col("at"))))
    links = both.select(F.expr(_TABLE.format(name="old", times="before")).alias("node"), F.expr(_TABLE.format(name="new", times="after")).alias("next"))
    each = touched.select("source_key", "touched", F.posexplode(F.expr("sequence(0, size(touched))")).alias("i", "_")).withColumn("node", F.expr(_TABLE.format(name="source_key", times="i")))
    ended = each.join(_ends(links), "node", "left").withColumn("end", F.coalesce("end", "node"))
    return ended.groupBy("source_key", "touched").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "end"))), lambda x: x["end"]).alias("lasts"))


def _in_tables(rows: DataFrame, tables: DataFrame | None) -> DataFrame:
    """Rows with the table they end in as ``source_key``."""
    if tables is None:
        return rows
    here = F.struct(F.col("seq"), F.lit(0).cast("long").alias("clause_no"))
    j = join_small(rows, tables, "source_key", "left")
    end = F.get("lasts", F.size(F.filter("touched", lambda t: t < here)))
    return j.withColumn("source_key", F.coalesce(end, "source_key")).select(*rows.columns)


def _rekeyed(records: DataFrame, changes: DataFrame, connector: str, reverse: bool) -> DataFrame:
    """Records under the keys of their table's last generation.

    ``changes``: ``(source_key, seq, keys)``.  Round g reduces the rows of generation g of all tables that
    have a next one, those carried over and those written then, and writes them with keys of generation
    g + 1; there are as many rounds as one table has key changes.
    """
    spark = records.sparkSession
    table = changes.groupBy("source_key").agg(F.sort_array(F.collect_set(F.struct("seq", "keys"))).alias("changes"))
    rounds = table.agg(F.max(F.size("changes"))).first()[0] or 0
    of = F.coalesce(F.size(F.filter("changes", lambda e: e["seq"] < F.col("seq"))), F.lit(0))
    numbered = join_small(records, table, "source_key", "left").withColumns({"generation": of, "last": F.coalesce(F.size("changes"), F.lit(0))})
    newest = numbered.groupBy(*A.REDUCED_SORT, "generation", "last").agg(F.max(F.struct("seq", "value")).alias("m"))
    fields = [*A.REDUCED_KEY, "seq", "value"]
    root = scratch_path(spark, f"generations/{uuid.uuid4().hex}")
    newest.select(*A.REDUCED_KEY, "m.seq", "m.value", "last", "generation").write.partitionBy("generation").parquet(f"{root}/written")
    kinds = "source_key string, row_key string, tag string, name string, seq long, value string, last int"
    schema = f"{kinds}, generation int"
    spark.createDataFrame([], kinds).write.parquet(f"{root}/carried/generation=0")

    def stored() -> DataFrame:
        carried = spark.read.schema(schema).option("basePath", f"{root}/carried").parquet(f"{root}/carried/generation=*")
        return spark.read.schema(schema).parquet(f"{root}/written").unionByName(carried)

    for g in range(rounds):
        now = stored().where((F.col("generation") == g) & (F.col("last") > g))
        state = A.materialize(A.reduce_contributions(now), A.wipes_of(now))
        keys = table.select("source_key", F.get("changes", F.lit(g))["keys"].alias("keys"), F.size("changes").alias("last")).where("keys is not null")
        state = join_small(state, keys, "source_key")
        values = F.transform("keys", lambda k: F.coalesce(F.element_at("cells", k), F.lit("")))
        state = state.withColumn("row_key", F.concat(joined_key(values, connector, reverse), F.lit(connector)))
        carried = join_small(A.records_of_state(state, F.col("version")), keys.select("source_key", "last"), "source_key")
        carried.select(*fields, "last").write.mode("overwrite").parquet(f"{root}/carried/generation={g + 1}")
    return stored().where("generation = last").select(*fields)


def fold_events(records: DataFrame, events: DataFrame, wipes: DataFrame, connector: str = DEFAULT_CONNECTOR, reverse: bool = True) -> DataFrame:
    """State after records and all schema events: final names of sources and columns, last keys, no stopped sources.

    ``records``: those of ``apply.contributions`` or their reduction, as long as records on both sides of an
    event that touches them were reduced apart.  ``events``: ``EVENT_COLUMNS``; ``wipes``: ``(source_key, seq)``.
    """
    ensure_checkpoint_dir(records.sparkSession)
    events = events.select(*EVENT_COLUMNS)
    few = fetched(events)
    events = events.checkpoint() if few is None else few
    effects = {r["effect"] for r in events.select("effect").distinct().collect()}  # at most five
    if not effects:
        return A.materialize(A.reduce_contributions(records), wipes.groupBy("source_key").agg(F.max("seq").alias("wipe_seq")))
    tables = _tables(source_renames(events)).checkpoint() if "rename_source" in effects else None
    # inside the fold a row key does without the source at its end
    bare = F.expr("left(row_key, greatest(char_length(row_key) - char_length(source_key), 0))")
    fields = [*A.REDUCED_KEY, "seq", "value"]
    records = _in_tables(records.select(*fields).withColumn("row_key", bare), tables)
    events = _in_tables(events.where("effect <> 'rename_source'"), tables)
    if effects & set(COLUMN_EFFECTS):
        records = remap_cells(records, column_fates(column_events_of(events)))
    if "stop" in effects:
        records = join_small(records, events.where("effect = 'stop'").select("source_key").distinct(), "source_key", "left_anti")
    if "rekey" in effects:
        keys = F.sort_array(F.transform(F.split("key_list", ","), lambda k: F.trim(F.lower(k))))
        records = _rekeyed(records, events.where("effect = 'rekey'").select("source_key", "seq", keys.alias("keys")), connector, reverse)
    # a truncation holds for its table, not for another one that takes the name later
    wiped = _in_tables(wipes.select("source_key", "seq"), tables).groupBy("source_key").agg(F.max("seq").alias("wiped"))
    records = join_small(records.where("tag <> 'wipe'"), wiped, "source_key", "left").where("wiped is null or seq > wiped")
    name = F.substring_index("source_key", "\u0000", 1)
    records = records.withColumn("source_key", name).withColumn("row_key", F.concat("row_key", "source_key")).select(*fields)
    return A.materialize(A.reduce_contributions(records), records.sparkSession.createDataFrame([], "source_key string, wipe_seq long"))


def apply_log(changes: DataFrame, keys_col: str | None = None, connector: str = DEFAULT_CONNECTOR, reverse: bool = True, **kw) -> DataFrame:
    """Current state after a log of row changes and all schema events, in ``seq`` order.

    * Columns dropped or renamed: as in ``apply_with_schema``, under whatever name the table has then.
    * RENAME TABLE: what came before it moves to the new source, row keys too; pairs
      of one statement in turn, so that names can be swapped.
    * A key dropped without another: the source's rows go, and its later changes
      are not followed.
    * A key change: the rows as of then get new row keys from their cells (of rows
      that meet under one key the newest cells stay); later changes go on from there.
    """
    keyed = A.with_row_keys(changes.where(F.col("op").isin("INSERT", "UPDATE", "DELETE", *SOURCE_WIPE_OPS)), keys_col, connector, reverse)
    records = A.contributions(keyed, kw.get("keep_old_key", False), kw.get("clean", True))
    wipes = changes.where(F.col("op").isin(*SOURCE_WIPE_OPS)).select("source_key", "seq")
    return fold_events(records, schema_events(changes), wipes, connector, reverse)
