"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the test tables (or change logs Spark derives from them)
and runs a tidemark operator over all of it.  Computed columns are aliased
to the names used by the DuckDB oracle in ``tidemark.plans.oracle``.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import keys as K
from tidemark.functions.cells import clean_value
from tidemark.operators import apply as A
from tidemark.operators import audit as AU
from tidemark.operators import ddl as DDL
from tidemark.operators import load as L
from tidemark.operators import mapping as M
from tidemark.operators import monitor as MON
from tidemark.operators import rollup as R
from tidemark.operators import schema_apply as SA
from tidemark.operators import schema_events as SE
from tidemark.sources import decode as DEC
from tidemark.operators import segments as SG
from tidemark.schema import CHANGELOG, STATUS_COLUMN
from tidemark.sources import fixtures as FX
from tidemark.session import scratch_path
from tidemark.sources.tables import table
from tidemark.streaming import apply_stream as STR
from tidemark.streaming import decode_stream as DST
from tidemark.streaming import forward as FWD
from tidemark.streaming import metrics as MET
from tidemark.streaming import rollup_stream as RST
from tidemark.streaming import segments_stream as SEGS
from tidemark.streaming import versions_stream as VS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current orders table after the orders change log."""
    state = A.apply_changes(FX.orders_changelog(spark, sf_dir))
    return A.to_columns(state, FX.ORDERS_COLUMNS, extra=["row_key", "version"])


def _both_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.orders_changelog(spark, sf_dir).unionByName(FX.events_changelog(spark, sf_dir))


@query
def segment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per source, daily segment and op."""
    return SG.segment_counts(_both_logs(spark, sf_dir), SG.DAILY)


@query
def segment_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events opening a new daily segment per source (T2, with re-triggers)."""
    log = _both_logs(spark, sf_dir).select("source_key", "seq", "exec_time")
    return SG.segment_changes(FX.stored(log, "both"), SG.DAILY)


@query
def increment_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily increment table of app.users with final status."""
    inc = SG.increment_table(FX.events_changelog(spark, sf_dir), SG.DAILY)
    return A.to_columns(inc, FX.EVENTS_COLUMNS + [STATUS_COLUMN], extra=["segment", "row_key"])


@query
def segment_counts_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per source, hourly segment and op."""
    return SG.segment_counts(_both_logs(spark, sf_dir), SG.HOURLY)


@query
def reset_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The barrier after one segment's signals were taken back."""
    ev = table(spark, sf_dir, "events")
    signals = ev.select(SG.segment_id("ts").alias("segment"), F.col("event_type").alias("instance"), F.col("ts").alias("ready_at"))
    return SG.segment_ready(SG.reset_signal(signals, "20240110"), instances=5)


SNAPSHOT_BOUNDARY = "2024-01-15 00:00:00"


@query
def snapshot_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of app.users as of a segment start."""
    snap = SG.snapshot_at(FX.events_changelog(spark, sf_dir), SNAPSHOT_BOUNDARY)
    return A.to_columns(snap, FX.EVENTS_COLUMNS, extra=["row_key", "version"])


@query
def segment_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily barrier over five instances (event types) signalling."""
    ev = table(spark, sf_dir, "events")
    signals = ev.select(SG.segment_id("ts").alias("segment"), F.col("event_type").alias("instance"), F.col("ts").alias("ready_at"))
    return SG.segment_ready(signals, instances=5)


@query
def rollup_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SUM roll-up of lineitem quantity per return flag and line status (G1)."""
    li = table(spark, sf_dir, "lineitem")
    return R.rollup_sum(li, ["l_returnflag", "l_linestatus"], ["l_quantity"], "rollup.lineitem")


@query
def rollup_sum_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SUM roll-up of prices with fractions and of a whole-number column per supplier (G1)."""
    li = table(spark, sf_dir, "lineitem")
    return R.rollup_sum(li, ["l_suppkey"], ["l_extendedprice", "l_linenumber"], "rollup.lineitem")


@query
def rollup_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COUNT roll-up of lineitem per supplier."""
    return R.rollup_count(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "count.lineitem")


@query
def rollup_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page-wise partial sums of lineitem (pages of 1000 order keys) added up."""
    li = table(spark, sf_dir, "lineitem")
    return R.rollup_paged(li, "l_orderkey", 1000, ["l_returnflag", "l_linestatus"], ["l_quantity"], "rollup.lineitem")


@query
def rollup_sum_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SUM of order totals per status, fed by inserts of absent rows."""
    return R.rollup_sum_stream(FX.stored(FX.orders_changelog(spark, sf_dir), "orders"), ["o_orderstatus"], ["o_totalprice"], "rollup.orders")


@query
def rollup_count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COUNT of orders per status, fed by inserts of absent rows."""
    return R.rollup_count_stream(FX.stored(FX.orders_changelog(spark, sf_dir), "orders"), ["o_orderstatus"], "count.orders")


# ---- sources, keys and loads -------------------------------------------------

SHARD_PATTERN = r"^shop_a\.customer_\d+$|^shop_b\.supplier$"

# Configuration: source -> destination mapping (FIXTURES.md 4.3).  One source
# is mapped to a destination that does not exist, conversations are unmapped.
MAPPING_ROWS = [
    ("shop.orders", "orders_dest", ["o_orderkey"], "1996-01-01 00:00:00", False),
    ("app.users", "users_dest", ["user_id"], "2024-01-10 00:00:00", True),
    ("shop_a.customer_0", "party", ["c_custkey"], "2024-01-01 00:00:00", False),
    ("shop_b.supplier", "party", ["c_custkey"], "2024-01-01 00:00:00", True),
    ("shop_a.customer_1", "ghost", ["c_custkey"], "2024-01-01 00:00:00", False),
]
DESTINATIONS = ["orders_dest", "users_dest", "party"]


def mapping_frame(spark: SparkSession) -> DataFrame:
    rows = [(s, d, k, r, re_) for s, d, k, r, re_ in MAPPING_ROWS]
    df = spark.createDataFrame(rows, "source_key string, destination string, keys array<string>, registered_at string, reinitialize boolean")
    return df.withColumn("registered_at", F.col("registered_at").cast("timestamp_ntz"))


def _three_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both_logs(spark, sf_dir).unionByName(FX.conversations_changelog(spark, sf_dir))


@query
def initial_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full scan of part with a field list into keyed cells."""
    fields = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]
    state = L.initial_load(table(spark, sf_dir, "part"), "shop.part", ["p_partkey"], fields)
    return A.to_columns(state, fields)


@query
def paged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 1000 order keys with bounds and row counts."""
    return L.page_summary(table(spark, sf_dir, "orders"), "o_orderkey", 1000)


@query
def paged_scan_signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a key that begins below zero and is null in some rows."""
    o = table(spark, sf_dir, "orders")
    return L.page_summary(o.select(F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderkey") - 5000).alias("k")), "k", 1000)


@query
def shard_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer shards and the renamed supplier table as one keyed frame."""
    u = L.shard_union(FX.party_shards(spark, sf_dir), SHARD_PATTERN, ["c_custkey"])
    return u.select("source_key", "row_key", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")


@query
def row_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composite row keys of conversation turns, keys in name order (K1-K3)."""
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", K.row_key_from_columns(["turn", "conv_id"], F.lit(FX.CONVERSATIONS_SOURCE)).alias("row_key"))


@query
def key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null, duplicate and colliding keys of lineitem, orders and conversations."""
    checks = [
        L.key_check(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem"),
        L.key_check(table(spark, sf_dir, "orders"), ["o_orderkey"], "orders"),
        L.key_check(table(spark, sf_dir, "conversations"), ["conv_id", "turn"], "conversations"),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


@query
def load_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """load / reload / skip per wanted source against the mapping."""
    wanted = _three_logs(spark, sf_dir).select("source_key").unionByName(
        L.shard_union(FX.party_shards(spark, sf_dir), SHARD_PATTERN, ["c_custkey"]).select("source_key")
    )
    return L.load_plan(wanted, mapping_frame(spark))


def _orders_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(*[v.alias(c) for c, v in FX.orders_values().items()])


@query
def load_then_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders loaded from their table, then the changes after the load applied on top."""
    loaded = L.load_records(_orders_rows(spark, sf_dir), FX.ORDERS_SOURCE, ["o_orderkey"])
    later = FX.orders_changelog(spark, sf_dir).where("seq % 10 <> 0")
    return A.to_columns(A.apply_on(loaded, later), FX.ORDERS_COLUMNS, extra=["row_key", "version"])


@query
def reload_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders reloaded in the middle of their change log: older changes go, newer ones apply."""
    rows = _orders_rows(spark, sf_dir)
    at = table(spark, sf_dir, "orders").select(F.floor(F.max("o_orderkey") / 2) * 10 + 5).scalar()
    state = A.apply_on(L.reload_records(rows, FX.ORDERS_SOURCE, ["o_orderkey"], at), FX.orders_changelog(spark, sf_dir))
    return A.to_columns(state, FX.ORDERS_COLUMNS, extra=["row_key", "version"])


# Both sources go to one destination; orders are keyed by customer, not by their physical key.
ROUTES = [("shop.orders", "people_dest", ["o_custkey"]), ("app.users", "people_dest", None)]


@query
def apply_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of a destination shared by two sources, one under a logical key."""
    mapping = spark.createDataFrame(ROUTES, "source_key string, destination string, keys array<string>")
    state = M.apply_routed(_three_logs(spark, sf_dir), mapping)
    return A.to_columns(state, FX.ORDERS_COLUMNS + FX.EVENTS_COLUMNS, extra=["destination", "source_key", "row_key", "version"])


@query
def source_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source keys from database and table behind a host prefix, per table of a log (K1)."""
    log = _three_logs(spark, sf_dir).unionByName(FX.ddl_changelog_fixture(spark, sf_dir))
    return log.groupBy(K.source_key("database", "table", "db1:3306/").alias("full_key"), "source_key").agg(F.count(F.lit(1)).alias("n_events"))


def _ranges(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, f"ranges-{uuid.uuid4().hex}")
    L.write_ranges(L.initial_load(table(spark, sf_dir, "orders"), FX.ORDERS_SOURCE, ["o_orderkey"]), path, 11)
    return path


@query
def range_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders state written in 11 contiguous row-key ranges: bounds and sizes of the files read back (K6)."""
    rows = L.read_ranges(spark, _ranges(spark, sf_dir))
    return rows.groupBy("region").agg(F.min("row_key").alias("start_key"), F.max("row_key").alias("end_key"), F.count(F.lit(1)).alias("n_rows"))


@query
def range_layout_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the files of a range layout: all rows in them, no two ranges overlapping, a file each, as
    large as the stored split points say; and how many rows the look-up of three keys finds, one of them missing (K6)."""
    path = _ranges(spark, sf_dir)
    rows = L.read_ranges(spark, path).withColumn("file", F.input_file_name())
    r = rows.groupBy("region").agg(F.min("row_key").alias("start_key"), F.max("row_key").alias("end_key"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct("file").alias("n_files"))
    before = F.lag("end_key").over(Window.orderBy("start_key"))
    r = r.withColumn("apart", F.coalesce(before < F.col("start_key"), F.lit(True)) & (F.col("start_key") <= F.col("end_key")))
    stored = L.range_splits(spark, path).select("region", F.col("start_key").alias("s"), F.col("end_key").alias("e"), F.col("n_rows").alias("n"))
    r = r.join(stored, "region", "full").withColumn("as_stored", (F.col("s") == F.col("start_key")) & (F.col("e") == F.col("end_key")) & (F.col("n") == F.col("n_rows")))
    lo, hi = rows.agg(F.min("row_key"), F.max("row_key")).first()
    found = [L.look_up(spark, path, k).count() for k in (lo, hi, lo + "?")]
    return r.agg(F.sum("n_rows").cast("long").alias("n_rows"), F.min("apart").alias("apart"), (F.count("*") <= 11).alias("at_most_11"), F.max("n_files").alias("n_files"),
                 F.min("as_stored").alias("as_stored")).withColumn("found", F.lit(",".join(map(str, found))))


@query
def paged_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders under a key with growing gaps and nulls read in eight pages: sizes and bounds."""
    o = table(spark, sf_dir, "orders")
    keyed = FX.stored(o.select(F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderkey") * F.col("o_orderkey")).alias("k"), "o_custkey"), "gappy")
    per = L.read_pages(keyed, "k", 8).groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi"))
    w = Window.orderBy("lo")
    per = per.withColumn("apart", F.coalesce(F.lag("hi").over(w) < F.col("lo"), F.lit(True)))
    keys = F.when(F.col("lo").isNotNull(), F.col("n"))
    return per.agg(F.sum("n").alias("n_rows"), F.sum(F.when(F.col("lo").isNull(), F.col("n"))).alias("n_null"), F.count("lo").alias("n_pages"),
                   F.min(F.when(F.col("lo").isNotNull(), F.col("apart"))).alias("apart"), (F.max(keys) <= 2 * F.min(keys)).alias("balanced"))


@query
def decode_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON change entries (with transaction markers) decoded to change rows."""
    feed = DEC.encode_entries(FX.events_changelog(spark, sf_dir))
    ch = A.with_row_keys(DEC.decode_changes(feed))
    return ch.select("source_key", "seq", "op", "row_key", F.size(F.coalesce("after", "before")).alias("n_cells"))


@query
def decode_multirow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of many rows decoded with their values and times."""
    ch = DEC.decode_changes(FX.multirow_entries(spark, sf_dir))
    cells = F.map_from_entries(F.transform("after", lambda c: F.struct(c["name"], c["value"])))
    return ch.select("source_key", "seq", "op", "exec_time", *[cells[c].alias(c) for c in ("event_id", "event_type", "props")])


@query
def decode_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a feed that are no entries, with the reason."""
    feed = DEC.encode_entries(FX.events_changelog(spark, sf_dir)).unionByName(FX.broken_lines(spark, sf_dir))
    return DEC.decode_rejects(feed)


@query
def subscription_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of tables matching the subscription pattern, counted per op."""
    ch = M.subscription_filter(_three_logs(spark, sf_dir), r"^(shop|chat)\..*")
    return ch.groupBy("source_key", "op").agg(F.count(F.lit(1)).alias("n_events"))


@query
def cells_from_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written after-cells of users changes (null skipped, null+updated = '')."""
    return AU.written_cells(FX.events_changelog(spark, sf_dir)).select("seq", "name", "value")


@query
def clean_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document texts with control-character runs replaced by one space (P10)."""
    d = table(spark, sf_dir, "documents")
    cleaned = clean_value(F.col("text"))
    return d.select("doc_id", cleaned.alias("text_clean"), (cleaned != F.col("text")).alias("changed"))


@query
def route_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes routed to their destination; unmapped sources dropped."""
    r = M.route_changes(_three_logs(spark, sf_dir), mapping_frame(spark))
    return r.groupBy("destination", "source_key", "op").agg(F.count(F.lit(1)).alias("n_events"))


# Events of a mapping: registered, moved to another destination, renamed, removed, registered again.
MAPPING_EVENTS = [
    (1, "add", "shop.orders", None, "orders_dest", "1992-01-01 00:00:00"),
    (2, "rename", "shop.orders", "shop.archive", None, "1996-01-01 00:00:00"),
    (3, "add", "shop.orders", None, "orders_new", "1997-06-01 00:00:00"),
    (4, "add", "app.users", None, "users_a", "2024-01-05 00:00:00"),
    (5, "add", "app.users", None, "users_b", "2024-01-12 00:00:00"),
    (6, "remove", "app.users", None, None, "2024-01-20 00:00:00"),
    (7, "add", "app.users", None, "users_a", "2024-01-25 12:00:00"),
    (8, "add", "chat.later", None, "chat_dest", "2024-01-01 00:00:00"),
    (9, "rename", "chat.later", "chat.conversations", None, "2024-02-01 12:00:00"),
]


@query
def route_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes under the mapping in force at their time, while it changes."""
    events = spark.createDataFrame([(n, op, s, new, d, [s], at) for n, op, s, new, d, at in MAPPING_EVENTS],
                                   "seq long, op string, source_key string, new_source_key string, destination string, keys array<string>, at string")
    history = M.mapping_history(events.withColumn("at", F.col("at").cast("timestamp_ntz")))
    r = M.route_as_of(_three_logs(spark, sf_dir), history)
    return r.groupBy("destination", "source_key", F.array_join("keys", ",").alias("key_list"), "op").agg(F.count(F.lit(1)).alias("n_events"))


FORWARD_NOW = "2030-01-01 00:00:00"


@query
def forward_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes newer than the mapping's registration time."""
    f = M.forward_filter(_three_logs(spark, sf_dir), mapping_frame(spark), FORWARD_NOW)
    return f.groupBy("source_key", "op").agg(F.count(F.lit(1)).alias("n_events"))


@query
def mapping_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapping after a mapping log, kept only for existing destinations (M1, M2).

    The log registers every source seen in the change logs at its first
    event; configured rows then rename app.users twice, rename a source that is
    not mapped, and remove the supplier shard.
    """
    logs = _three_logs(spark, sf_dir)
    cfg = mapping_frame(spark)
    seen = logs.groupBy("source_key").agg(F.min("seq").alias("seq"), F.min("exec_time").alias("at"))
    adds = seen.join(cfg.select("source_key", "destination", "keys"), "source_key", "left").select(
        "seq", F.lit("add").alias("op"), "source_key", F.lit(None).cast("string").alias("new_source_key"),
        F.coalesce("destination", F.lit("unrouted")).alias("destination"), "keys", "at")
    shard_adds = cfg.where(F.col("source_key").startswith("shop_")).select(
        F.lit(0).cast("long").alias("seq"), F.lit("add").alias("op"), "source_key", F.lit(None).cast("string").alias("new_source_key"),
        "destination", "keys", F.col("registered_at").alias("at"))
    edits = spark.createDataFrame(
        [(2**62, "rename", "app.users", "app.people", None, None, "2024-01-31 00:00:00"),
         (2**62 + 1, "rename", "app.people", "app.members", None, None, "2024-02-01 00:00:00"),
         (2**62 + 2, "rename", "app.nobody", "app.users", None, None, "2024-02-01 00:00:00"),
         (2**62 + 3, "remove", "shop_b.supplier", None, None, None, "2024-02-01 00:00:00")],
        "seq long, op string, source_key string, new_source_key string, destination string, keys array<string>, at string",
    ).withColumn("at", F.col("at").cast("timestamp_ntz"))
    log = adds.unionByName(shard_adds).unionByName(edits)
    dest = spark.createDataFrame([(d,) for d in DESTINATIONS], "destination string")
    return M.mapping_state(log, dest).select("source_key", "destination", "registered_at")


@query
def substring_index_fn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """substring_index of page URLs by '/' and '.' for counts -3..3."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    ns = F.explode(F.array(*[F.lit(n) for n in range(-3, 4)])).alias("n")
    seps = F.explode(F.array(F.lit("/"), F.lit("."))).alias("sep")
    x = p.select("page_id", "url", ns).select("page_id", "url", "n", seps)
    return x.select("page_id", "n", "sep", F.expr("substring_index(url, sep, n)").alias("part"))


# ---- per-change views --------------------------------------------------------


@query
def column_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column-level audit of conversation changes, whole values."""
    return AU.column_audit(FX.conversations_changelog(spark, sf_dir))


@query
def cell_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last two versions of every cell of every live users row."""
    return AU.cell_versions(FX.stored(FX.events_changelog(spark, sf_dir), "events"), n=2).select("row_key", "name", "version", "value", "seq")


# ---- schema events on a state ------------------------------------------------


def _two_source_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.apply_changes(_both_logs(spark, sf_dir))


@query
def source_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of app.users out of a state shared with shop.orders."""
    s = SE.source_slice(_two_source_state(spark, sf_dir), FX.EVENTS_SOURCE)
    return A.to_columns(s, FX.EVENTS_COLUMNS, extra=["row_key", "version"])


@query
def drop_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders state after DROP COLUMN o_orderpriority (D3)."""
    s = SE.drop_column(_two_source_state(spark, sf_dir), FX.ORDERS_SOURCE, "O_ORDERPRIORITY")
    s = SE.source_slice(s, FX.ORDERS_SOURCE)
    return A.to_columns(s, FX.ORDERS_COLUMNS, extra=["row_key", F.size("cells").alias("n_cells")])


@query
def rename_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders state after CHANGE COLUMN o_orderstatus -> o_status."""
    s = SE.rename_column(_two_source_state(spark, sf_dir), FX.ORDERS_SOURCE, "o_orderstatus", "O_Status")
    s = SE.source_slice(s, FX.ORDERS_SOURCE)
    return A.to_columns(s, ["o_orderkey", "o_status", "o_orderstatus"], extra=["row_key", F.size("cells").alias("n_cells")])


@query
def rekey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders re-keyed on (o_custkey, o_orderkey) after a key change."""
    s = SE.rekey(_two_source_state(spark, sf_dir), FX.ORDERS_SOURCE, ["o_orderkey", "o_custkey"])
    return A.to_columns(SE.source_slice(s, FX.ORDERS_SOURCE), ["o_orderkey", "o_custkey"])


@query
def rename_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """app.users renamed to app.members with new row keys."""
    s = SE.rename_source(_two_source_state(spark, sf_dir), FX.EVENTS_SOURCE, "app.members", ["user_id"])
    return s.groupBy("source_key").agg(F.count(F.lit(1)).alias("n_rows"), F.min("row_key").alias("min_row_key"), F.max("row_key").alias("max_row_key"))


@query
def stop_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key dropped without replacement: slice deleted, mapping removed."""
    state, mapping = SE.stop_source(_two_source_state(spark, sf_dir), mapping_frame(spark), FX.ORDERS_SOURCE)
    routed = M.route_changes(_both_logs(spark, sf_dir), mapping).groupBy("source_key").agg(F.count(F.lit(1)).alias("n_routed"))
    rows = state.groupBy("source_key").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.join(routed, "source_key", "full")


# ---- monitoring --------------------------------------------------------------

# Parameters of the monitoring queries (never the wall clock).
BATCH_SECONDS = 60
IDLE_THRESHOLD = 10
LAG_THRESHOLD_SECONDS = 1200
LAG_CHECK_EVERY = 15
IGNORED_HOURS = [0, 1, 2, 3, 4]


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MON.batch_metrics(spark, FX.stored(FX.events_changelog(spark, sf_dir).select("exec_time"), "events"), BATCH_SECONDS)


@query
def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per one-minute batch: changes, last exec time seen, idle counter (O3)."""
    return MON.progress(_metrics(spark, sf_dir), IDLE_THRESHOLD)


@query
def idle_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts after more than 10 consecutive empty batches, then reset (O2)."""
    return MON.idle_alerts(_metrics(spark, sf_dir), IDLE_THRESHOLD)


@query
def lag_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag >= 20 min at checks every 15 batches, not while idle; hours 0-4 muted (O1)."""
    return MON.lag_alerts(_metrics(spark, sf_dir), IDLE_THRESHOLD, LAG_THRESHOLD_SECONDS, LAG_CHECK_EVERY, IGNORED_HOURS)


# ---- schema events -----------------------------------------------------------


@query
def ddl_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DDL events cut into classified sub-changes with names and effects."""
    return DDL.ddl_changelog(FX.ddl_changelog_fixture(spark, sf_dir))


@query
def op_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per kind with their dispatch class over row and schema logs."""
    return AU.op_summary(_three_logs(spark, sf_dir).unionByName(FX.ddl_changelog_fixture(spark, sf_dir)))


@query
def truncate_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders state when a TRUNCATE sits in the middle of the log."""
    log = FX.orders_changelog(spark, sf_dir).unionByName(FX.orders_truncate_event(spark, sf_dir))
    return A.to_columns(A.apply_changes(log), FX.ORDERS_COLUMNS, extra=["row_key", "version"])


# Configuration: table groups (explicit list, else pattern; logical keys win).
GROUP_RULES = [
    ("orders", "shop", ["orders"], None, None),
    ("users", "app", None, "^user", ["user_id"]),
    ("chat", "chat", None, "^conv", None),
    ("parts", "shop", None, "^parts_[0-9]+$", ["id"]),
]


@query
def resolve_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of all logs assigned to table groups with their keys."""
    logs = _three_logs(spark, sf_dir).unionByName(FX.ddl_changelog_fixture(spark, sf_dir))
    rules = spark.createDataFrame(GROUP_RULES, "group_name string, database string, tables array<string>, pattern string, logical_keys array<string>")
    return L.resolve_groups(L.source_listing(logs), rules)


# ---- streaming ---------------------------------------------------------------


@query
def stream_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """users state from a file stream of the change log: 8 parts of shuffled
    rows, 2 parts per micro-batch (S5, A5)."""
    run = scratch_path(spark, f"stream-apply-{uuid.uuid4().hex}")
    src, state, ckpt = f"{run}/input", f"{run}/state", f"{run}/checkpoint"
    each = FX.write_events(spark, sf_dir, src, 8)
    st = STR.apply_stream_once(spark, src, state, ckpt, max_files_per_trigger=2 * each)
    return A.to_columns(st, FX.EVENTS_COLUMNS, extra=["row_key", "version"])


@query
def forward_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes newer than their registration as JSON entries on the instance topic."""
    return FWD.forward_json(_three_logs(spark, sf_dir), mapping_frame(spark), FORWARD_NOW, "instance_1")


@query
def forward_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forwarded JSON entries read back."""
    v = "database string, table string, exec_time string, op string, seq long, after array<struct<name:string,value:string>>"
    f = forward_json(spark, sf_dir).where("source_key = 'app.users'").select("topic", F.from_json("value", v).alias("v"))
    cells = F.map_from_entries(F.transform(F.coalesce("v.after", F.array().cast("array<struct<name:string,value:string>>")), lambda c: F.struct(c["name"], c["value"])))
    return f.select("topic", "v.database", "v.table", F.col("v.exec_time").cast("timestamp_ntz").alias("exec_time"), "v.op", "v.seq", cells["event_type"].alias("event_type"))


@query
def stream_schema_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of apply_schema_events from a stream: a rename chain and a
    column drop arrive between row changes, one chunk of seq-ordered changes a
    micro-batch (D3, D4, A5)."""
    run = scratch_path(spark, f"stream-schema-{uuid.uuid4().hex}")
    log = FX.orders_changelog(spark, sf_dir).unionByName(FX.orders_schema_events(spark, sf_dir))
    each = FX.write_in_seq_order(log, f"{run}/input", chunks=4)
    st = STR.apply_stream_once(spark, f"{run}/input", f"{run}/state", f"{run}/checkpoint", max_files_per_trigger=each)
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_status", "o_state", "o_totalprice", "o_orderdate", "o_orderpriority"]
    return A.to_columns(st, cols, extra=["row_key", "version"])


@query
def stream_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """apply_routed from a stream that reads the mapping anew for each micro-batch."""
    run = scratch_path(spark, f"stream-routed-{uuid.uuid4().hex}")
    mapping = spark.createDataFrame(ROUTES, "source_key string, destination string, keys array<string>")
    mapping.write.parquet(f"{run}/mapping")
    each = FX.write_shuffled(_three_logs(spark, sf_dir), f"{run}/input", 4, FX.rows_of(spark, sf_dir, "orders", "events", "conversations"))
    STR.apply_stream_once(spark, f"{run}/input", f"{run}/state", f"{run}/checkpoint", max_files_per_trigger=2 * each, mapping_path=f"{run}/mapping")
    state = STR.states_by_destination(spark, f"{run}/state", mapping)
    return A.to_columns(state, FX.ORDERS_COLUMNS + FX.EVENTS_COLUMNS, extra=["destination", "source_key", "row_key", "version"])


@query
def stream_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream whose mapping table gains a source between micro-batches: that source's changes are applied from
    then on (D9, P7, A5)."""
    run = scratch_path(spark, f"stream-remap-{uuid.uuid4().hex}")
    late = F.col("seq") > FX.orders_truncate_event(spark, sf_dir).select(F.max("seq")).scalar()
    log = _both_logs(spark, sf_dir)
    for routes, part in ((ROUTES[1:], ~late), (ROUTES, late)):
        spark.createDataFrame(routes, "source_key string, destination string, keys array<string>").coalesce(1).write.mode("overwrite").parquet(f"{run}/mapping")
        log.where(part).write.mode("append").parquet(f"{run}/input")
        files = len(spark.read.parquet(f"{run}/input").inputFiles())  # each part is one micro-batch
        state = STR.apply_stream_once(spark, f"{run}/input", f"{run}/state", f"{run}/checkpoint", max_files_per_trigger=max(100, files), mapping_path=f"{run}/mapping")
    return A.to_columns(state, FX.ORDERS_COLUMNS + FX.EVENTS_COLUMNS, extra=["source_key", "row_key", "version"])


@query
def forward_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes forwarded by a stream that looks at the clock in each micro-batch: of a source that is not mapped,
    those newer than the look-up (P8, W3)."""
    run = scratch_path(spark, f"forward-{uuid.uuid4().hex}")
    each = FX.write_in_time_order(FX.events_changelog(spark, sf_dir), f"{run}/input", chunk_days=6)
    mapping_frame(spark).where("source_key <> 'app.users'").write.parquet(f"{run}/mapping")
    src = STR.change_stream(spark, f"{run}/input", max_files_per_trigger=each)
    FWD.write_forward_stream(src, f"{run}/mapping", "instance_1", f"{run}/out", f"{run}/checkpoint", clock=lambda b: f"2024-01-{4 + 6 * b:02} 00:00:00").awaitTermination()
    v = F.from_json("value", "op string, seq long")
    return FWD.read_forwarded(spark, f"{run}/out").select("topic", "batch", v.alias("v")).select("topic", "batch", "v.op", "v.seq")


@query
def versions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last two versions of cell_versions kept by a stream of shuffled rows."""
    run = scratch_path(spark, f"versions-{uuid.uuid4().hex}")
    each = FX.write_events(spark, sf_dir, f"{run}/input", 4)
    VS.run_versions_stream(STR.change_stream(spark, f"{run}/input", max_files_per_trigger=2 * each), f"{run}/out", f"{run}/checkpoint", 2).awaitTermination()
    return VS.current_versions(spark, f"{run}/out", 2).select("row_key", "name", "version", "value", "seq")


def _feed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """State and dead letters of a stream over a JSON feed with broken lines in it."""
    run = scratch_path(spark, f"feed-{uuid.uuid4().hex}")
    lines = DEC.encode_entries(FX.events_changelog(spark, sf_dir)).unionByName(FX.broken_lines(spark, sf_dir))
    each = FX.write_feed(lines, f"{run}/input", rows=FX.rows_of(spark, sf_dir, "events"))
    DST.run_feed_stream(spark, f"{run}/input", f"{run}/state", f"{run}/dead", f"{run}/checkpoint", max_files_per_trigger=2 * each).awaitTermination()
    return STR.current_state(spark, f"{run}/state"), DST.read_dead_letters(spark, f"{run}/dead")


@query
def feed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """users state from a stream over serialized entries, broken lines among them."""
    return A.to_columns(_feed(spark, sf_dir)[0], FX.EVENTS_COLUMNS, extra=["row_key", "version"])


@query
def feed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that this stream set aside, with the reason."""
    return _feed(spark, sf_dir)[1]


IDLE_YEARS, LAG_YEARS_SECONDS, LAG_EVERY_YEARS = 10, 200 * 86400, 3


@query
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress, idle alerts and lag of a real stream, from the row that each micro-batch wrote: one fetch a year
    over all logs, twenty-five years of them empty (O1, O2, O3)."""
    run = scratch_path(spark, f"progress-{uuid.uuid4().hex}")
    landing = FX.land_years(_three_logs(spark, sf_dir), f"{run}/input")
    first = next(landing)

    def counted(batch: DataFrame, batch_id: int) -> None:
        SG.segment_counts(batch).write.mode("overwrite").parquet(f"{run}/counts/batch={batch_id}")

    process = MET.metered(counted, f"{run}/metrics", clock=lambda b: f"{first + b + 1}-01-01 00:00:00")
    src = spark.readStream.schema(CHANGELOG).parquet(f"{run}/input")  # a year's files are one micro-batch
    for _ in itertools.chain([first], landing):
        src.writeStream.foreachBatch(process).option("checkpointLocation", f"{run}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    m = MON.metrics_of_batches(MET.batch_rows(spark, f"{run}/metrics"))
    idle = MON.idle_alerts(m, IDLE_YEARS).select("batch_id", F.lit(True).alias("idle_alert"))
    lag = MON.lag_alerts(m, IDLE_YEARS, LAG_YEARS_SECONDS, LAG_EVERY_YEARS, [1]).select("batch_id", "delay_seconds")
    return MON.progress(m, IDLE_YEARS).join(idle, "batch_id", "left").join(lag, "batch_id", "left").withColumn("idle_alert", F.coalesce("idle_alert", F.lit(False)))


@query
def schema_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notice rows (source, normalised DDL) for fully understood schema events."""
    return DDL.schema_notices(FX.ddl_changelog_fixture(spark, sf_dir))


@query
def apply_schema_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders state when column renames (a chain) and a column drop sit in the
    log between row changes: cells follow their column's events in seq order."""
    log = FX.orders_changelog(spark, sf_dir).unionByName(FX.orders_schema_events(spark, sf_dir))
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_status", "o_state", "o_totalprice", "o_orderdate", "o_orderpriority"]
    return A.to_columns(SA.apply_with_schema(log), cols, extra=["row_key", "version"])


@query
def apply_rename_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders state when a RENAME TABLE sits in the middle of the log: earlier
    rows move, later changes come under the new name (D5, K5)."""
    log = FX.orders_after(spark, sf_dir, source="shop.orders_new").unionByName(FX.orders_ddl(spark, sf_dir, "rename table orders to orders_new", "RENAME"))
    return A.to_columns(SA.apply_log(log), FX.ORDERS_COLUMNS, extra=["source_key", "row_key", "version"])


@query
def apply_rekey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders state when the key changes to the customer in the middle of the log."""
    event = FX.orders_ddl(spark, sf_dir, "alter table orders drop primary key, add primary key (o_custkey)")
    log = FX.orders_after(spark, sf_dir, key="o_custkey").unionByName(event)
    return A.to_columns(SA.apply_log(log), FX.ORDERS_COLUMNS, extra=["row_key", "version"])


@query
def apply_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of both sources when orders lose their key in the middle of the log."""
    log = _both_logs(spark, sf_dir).unionByName(FX.orders_ddl(spark, sf_dir, "alter table orders drop primary key"))
    return A.to_columns(SA.apply_log(log), FX.EVENTS_COLUMNS, extra=["source_key", "row_key", "version"])


@query
def apply_rekeys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of 20 sources with 50 key changes between their rows."""
    state = SA.apply_log(FX.stored(FX.orders_keys_changelog(spark, sf_dir), "keys"))
    return A.to_columns(state, FX.ORDERS_COLUMNS, extra=["source_key", "row_key", "version"])


@query
def apply_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources that change names in one statement, through the name of a dropped one."""
    state = SA.apply_log(FX.swapped_sources_log(spark, sf_dir))
    return A.to_columns(state, FX.ORDERS_COLUMNS, extra=["source_key", "row_key", "version"])


@query
def apply_erase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders state when the table is dropped in the middle of the log."""
    log = FX.orders_changelog(spark, sf_dir).unionByName(FX.orders_ddl(spark, sf_dir, "drop table orders", "ERASE"))
    return A.to_columns(SA.apply_log(log), FX.ORDERS_COLUMNS, extra=["row_key", "version"])


def _streamed(spark: SparkSession, log: DataFrame, name: str, chunks: int = 3) -> DataFrame:
    """The state of a log that lands in ``chunks`` consecutive parts, one a micro-batch."""
    run = scratch_path(spark, f"stream-{name}-{uuid.uuid4().hex}")
    each = FX.write_in_seq_order(log, f"{run}/input", chunks=chunks)
    return STR.apply_stream_once(spark, f"{run}/input", f"{run}/state", f"{run}/checkpoint", max_files_per_trigger=each)


@query
def stream_rename_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of apply_rename_source from a stream."""
    log = FX.orders_after(spark, sf_dir, source="shop.orders_new").unionByName(FX.orders_ddl(spark, sf_dir, "rename table orders to orders_new", "RENAME"))
    return A.to_columns(_streamed(spark, log, "rename"), FX.ORDERS_COLUMNS, extra=["source_key", "row_key", "version"])


@query
def stream_rekey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of apply_rekey from a stream."""
    event = FX.orders_ddl(spark, sf_dir, "alter table orders drop primary key, add primary key (o_custkey)")
    log = FX.orders_after(spark, sf_dir, key="o_custkey").unionByName(event)
    return A.to_columns(_streamed(spark, log, "rekey"), FX.ORDERS_COLUMNS, extra=["row_key", "version"])


@query
def stream_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of apply_stop from a stream."""
    log = _both_logs(spark, sf_dir).unionByName(FX.orders_ddl(spark, sf_dir, "alter table orders drop primary key"))
    return A.to_columns(_streamed(spark, log, "stop"), FX.EVENTS_COLUMNS, extra=["source_key", "row_key", "version"])


@query
def stream_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of app.users that a stream writes when its changes open a day, one for each day but the first."""
    run = scratch_path(spark, f"stream-snapshots-{uuid.uuid4().hex}")
    each = FX.write_in_time_order(FX.events_changelog(spark, sf_dir), f"{run}/input", chunk_days=8)
    q = STR.run_apply_stream(spark, f"{run}/input", f"{run}/state", f"{run}/checkpoint", max_files_per_trigger=each, snapshots=f"{run}/snapshots")
    q.awaitTermination()
    return A.to_columns(STR.read_snapshots(spark, f"{run}/snapshots"), FX.EVENTS_COLUMNS, extra=["segment", "row_key", "version"])


@query
def idle_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silences of at least ten minutes between a source's real events (O2)."""
    return MON.idle_gaps(FX.stored(FX.events_changelog(spark, sf_dir).select("source_key", "seq", "exec_time"), "events"), 600)


STREAM_LATENESS = "1 hour"


@query
def segment_close_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily segments of the users log closed by the event-time watermark in a
    file stream (chunks land in time order, one per six days, one chunk per
    micro-batch); each closed segment's counts are emitted once (T1, T8)."""
    run = scratch_path(spark, f"segment-close-{uuid.uuid4().hex}")
    each = FX.write_in_time_order(FX.events_changelog(spark, sf_dir), f"{run}/input")
    q = SEGS.run_closed_segment_counts(STR.change_stream(spark, f"{run}/input", max_files_per_trigger=each), f"{run}/out", f"{run}/checkpoint",
                                       lateness=STREAM_LATENESS)
    q.awaitTermination()
    return spark.read.schema("source_key string, segment string, op string, n_events long").parquet(f"{run}/out")


BARRIER_DAYS = [6, 10, 15]  # of events that one chunk of each input holds


@query
def barrier_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily segments of three inputs that arrive at different speeds: a segment closes for all of them in the
    micro-batch after the slowest one has passed its end (T8, T9)."""
    run = scratch_path(spark, f"barrier-{uuid.uuid4().hex}")
    log = FX.events_changelog(spark, sf_dir)
    streams = []
    for i, days in enumerate(BARRIER_DAYS):
        each = FX.write_in_time_order(log.where(F.pmod("seq", F.lit(3)) == i), f"{run}/input{i}", chunk_days=days)
        streams.append(STR.change_stream(spark, f"{run}/input{i}", max_files_per_trigger=each))
    q = SEGS.run_barrier(streams, f"{run}/out", f"{run}/checkpoint", lateness=STREAM_LATENESS)
    q.awaitTermination()
    return SEGS.closed_segments(spark, f"{run}/out")


@query
def increment_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily increment tables of app.users kept by a file stream of shuffled rows."""
    run = scratch_path(spark, f"increment-stream-{uuid.uuid4().hex}")
    each = FX.write_events(spark, sf_dir, f"{run}/input", 4)
    q = SEGS.run_increment_stream(STR.change_stream(spark, f"{run}/input", max_files_per_trigger=2 * each), f"{run}/out", f"{run}/checkpoint")
    q.awaitTermination()
    return A.to_columns(SEGS.current_increments(spark, f"{run}/out"), FX.EVENTS_COLUMNS + [STATUS_COLUMN], extra=["segment", "row_key"])


@query
def rollup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SUM and COUNT of orders per status maintained by a file stream: each
    micro-batch adds the inserts that hit absent rows, judged against the last
    event of their rows in the stream's state (G3, G4, S8)."""
    run = scratch_path(spark, f"rollup-stream-{uuid.uuid4().hex}")
    each = FX.write_in_seq_order(FX.orders_changelog(spark, sf_dir), f"{run}/input", chunks=3)
    buckets = RST.buckets_for(table(spark, sf_dir, "orders").count())
    q = RST.run_rollup_stream(spark, f"{run}/input", f"{run}/rollup", f"{run}/checkpoint", ["o_orderstatus"], ["o_totalprice"], max_files_per_trigger=each, buckets=buckets)
    q.awaitTermination()
    return RST.current_rollup(spark, f"{run}/rollup", ["o_orderstatus"], ["o_totalprice"], "rollup.orders")
