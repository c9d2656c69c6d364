"""Mapping of sources to destinations: state of a mapping log, routing,
forwarding filter and subscription filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import apply as A
from tidemark.operators.joins import join_small


def mapping_state(mapping_log: DataFrame, destinations: DataFrame | None = None) -> DataFrame:
    """Current mapping from a log of ``(seq, op, source_key, new_source_key,
    destination, keys, at)`` with ops add / remove / rename, newest wins per
    source key.  A rename moves what the old key maps to, destination and keys,
    to the new key; renaming a source that is not mapped changes nothing.  With
    ``destinations`` (column ``destination``), only mappings to existing
    destinations are kept (left-semi join).

    Sources that no rename names need one aggregate.  The events of the others,
    configuration as they are, are folded in order of ``seq``.
    """
    renames = mapping_log.where(F.col("op") == "rename")
    named = renames.select(F.explode(F.array("source_key", "new_source_key")).alias("source_key")).distinct()
    plain = mapping_log.join(named, "source_key", "left_anti").groupBy("source_key").agg(F.max(F.struct("seq", "op", "destination", "keys", "at")).alias("m"))
    live = plain.where(F.col("m.op") == "add").select("source_key", "m.destination", "m.keys", F.col("m.at").alias("registered_at"))
    events = mapping_log.join(named, "source_key", "left_semi").agg(
        F.sort_array(F.collect_list(F.struct("seq", "op", "source_key", "new_source_key", "destination", "keys", "at"))).alias("events"))
    kind = f"map<string,struct<destination:string,keys:array<string>,registered_at:{mapping_log.schema['at'].dataType.simpleString()}>>"
    fold = f"""aggregate(events, cast(map() as {kind}), (m, e) -> case
        when e.op = 'add' then map_concat(map_filter(m, (k, v) -> k <> e.source_key), map(e.source_key, struct(e.destination as destination, e.keys as keys, e.at as registered_at)))
        when e.op = 'remove' then map_filter(m, (k, v) -> k <> e.source_key)
        when map_contains_key(m, e.source_key) then map_concat(map_filter(m, (k, v) -> k <> e.source_key and k <> e.new_source_key),
            map(e.new_source_key, struct(m[e.source_key].destination as destination, m[e.source_key].keys as keys, e.at as registered_at)))
        else m end)"""
    moved = events.select(F.explode(F.expr(fold)).alias("source_key", "v")).select("source_key", "v.destination", "v.keys", "v.registered_at")
    live = live.unionByName(moved)
    if destinations is not None:
        live = join_small(live, destinations.select("destination").distinct(), "destination", "left_semi")
    return live


def mapping_history(mapping_log: DataFrame) -> DataFrame:
    """``(source_key, at, seq, destination, keys)``: what each source is mapped to from a time on, null where it is
    not mapped any more.  ``mapping_log``: as for ``mapping_state``; its events hold in order of ``(at, seq)``.

    Sources that no rename names need no fold; the events of the others are folded with what they close and open.
    """
    renames = mapping_log.where(F.col("op") == "rename")
    named = renames.select(F.explode(F.array("source_key", "new_source_key")).alias("source_key")).distinct()
    added = F.col("op") == "add"
    plain = mapping_log.join(named, "source_key", "left_anti").where("op <> 'rename'").select(
        "source_key", "at", "seq", F.when(added, F.col("destination")).alias("destination"), F.when(added, F.col("keys")).alias("keys"))
    events = mapping_log.join(named, "source_key", "left_semi").agg(
        F.sort_array(F.collect_list(F.struct("at", "seq", "op", "source_key", "new_source_key", "destination", "keys"))).alias("events"))
    time = mapping_log.schema["at"].dataType.simpleString()
    entry = f"struct<source_key:string,at:{time},seq:bigint,destination:string,keys:array<string>>"
    live = "map<string,struct<destination:string,keys:array<string>>>"

    def opened(source: str, destination: str, keys: str) -> str:
        return f"named_struct('source_key', {source}, 'at', e.at, 'seq', e.seq, 'destination', {destination}, 'keys', {keys})"

    without = "map_filter(acc.m, (k, v) -> k <> e.source_key"
    gone = opened("e.source_key", "cast(null as string)", "cast(null as array<string>)")
    fold = f"""aggregate(events, named_struct('m', cast(map() as {live}), 'h', cast(array() as array<{entry}>)), (acc, e) -> case
        when e.op = 'add' then named_struct('m', map_concat({without}), map(e.source_key, named_struct('destination', e.destination, 'keys', e.keys))),
            'h', concat(acc.h, array({opened("e.source_key", "e.destination", "e.keys")})))
        when e.op = 'remove' then named_struct('m', {without}), 'h', concat(acc.h, array({gone})))
        when map_contains_key(acc.m, e.source_key) then named_struct(
            'm', map_concat({without} and k <> e.new_source_key), map(e.new_source_key, acc.m[e.source_key])),
            'h', concat(acc.h, array({gone}, {opened("e.new_source_key", "acc.m[e.source_key].destination", "acc.m[e.source_key].keys")})))
        else acc end).h"""
    moved = events.select(F.explode(F.expr(fold)).alias("x")).select("x.*")
    return plain.unionByName(moved)


def route_as_of(changes: DataFrame, history: DataFrame) -> DataFrame:
    """Changes with the ``destination`` and ``keys`` that their source was mapped to at their ``exec_time``; those
    of a source not mapped then are dropped.

    A source's entries travel as one sorted array in a broadcast look-up, so the changes, a hot source's among
    them, stay where they are.  Entries of one time hold in order of ``seq``, from that time on.
    """
    per = history.groupBy("source_key").agg(F.sort_array(F.collect_list(F.struct("at", "seq", "destination", "keys"))).alias("_entries"))
    last = F.element_at(F.filter("_entries", lambda e: e["at"] <= F.col("exec_time")), -1)
    known = join_small(changes, per, "source_key", "inner").where(F.exists("_entries", lambda e: e["at"] <= F.col("exec_time")))
    return known.withColumn("_entry", last).select(*changes.columns, "_entry.destination", "_entry.keys").where("destination is not null")


def route_changes(changes: DataFrame, mapping: DataFrame) -> DataFrame:
    """Changes of mapped sources with their destination; unmapped are dropped."""
    return join_small(changes, mapping.select("source_key", "destination", "keys"), "source_key", "inner")


def apply_routed(changes: DataFrame, mapping: DataFrame, **kw) -> DataFrame:
    """State of every destination: changes of mapped sources, keyed by their
    mapping's logical keys (the images' key columns where it names none), applied
    and tagged with ``destination``.  Sources that share a destination stay apart
    by their source key in the row keys."""
    state = A.apply_changes(route_changes(changes, mapping), keys_col="keys", **kw)
    return join_small(state, mapping.select("source_key", "destination"), "source_key", "inner")


def forward_filter(changes: DataFrame, mapping: DataFrame, now: str) -> DataFrame:
    """Changes newer than their source's registration time; an unmapped
    source counts as registered ``now``, so nothing older passes."""
    m = mapping.select("source_key", "registered_at")
    j = join_small(changes, m, "source_key", "left")
    reg = F.coalesce(F.col("registered_at"), F.lit(now).cast("timestamp_ntz"))
    return j.where(F.col("exec_time") > reg).drop("registered_at")


def subscription_filter(changes: DataFrame, pattern: str) -> DataFrame:
    """Changes whose ``database.table`` matches ``pattern``; empty = keep all."""
    if not pattern:
        return changes
    return changes.where(F.concat_ws(".", "database", "table").rlike(pattern))
