"""Schema-event log: DDL statements -> classified sub-changes and notices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ddl as D

# Event kinds whose ddl text is parsed (QUERY and index events are ignored).
DDL_OPS = ("ALTER", "CREATE", "RENAME", "TRUNCATE", "ERASE")

# Data effect of each clause kind (statement-level key changes handled below).
EFFECT = {
    "rename_table": "rename_source",
    "rename_column": "rename_column",
    "change_column": "rename_column",
    "drop_column": "drop_column",
    "truncate": "wipe",
    "drop_table": "wipe",
    "create": "refresh_mapping",
}


def _statements(ddl_log: DataFrame) -> DataFrame:
    """``(source_key, seq, norm, stmt_kind, parts, kinds)`` of every DDL event: its clauses and what they are."""
    if "op" in ddl_log.columns:
        ddl_log = ddl_log.where(F.col("op").isin(*DDL_OPS))
    s = ddl_log.where(F.col("ddl").isNotNull()).select("source_key", "seq", _once(norm=D.normalise(F.col("ddl"))))
    s = s.select("source_key", "seq", "x.norm", _once(stmt_kind=D.statement_kind(F.col("x.norm"))))
    s = s.select("source_key", "seq", "norm", "x.stmt_kind", _once(parts=D.clauses(F.col("norm"), F.col("x.stmt_kind"))))
    s = s.select("source_key", "seq", "norm", "stmt_kind", "x.parts", _once(kinds=F.transform("x.parts", lambda c: D.clause_kind(F.col("stmt_kind"), c))))
    return s.select("source_key", "seq", "norm", "stmt_kind", "parts", "x.kinds")


def _once(**columns: Column) -> Column:
    """Columns in a struct ``x`` that the optimizer does not copy into every use of theirs."""
    return F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("x")


def ddl_changelog(ddl_log: DataFrame) -> DataFrame:
    """One row per sub-change of every DDL event ``(source_key, seq, ddl)``:
    ``clause_no`` (1-based), ``kind``, ``old_name``, ``new_name``, ``key_list``
    and ``effect``.  A statement that drops the primary key and adds one
    re-keys the source; dropping it alone stops following the source; adding
    one alone changes nothing.  A change column keeping its name is a no-op.
    What a statement holds is known before its clauses are exploded, so
    nothing is shuffled."""
    s = _statements(ddl_log)
    x = s.select(
        "source_key", "seq", "stmt_kind",
        F.regexp_extract("norm", D.TARGET, 1).alias("target"),
        F.array_contains("kinds", "add_key").alias("has_add"),
        F.array_contains("kinds", "drop_key").alias("has_drop"),
        F.posexplode(F.arrays_zip("parts", "kinds")).alias("pos", "c"),
    ).withColumn("clause", F.col("c.parts")).withColumn("kind", F.col("c.kinds"))
    old, new = D.clause_names(F.col("stmt_kind"), F.col("kind"), F.col("clause"), F.col("target"))
    kind = F.when((F.col("kind") == "change_column") & (old == new), "noop").otherwise(F.col("kind"))
    x = x.select("source_key", "seq", "pos", "clause", "has_add", "has_drop", _once(kind=kind, old_name=old, new_name=new)).select("*", "x.*").drop("x")
    effect = F.lit(None).cast("string")
    for k, e in EFFECT.items():
        effect = F.when(F.col("kind") == k, F.lit(e)).otherwise(effect)
    effect = (
        F.when(F.col("kind").isin("add_key", "drop_key") & F.col("has_add") & F.col("has_drop"), "rekey")
        .when((F.col("kind") == "drop_key") & ~F.col("has_add"), "stop")
        .when(F.col("kind") == "unknown", "error")
        .otherwise(F.coalesce(effect, F.lit("none")))
    )
    return x.select(
        "source_key", "seq", (F.col("pos") + 1).cast("long").alias("clause_no"), "kind", "old_name", "new_name",
        F.when(F.col("kind") == "add_key", D.key_list(F.col("clause"))).alias("key_list"), effect.alias("effect"),
    )


def schema_notices(ddl_log: DataFrame) -> DataFrame:
    """Notice rows ``(source_key, seq, ddl)`` for statements whose every
    sub-change was understood (the reference alerts after success)."""
    return _statements(ddl_log).where(~F.array_contains("kinds", "unknown")).select("source_key", "seq", F.col("norm").alias("ddl"))
