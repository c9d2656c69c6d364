"""Struct types shared by all operators (the change-log contract)."""

from __future__ import annotations

from pyspark.sql import types as T

# One column of a row image: name, key flag, updated flag, null flag, text value.
CELL = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("is_key", T.BooleanType()),
        T.StructField("updated", T.BooleanType()),
        T.StructField("is_null", T.BooleanType()),
        T.StructField("value", T.StringType()),
    ]
)

IMAGE = T.ArrayType(CELL)

# The change log: one row per changed row (or per schema event).
CHANGELOG = T.StructType(
    [
        T.StructField("source_key", T.StringType()),
        T.StructField("database", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("exec_time", T.TimestampNTZType()),
        T.StructField("op", T.StringType()),
        T.StructField("ddl", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("before", IMAGE),
        T.StructField("after", IMAGE),
    ]
)

CHANGELOG_COLUMNS = [f.name for f in CHANGELOG.fields]

# Event kinds.  Row events change data; the rest are schema or control events.
INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"
ROW_OPS = (INSERT, UPDATE, DELETE)
TRUNCATE, ERASE = "TRUNCATE", "ERASE"  # ERASE = drop table
SOURCE_WIPE_OPS = (TRUNCATE, ERASE)
SCHEMA_OPS = ("ALTER", "CREATE", "RENAME", TRUNCATE, ERASE, "CINDEX", "DINDEX")
IGNORED_OPS = ("QUERY", "CINDEX", "DINDEX")

# Status marks of an increment table.
INSERTED, UPDATED, DELETED = "INSERTED", "UPDATED", "DELETED"
STATUS_COLUMN = "final_status"
