"""Decode serialized change entries (JSON lines) into the change-log schema.

An entry carries one event type for many rows, like a binlog entry:
``{entry_type, event_type, database, table, execute_time (epoch ms),
log_file, offset, ddl, rows: [{before, after}]}``.  Transaction markers are
dropped; each row becomes one change with ``seq`` folded from
(log file, offset, row index).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import CHANGELOG_COLUMNS, IMAGE, ROW_OPS

ENTRY = T.StructType(
    [
        T.StructField("entry_type", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("database", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("execute_time", T.LongType()),
        T.StructField("log_file", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("ddl", T.StringType()),
        T.StructField("rows", T.ArrayType(T.StructType([T.StructField("before", IMAGE), T.StructField("after", IMAGE)]))),
    ]
)

# Transaction marker entry types, dropped before decoding.
TRANSACTION_MARKERS = ("TRANSACTIONBEGIN", "TRANSACTIONEND")
# seq = ((log_file << OFFSET_BITS) + offset) << ROW_BITS + row index: 32 768 log files of 4 GiB, 65 536 rows an entry
FILE_BITS, OFFSET_BITS, ROW_BITS = 15, 32, 16


def fold_seq(log_file: Column, offset: Column, row: Column) -> Column:
    """One BIGINT in the order of (log file, offset, row); a value that does not
    fit raises, as a folded seq would silently collide with another."""
    fits = log_file.between(0, 2**FILE_BITS - 1) & offset.between(0, 2**OFFSET_BITS - 1) & row.between(0, 2**ROW_BITS - 1)
    place = F.concat_ws(", ", log_file, offset, row)
    return F.when(fits, F.shiftleft(F.shiftleft(log_file, OFFSET_BITS) + offset, ROW_BITS) + row).otherwise(
        F.raise_error(F.concat(F.lit("log file, offset or row index out of range: "), place)).cast("long"))


def decode_changes(lines: DataFrame, value_col: str = "value", source_prefix: str = "") -> DataFrame:
    """JSON entries -> change-log rows (one per row of every data entry).
    Lines that cannot be decoded are in ``decode_rejects``."""
    return changes_of(read_entries(lines, value_col), source_prefix)


def read_entries(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Each line as its entry ``e`` or, if it is none, its text and the ``reason``: ``(value, reason, e)``.

    A line is parsed once, by a generator of one row: a filter on what it gives is
    not moved below it, where it would parse the line again for every field."""
    line = F.col(value_col)
    once = F.inline(F.array(F.struct(F.from_json(line, ENTRY).alias("e"), F.try_parse_json(line).isNotNull().alias("parsed"))))
    judged = lines.select(line.alias("value"), once).select("value", reject_reason().alias("reason"), "e")
    return judged.select(F.when(F.col("reason").isNotNull(), F.col("value")).alias("value"), "reason", "e")


def changes_of(entries: DataFrame, source_prefix: str = "") -> DataFrame:
    """The changes among ``read_entries``."""
    data = entries.where("reason is null").select("e.*").where(~F.col("entry_type").isin(*TRANSACTION_MARKERS))
    rows = data.select("*", F.posexplode_outer("rows").alias("_pos", "_row"))
    return rows.select(
        F.concat(F.lit(source_prefix), F.col("database"), F.lit("."), F.col("table")).alias("source_key"),
        "database",
        "table",
        F.timestamp_millis("execute_time").cast("timestamp_ntz").alias("exec_time"),
        F.upper("event_type").alias("op"),
        "ddl",
        fold_seq(F.coalesce("log_file", F.lit(0)), F.col("offset"), F.coalesce("_pos", F.lit(0))).alias("seq"),
        F.col("_row.before").alias("before"),
        F.col("_row.after").alias("after"),
    ).select(*CHANGELOG_COLUMNS)


def reject_reason() -> Column:
    """Why a line is no entry, from its text ``value``, its entry ``e`` and whether it is JSON at all (``parsed``);
    null for entries and transaction markers.

    An entry that would decode to a change without a source, an image or a place
    in the order is none: fields of another type than theirs are told from
    missing ones by their raw text."""
    line, e, parsed = F.col("value"), F.col("e"), F.col("parsed")
    marker = F.coalesce(e["entry_type"].isin(*TRANSACTION_MARKERS), F.lit(False))
    of_rows = F.upper(e["event_type"]).isin(*ROW_OPS)

    def mistyped(field: str) -> Column:
        return e[field].isNull() & F.get_json_object(line, f"$.{field}").isNotNull()

    no_image = F.exists(F.coalesce(e["rows"], F.array().cast(ENTRY["rows"].dataType)), lambda r: r.isNull() | (r["before"].isNull() & r["after"].isNull()))
    place = F.coalesce(e["log_file"], F.lit(0)).between(0, 2**FILE_BITS - 1) & e["offset"].between(0, 2**OFFSET_BITS - 1)
    place = place & (F.coalesce(F.size(e["rows"]), F.lit(0)) <= 2**ROW_BITS)
    return (
        F.when(~parsed | line.isNull(), "not JSON")
        .when(e["entry_type"].isNull(), "no entry type")
        .when(~marker & e["event_type"].isNull(), "no event type")
        .when(~marker & (mistyped("offset") | mistyped("log_file") | mistyped("execute_time")), "a number is none")
        .when(~marker & e["offset"].isNull(), "no offset")
        .when(~marker & (F.coalesce(e["database"], F.lit("")) == ""), "no database")
        .when(~marker & (F.coalesce(e["table"], F.lit("")) == "") & of_rows, "no table")
        .when(~marker & mistyped("rows"), "rows are no list of images")
        .when(~marker & of_rows & (F.coalesce(F.size(e["rows"]), F.lit(0)) <= 0), "no rows")
        .when(~marker & of_rows & no_image, "a row without images")
        .when(~marker & ~place, "out of range")
    )


def decode_rejects(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``(value, reason)`` of the lines that ``decode_changes`` leaves out,
    transaction markers aside."""
    return rejects_of(read_entries(lines, value_col))


def rejects_of(entries: DataFrame) -> DataFrame:
    """The lines among ``read_entries`` that are no entry."""
    return entries.where("reason is not null").select("value", "reason")


def encode_entries(changes: DataFrame, log_file: int = 0) -> DataFrame:
    """Change rows -> JSON entries with transaction markers (for tests and
    stand-in feeds); ``offset`` = the change's ``seq``."""
    base = [
        F.col("database"), F.col("table"), F.unix_millis(F.col("exec_time").cast("timestamp")).alias("execute_time"),
        F.lit(log_file).cast("long").alias("log_file"), F.col("seq").alias("offset"), F.col("ddl"),
    ]

    def entry(kind: Column, rows: Column) -> Column:
        return F.to_json(F.struct(kind.alias("entry_type"), F.col("op").alias("event_type"), *base, rows.alias("rows")))

    rows = F.array(F.struct(F.col("before"), F.col("after")))
    marks = F.array(
        entry(F.lit("TRANSACTIONBEGIN"), F.lit(None).cast(ENTRY["rows"].dataType)),
        entry(F.lit("ROWDATA"), rows),
        entry(F.lit("TRANSACTIONEND"), F.lit(None).cast(ENTRY["rows"].dataType)),
    )
    return changes.select(F.explode(marks).alias("value"))
