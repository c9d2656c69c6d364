"""Key expressions: source key, key values of a row image, row key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_CONNECTOR = "+"


def source_key(database: Column | str, table: Column | str, prefix: str = "") -> Column:
    """``<prefix><database>.<table>``; the prefix stands for ``host:port/``."""
    db = F.col(database) if isinstance(database, str) else database
    tb = F.col(table) if isinstance(table, str) else table
    return F.concat(F.lit(prefix), db, F.lit("."), tb)


def _in_key(keys: Column | None) -> Callable[[Column], Column]:
    if keys is None:
        return lambda c: F.coalesce(c["is_key"], F.lit(False))
    lowered = F.transform(keys, lambda k: F.lower(k))
    return lambda c: F.coalesce(F.array_contains(lowered, F.lower(c["name"])), c["is_key"], F.lit(False))


def key_values(image: Column, keys: Column | None = None) -> Column:
    """Values of the key columns of ``image``, ordered by column name.

    ``keys`` (ARRAY<STRING>) names the logical key; when absent, or null in a
    row, the ``is_key`` flags of the image decide.  A null value becomes ''.
    """
    picked = F.filter(image, _in_key(keys))
    ordered = F.array_sort(
        F.transform(picked, lambda c: F.struct(F.lower(c["name"]).alias("name"), c["value"].alias("value")))
    )
    return F.transform(ordered, lambda c: F.coalesce(c["value"], F.lit("")))


def joined_key(values: Column, connector: str = DEFAULT_CONNECTOR, reverse: bool = True) -> Column:
    """join(values), optionally reversed as one string, which spreads sequential ids over the key space."""
    joined = F.array_join(values, connector)
    return F.reverse(joined) if reverse else joined


def row_key_from_values(values: Column, src: Column, connector: str = DEFAULT_CONNECTOR, reverse: bool = True) -> Column:
    """Row key = ``joined_key`` + connector + source key."""
    return F.concat(joined_key(values, connector, reverse), F.lit(connector), src)


def row_key_from_columns(cols: list[str], src: Column, connector: str = DEFAULT_CONNECTOR, reverse: bool = True) -> Column:
    """Row key of a relational row: key columns sorted by (lower-cased) name."""
    ordered = sorted(cols, key=lambda c: c.lower())
    values = F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ordered])
    return row_key_from_values(values, src, connector, reverse)


def has_key(image: Column, keys: Column | None = None) -> Column:
    return F.exists(image, _in_key(keys))


def row_key(image: Column, src: Column, keys: Column | None = None, connector: str = DEFAULT_CONNECTOR, reverse: bool = True) -> Column:
    """Row key of a row image; null when the image has no key column."""
    return F.when(has_key(image, keys), row_key_from_values(key_values(image, keys), src, connector, reverse))
