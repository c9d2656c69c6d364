"""Cell expressions: value cleaning, the "written" rule, image -> map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value (our own definition of the cleaning rule): every run of
# carriage return, line feed, tab or other control character in
# U+0000..U+001F becomes one space.
CONTROL_RUN = "[\\x00-\\x1f]+"


def clean_value(value: Column) -> Column:
    """Replace each run of control characters by one space."""
    return F.regexp_replace(value, CONTROL_RUN, " ")


def is_written(cell: Column, op: Column, null_updated_writes: bool = True) -> Column:
    """Does this cell of an image write to the destination?

    A non-null cell always writes.  A null cell writes '' only on UPDATE when
    flagged updated; otherwise the old value stays.
    """
    not_null = ~F.coalesce(cell["is_null"], F.lit(False)) & cell["value"].isNotNull()
    if not null_updated_writes:
        return not_null
    return not_null | ((op == F.lit("UPDATE")) & F.coalesce(cell["updated"], F.lit(False)))


def written_value(cell: Column, clean: bool = True) -> Column:
    """Value a written cell stores: '' for a null, else the (cleaned) text."""
    null = F.coalesce(cell["is_null"], F.lit(False)) | cell["value"].isNull()
    v = clean_value(cell["value"]) if clean else cell["value"]
    return F.when(null, F.lit("")).otherwise(v)


def image_to_map(image: Column, op: Column, clean: bool = True, null_updated_writes: bool = True) -> Column:
    """Written cells of an image as MAP<name, value>; names lower-cased."""
    kept = F.filter(image, lambda c: is_written(c, op, null_updated_writes))
    entries = F.transform(kept, lambda c: F.struct(F.lower(c["name"]).alias("key"), written_value(c, clean).alias("value")))
    return F.map_from_entries(entries)
