"""Line dedup: of lines found in several documents only the first document's stay.

Hashes of line keys are range-partitioned and sorted by hash, document and position; a streaming window sees each
hash's first document, and what comes back is one compressed bitmap of kept lines per document, no text.  Only
DataFrame functions are used.

Defined cases: a null text is one empty line; a null id counts as one id above all others; rows with the same id
are one document for the count of documents, and every row is returned; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, id_of, keyed

#: Blanks at the ends of a line are not part of its key; from Python, as SQL literals know no form feed.
TRIMMED = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A hash with more than HEAVY_ROWS lines, or 1/HEAVY_SHARE of all in a smaller table, is spread over SALTS sort groups
#: or more, none above HEAVY_ROWS.  HEAVY_MOST hashes are at most, so that they can be broadcast: beyond a table of
#: HEAVY_ROWS * HEAVY_MOST lines a hash needs 1/HEAVY_MOST of all.
HEAVY_ROWS, HEAVY_SHARE, HEAVY_MOST, SALTS = 200_000, 200, 100_000, 64


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """``(_id, _fp, pos, hash)`` of each line whose key has at least ``min_chars`` code points."""
    lines = keyed(docs, id_col, text_col).select("_id", "_fp", F.posexplode(F.split("_text", "\n")).alias("pos", "line"))
    key = F.translate(F.btrim("line", F.lit(TRIMMED)), UPPER, LOWER)
    return lines.withColumn("line", key).where(F.char_length("line") >= min_chars).select("_id", "_fp", "pos", F.unhex(F.md5(F.col("line").cast("binary"))).alias("hash"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """``(_id, _fp, keep)`` of the documents that lose lines.

    ``keep`` is a compressed bitmap: ``(word, bits)`` for those words of 64 lines that lose some; bit i of a word
    is 1 if the line stays, and words that are left out keep all lines.
    """
    hashed = cut(line_hashes(docs, id_col, text_col, min_chars))
    per_hash = hashed.groupBy("hash").agg(F.count("*").alias("n"), F.min("_id").alias("hot_first"))
    total = hashed.count()
    bound = max(min(total // HEAVY_SHARE + SALTS, HEAVY_ROWS), total // HEAVY_MOST)
    heavy = per_hash.where(F.col("n") > bound).select("hash", "hot_first", F.greatest(F.lit(SALTS), F.expr(f"n div {HEAVY_ROWS} + 1")).alias("salts"))
    salt = F.when(F.col("hot_first").isNull(), 0).otherwise(F.pmod(F.xxhash64("_id", "pos"), F.col("salts")))
    dealt = hashed.join(F.broadcast(heavy), "hash", "left").withColumn("salt", salt).repartitionByRange("hash", "salt")
    first = F.first("_id").over(Window.partitionBy("hash", "salt").orderBy("_id", "pos"))
    lost = dealt.withColumn("first", F.coalesce("hot_first", first)).where("_id > first")
    words = lost.groupBy("_id", "_fp", F.expr("pos div 64").cast("int").alias("word")).agg(F.expr("~bit_or(shiftleft(1L, pos % 64))").alias("bits"))
    return words.groupBy("_id", "_fp").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("keep"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """``(doc_id, text, n_lines, n_dropped, keep)``: every document with the kept lines, joined by a line feed.

    With ``carry`` a struct ``_row`` has its other columns.
    """
    whole = keyed(docs, id_col, text_col, carry).withColumn("lines", F.split("_text", "\n")).drop("_text")
    both = whole.join(bitmaps.hint("shuffle_hash"), ["_id", "_fp"], "left")
    by_word = F.map_from_entries("keep")
    dense = F.transform(F.expr("sequence(0, (size(lines) - 1) div 64)"), lambda w: F.coalesce(by_word[w.cast("int")], F.lit(-1).cast("long")))
    both = both.withColumn("dense", F.when(F.col("keep").isNotNull(), dense))
    kept = F.expr("if(keep is null, lines, filter(lines, (x, i) -> (shiftright(dense[i div 64], i % 64) & 1L) = 1L))")
    both = both.withColumn("kept", kept)
    return both.select(
        id_of("_id").alias("doc_id"),
        F.array_join("kept", "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        "keep",
        *["_row"] * carry,
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, carry: bool = False) -> DataFrame:
    """Every document with the lines that it keeps; see the module for the defined cases."""
    return apply_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, min_chars), id_col, text_col, carry)
