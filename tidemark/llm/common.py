"""Helpers shared by the operators: stand-ins for null ids, shared-folder checkpoints, connected components."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

#: A null id takes part as this id, larger than any other; results show null again.
NULL_ID = 2**63 - 1


def on_workers(spark: SparkSession) -> None:
    """Lets Python workers find this package where the session's machines have it at the same place as the driver
    but not on their path."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in path:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*path, root])


def key_of(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("long"), F.lit(NULL_ID))


def id_of(key: str) -> Column:
    return F.when(F.col(key) != NULL_ID, F.col(key))


def keyed(docs: DataFrame, id_col: str, text_col: str, carry: bool = False) -> DataFrame:
    """Columns ``_id``, ``_text`` (null: empty) and ``_fp``.  Rows of one id and one text share ``(_id, _fp)``.

    With ``carry`` the other columns come along in a struct ``_row``, so that no name can clash.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    other = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("_row")] if carry else []
    return docs.select(key_of(id_col).alias("_id"), text.alias("_text"), *other).withColumn("_fp", F.xxhash64("_text"))


#: The names that ``with_key`` gives to the id's stand-in and the hash of the text.
KEY = ["_key_id", "_key_fp"]


def fp_of(text: Column) -> Column:
    """The ``_fp`` of a text."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def with_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(*KEY, row)``: rows of one id and one text share the key, ``row`` has all columns."""
    return docs.select(key_of(id_col).alias(KEY[0]), fp_of(F.col(f"`{text_col}`")).alias(KEY[1]), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def uncarried(df: DataFrame, columns: list[str], text_col: str, text: str, size_col: str = "n_chars") -> DataFrame:
    """The columns of documents again from ``_row``, with a new text and, if they have one, its size in characters."""
    new = {text_col: F.col(text), size_col: F.char_length(text).cast("long")}
    return df.select(*[(new[c] if c in new else F.col("_row")[c]).alias(c) for c in columns])


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder, so that lost executors do not bring back their history."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def parts(spark: SparkSession, rows: int, rows_per_part: int) -> int:
    """A number of partitions that follows the number of rows; small inputs still use the whole session."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_part))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)``: the smallest node that each linked node reaches.

    Every round a node takes the smallest label among its neighbours and itself, and then that label's own label
    (pointer jumping), until nothing changes.  Links and labels stay distributed; each round is written to the
    shared checkpoint folder.  A hub's neighbours are reduced by a partial ``min`` before they meet.
    """
    one = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x != y")
    both = cut(one.union(one.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    labels = cut(both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.first("x")).alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "y"), "y").select(F.col("x").alias("node"), F.col("component").alias("to"), F.lit(None).cast("long").alias("was"))
        low = near.union(labels.select("node", F.col("component").alias("to"), F.col("component").alias("was"))).groupBy("node").agg(F.min("to").alias("to"), F.max("was").alias("was"))
        own = labels.select(F.col("node").alias("to"), F.col("component").alias("jump"))
        new = cut(low.join(own, "to", "left").select("node", F.least("to", F.coalesce("jump", "to")).alias("component"), "was"))
        if new.where("component != was").isEmpty():
            return new.select("node", "component")
        labels = new.select("node", "component")
