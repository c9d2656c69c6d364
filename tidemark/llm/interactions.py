"""Filter interaction audit: what each of five filters removes in each of their 120 orders, without running an order.

1. Every row gets a mask of the filters it fails; rows are counted per part, mask and label.  From here on the work
   depends on the number of parts, not of rows.
2. Orders are ranked lexicographically (Lehmer rank).  A mask's rows go at step k under filter f where the order
   begins with k - 1 filters outside the mask and then f: each such beginning of k letters is one interval of
   (5 - k)! ranks.  The counts are added at an interval's begin and subtracted at its end.
3. Prefix sums across the 120 ranks of each step give what every step of every order removes; what it keeps and what
   was removed before follow, and Shapley totals are the same intervals' lengths times counts.

The filters, over whole texts and words between blanks: A under 200 words; B fewer distinct words than half of all;
C more than 2 % ASCII capitals; D holds one of ``#$%&*|``; E equal to the text of a row with a smaller id.

Defined cases: a null text is empty; null and empty parts are one; a null id is larger than any other, equal ids do
not make copies of each other; an id without a label, or with null labels only, counts in neither lost column, one
with several labels counts if one of them is 1; an empty table gives no rows; extra columns are ignored.

E compares SHA-256 values.  Copies are counted per part and label before they meet, so a text that a third of all
rows share costs a row per task, part and label.  Labels are joined on ids after equal rows of an id were counted;
rows without an id skip that join.
"""

from __future__ import annotations

from itertools import combinations, permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import NULL_ID, key_of

LETTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(LETTERS)]  #: by rank
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SIGNS = 200, 50, 2, "#$%&*|"
COUNTS = ["n", "good", "toxic"]


def failures(text: Column) -> Column:
    """The bits of A to D (1, 2, 4, 8) that a text fails."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def bits(ws: Column) -> Column:
        return (
            F.when(F.size(ws) < MIN_WORDS, 1).otherwise(0)
            + F.when(100 * F.size(F.array_distinct(ws)) < DISTINCT_PERCENT * F.size(ws), 2).otherwise(0)
            + F.when(100 * F.char_length(F.regexp_replace(text, "[^A-Z]+", "")) > CAPITAL_PERCENT * F.char_length(text), 4).otherwise(0)
            + F.when(text.rlike(f"[{SIGNS}]"), 8).otherwise(0)
        )

    return F.transform(F.array(words), bits)[0]


def masks(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``part, mask, n, good, toxic``: rows of each part by the filters they fail."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    part = F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit(""))
    rows = docs.select(key_of(id_col).alias("_id"), part.alias("part"), F.unhex(F.sha2(text, 256)).alias("same"), failures(text).alias("mask"))
    rows = rows.groupBy("same", "_id", "part", "mask").agg(F.count("*").alias("n"))
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("_id"), *[F.coalesce(F.col(c) == 1, F.lit(False)).alias(c) for c in ("quality", "toxic")])
    known = known.where("_id is not null and (quality or toxic)").groupBy("_id").agg(F.max("quality").alias("good"), F.max("toxic").alias("toxic"))
    none = F.lit(False)
    told = rows.where(F.col("_id") != NULL_ID).join(known, "_id", "left").withColumns({"good": F.coalesce("good", none), "toxic": F.coalesce("toxic", none)})
    told = told.unionByName(rows.where(F.col("_id") == NULL_ID).withColumns({"good": none, "toxic": none}))
    groups = told.groupBy("same", "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"), F.min("_id").alias("low"), F.min_by("n", "_id").alias("at_low"))
    first = F.min("low").over(Window.partitionBy("same"))
    own = F.when(F.col("low") == first, F.col("at_low")).otherwise(0)
    split = groups.withColumn("own", own).select("part", "mask", "good", "toxic", F.explode(F.expr("array(struct(0 as e, own as n), struct(16 as e, n - own as n))")).alias("x"))
    return split.groupBy("part", (F.col("mask") + F.col("x.e")).alias("mask")).agg(
        F.sum("x.n").alias("n"), F.sum(F.when(F.col("good"), F.col("x.n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("x.n")).otherwise(0)).alias("toxic")
    ).where("n > 0")


def intervals() -> list[tuple[int, int, str, int, int]]:
    """``(mask, step, letter, begin, end)``: the ranks of the orders in which a mask's rows go at that step, by that letter."""
    out = []
    for step in range(1, len(LETTERS) + 1):
        width = factorial(len(LETTERS) - step)
        for place, beginning in enumerate(permutations(range(len(LETTERS)), step)):
            *before, last = beginning
            free = [x for x in range(len(LETTERS)) if x not in beginning]
            for k in range(len(free) + 1):
                for more in combinations(free, k):  # a mask holds the last letter and none of those before it
                    mask = sum(1 << x for x in (last, *more))
                    out.append((mask, step, LETTERS[last], place * width, (place + 1) * width))
    return out


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row for each part, order and step; see the module.

    ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``
    """
    spark: SparkSession = docs.sparkSession
    counted = masks(docs, labels, id_col, text_col, part_col)
    spans = F.broadcast(spark.createDataFrame(intervals(), "mask int, step int, letter string, start int, stop int"))  # of 31 masks
    steps = spark.createDataFrame([(r, o, k + 1, x) for r, o in enumerate(ORDERS) for k, x in enumerate(o)], "rank int, filter_order string, step int, letter string")
    steps = F.broadcast(steps)  # 600 rows

    going = counted.join(spans, "mask")
    shapley = going.groupBy("part", "letter").agg(F.sum(F.expr("n * (stop - start)")).alias("shapley"))
    signed = F.explode(F.expr("array(struct(start as rank, 1 as sign), struct(stop as rank, -1 as sign))"))
    ends = going.select("part", "step", *COUNTS, signed.alias("e")).groupBy("part", "step", F.col("e.rank").alias("rank"))
    ends = ends.agg(*[F.sum(F.col(c) * F.col("e.sign")).alias(c) for c in COUNTS])
    parts = counted.groupBy("part").agg(F.sum("n").alias("total"), *[F.sum(F.expr(f"if(mask & {1 << i} > 0, n, 0)")).alias(f"fails_{x}") for i, x in enumerate(LETTERS)],
                                        *[F.sum(F.expr(f"if(mask = {1 << i}, n, 0)")).alias(f"only_{x}") for i, x in enumerate(LETTERS)])
    grid = parts.crossJoin(steps)  # each part's 600 result rows
    ranks = Window.partitionBy("part", "step").orderBy("rank")
    summed = grid.join(ends, ["part", "step", "rank"], "left").withColumns({c: F.sum(F.coalesce(c, F.lit(0))).over(ranks) for c in COUNTS})
    gone = F.sum("n").over(Window.partitionBy("part", "rank").orderBy("step"))

    def of_letter(prefix: str) -> Column:
        return F.coalesce(*[F.when(F.col("letter") == x, F.col(f"{prefix}_{x}")) for x in LETTERS])

    out = summed.withColumn("kept", F.col("total") - gone).join(shapley, ["part", "letter"], "left")
    return out.select(
        "part", "filter_order", "step", "kept", F.col("n").alias("removed"), (of_letter("fails") - F.col("n")).alias("redundant"), of_letter("only").alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), F.coalesce("shapley", F.lit(0)).cast("long").alias("shapley"))
