"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A feature is the presence of an n-gram (``ORDERS`` code points, lower-cased, hashed to ``SLOTS`` slots) in a text.
Its value is the log ratio of its smoothed document counts in both classes; logistic regression weighs the scaled
features.  The model is fitted on a bounded sample of rows: at most ``per_class`` labelled documents of each class,
whole texts.  Tasks reduce them first to the documents of each class per slot, then to the chosen slots that each
document has, so no text reaches the driver.  Scoring reads every whole text, and a text's score depends on it alone.

Defined cases: a null text is scored as an empty one; a document with several labels is toxic if one says so; of several texts of a
labelled id the one with the smallest hash is learned from; labels
without a document and null labels are left out; without both classes to learn from every score is the share of
toxic labels, or 0; every row is returned; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, on_workers

ORDERS, SLOTS = (3, 4, 5), 1 << 20
PER_CLASS = 2000
FEATURES, MIN_DOCS, SMOOTH, RIDGE, ROUNDS = 3000, 4, 1.0, 2e-3, 300
CHUNK_CHARS = 2_000_000


def ngram_slots(code: np.ndarray) -> Iterator[np.ndarray]:
    """The slot of the n-gram that begins at each code point, for each order; windows that leave the text lack."""
    x = code.astype(np.uint32) + np.uint32(1)
    for n in ORDERS:
        if len(x) < n:
            continue
        h = np.full(len(x) - n + 1, n, np.uint32)
        for j in range(n):
            h = (h ^ x[j : len(x) - n + 1 + j]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        yield h % np.uint32(SLOTS)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def text_slots(text: str) -> np.ndarray:
    found = list(ngram_slots(codes(text)))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint32)


def choose(counts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The FEATURES slots whose shares of documents differ most surely between the classes; ``counts``: class by slot."""
    rate = counts / size[:, None]
    both = counts.sum(0) / size.sum()
    strength = np.abs(rate[1] - rate[0]) / np.sqrt(both * (1 - both) * (1 / size).sum() + 1e-9)
    strength[counts.sum(0) < MIN_DOCS] = 0
    return np.sort(np.argsort(-strength, kind="stable")[:FEATURES])


def train(present: list[np.ndarray], toxic: list[int], share: float, slots: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Slots, their weights (log-count ratio times learned weight) and the bias; ``share``: of toxic among all.

    ``present``: for each document, which of ``slots`` it has; ``counts``: class by chosen slot.
    """
    y = np.array(toxic, np.float64)
    size = [(y == c).sum() for c in (0, 1)]
    smooth = [(counts[c] + SMOOTH) / (size[c] + 2 * SMOOTH) for c in (0, 1)]
    ratio = np.log(smooth[1] / smooth[0])
    x = np.zeros((len(y), len(slots)), np.float32)
    for i, s in enumerate(present):
        x[i, s] = 1
    x *= ratio.astype(np.float32)
    part = np.where(y == 1, share / size[1], (1 - share) / size[0])  # the sample's classes in their true shares
    w, bias = np.zeros(len(slots)), np.log(share / (1 - share))
    step = 1 / (0.25 * (part[:, None] * x * x).sum() + RIDGE)
    ahead, ahead_bias = w, bias
    for k in range(ROUNDS):  # accelerated gradient descent
        p = 1 / (1 + np.exp(-(x @ ahead.astype(np.float32) + ahead_bias)))
        error = part * (p - y)
        new, new_bias = ahead - step * (x.T @ error.astype(np.float32) + RIDGE * ahead), ahead_bias - step * error.sum()
        ahead, ahead_bias = new + k / (k + 3) * (new - w), new_bias + k / (k + 3) * (new_bias - bias)
        w, bias = new, new_bias
    return slots.astype(np.uint32), w * ratio, float(bias)


def score(slots: np.ndarray, weights: np.ndarray, bias: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros(SLOTS, np.float64)
        weight[slots] = weights
        useful = weight != 0
        for b in batches:
            code = [codes(t or "") for t in b.column("_text").to_pylist()]
            total = np.full(len(code), bias)
            size = np.cumsum([0, *(len(c) for c in code)])
            at = 0
            while at < len(code):  # texts together up to CHUNK_CHARS
                to = max(at + 1, int(np.searchsorted(size, size[at] + CHUNK_CHARS, "right")) - 1)
                end = size[at + 1 : to + 1] - size[at]
                found = []
                for n, slot in zip(ORDERS, ngram_slots(np.concatenate(code[at:to])), strict=False):
                    hit = np.flatnonzero(useful[slot])
                    doc = np.searchsorted(end, hit, "right")
                    inside = hit + n <= end[doc]  # not across two texts
                    found.append(doc[inside] * SLOTS + slot[hit[inside]])
                if found:
                    one = np.unique(np.concatenate(found))
                    total[at:to] += np.bincount(one // SLOTS, weight[one % SLOTS], to - at)
                at = to
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(total, -500, 500))))], names=["doc_id", "score"])

    return run


def count_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that hold a slot."""
    counts = np.zeros((2, SLOTS), np.int64)
    for b in batches:
        for text, y in zip(b.column("_text").to_pylist(), b.column("_y").to_pylist(), strict=True):
            counts[y][text_slots(text)] += 1
    some = np.flatnonzero(counts.any(0))
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[0][some]), pa.array(counts[1][some])], names=["slot", "clean", "toxic"])


def present_slots(slots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.flatnonzero(np.isin(slots, text_slots(t), assume_unique=True)) for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_y"), pa.array(found, pa.list_(pa.int64()))], names=["_id", "_y", "found"])

    return run


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int) -> tuple[DataFrame, float]:
    """``_id, _y, _text`` to learn from, and the share of toxic ones among all labels that may be learned from."""
    known = labels.where(f"`{id_col}` is not null and `{label_col}` is not null").groupBy(F.col(f"`{id_col}`").cast("long").alias("_id")).agg((F.max(f"`{label_col}`") > 0).cast("int").alias("_y"))
    known = known.where(F.crc32(F.col("_id").cast("string").cast("binary")) % 5 != 0)
    n = known.agg(F.count("*").alias("n"), F.sum("_y").alias("toxic")).first()
    ids = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id")).distinct()
    order = F.xxhash64(F.lit(10), "_id")
    chosen = [known.where(F.col("_y") == y).join(ids, "_id", "left_semi").orderBy(order, "_id").limit(per_class) for y in (0, 1)]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), text.alias("_text"))
    rows = texts.join(F.broadcast(chosen[0].union(chosen[1])), "_id")  # 2 * per_class ids at most
    one = rows.groupBy("_id", "_y").agg(F.min_by("_text", F.struct(F.xxhash64("_text"), "_text")).alias("_text"))
    return cut(one), (n.toxic or 0) / max(1, n.n)


def fit(learned: DataFrame, share: float) -> tuple[np.ndarray, np.ndarray, float] | None:
    """The model from ``sample``; None without both classes."""
    size = np.zeros(2)
    for r in learned.groupBy("_y").count().collect():
        size[r["_y"]] = r["count"]
    if not size.all():
        return None
    counts = np.zeros((2, SLOTS))
    found = learned.mapInArrow(count_slots, "slot int, clean long, toxic long").groupBy("slot").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()  # SLOTS rows at most
    counts[:, found.column("slot").to_numpy()] = [found.column(c).to_numpy() for c in ("clean", "toxic")]
    slots = choose(counts, size)
    rows = learned.mapInArrow(present_slots(slots.astype(np.uint32)), "_id long, _y int, found array<long>").orderBy("_id").toArrow()  # FEATURES numbers a document at most
    return train([np.array(x, np.int64) for x in rows.column("found").to_pylist()], rows.column("_y").to_pylist(), share, slots, counts[:, slots])


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    Labels are learned from only where crc32(id as text) mod 5 is not 0; ``held_out`` marks that remainder.
    """
    on_workers(docs.sparkSession)
    learned, share = sample(docs, labels, id_col, text_col, label_col, per_class)
    model = fit(learned, share)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    if model is not None:
        scored = rows.mapInArrow(score(*model), "doc_id long, score double")
    else:
        scored = rows.select("doc_id", F.lit(share).alias("score"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
