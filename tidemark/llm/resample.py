"""Target-distribution importance resampling: Gumbel top-k over hashed n-gram weights, ranked by a parallel sort.

1. Features are the runs of 1 to ``ORDERS`` consecutive words; a feature's bucket is the crc32 of its bytes modulo
   ``BUCKETS``.  Both tables' bucket counts (one row per bucket) give an array of integer gains.
2. A document's weight is the sum of the gains at its features' buckets, looked up in that array.  A hash of its id
   adds Gumbel noise; the highest scores are a draw without replacement in proportion to exp(weight / 1000).
3. Ranks come from a parallel sort by regular sampling.  Every run (a bounded number of rows) is sorted where it
   lies; ``PER_RUN`` rows at regular places of each go to the driver and give regular splitters.  Rows are counted
   per segment between splitters; segments that can hold no drawn row stay where they are.  The others are exchanged,
   one segment a group, merged locally, and prefix counts over segments make local places exact ranks.  The sort key
   ends with the row's run and place, so that any number of equal rows is split evenly too.

Words are runs of code points other than ASCII ones that are no letter or digit, A-Z in lower case.

Defined cases: a null text has no words; a document with fewer than ``min_words`` words is never drawn; without
features a weight is 0; a null id is hashed as the empty text and comes after all ids among equal scores; of rows
equal in score and id those with more features come first; equal rows take consecutive ranks; an empty target table
gives gains too (t = T = 0); every row is returned; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.common import cut, id_of, key_of, on_workers, parts

ORDERS, BUCKETS = 3, 10_000
MIN_WORDS, DRAWN_PERCENT, SEED = 20, 5, "42"
RUN_ROWS, PER_RUN = 1 << 19, 32  #: rows of a run about, and regular samples of each that reach the driver
_POLYNOMIAL = 0xEDB88320  #: fixed value: CRC-32, reflected
_SHORT = 64  #: lengths whose shift has a table of its own

_byte = np.arange(256)
#: bytes outside words: ASCII but digits and small letters (after lower-casing); bytes of longer characters are inside
OUTSIDE = (_byte < 128) & ~((_byte >= 48) & (_byte <= 57)) & ~((_byte >= 97) & (_byte <= 122))


def _byte_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> np.uint32(1)) ^ np.uint32(_POLYNOMIAL), x >> np.uint32(1)).astype(np.uint32)
    return x


_TABLE = _byte_table()


def _step(crc: np.ndarray) -> np.ndarray:
    """The linear part of one zero byte."""
    return _TABLE[crc & np.uint32(255)] ^ (crc >> np.uint32(8))


def _tabled(columns: np.ndarray) -> np.ndarray:
    """Four tables of 256 for a linear map given by its images of the 32 single bits."""
    out = np.zeros((4, 256), np.uint32)
    for part in range(4):
        for bit in range(8):
            out[part, ((_byte >> bit) & 1) == 1] ^= columns[8 * part + bit]
    return out


def _use(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = tables[0][crc & np.uint32(255)]
    for part in range(1, 4):
        out ^= tables[part][(crc >> np.uint32(8 * part)) & np.uint32(255)]
    return out


def _shift_tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """The shift by each short length, and by each power of two of bytes."""
    columns = np.uint32(1) << np.arange(32, dtype=np.uint32)
    short = []
    for _ in range(_SHORT):
        short.append(_tabled(columns))
        columns = _step(columns)
    doubled = [short[1]]
    single = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(30):
        doubled.append(_tabled(_use(doubled[-1], _use(doubled[-1], single))))
    return np.stack(short), doubled


_SHIFTS, _DOUBLED = _shift_tables()
_FLAT = np.ascontiguousarray(_SHIFTS).reshape(-1)


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What the crc of a text contributes to the crc of it and ``length`` more bytes."""
    short = np.minimum(length, _SHORT - 1).astype(np.uint32) * np.uint32(1024)
    out = _FLAT[short + (crc & np.uint32(255))]
    for part in range(1, 4):
        out ^= _FLAT[short + np.uint32(256 * part) + ((crc >> np.uint32(8 * part)) & np.uint32(255))]
    far = np.flatnonzero(length >= _SHORT)
    if len(far):
        x, rest = crc[far], length[far].copy()
        for tables in _DOUBLED:
            odd = (rest & 1) == 1
            x[odd] = _use(tables, x[odd])
            rest >>= 1
        out[far] = x
    return out


def word_crcs(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The crc32 of each word's bytes: all words go on byte by byte together, the longest first."""
    order = np.argsort(-size, kind="stable")
    at, left = start[order], size[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    longest = int(left[0]) if len(left) else 0
    more = len(left) - np.searchsorted(left[::-1], np.arange(min(longest, 4 * _SHORT)), "right")
    for j, n in enumerate(more.tolist()):
        crc[:n] = _TABLE[(crc[:n] ^ data[at[:n] + j]) & np.uint32(255)] ^ (crc[:n] >> np.uint32(8))
    out = np.empty_like(crc)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > 4 * _SHORT).tolist():
        out[i] = zlib.crc32(data[start[i] : start[i] + size[i]].tobytes())
    return out


def features(column: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each order the buckets of its features and the row of each; and the number of words of each row."""
    data, at = W.text_bytes(column)
    data = W.LOWER[data]
    outside = OUTSIDE[data]
    begins, stops = np.ones(len(data) + 1, bool), np.ones(len(data) + 1, bool)
    begins[1:], stops[:-1] = outside, outside
    begins[at], stops[at] = True, True
    start = np.flatnonzero(begins[:-1] & ~outside)
    stop = np.flatnonzero(stops)
    size = (stop[np.searchsorted(stop, start, "right")] if len(start) else start) - start
    first = np.searchsorted(start, at)
    row = np.repeat(np.arange(len(at) - 1), np.diff(first))
    word = word_crcs(data, start, size)
    blank = np.full(len(word), zlib.crc32(b" "), np.uint32)
    after = shifted(blank, size) ^ word  # the crc of a blank and the word
    out, crc = [], word
    for n in range(1, ORDERS + 1):
        if n > 1:
            crc = shifted(crc[:-1], size[n - 1 :] + 1) ^ after[n - 1 :]
        inside = row[: len(crc)] == row[n - 1 :]
        out.append((crc[inside] % np.uint32(BUCKETS), row[: len(crc)][inside]))
        if len(crc) < 2:
            break
    return out, np.diff(first)


def count_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for b in (c for big in batches for c in W.chunks(big)):
        for bucket, _ in features(b.column("_text"))[0]:
            total += np.bincount(bucket, minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """Features per bucket over a whole table."""
    found = texts.select(F.col(f"`{text_col}`").cast("string").alias("_text")).mapInArrow(count_buckets, "bucket int, n long")
    out = np.zeros(BUCKETS, np.int64)
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        out[r["bucket"]] = r["n"]
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(gains: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (c for big in batches for c in W.chunks(big)):
            found, n_words = features(b.column("_text"))
            n, weight = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            for bucket, row in found:
                edge = np.searchsorted(row, np.arange(b.num_rows + 1))  # rows are in order
                n += np.diff(edge)
                weight += np.diff(np.concatenate([[0], np.cumsum(gains[bucket])])[edge])
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(n_words.astype(np.int64)), pa.array(n), pa.array(weight)], names=["_id", "n_words", "n_features", "weight"])

    return run


#: The sort key, best first, all ascending; the last tells a row's run and its place there.
KEY = ["down", "_id", "fewer", "place"]


def regular_places(per_run: int):
    """Rows of a sorted run at ``per_run`` regular places: every run has the same say, its length comes along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = [b for b in batches if b.num_rows]
        if t:
            t = pa.Table.from_batches(t).combine_chunks()
            at = np.unique((np.arange(per_run) * 2 + 1) * t.num_rows // (2 * per_run))
            some = t.take(pa.array(at)).append_column("share", pa.array(np.full(len(at), t.num_rows / len(at))))
            yield from some.to_batches()

    return run


def _splitters(samples: list[tuple], segments: int) -> list[tuple]:
    """Keys at regular places of the sorted samples, by the rows that each stands for."""
    samples = sorted(samples)
    if not samples:
        return []
    total = np.cumsum([s[-1] for s in samples])
    at = np.searchsorted(total, total[-1] * np.arange(1, segments) / segments)
    return [samples[i][:-1] for i in sorted(set(at.tolist()))]


def _segment_of(key: list[np.ndarray], splitters: list[tuple]) -> np.ndarray:
    """How many splitters are at or below each key."""
    n = len(splitters)
    both = [np.concatenate([np.array([s[i] for s in splitters], np.int64), k]) for i, k in enumerate(key)]
    order = np.lexsort([np.arange(n + len(key[0])), *both[::-1]])  # a splitter comes before a row that equals it
    passed = np.cumsum(order < n)
    out = np.empty(n + len(key[0]), np.int64)
    out[order] = passed
    return out[n:]


def segmented(splitters: list[tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seg = _segment_of([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in KEY], splitters)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(seg.astype(np.int32))], names=[*b.schema.names, "segment"])

    return run


def ranked(before: dict[int, int], last: int):
    """Ranks of rows sorted by segment and key: the rows of earlier segments, and the place in one's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen = None, 0
        for b in batches:
            seg = b.column("segment").to_numpy()
            if not len(seg):
                continue
            edge = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
            ahead = np.array([before[s] for s in seg[edge].tolist()]) - edge
            rank = np.arange(1, len(seg) + 1) + np.repeat(ahead, np.diff(np.r_[edge, len(seg)]))
            if seg[0] == now:
                rank[: edge[1] if len(edge) > 1 else None] += seen
                seen = seen + len(seg) if len(edge) == 1 else len(seg) - edge[-1]
            else:
                seen = len(seg) - edge[-1]
            now = seg[-1]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rank, mask=rank > last)], names=[*b.schema.names, "rank"])

    return run


def with_ranks(scored: DataFrame, percent: int = DRAWN_PERCENT, min_words: int = MIN_WORDS, run_rows: int = RUN_ROWS, per_run: int = PER_RUN) -> DataFrame:
    """``scored`` (``_id, n_words, n_features, weight, score``) with ``rank`` of the drawn rows."""
    spark = scored.sparkSession
    rows = cut(scored)
    counted = rows.agg(F.count(F.when(F.col("n_words") >= min_words, 1)).alias("eligible"), F.count("*").alias("all")).first()
    drawn = percent * counted["eligible"] // 100
    short = rows.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    long = rows.where(F.col("n_words") >= min_words).withColumns({"down": -F.col("score"), "fewer": -F.col("n_features")})
    n = parts(spark, counted["eligible"], run_rows)
    runs = cut(long.coalesce(n).withColumn("place", F.monotonically_increasing_id()).sortWithinPartitions(*KEY))
    kinds = ", ".join(f"{c} long" for c in KEY)
    samples = runs.select(*KEY).mapInArrow(regular_places(per_run), f"{kinds}, share double").collect()  # per_run rows of each run
    splitters = _splitters([tuple(r) for r in samples], n)
    fields = ", ".join(f"{c} {t}" for c, t in runs.dtypes)
    split = runs.mapInArrow(segmented(splitters), f"{fields}, segment int")
    sizes = {r["segment"]: r["count"] for r in split.groupBy("segment").count().collect()}  # a row for each segment
    order = sorted(sizes)
    before = dict(zip(order, np.concatenate([[0], np.cumsum([sizes[s] for s in order])]).astype(int).tolist(), strict=False))
    wanted = [s for s in order if before[s] < drawn]
    top = max(wanted, default=-1)
    exchanged = split.where(F.col("segment") <= top).repartition(max(1, len(wanted)), "segment").sortWithinPartitions("segment", *KEY)
    first = exchanged.mapInArrow(ranked(before, drawn), f"{fields}, segment int, rank long")
    rest = split.where(F.col("segment") > top).withColumn("rank", F.lit(None).cast("long"))
    out = [*scored.columns, "rank"]
    return first.select(*out).union(rest.select(*out)).union(short.select(*out))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", percent: int = DRAWN_PERCENT, min_words: int = MIN_WORDS, seed: str = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row; see the module."""
    on_workers(docs.sparkSession)
    gains = gains_of(bucket_counts(docs, text_col), bucket_counts(target, target_col))
    texts = docs.select(key_of(id_col).alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    weighed = texts.mapInArrow(weigh(gains), "_id long, n_words long, n_features long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_of("_id").cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").cast("double") + 0.5) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(u)))
    out = with_ranks(weighed.withColumn("score", F.col("weight") + noise), percent, min_words)
    return out.select(id_of("_id").alias("doc_id"), "n_words", "n_features", "weight", "score", "rank")
