import hashlib
import math
import random
import re
import zlib
from collections import Counter

import cases
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import resample as R

DOC = "doc_id long, text string, weight string, rank int, run long, place long, _id int, segment int, score long"


def buckets(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return [zlib.crc32(" ".join(ws[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(ws) - n + 1)], len(ws)


def brute(docs, target, percent=5):
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(buckets(x)[0])
    for x in target:
        t.update(buckets(x)[0])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000)))) for b in range(10000)]
    rows = []
    for i, x in docs:
        bs, n = buckets(x)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in bs)
        rows.append((i, len(bs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], cases.key_of(r[0]), -r[1]))
    drawn = percent * len(able) // 100
    ranked = [(*r[:4], k if k <= drawn else None) for k, r in enumerate(able, 1)]
    return ranked + [(*r[:4], None) for r in rows if r[4] < 20]


def run(spark, docs, target, **kw):
    d = spark.createDataFrame([(i, t, "w", 1, 2, 3, 4, 5, 6) for i, t in docs], DOC)
    out = R.resample(d, spark.createDataFrame([(1, t) for t in target], "item_id int, text string"), **kw)
    return cases.rows_of(out, "doc_id", "n_features", "weight", "score", "rank")


def documents():
    r = random.Random(5)
    words = ["".join(r.choices("abcXYZ019é日", k=r.randint(1, 9))) for _ in range(200)] + ["x" * 100, "É" * 3000]
    docs = [(i, " ,-_".join(r.choices(words, k=r.choice([0, 1, 2, 19, 20, 50])))) for i in range(300)]
    docs += [(900, None), (901, ""), (902, "..."), (None, docs[8][1]), (None, docs[8][1]), (None, " ".join(words)), docs[7], docs[7], (7, " ".join(words)), (903, "long word " * 30_000)]
    return docs, [" ".join(r.choices(words[:20], k=60)) for _ in range(5)] + [None, ""]


def test_against_brute_force(spark):
    docs, target = documents()
    for percent in (5, 60, 100):
        cases.same(run(spark, docs, target, percent=percent), brute(docs, target, percent))


def test_empty_tables(spark):
    assert run(spark, [], ["a"]) == []
    docs = documents()[0][:40]
    cases.same(run(spark, docs, []), brute(docs, []))
    cases.same(run(spark, [(1, "a b")], ["a"]), brute([(1, "a b")], ["a"]))


def test_sort_of_many_equal_rows_is_split_evenly(spark):
    """A third of the rows under one key: ranks are 1 to n, and no segment holds much more than its share."""
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("_id"), F.lit(30).cast("long").alias("n_words"), F.lit(1).cast("long").alias("n_features"), F.lit(0).cast("long").alias("weight"), F.when(F.col("id") % 3 == 0, 77).otherwise(F.col("id") % 100).alias("score"))
    got = R.with_ranks(rows, percent=100, run_rows=1000).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 30_001))
    by = sorted(got, key=lambda r: r["rank"])
    assert [(-r["score"], r["_id"]) for r in by] == sorted((-r["score"], r["_id"]) for r in got)
    half = R.with_ranks(rows, percent=50, run_rows=1000).collect()
    assert sorted(r["rank"] for r in half if r["rank"]) == list(range(1, 15_001)) and len(half) == 30_000


def test_segments_follow_splitters():
    import numpy as np

    r = np.random.default_rng(1)
    key = [r.integers(0, 4, 500) for _ in R.KEY]
    rows = list(zip(*[k.tolist() for k in key], strict=True))
    splitters = sorted(set(rows))[::40]
    assert R._segment_of(key, splitters).tolist() == [sum(s <= x for s in splitters) for x in rows]


def test_crc_of_runs_of_words():
    texts = ["a", "b" * 63 + " " + "c" * 64 + " " + "d" * 65, "e" * 255 + " f " + "g" * 70_000 + " h", "日本 É"]
    found, n = R.features(pa.array(texts))
    for i, t in enumerate(texts):
        assert sorted(int(b) for bucket, row in found for b in bucket[row == i]) == sorted(buckets(t)[0]) and n[i] == buckets(t)[1]
