"""Skew probe: one row key holds a third of the change log.

Builds the users change log from ``events`` and moves every third event to
user 0, then runs the apply and the previous-event lookup with Spark's event
log written to a fresh scratch folder.  For every stage that reads a shuffle
it prints the largest and the median shuffle-read record count per task: a
hot key that was combined map-side (apply) or cut into blocks
(previous_row) shows a max close to the median.

Usage: python tools/skew_probe.py [sf_dir]
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def stage_stats(log_dir: str) -> tuple[dict[int, list[int]], dict[int, str]]:
    import zstandard

    reads: dict[int, list[int]] = {}
    phase: dict[int, str] = {}
    for f in glob.glob(os.path.join(log_dir, "*", "events_*")) + glob.glob(os.path.join(log_dir, "*.zstd")):
        with open(f, "rb") as fh:
            raw = zstandard.ZstdDecompressor().stream_reader(fh) if f.endswith(".zstd") else fh
            for line in io.TextIOWrapper(raw, encoding="utf-8"):
                e = json.loads(line)
                if e.get("Event") == "SparkListenerJobStart":
                    desc = (e.get("Properties") or {}).get("spark.job.description", "")
                    for sid in e.get("Stage IDs", []):
                        phase[sid] = desc
                if e.get("Event") == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                    n = e["Task Metrics"].get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                    if n:
                        reads.setdefault(e["Stage ID"], []).append(n)
    return reads, phase


def main() -> None:
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from tidemark.operators import apply as A
    from tidemark.operators.ordered import previous_row
    from tidemark.session import local_session
    from tidemark.sources import fixtures as FX

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="skew-probe-", dir="/tmp")
    spark = local_session("skew-probe", extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                                "spark.sql.shuffle.partitions": "16",
                                                "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    ev = FX.events_changelog(spark, sf_dir)
    hot = F.col("seq") % 3 == 0

    def to_user0(img):
        return F.transform(img, lambda c: F.when(c["is_key"], c.withField("value", F.lit("0"))).otherwise(c))

    log = FX.stored(ev.withColumn("after", F.when(hot, to_user0(F.col("after"))).otherwise(F.col("after")))
                    .withColumn("before", F.when(hot, to_user0(F.col("before"))).otherwise(F.col("before"))), "hot")
    sc = spark.sparkContext
    sc.setJobDescription("apply_changes")
    A.apply_changes(log).write.format("noop").mode("overwrite").save()
    keyed = A.with_row_keys(log).select("source_key", "row_key", "seq", "op")
    sc.setJobDescription("previous_row (blocked)")
    previous_row(keyed, ["source_key", "row_key"], "seq", ["op"]).write.format("noop").mode("overwrite").save()
    sc.setJobDescription("plain lag window (contrast only)")
    keyed.withColumn("p", F.lag("op").over(Window.partitionBy("source_key", "row_key").orderBy("seq"))).write.format("noop").mode("overwrite").save()
    total = log.count()
    spark.stop()
    print(f"log rows: {total}, hot key share: 1/3")
    reads_by_stage, phase = stage_stats(log_dir)
    for stage, reads in sorted(reads_by_stage.items()):
        if len(reads) > 1:
            print(f"{phase.get(stage, ''):32s} stage {stage:3d}: tasks={len(reads):3d} max={max(reads):8d} median={int(statistics.median(reads)):8d} "
                  f"max/median={max(reads) / max(1, statistics.median(reads)):.2f}")


if __name__ == "__main__":
    main()
