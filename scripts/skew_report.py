#!/usr/bin/env python
"""Hot-key check: give one visitor a third of the basket log, run the skew-safe matrix
plan (shuffle branch forced, runtime broadcasts off) and the window form, and report
each shuffle-reading stage's largest task share from Spark's event log.

usage: python scripts/skew_report.py SF_DIR SCRATCH_DIR   (SCRATCH_DIR: a fresh folder)
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys

import zstandard

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def run(sf_dir: str, scratch: str) -> None:
    from pyspark.sql import functions as F

    from rankloom import operators as ops
    from rankloom import sources as src
    from rankloom.session import build_session
    spark = build_session(shuffle_partitions=32, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": scratch,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        # one task per shuffle partition, so task shares show the key distribution
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    spark.sparkContext.setCheckpointDir(f"{scratch}/ckpt")
    ev = src.basket_log(spark, sf_dir)
    hot = ev.withColumn("visitorid", F.when(F.col("visitorid") % 3 == 0, F.lit(0))
                        .otherwise(F.col("visitorid")))
    sc = spark.sparkContext
    sc.setJobGroup("matrix", "skew-safe model-3 matrix, shuffle branch")
    ops.visitor_matrix(hot, 1, True, max_broadcast_bytes=0).write.format("noop").mode("overwrite").save()
    sc.setJobGroup("window", "count over (partition by visitor)")
    ops.events_of_active(hot, 1, method="window", max_window_rows=1 << 40).write.format("noop").mode("overwrite").save()
    spark.stop()


def _lines(path: str):
    raw = open(path, "rb")
    if path.endswith(".zstd"):
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
    return io.TextIOWrapper(raw, encoding="utf-8")


def report(scratch: str) -> None:
    tasks, group = collections.defaultdict(list), {}
    for f in glob.glob(f"{scratch}/eventlog_v2_*/events_*"):
        for line in _lines(f):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for s in e["Stage IDs"]:
                    group[s] = g
            elif e["Event"] == "SparkListenerTaskEnd":
                m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                tasks[e["Stage ID"]].append(m.get("Total Records Read", 0))
    for s in sorted(tasks):
        recs = tasks[s]
        if sum(recs) > 1000:
            print(json.dumps({"group": group.get(s), "stage": s, "tasks": len(recs),
                              "records": sum(recs), "max_task_share": round(max(recs) / sum(recs), 3)}))


if __name__ == "__main__":
    run(sys.argv[1], sys.argv[2])
    report(sys.argv[2])
