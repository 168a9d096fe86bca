"""Skew check: a third of the rows share one key; no task may read a third of the records.

Usage: python tools/skew_check.py [sf_dir]

Builds a skewed batch from the driver tables (every third row, by a hash of its invoice
key, gets invoice key HOT and store 1), runs the first-row-per-key dedupe, the skipped-row
report, the stores dimension and a keyed update by store, and reads Spark's event log (written to a scratch
folder) for the largest share of shuffle records read by a single task in each stage.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from salesmart.operators.load import append_new, skipped_rows  # noqa: E402
from salesmart.operators.model import dim_stores  # noqa: E402
from salesmart.operators.quality import update_from  # noqa: E402
from salesmart.plans import catalog  # noqa: E402
from salesmart.session import local_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="salesmart-eventlog-")
    spark = local_session(8, 16, extra={"spark.eventLog.enabled": "true",
                                        "spark.eventLog.dir": log_dir,
                                        "spark.eventLog.compress": "false",
                                        "spark.sql.adaptive.coalescePartitions.enabled": "false",
                                        "spark.sql.adaptive.localShuffleReader.enabled": "false"})
    clean = catalog.clean(spark, sf)
    hot = F.abs(F.xxhash64("invoice_line_no")) % 3 == 0
    skewed = (clean.withColumn("invoice_line_no", F.when(hot, F.lit("HOT")).otherwise(F.col("invoice_line_no")))
                   .withColumn("store", F.when(hot, F.lit(1)).otherwise(F.col("store"))))
    total = skewed.count()
    hot_rows = skewed.filter(F.col("invoice_line_no") == "HOT").count()
    empty = spark.createDataFrame([], skewed.schema)
    jobs = {
        "first_per_key": lambda: append_new(skewed, empty).count(),
        "skipped_rows": lambda: skipped_rows(skewed, empty).agg(F.sum("copies")).first()[0],
        "dim_stores": lambda: dim_stores(skewed).count(),
        "update_from": lambda: update_from(
            skewed, dim_stores(skewed).select(F.col("store_id").alias("store"),
                                              F.col("store_name").alias("name")),
            "store", ["name"]).count(),
    }
    results = {}
    for name, fn in jobs.items():
        spark.sparkContext.setJobGroup(name, name)
        results[name] = fn()
    spark.stop()

    per_stage = defaultdict(list)
    job_of_stage = {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        job_of_stage[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    metrics = ev.get("Task Metrics") or {}
                    read = (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    per_stage[ev["Stage ID"]].append(read)
    print(f"rows {total}, hot-key rows {hot_rows} ({hot_rows / total:.1%})")
    print(f"results {results}")
    worst = 0.0
    for sid in sorted(per_stage):
        reads = per_stage[sid]
        if sum(reads) == 0 or job_of_stage.get(sid) not in jobs:
            continue
        share = max(reads) / total
        worst = max(worst, share)
        print(f"stage {sid:3d} {job_of_stage[sid]:14s} tasks {len(reads):3d} "
              f"records read {sum(reads):8d} max/task {max(reads):7d} = {share:.1%} of all rows")
    print(f"largest single-task share of all rows: {worst:.1%}")


if __name__ == "__main__":
    main()
