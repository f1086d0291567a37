"""Input and shuffle volume per headline query, from Spark's event log.

Usage: python tools/shuffle_report.py [sf_dir] [query ...]
Runs each query once (after a warm-up) with the event log written to a fresh
scratch folder, then sums the task metrics of the jobs each query ran.
Prints one markdown table.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    keys = sys.argv[2:] or list(HEADLINE)
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-")
    os.environ.setdefault("PLATEWISE_SHUFFLE_PARTITIONS", "16")
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.rolling.enabled", "false")
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from platewise.queries import all_queries

    qs = all_queries()
    for k in keys:
        qs[k](spark, sf).write.format("noop").mode("overwrite").save()  # warm-up, fixtures stored
    for k in keys:
        spark.sparkContext.setJobGroup(f"q:{k}", k)
        qs[k](spark, sf).write.format("noop").mode("overwrite").save()
    spark.stop()

    job_group: dict[int, str] = {}
    stage_job: dict[int, int] = {}
    totals: dict[str, dict[str, int]] = {
        k: {"input": 0, "input_rows": 0, "shuffle": 0, "shuffle_rows": 0, "tasks": 0} for k in keys}
    files = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]
    for path in files:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
                    if group.startswith("q:"):
                        job_group[ev["Job ID"]] = group[2:]
                        for sid in ev.get("Stage IDs", []):
                            stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    job = stage_job.get(ev.get("Stage ID"))
                    q = job_group.get(job)
                    m = ev.get("Task Metrics") or {}
                    if q is None or not m:
                        continue
                    inp = m.get("Input Metrics") or {}
                    shw = m.get("Shuffle Write Metrics") or {}
                    totals[q]["input"] += inp.get("Bytes Read", 0)
                    totals[q]["input_rows"] += inp.get("Records Read", 0)
                    totals[q]["shuffle"] += shw.get("Shuffle Bytes Written", 0)
                    totals[q]["shuffle_rows"] += shw.get("Shuffle Records Written", 0)
                    totals[q]["tasks"] += 1
    print(f"sf: {sf}; event log: {log_dir}\n")
    print("| query | rows read | rows shuffled | input MB (parquet) | shuffle MB (rows) | tasks |")
    print("|---|---|---|---|---|---|")
    for k in keys:
        t = totals[k]
        print(f"| {k} | {t['input_rows']:,} | {t['shuffle_rows']:,} | {t['input'] / 1e6:.1f} | "
              f"{t['shuffle'] / 1e6:.2f} | {t['tasks']} |")


if __name__ == "__main__":
    main()
