"""Benchmark: every catalog query on the stand-ins of one scale factor.

Usage: ``python bench.py`` (env ``BENCH_SF_DIR``, default
/root/testdata/sf0.1; ``BENCH_CPUS``, default 8). The stand-in datasets are
built once and written as parquet below the session's checkpoint folder
(time reported as ``prepare_sec``), so each query starts from nested
parquet as it would on real inputs. Each query runs to completion through
Spark's ``noop`` sink (full execution, nothing collected on the driver):
one warm-up run, then the median of ``BENCH_REPS`` (default 3) timed runs, the
last of them tagged with a job group whose stages and shuffle bytes are read
back from the event log (``stages``, ``shuffle_bytes_written``).
``BENCH_QUERIES`` (names with commas) picks some queries.

``small`` holds the times of one run of each query on a smaller scale factor
(``BENCH_SMALL_DIR``, default /root/testdata/sf0.01) and ``growth`` their
ratio; ``unprepared_sec`` is the headline query from the driver tables
themselves, stand-ins included.

``baseline`` compares the one-pass report with the same report built by
chaining the individual operators: wall time, shuffle count of the plan
with automatic broadcasts off (the shape it has on large inputs), and the
stages, tasks and shuffle bytes actually written, read from Spark's event
log (written to a scratch folder, ``BENCH_EVENT_DIR``; the UI stays off).
Prints one JSON line.
"""

from __future__ import annotations

import contextlib
import glob
import io
import json
import os
import re
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

import chained as C  # noqa: E402

from entiscore.plans import report as R  # noqa: E402
from entiscore.plans.catalog import CATALOG, terms  # noqa: E402
from entiscore.session import local_session, scratch_path  # noqa: E402
from entiscore.sources import fixtures as fx  # noqa: E402

HEADLINE = "priority_report"


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(build, reps: int, sc=None, group: str = "") -> float:
    """Median seconds after a warm-up; with a group, the last run's jobs carry it."""
    run(build())
    ts = []
    for i in range(reps):
        if group and i == reps - 1:
            sc.setJobGroup(group, group)
        t0 = time.time()
        run(build())
        ts.append(time.time() - t0)
    if group:
        sc.setJobGroup("bench", "untagged")
    return round(statistics.median(ts), 3)


def shuffle_count(spark, df) -> int:
    """Shuffles in the formatted physical plan (subqueries included) with
    automatic broadcasts disabled."""
    old = (spark.conf.get("spark.sql.autoBroadcastJoinThreshold"),
           spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[0])
        if old[1] is None:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        else:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old[1])
    return len(re.findall(r"^\(\d+\) Exchange\b", buf.getvalue(), flags=re.M))


def event_log_metrics(event_dir: str) -> dict[str, dict[str, int]]:
    """Stages, tasks and shuffle bytes written per job group, from the event log."""
    job_group, stage_group = {}, {}
    out: dict[str, dict[str, int]] = {}
    paths = sorted(glob.glob(os.path.join(event_dir, "**", "events_*"), recursive=True)) or [
        p for p in glob.glob(os.path.join(event_dir, "*")) if os.path.isfile(p)]
    for path in paths:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if group:
                        job_group[ev["Job ID"]] = group
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    if group is None:
                        continue
                    m = out.setdefault(group, {"stages": 0, "tasks": 0, "shuffle_bytes_written": 0})
                    m["tasks"] += 1
                    sw = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    m["shuffle_bytes_written"] += int(sw.get("Shuffle Bytes Written", 0))
                elif kind == "SparkListenerStageCompleted":
                    info = ev.get("Stage Info", {})
                    group = stage_group.get(info.get("Stage ID"))
                    if group is not None and "Failure Reason" not in info:
                        out.setdefault(group, {"stages": 0, "tasks": 0, "shuffle_bytes_written": 0})["stages"] += 1
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    event_dir = os.environ.get("BENCH_EVENT_DIR") or tempfile.mkdtemp(prefix="entiscore-events-")
    small_dir = os.environ.get("BENCH_SMALL_DIR", "/root/testdata/sf0.01")
    spark = local_session(cpus, shuffle_partitions=max(8, cpus),
                          conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir,
                                "spark.eventLog.compress": "false"})
    unprepared = timed(lambda: CATALOG[HEADLINE](spark, sf_dir), 1)
    t0 = time.time()
    fx.materialize(spark, sf_dir, scratch_path(spark, "bench-standins"))
    prepare = time.time() - t0

    reps = int(os.environ.get("BENCH_REPS", "3"))
    sc = spark.sparkContext
    times: dict[str, float] = {}
    chosen = {k: v for k, v in CATALOG.items() if k in os.environ.get("BENCH_QUERIES", k).split(",") or k == HEADLINE}
    for name, build in chosen.items():
        times[name] = timed(lambda b=build: b(spark, sf_dir), reps, sc, f"q:{name}")

    small: dict[str, float] = {}
    if os.path.isdir(small_dir) and small_dir != sf_dir:
        fx.materialize(spark, small_dir, scratch_path(spark, "bench-standins"))
        for name, build in chosen.items():
            t0 = time.time()
            run(build(spark, small_dir))
            small[name] = round(time.time() - t0, 3)

    def report_args():
        return (fx.target(spark, sf_dir), fx.gene_essentiality(spark, sf_dir), fx.mouse_phenotypes(spark, sf_dir),
                fx.molecule(spark, sf_dir), fx.tissue_atlas(spark, sf_dir), fx.mouse_phenotypes(spark, sf_dir),
                fx.phenotype_scores(spark, sf_dir), *terms(spark, sf_dir), fx.query_ids(spark, sf_dir))

    baseline = {
        "one_pass_sec": times[HEADLINE],
        "chained_sec": timed(lambda: C.priority_report_chained(*report_args()), reps),
        "one_pass_shuffles": shuffle_count(spark, R.priority_report(*report_args())),
        "chained_shuffles": shuffle_count(spark, C.priority_report_chained(*report_args())),
    }
    for group, build in (("one_pass", R.priority_report), ("chained", C.priority_report_chained)):
        sc.setJobGroup(group, f"report {group}")
        run(build(*report_args()))
    sc.setJobGroup("bench", "rest")

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "all_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "headline": {HEADLINE: times[HEADLINE]},
        "baseline": baseline,
        "prepare_sec": round(prepare, 3),
        "unprepared_sec": unprepared,
        "small": small,
        "growth": {k: round(times[k] / v, 2) for k, v in small.items() if v},
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }
    spark.stop()
    metrics = event_log_metrics(event_dir)
    for group in ("one_pass", "chained"):
        for k, v in metrics.get(group, {}).items():
            baseline[f"{group}_{k}"] = v
    out["shuffle_bytes_written"] = {name: metrics.get(f"q:{name}", {}).get("shuffle_bytes_written", 0)
                                    for name in chosen}
    out["stages"] = {name: metrics.get(f"q:{name}", {}).get("stages", 0) for name in chosen}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
