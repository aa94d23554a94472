"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query's DataFrame is built (this may run bounded preparatory jobs such as
range ranking or per-source writes) and then fully executed into the ``noop``
sink, so the time covers the whole plan without collecting rows to the driver.
A JIT warm-up pass on sf0.001 runs first and is not timed.

With BENCH_DETAIL=1 (default) a second, untimed pass runs every query under its
own job group in a fresh session whose event log goes to a scratch folder; the
log gives input records and shuffle bytes per query, and a count gives rows out.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "quota_select", "multi_source_select", "quality_gate", "measured_percentiles", "split_exact",
    "class_counts", "coco_to_yolo", "dedup_first_kept",
]


def _open_log(path: str):
    import io

    if path.endswith(".zstd"):
        import zstandard

        raw = zstandard.ZstdDecompressor().stream_reader(open(path, "rb"))
        return io.TextIOWrapper(raw, encoding="utf-8")
    return open(path, encoding="utf-8")


def _event_log_detail(log_dir: str) -> dict[str, dict[str, int]]:
    stage_group: dict[int, str] = {}
    out: dict[str, dict[str, int]] = {}
    # Spark 4 writes a rolling event log: a folder per application with events_<n>_* files
    files = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
             if os.path.isfile(p) and not os.path.basename(p).startswith("appstatus")]
    for path in sorted(files):
        with _open_log(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if group:
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if not group:
                        continue
                    d = out.setdefault(group, {"input_records": 0, "shuffle_bytes": 0})
                    d["input_records"] += (m.get("Input Metrics") or {}).get("Records Read", 0)
                    d["shuffle_bytes"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
    return out


def _run(names, sf_dir, cpus, log_dir=None, warm=True):
    from vistasieve.plans.queries import QUERIES
    from vistasieve.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                          app="vistasieve-bench", event_log_dir=log_dir)
    sc = spark.sparkContext
    spark.range(1000).selectExpr("sum(id)").collect()
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warm and warm_dir and os.path.isdir(warm_dir):
        for name in names:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        sc.setJobGroup(name, name)
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        if log_dir:
            sc.setJobGroup(f"count:{name}", "untimed row count")
            rows[name] = df.count()
    spark.stop()
    return times, rows


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE

    # timed pass: no event log (it costs ~50 % of wall time on small data)
    times, _ = _run(names, sf_dir, cpus)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
    }
    if os.environ.get("BENCH_DETAIL", "1") == "1":
        # untimed pass in a fresh session with the event log in a scratch folder
        log_dir = tempfile.mkdtemp(prefix="vistasieve-eventlog-")
        _, rows = _run(names, sf_dir, cpus, log_dir=log_dir, warm=False)
        ev = _event_log_detail(log_dir)
        out["detail"] = {
            n: {"rows_out": rows[n], "input_records": ev.get(n, {}).get("input_records", 0),
                "shuffle_bytes": ev.get(n, {}).get("shuffle_bytes", 0)}
            for n in names
        }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
