"""Per-stage input / shuffle volumes from Spark's event log.

Usage: python tools/stage_report.py SCRATCH_DIR [SF_DIR] [query ... | run_task]

Runs the named registered queries (or the whole task job) on a local session
whose event log goes to SCRATCH_DIR (a fresh folder, e.g. from
``mktemp -d /tmp/run-XXXXXX``), then prints one line per completed stage:
tasks, input bytes, shuffle read, shuffle write, and the stage name.
"""

from __future__ import annotations

import glob
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from visitlens.plans import queries as Q  # noqa: E402
from visitlens.plans.job import build_task, write_all  # noqa: E402
from visitlens.session import local_session  # noqa: E402
from visitlens.sources import fixtures  # noqa: E402

METRICS = {
    "input": "internal.metrics.input.bytesRead",
    "shuffle_read_local": "internal.metrics.shuffle.read.localBytesRead",
    "shuffle_read_remote": "internal.metrics.shuffle.read.remoteBytesRead",
    "shuffle_write": "internal.metrics.shuffle.write.bytesWritten",
}


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def run(spark, sf_dir: str, names: list[str]) -> None:
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        if name == "run_task":
            visits, users = fixtures.visit_actions(spark, sf_dir), fixtures.user_info(spark, sf_dir)
            params = Q.STAT_PARAMS.with_options(extract_per_day=Q.EXTRACT_PER_DAY)
            results, kept = build_task(visits, users, params, Q.TASK_ID, require_sessions=True)
            write_all(results.tables(), lambda n, df: _noop(df))
            for df in kept:
                df.unpersist()
        else:
            _noop(Q.QUERIES[name](spark, sf_dir))


def report(log_dir: str) -> list[dict]:
    stages = []
    paths = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]
    for path in paths:
        if "appstatus" in os.path.basename(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerStageCompleted":
                    continue
                info = ev["Stage Info"]
                acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                row = {k: int(acc.get(v) or 0) for k, v in METRICS.items()}
                row.update(stage=info["Stage ID"], tasks=info["Number of Tasks"], name=info["Stage Name"][:60],
                           ms=(info.get("Completion Time", 0) - info.get("Submission Time", 0)))
                stages.append(row)
    return sorted(stages, key=lambda r: r["stage"])


def main() -> None:
    log_dir = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    names = sys.argv[3:] or ["run_task"]
    os.makedirs(log_dir, exist_ok=True)
    spark = local_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false"})
    run(spark, sf_dir, names)
    spark.stop()
    rows = report(log_dir)
    print(f"{'stage':>5} {'tasks':>5} {'ms':>6} {'input':>10} {'shuf_read':>10} {'shuf_write':>10}  name")
    for r in rows:
        read = r["shuffle_read_local"] + r["shuffle_read_remote"]
        print(f"{r['stage']:>5} {r['tasks']:>5} {r['ms']:>6} {r['input']:>10} {read:>10} {r['shuffle_write']:>10}  {r['name']}")
    tot = {k: sum(r[k] for r in rows) for k in ("input", "shuffle_write")}
    print(f"total input {tot['input']} B, total shuffle write {tot['shuffle_write']} B, stages {len(rows)}")


if __name__ == "__main__":
    main()
