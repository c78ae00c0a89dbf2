"""Time the headline queries and the task job on K shifted copies of a testdata scale.

Usage: python tools/scale_run.py OUT_DIR K [SRC_SF_DIR]

OUT_DIR must be a fresh scratch folder (e.g. ``mktemp -d /tmp/run-XXXXXX``).
Copy c of every event gets ``event_id + c * 1e9`` and ``ts + 31 * c`` days,
so each copy adds new user-day sessions; customer and nation are copied as
they are.  Prints one JSON line of best-of-2 seconds per query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from visitlens.plans import queries as Q  # noqa: E402
from visitlens.plans.job import build_task, write_all  # noqa: E402
from visitlens.session import local_session  # noqa: E402
from visitlens.sources import fixtures  # noqa: E402

HEADLINE = ["session_rollup", "session_aggr_stat", "top10_category", "top10_session", "session_detail",
            "random_extract"]


def derive(spark, src: str, out: str, k: int) -> None:
    e = spark.read.parquet(f"{src}/events.parquet")
    copies = e.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    big = copies.select(
        (F.col("event_id") + F.col("copy").cast("bigint") * F.lit(10**9)).alias("event_id"),
        F.timestamp_add("DAY", F.col("copy") * 31, F.col("ts")).alias("ts"),
        "user_id", "event_type", "value", "props",
    )
    big.write.parquet(f"{out}/events.parquet")
    for t in ("customer", "nation"):
        spark.read.parquet(f"{src}/{t}.parquet").write.parquet(f"{out}/{t}.parquet")


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _best(spark, fn) -> float:
    best = float("inf")
    for _ in range(2):
        spark.catalog.clearCache()
        t0 = time.perf_counter()
        fn()
        best = min(best, time.perf_counter() - t0)
    return round(best, 3)


def main() -> None:
    out, k = sys.argv[1], int(sys.argv[2])
    src = sys.argv[3] if len(sys.argv) > 3 else "/root/testdata/sf0.1"
    spark = local_session()
    if not os.path.exists(f"{out}/events.parquet"):
        derive(spark, src, out, k)
    res = {"events": spark.read.parquet(f"{out}/events.parquet").count()}
    for name in HEADLINE:
        res[name] = _best(spark, lambda: _noop(Q.QUERIES[name](spark, out)))

    def task() -> None:
        visits, users = fixtures.visit_actions(spark, out), fixtures.user_info(spark, out)
        params = Q.STAT_PARAMS.with_options(extract_per_day=Q.EXTRACT_PER_DAY)
        results, kept = build_task(visits, users, params, Q.TASK_ID, require_sessions=True)
        write_all(results.tables(), lambda n, df: _noop(df))
        for df in kept:
            df.unpersist()

    res["run_task"] = _best(spark, task)
    print(json.dumps(res))
    spark.stop()


if __name__ == "__main__":
    main()
