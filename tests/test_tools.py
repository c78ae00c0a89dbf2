"""The diagnostics in tools/: plan summary and event-log stage report."""

import json
import os
import sys

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import plan_summary  # noqa: E402
import stage_report  # noqa: E402

from visitlens.plans import queries as Q  # noqa: E402


def test_plan_summary_counts(spark):
    plan = Q.QUERIES["top10_session"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    s = plan_summary.summarise(plan)
    assert s["shuffles"] >= 3 and s["partial aggs"] >= 2 and s["pushed filters"] == "yes"


def test_stage_report_parses_event_log(tmp_path):
    ev = {
        "Event": "SparkListenerStageCompleted",
        "Stage Info": {
            "Stage ID": 3, "Number of Tasks": 8, "Stage Name": "save at x", "Submission Time": 1000,
            "Completion Time": 1250,
            "Accumulables": [
                {"Name": "internal.metrics.shuffle.write.bytesWritten", "Value": 4096},
                {"Name": "internal.metrics.input.bytesRead", "Value": 100},
            ],
        },
    }
    d = tmp_path / "eventlog_v2_app"
    d.mkdir()
    (d / "events_1_app").write_text(json.dumps({"Event": "SparkListenerLogStart"}) + "\n" + json.dumps(ev) + "\n")
    (d / "appstatus_app").write_text("")
    rows = stage_report.report(str(tmp_path))
    assert rows == [{"input": 100, "shuffle_read_local": 0, "shuffle_read_remote": 0, "shuffle_write": 4096,
                     "stage": 3, "tasks": 8, "name": "save at x", "ms": 250}]
