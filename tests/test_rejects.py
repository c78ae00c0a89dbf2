"""Lenient times and the reject channel of the text format."""

import os
from datetime import datetime

import pytest

from visitlens.functions.dates import after, before, minus, parse_time
from visitlens.sources.visits import checked_visits, read_visit_lines, read_visit_text, reject_counts
from visitlens.streaming.ingest import checked_text_stream, start_ingest, start_reject_log

SEP = "\u0001"

LENIENT = [
    ("2019-01-01 05:03:04", "2019-01-01 05:03:04"),
    ("2019-1-1 5:3:4", "2019-01-01 05:03:04"),
    ("2019-13-01 00:00:00", "2020-01-01 00:00:00"),
    ("2019-00-10 00:00:00", "2018-12-10 00:00:00"),
    ("2019-02-30 00:00:00", "2019-03-02 00:00:00"),
    ("2020-02-30 00:00:00", "2020-03-01 00:00:00"),
    ("2019-01-00 00:00:00", "2018-12-31 00:00:00"),
    ("2019-01-01 25:61:61", "2019-01-02 02:02:01"),
    ("2019-01-01 -1:00:00", "2018-12-31 23:00:00"),
    ("2019--1-01 00:00:00", "2018-11-01 00:00:00"),
    ("2019-01-01 00:00:100000", "2019-01-02 03:46:40"),
    ("  2019- 1-01  5:03: 4", "2019-01-01 05:03:04"),
    ("2019-01-01 05:03:04.999 UTC", "2019-01-01 05:03:04"),
    ("2019-01-01 05:03:04abc", "2019-01-01 05:03:04"),
    ("2019-01-400 00:00:00", "2020-02-04 00:00:00"),
    ("19-01-01 00:00:00", "0019-01-01 00:00:00"),
    ("2019-01-01", None), ("2019-01-01T05:03:04", None), ("x2019-01-01 05:03:04", None), ("", None), (None, None),
    ("99999-01-01 00:00:00", None), ("2019-01-99999999 00:00:00", None), ("99999999999-01-01 00:00:00", None), ("9999-12-32 00:00:00", None),
]


def test_lenient_times(spark):
    df = spark.createDataFrame(LENIENT, "t string, want string")
    got = df.select("t", "want", parse_time("t", lenient=True).cast("string").alias("got"), parse_time("t").cast("string").alias("strict")).collect()
    assert [(r.t, r.got) for r in got] == [(r.t, r.want) for r in got]
    assert {r.t for r in got if r.strict} == {"2019-01-01 05:03:04", "2019-1-1 5:3:4"}


def test_lenient_comparisons(spark):
    rows = [("2019-01-01 24:00:00 x", "2019-01-02 00:00:01"), ("2019-02-29 00:00:00", "2019-03-01 00:00:00"), ("no", "2019-01-01 00:00:00"), ("9000-01-01 00:00:00", "2019-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [tuple(r) for r in df.select(before("a", "b", True), after("a", "b", True), minus("a", "b", True)).collect()]
    assert got == [(True, False, -1), (False, False, 0), (False, False, 0), (False, True, 0)]


def _line(n=12, **fields):
    values = {0: "2019-01-01", 1: "7", 2: "abc", 3: "3", 4: "2019-01-01 5:03:09", 5: "hot pot", 6: "12", 7: "40", 8: "3,5", 9: "1", 10: "null", 11: "null"}
    values |= {int(k[1:]): v for k, v in fields.items()}
    return SEP.join(values.get(i, "extra") for i in range(n))


LINES = [_line(), _line(11), _line(13), _line(13), _line(1), _line(_4="2019-01-01 25:00:00"), _line(_1="seven"), _line(_6="null", _7=""), "", _line(_5='"quoted')]


def test_wrong_field_counts_are_reported(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "a.txt").write_text("\n".join(LINES) + "\n")
    lines = read_visit_lines(spark, str(tmp_path / "in"))
    visits, rejects = checked_visits(lines)
    assert visits.count() + rejects.count() == len([x for x in LINES if x])
    counts = {(r.reason, r.n_fields): r.n_lines for r in reject_counts(rejects).collect()}
    assert counts == {("field count", 11): 1, ("field count", 13): 2, ("field count", 1): 1}
    assert {r.line for r in rejects.collect()} == {_line(11), _line(13), _line(1)}
    whole = str(tmp_path / "whole")
    os.makedirs(whole)
    good = [x for x in LINES if x.count(SEP) == 11]
    (tmp_path / "whole" / "a.txt").write_text("\n".join(good) + "\n")
    assert sorted(map(str, visits.collect())) == sorted(map(str, read_visit_text(spark, whole).collect()))


def test_strict_values_are_reported(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    visits, rejects = checked_visits(lines, strict_values=True)
    counts = {(r.reason, r.n_fields): r.n_lines for r in reject_counts(rejects).collect()}
    assert counts[("action_time", 12)] == counts[("user_id", 12)] == 1 and visits.count() == 3
    lenient, rejects = checked_visits(lines, lenient_times=True, strict_values=True)
    assert rejects.where("reason = 'action_time'").count() == 0
    assert datetime(2019, 1, 2, 1) in {r.action_time for r in lenient.collect()}


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_rejects_of_a_stream(spark, tmp_path, ending):
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "a.txt").write_text(ending.join(LINES) + ending, newline="")
    visits, rejects = checked_text_stream(spark, str(tmp_path / "in"))
    queries = [
        start_ingest(visits, str(tmp_path / "t"), str(tmp_path / "c1"), available_now=True),
        start_reject_log(rejects, str(tmp_path / "r"), str(tmp_path / "c2"), available_now=True),
    ]
    for q in queries:
        q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5
    bad = spark.read.parquet(str(tmp_path / "r"))
    assert {(r.reason, r.n_fields, r.line) for r in bad.collect()} == {("field count", n, _line(n)) for n in (1, 11, 13)} and bad.count() == 4
