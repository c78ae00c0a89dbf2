"""Results must not depend on the session time zone (wall-clock NTZ values)."""

from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as E
from visitlens.plans import queries as Q
from conftest import SF_SMALL
from conftest import visit_row as V
from test_oracle import _digest
from visitlens.functions import dates
from visitlens.operators import sessions


@pytest.fixture
def la_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", old)


def test_dst_gap_is_wall_clock(la_zone, make_visits):
    v = make_visits([
        V("a", 1, datetime(2024, 3, 10, 1, 59, 59)),
        V("a", 1, datetime(2024, 3, 10, 2, 30, 0)),  # does not exist in LA local time
        V("a", 1, datetime(2024, 3, 10, 3, 0, 1)),
    ])
    r = sessions.session_rollup(v).select(
        "visit_length", dates.format_time("start_time").alias("t"), dates.date_hour("end_time").alias("h")
    ).first()
    assert (r.visit_length, r.t, r.h) == (3602, "2024-03-10 01:59:59", "2024-03-10_03")
    df = la_zone.createDataFrame([("2024-03-10 2:30:00",)], "s string")
    assert str(df.select(dates.parse_time("s").alias("t")).first().t) == "2024-03-10 02:30:00"


def test_queries_match_sql_in_another_zone(la_zone):
    con = duckdb.connect()
    for t in ("events", "customer", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sql = E.oracle_sql()
    bad = []
    for name, fn in Q.QUERIES.items():
        df = fn(la_zone, SF_SMALL)
        rows = [tuple(r) for r in df.collect()]
        res = con.execute(sql[name])
        cols = [c[0] for c in res.description]
        if _digest(df.columns, rows) != _digest(cols, res.fetchall()):
            bad.append(name)
    assert not bad
