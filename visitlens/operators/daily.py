"""Daily session states: what tasks over the same visit log share.

Two narrow tables per day, both mergeable, hold what a task needs of the actions:

* sessions: datestr, session_id, user_id, first_time, last_time, steps;
* values: datestr, session_id, user_id, kind, value, n (searched keywords, clicked, ordered
  and paid category fields with their number).

A day is computed once (``write_daily_states``, partitioned by ``datestr``; a day written again
replaces itself).  A task reads the states of its date range and merges them: minimum,
maximum and sums, so sessions over midnight come out as from the actions.  Hit flags of
keyword and category filters come from the values, in the same grouping.  Only the detail
export still reads actions.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.dates import seconds_between
from visitlens.operators import topn
from visitlens.operators.predicates import date_range, mark_listed, session_hit_aggregates
from visitlens.params import TaskParams

_SESSION = ["session_id", "user_id"]
_VALUE = [*_SESSION, "kind", "value"]


class DailyStates(NamedTuple):
    sessions: DataFrame
    values: DataFrame

    def between(self, start_date: str | None, end_date: str | None) -> "DailyStates":
        return DailyStates(*(date_range(t, start_date, end_date) for t in self))


def daily_sessions(visits: DataFrame) -> DataFrame:
    """One row per day, session and user: first and last action, number of actions."""
    return visits.groupBy("datestr", *_SESSION).agg(
        F.min("action_time").alias("first_time"),
        F.max("action_time").alias("last_time"),
        F.count("session_id").alias("steps"),
    )


def daily_values(visits: DataFrame) -> DataFrame:
    """One row per day, session, user, kind and value (fields as they are, lists unsplit)."""
    fields = F.array(
        F.struct(F.lit("search").alias("kind"), F.col("search_keyword").alias("value")),
        *[F.struct(F.lit(k).alias("kind"), F.col(topn._FIELDS[k]).cast("string").alias("value")) for k in topn.KINDS],
    )
    long = visits.select("datestr", *_SESSION, F.inline(F.filter(fields, lambda s: s["value"].isNotNull())))
    return long.groupBy("datestr", *_VALUE).agg(F.count(F.lit(1)).alias("n"))


def daily_states(visits: DataFrame) -> DailyStates:
    return DailyStates(daily_sessions(visits), daily_values(visits))


def write_daily_states(visits: DataFrame, path: str) -> None:
    """Write the states of the days in ``visits``, replacing those days and no others."""
    for name, table in daily_states(visits)._asdict().items():
        writer = table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("datestr")
        writer.parquet(f"{path.rstrip('/')}/{name}")


def read_daily_states(spark: SparkSession, path: str) -> DailyStates:
    """The written states; a date range on them prunes ``datestr`` folders."""

    def read(name: str) -> DataFrame:
        df = spark.read.parquet(f"{path.rstrip('/')}/{name}")
        return df.withColumn("datestr", F.date_format("datestr", "yyyy-MM-dd")) if dict(df.dtypes)["datestr"] == "date" else df

    return DailyStates(read("sessions"), read("values"))


def rollup_from_daily(sessions: DataFrame, values: DataFrame | None = None, params: TaskParams | None = None) -> DataFrame:
    """The rows of ``session_rollup`` over the days of the states, one grouping.

    ``values`` are needed only if ``params`` has a keyword or category filter."""
    hits = session_hit_aggregates(params)
    rows = sessions.select(*_SESSION, "first_time", "last_time", "steps")
    if hits:
        if values is None:
            raise ValueError("keyword and category filters need the daily values")
        field = lambda kind: F.when(F.col("kind") == kind, F.col("value"))
        found = values.where(F.col("kind").isin("search", "click")).select(
            *_SESSION, field("search").alias("search_keyword"), field("click").cast("bigint").alias("click_category_id")
        )
        rows = rows.unionByName(mark_listed(found, params), allowMissingColumns=True)
    agg = rows.groupBy(*_SESSION).agg(
        F.min("first_time").alias("start_time"),
        F.max("last_time").alias("end_time"),
        F.sum("steps").alias("step_length"),
        *hits,
    )
    flags = [c for c in agg.columns if c.endswith("_hit")]
    length = seconds_between("end_time", "start_time").alias("visit_length")
    return agg.select(*_SESSION, "start_time", "end_time", length, "step_length", *flags)


def kinds_from_daily(values: DataFrame, split_ids: bool = False) -> DataFrame:
    """The rows of ``topn.session_category_kinds``."""
    rows = values.where(F.col("kind").isin(*topn.KINDS))
    if split_ids:
        rows = rows.withColumn("value", F.explode(F.split("value", ",")))
    number = F.when(~F.col("value").isin(*topn.MISSING_TOKENS), F.col("value").try_cast("bigint"))
    rows = rows.select(*_SESSION, "kind", number.alias("category_id"), "n").where(F.col("category_id").isNotNull())
    counts = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"{k}_n") for k in topn.KINDS]
    return rows.groupBy(*_SESSION, "category_id").agg(*counts)


def keywords_from_daily(values: DataFrame) -> DataFrame:
    """``session_id, user_id, keyword``: each session's distinct searched keywords."""
    return values.where(F.col("kind") == "search").select(*_SESSION, F.col("value").alias("keyword")).distinct()
