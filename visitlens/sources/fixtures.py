"""Map the driver's testdata tables onto the visit-log and user-profile schemas.

``events`` becomes ``user_visit_action`` and ``customer`` x ``nation`` becomes
``user_info`` (FIXTURES.md §3).  Both are lazy DataFrame views over the
parquet files, so column pruning and the date-range filter reach the scan.

Session grain "day" makes one session per user and day; "month" one per user
and month.  ``time_divisor`` > 1 compresses each day's clock (seconds of the
day integer-divided by it) so short visit lengths occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.dates import format_date, format_month
from visitlens.schema import VISIT_COLUMNS

GRAINS = ("day", "month")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _scaled_time(ts: Column, divisor: int) -> Column:
    if divisor == 1:
        return ts
    sec_of_day = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts).cast("int")
    midnight = F.to_date(ts).cast("timestamp_ntz")
    return F.timestamp_add("SECOND", F.floor(sec_of_day / divisor).cast("int"), midnight)


def visit_actions(
    spark: SparkSession,
    sf_dir: str,
    *,
    grain: str = "day",
    time_divisor: int = 1,
    start_date: str | None = None,
    end_date: str | None = None,
) -> DataFrame:
    """The visit log derived from ``events`` (12 columns, VISIT_ACTION schema).

    ``start_date`` / ``end_date`` (inclusive ``yyyy-MM-dd``) prune on the raw
    ``ts`` column so the range is pushed into the parquet scan; ``datestr``
    is derived from the same ``ts``, so this equals filtering ``datestr``.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {sorted(GRAINS)}")
    if time_divisor < 1:
        raise ValueError("time_divisor must be >= 1")
    e = _table(spark, sf_dir, "events")
    if start_date:
        e = e.where(F.col("ts") >= F.lit(start_date).cast("date").cast("timestamp_ntz"))
    if end_date:
        e = e.where(F.col("ts") < F.date_add(F.lit(end_date).cast("date"), 1).cast("timestamp_ntz"))
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    kind = F.col("event_type")
    product = (F.col("event_id") % 100)
    datestr = format_date("ts")
    session_key = datestr if grain == "day" else format_month("ts")
    out = e.select(
        datestr.alias("datestr"),
        F.col("user_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("_"), session_key).alias("session_id"),
        (F.col("event_id") % 10).alias("page_id"),
        _scaled_time(F.col("ts"), time_divisor).alias("action_time"),
        F.when(kind == "view", F.concat(F.lit("kw"), (k % 10).cast("string"))).alias("search_keyword"),
        F.when(kind == "click", k).alias("click_category_id"),
        F.when(kind == "click", product).alias("click_product_id"),
        F.when(kind == "signup", k.cast("string")).alias("order_category_ids"),
        F.when(kind == "signup", product.cast("string")).alias("order_product_ids"),
        F.when(kind == "purchase", k.cast("string")).alias("pay_category_ids"),
        F.when(kind == "purchase", product.cast("string")).alias("pay_product_ids"),
    )
    return out.select(*VISIT_COLUMNS)


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User profiles from ``customer`` joined to ``nation`` (a fixed 25-row table)."""
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "inner")
    return j.select(
        F.col("c_custkey").alias("userid"),
        (F.lit(18) + F.col("c_custkey") % 43).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.col("n_name").alias("city"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("male")).otherwise(F.lit("female")).alias("sex"),
    )


def register_views(spark: SparkSession, sf_dir: str, grain: str = "day") -> list[str]:
    """Expose the fixture views to Spark SQL as ``user_visit_action`` and ``user_info``.

    Lets SQL users query the testdata under the visit-log schema, e.g.
    ``spark.sql("select session_id, count(*) from user_visit_action group by 1")``.
    """
    visit_actions(spark, sf_dir, grain=grain).createOrReplaceTempView("user_visit_action")
    user_info(spark, sf_dir).createOrReplaceTempView("user_info")
    return ["user_visit_action", "user_info"]


def task_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A task table derived from ``events``: one task per distinct day of data.

    taskid = the day as ``yyyyMMdd``; ``task_param`` is a JSON object that asks
    for that day, ages 20-40 and, on odd days, a category list given as a JSON
    array (which reads back as its JSON text).  No window or driver step: ids
    come from the day itself.
    """
    days = _table(spark, sf_dir, "events").select(format_date("ts").alias("day")).distinct()
    odd = F.dayofmonth(F.to_date("day")) % 2 == 1
    param = F.to_json(F.struct(
        F.col("day").alias("startDate"),
        F.col("day").alias("endDate"),
        F.lit("20").alias("startAge"),
        F.lit("40").alias("endAge"),
        F.when(odd, F.lit("female")).otherwise(F.lit("male")).alias("sex"),
        F.when(odd, F.array(F.lit(5), F.lit(17))).alias("categoryIds"),
    ))
    return days.select(
        F.regexp_replace("day", "-", "").cast("bigint").alias("taskid"),
        F.concat(F.lit("day "), F.col("day")).alias("task_name"),
        F.lit(None).cast("string").alias("create_time"),
        F.lit(None).cast("string").alias("start_time"),
        F.lit(None).cast("string").alias("finish_time"),
        F.lit("session").alias("task_type"),
        F.lit("new").alias("task_status"),
        param.alias("task_param"),
    )
