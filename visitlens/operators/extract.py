"""Hour-proportional random extraction of sessions (and its per-hour counts).

For each day, ``per_day`` sessions are to be drawn, split over the day's
hours in proportion to their session counts: hour quota
``floor(hour_sessions * per_day / day_sessions)`` (integer arithmetic).
Inside an hour the draw is the sessions with the smallest
``md5(session_id || '|' || seed)``: random-looking, repeatable, and the same
in every engine.

Profile rows carry a ``weight`` (w identical joined rows); such a row fills
w consecutive draw slots and is emitted as often as it was drawn.

Scale: an hour is cut into buckets by the leading digits of the draw key, which
are uniform.  The buckets' weights are counted (pre-aggregated) and summed in
key order; only buckets that begin below the hour's quota are read on, and rows
are ranked inside their bucket (``operators.ranking``).  This is exact for any
``per_day``, and no task ever sees a whole hour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.functions.dates import date_hour, format_date, format_time
from visitlens.operators.joins import broadcast_if_small
from visitlens.operators.ranking import bucket_offsets, rank_in_buckets

# Leading hex digits of the draw key that name a bucket (4096 buckets an hour).
DRAW_DIGITS = 3
DRAW_ORDER = ["draw", "session_id", "user_id", "age", "professional", "city", "sex"]


def _weight(profile: DataFrame) -> Column:
    return F.col("weight") if "weight" in profile.columns else F.lit(1).cast("bigint")


def _with_hour(profile: DataFrame) -> DataFrame:
    attrs = [c for c in ("age", "professional", "city", "sex") if c in profile.columns]
    return profile.select(
        "session_id",
        "user_id",
        "start_time",
        *attrs,
        _weight(profile).alias("weight"),
        format_date("start_time").alias("day"),
        date_hour("start_time").alias("date_hour"),
    ).where(F.col("start_time").isNotNull())


def sessions_per_hour(profile: DataFrame) -> DataFrame:
    """``date_hour, session_count`` (A11)."""
    return _with_hour(profile).groupBy("date_hour").agg(F.sum("weight").cast("bigint").alias("session_count"))


def sessions_per_day(profile: DataFrame) -> DataFrame:
    """``day, session_count`` (A12)."""
    return _with_hour(profile).groupBy("day").agg(F.sum("weight").cast("bigint").alias("session_count"))


def hour_quotas(profile: DataFrame, per_day: int) -> DataFrame:
    """``day, date_hour, hour_count, day_count, quota`` (one row per hour with sessions).

    The hour table has at most 24 rows per day, so the day total is a window
    over that small table.
    """
    hours = _with_hour(profile).groupBy("day", "date_hour").agg(F.sum("weight").cast("bigint").alias("hour_count"))
    hours = hours.withColumn("day_count", F.sum("hour_count").over(Window.partitionBy("day")).cast("bigint"))
    scaled = F.col("hour_count") * F.lit(int(per_day))
    quota = F.call_function("div", scaled, F.col("day_count"))
    return hours.withColumn("quota", quota)


def draw_key(session_id: str, seed: str) -> Column:
    return F.md5(F.concat(F.col(session_id), F.lit("|" + str(seed))))


def extract_sessions(profile: DataFrame, per_day: int, seed: str = "0") -> DataFrame:
    """The drawn sessions: ``session_id, user_id, start_time, date_hour, pick, copy``.

    One row per drawn slot: ``pick`` is the row's rank in its hour, ``copy``
    numbers the slots of a weighted row.
    """
    s = _with_hour(profile).withColumn("draw", draw_key("session_id", seed)).where(F.col("draw").isNotNull())
    s = s.withColumn("bucket", F.substring("draw", 1, DRAW_DIGITS))
    order = [c for c in DRAW_ORDER if c in s.columns]
    key = ["date_hour"], ["bucket"]
    quotas = hour_quotas(profile, per_day).select("date_hour", "quota")
    offsets = bucket_offsets(s, *key, F.col("weight")).join(quotas, "date_hour").where(F.col("weight_before") < F.col("quota"))
    ranked = rank_in_buckets(s, offsets, *key, order).withColumnRenamed("rank", "pick")
    # slots taken by earlier rows of the bucket and by earlier buckets
    rows = Window.partitionBy("date_hour", "bucket").orderBy("pick").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.col("weight_before") + F.coalesce(F.sum("weight").over(rows), F.lit(0))
    j = ranked.withColumn("earlier", earlier.cast("bigint"))
    copies = F.least(F.col("weight"), F.col("quota") - F.col("earlier"))
    j = j.withColumn("copies", copies).where(F.col("copies") > 0)
    return j.select(
        "session_id", "user_id", "start_time", "date_hour", "pick",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"),
    )


def _joined(values: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_set(values)), lambda x: x.cast("string")), ",")


def random_extract(
    profile: DataFrame,
    visits: DataFrame,
    per_day: int,
    seed: str = "0",
    taskid: int | None = None,
    kept: list[DataFrame] | None = None,
    measure: bool = True,
) -> DataFrame:
    """Drawn sessions with their distinct searched keywords and clicked
    categories (sorted, comma-joined), as the ``session_random_extract`` table.

    ``visits`` must be the same date-filtered visit log the profile came from,
    so every drawn session has at least one action there.  The drawn set
    (at most ``per_day`` x days slots) is materialised and measured, then
    joined to the actions once, broadcast when under the threshold so the
    visit log is not shuffled; the lists are built only for the drawn
    sessions, from sets bounded by the distinct values.
    """
    drawn = extract_sessions(profile, per_day, seed)
    if measure:
        drawn, _ = broadcast_if_small(drawn, kept)
    acts = visits.select("session_id", "user_id", "search_keyword", "click_category_id")
    j = acts.join(drawn, ["session_id", "user_id"], "inner")
    out = j.groupBy("session_id", "user_id", "start_time", "pick", "copy").agg(
        _joined(F.col("search_keyword")).alias("search_keywords"),
        _joined(F.col("click_category_id")).alias("click_category_ids"),
    )
    cols = [F.lit(int(taskid)).cast("bigint").alias("taskid")] if taskid is not None else []
    return out.select(
        *cols,
        F.col("session_id").alias("sessionid"),
        format_time("start_time").alias("start_time"),
        F.col("search_keywords"),
        F.col("click_category_ids"),
    )


def random_extract_from_parts(
    profile: DataFrame,
    kinds: DataFrame,
    keywords: DataFrame,
    per_day: int,
    seed: str = "0",
    taskid: int | None = None,
    kept: list[DataFrame] | None = None,
    measure: bool = True,
) -> DataFrame:
    """``random_extract`` with the lists taken from session x category counts and keywords
    (of the daily states, or ``sessions.kinds_part`` / ``keywords_part``) instead of the visit log.

    Same rows as ``random_extract``: the clicked categories of a session are its
    ``click_n > 0`` rows, its keywords the keyword rows.  The measured drawn
    set meets those tables map-side, and no action is read.
    """
    drawn = extract_sessions(profile, per_day, seed)
    if measure:
        drawn, _ = broadcast_if_small(drawn, kept)
    values = keywords.select("session_id", "user_id", "keyword", F.lit(None).cast("bigint").alias("category_id"))
    values = values.unionByName(
        kinds.where(F.col("click_n") > 0).select(
            "session_id", "user_id", F.lit(None).cast("string").alias("keyword"), "category_id"
        )
    )
    slot = ["session_id", "user_id", "start_time", "pick", "copy"]
    matched = values.join(drawn, ["session_id", "user_id"], "inner").select(*slot, "keyword", "category_id")
    # every drawn slot also contributes an empty row, so slots without keywords
    # or clicks survive the grouping without an outer join
    empty = drawn.select(*slot, F.lit(None).cast("string").alias("keyword"),
                         F.lit(None).cast("bigint").alias("category_id"))
    out = matched.unionByName(empty).groupBy(*slot).agg(
        _joined(F.col("keyword")).alias("search_keywords"),
        _joined(F.col("category_id")).alias("click_category_ids"),
    )
    cols = [F.lit(int(taskid)).cast("bigint").alias("taskid")] if taskid is not None else []
    return out.select(
        *cols,
        F.col("session_id").alias("sessionid"),
        format_time("start_time").alias("start_time"),
        F.coalesce("search_keywords", F.lit("")).alias("search_keywords"),
        F.coalesce("click_category_ids", F.lit("")).alias("click_category_ids"),
    )
