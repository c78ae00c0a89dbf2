"""Values of a session in arrival order, in chunks of bounded length.

The reference keeps four lists per session (searched keywords, clicked, ordered and
paid category fields) in one row, which grows with the session.  Here a list is cut into
chunks of at most ``chunk`` values: rows (session, user, kind, chunk_no, values) whose
concatenation is the whole list.

Arrival order is (action_time, page_id, value), NULL first, so reruns agree.  Equal actions are
folded with a count by a pre-aggregated grouping.  Positions come from
``ranking.split_large_groups``: a long session is cut at sampled times, the buckets' sums give
the position at which each begins, and only rows of one bucket meet in a window.  So no
row and no task holds a hot session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlens.operators import topn
from visitlens.operators.ranking import bucket_offsets, join_null_safe, split_large_groups

KIND_COLUMNS = {"search": "search_keywords", "click": "click_category_ids", "order": "order_category_ids",
                "pay": "pay_category_ids"}
SEPARATOR = "\u0001"
CHUNK = 10_000  # values of a chunk
_LIST = ["session_id", "user_id", "kind"]
_ORDER = ["action_time", "page_id", "value"]


def _values(visits: DataFrame, split_ids: bool) -> DataFrame:
    items = F.concat(
        F.array(F.struct(F.lit("search").alias("kind"), F.col("search_keyword").alias("token"))),
        topn._token_structs("click", F.col("click_category_id").cast("string"), False),
        topn._token_structs("order", F.col("order_category_ids"), split_ids),
        topn._token_structs("pay", F.col("pay_category_ids"), split_ids),
    )
    kept = F.inline(F.filter(items, lambda s: s["token"].isNotNull()))
    long = visits.select("session_id", "user_id", "action_time", "page_id", kept).withColumnRenamed("token", "value")
    return long.groupBy(*_LIST, *_ORDER).agg(F.count(F.lit(1)).alias("n"))


def value_positions(visits: DataFrame, split_ids: bool = False) -> DataFrame:
    """``session_id, user_id, kind, value, position, n``: the value stands at the positions
    ``position .. position + n - 1`` (from 0) of the session's list of that kind."""
    values = split_large_groups(_values(visits, split_ids), _LIST, _ORDER)
    offsets = bucket_offsets(values, _LIST, ["_bucket"], F.col("n")).drop("rows_before")
    placed = join_null_safe(values, offsets, [*_LIST, "_bucket"])
    within = Window.partitionBy(*_LIST, "_bucket").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, -1)
    position = F.col("weight_before") + F.coalesce(F.sum("n").over(within), F.lit(0))
    return placed.select(*_LIST, "value", position.cast("bigint").alias("position"), "n")


def session_value_chunks(visits: DataFrame, chunk: int = CHUNK, split_ids: bool = False) -> DataFrame:
    """``session_id, user_id, kind, chunk_no, values``: chunk k holds the values at the
    positions ``k * chunk .. (k + 1) * chunk - 1``; every chunk but a list's last is full."""
    size, last = F.lit(int(chunk)), F.col("position") + F.col("n") - 1
    number = F.sequence(F.floor(F.col("position") / size), F.floor(last / size))
    parts = value_positions(visits, split_ids).withColumn("chunk_no", F.explode(number))
    low = F.greatest("position", F.col("chunk_no") * size)
    high = F.least(last, (F.col("chunk_no") + 1) * size - 1)
    parts = parts.select(*_LIST, "chunk_no", F.struct(low.alias("at"), "value", (high - low + 1).cast("int").alias("n")).alias("part"))
    whole = parts.groupBy(*_LIST, "chunk_no").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    values = F.flatten(F.transform("parts", lambda p: F.array_repeat(p["value"], p["n"])))
    return whole.select(*_LIST, "chunk_no", values.alias("values"))


def session_profile_lists(profile: DataFrame, visits: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The session profile with the four lists, joined by ``\\u0001`` (``""`` when empty).

    One row per profile row and chunk: an ordinary session has the one row with chunk_no 0, a
    session with more than ``chunk`` values of a kind continues in further rows.  ``visits`` is
    the date-filtered log the profile came from.
    """
    chunks = session_value_chunks(visits, chunk)
    text = F.concat_ws(SEPARATOR, "values")
    lists = chunks.groupBy("session_id", "user_id", "chunk_no").agg(
        *[F.max(F.when(F.col("kind") == kind, text)).alias(name) for kind, name in KIND_COLUMNS.items()]
    )
    wide = join_null_safe(profile, lists, ["session_id", "user_id"], "left")
    return wide.select(
        *profile.columns,
        F.coalesce("chunk_no", F.lit(0)).cast("bigint").alias("chunk_no"),
        *[F.coalesce(name, F.lit("")).alias(name) for name in KIND_COLUMNS.values()],
    )
