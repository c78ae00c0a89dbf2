"""Top categories, top sessions per category, and the detail export.

The reference counts categories by splitting per-session id lists; here the
actions stay in long form: one row per (action, category, kind).  Counts
are weighted by how many profile rows a session's user contributes (a
userid listed twice counts its sessions twice, as the inner join does), so
results equal counting over the session profile without building it.

Plan shape (scope "all"):
  actions -> partial/final agg on (user, category)   [shuffle of partial counts]
          -> join user weights (broadcast when small: Catalyst's estimate,
             or measured first in run_task; else sort-merge + AQE skew split)
          -> agg on category                         [tiny]
          -> TakeOrderedAndProject(top 10)
Top sessions:
  actions -> agg on (session, user, category) -> join weights
          -> agg on (session, category)
          -> exact rank in buckets of equal clicks (``operators.ranking``): only
             buckets within the first N rows of a category are ranked, with a partial
             limit in every task for small N, cut further at sampled ids for large N.
User weights keep one row per distinct user variant, so the join with them has
exchanges on both sides and a hot user can be split.
Detail export: the distinct top-session ids (<= N x categories rows) are
measured and broadcast, so the visit log is probed map-side, not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.functions.dates import format_time
from visitlens.operators.joins import broadcast_if_small, probably_in
from visitlens.operators.ranking import bucket_offsets, rank_in_buckets, split_large_groups
from visitlens.operators.users import user_variants

KINDS = ("click", "order", "pay")
MISSING_TOKENS = ("", "null")
_FIELDS = {"click": "click_category_id", "order": "order_category_ids", "pay": "pay_category_ids"}
# Up to this N every task passes on N rows of a category and click count (Spark's window
# group limit), so ties need no further buckets; beyond, they are cut at sampled ids.
# Both are exact.
PARTIAL_TOP = 100


def _token_structs(kind: str, column: Column, split: bool) -> Column:
    if split:
        # concat() is NULL if any array is NULL, so a missing field must give []
        parts = F.coalesce(F.split(column, ","), F.array().cast("array<string>"))
        return F.transform(parts, lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("token")))
    return F.array(F.struct(F.lit(kind).alias("kind"), column.alias("token")))


def category_actions(visits: DataFrame, split_ids: bool = False, kind: str | None = None) -> DataFrame:
    """Long form: ``session_id, user_id, kind, category_id`` per categorised action.

    With ``kind`` only that kind's field is read, and rows without it are
    filtered at the scan.

    Click ids are one number; order/pay id fields are one token each unless
    ``split_ids`` splits them on commas.  NULL, ``""`` and ``"null"`` tokens
    are missing.  With ``kind`` "order" or "pay", ``category_id`` is the token's
    text and every token is kept, ``3,5`` as one (the reference counts it
    so).  Without ``kind`` the rows serve the categories that are clicked,
    ordered and paid: a token that is no number equals no click id and is left out.
    """
    if kind is not None:
        visits = visits.where(F.col(_FIELDS[kind]).isNotNull())
        field = F.col(_FIELDS[kind])
        token = field.cast("bigint") if kind == "click" else F.explode(F.split(field, ",")) if split_ids else field
        long = visits.select("session_id", "user_id", F.lit(kind).alias("kind"), token.alias("category_id"))
        return long.where(F.col("category_id").isNotNull() if kind == "click" else ~F.col("category_id").isin(*MISSING_TOKENS))
    items = F.concat(*[
        _token_structs(k, F.col(_FIELDS[k]).cast("string"), split_ids and k != "click") for k in KINDS
    ])
    kept = F.filter(items, lambda s: s["token"].isNotNull() & ~s["token"].isin(*MISSING_TOKENS))
    long = visits.select("session_id", "user_id", F.inline(kept))
    return long.select(
        "session_id", "user_id", "kind", F.col("token").try_cast("bigint").alias("category_id")
    ).where(F.col("category_id").isNotNull())


def user_weights(
    users: DataFrame | None, kept: list[DataFrame] | None = None, measure: bool = False, variants: DataFrame | None = None
) -> DataFrame:
    """``user_id, weight``: profile rows each user id yields in the inner join, one row
    per distinct user variant (the weights of an id add up).

    With ``measure`` the table is measured and broadcast when under the
    threshold (see ``session_profile``); otherwise Catalyst/AQE choose.
    """
    if variants is None:
        variants = user_variants(users)
        if measure:
            variants, _ = broadcast_if_small(variants, kept)
    return variants.select(F.col("userid").alias("user_id"), "weight")


def session_weights(profile: DataFrame) -> DataFrame:
    """``session_id, user_id, weight`` from a (filtered) profile."""
    w = F.sum("weight") if "weight" in profile.columns else F.count(F.lit(1))
    return profile.groupBy("session_id", "user_id").agg(w.cast("bigint").alias("weight"))


def _weighted(pre: DataFrame, weights: DataFrame, keys: list[str]) -> DataFrame:
    return pre.join(weights, keys, "inner")


def category_counts(actions: DataFrame, weights: DataFrame) -> DataFrame:
    """``category_id, click_count, order_count, pay_count`` over the weighted actions."""
    keys = [c for c in weights.columns if c != "weight"]
    pre = actions.groupBy(*keys, "category_id").agg(
        *[F.count_if(F.col("kind") == k).alias(f"{k}_n") for k in KINDS]
    )
    j = _weighted(pre, weights, keys)
    return j.groupBy("category_id").agg(
        *[F.sum(F.col(f"{k}_n") * F.col("weight")).cast("bigint").alias(f"{k}_count") for k in KINDS]
    )


def kind_counts(actions: DataFrame, weights: DataFrame, kind: str) -> DataFrame:
    """``category_id, count`` for one action kind (A2-A4)."""
    keys = [c for c in weights.columns if c != "weight"]
    pre = actions.where(F.col("kind") == kind).groupBy(*keys, "category_id").agg(F.count(F.lit(1)).alias("n"))
    j = _weighted(pre, weights, keys)
    return j.groupBy("category_id").agg(F.sum(F.col("n") * F.col("weight")).cast("bigint").alias(f"{kind}_count"))


def session_category_kinds(actions: DataFrame) -> DataFrame:
    """``session_id, user_id, category_id, click_n, order_n, pay_n``.

    One aggregate both top-N outputs can share (``run_task`` persists it), so
    the action log is read and shuffled once for the two of them.
    """
    return actions.groupBy("session_id", "user_id", "category_id").agg(
        *[F.count_if(F.col("kind") == k).alias(f"{k}_n") for k in KINDS]
    )


def category_counts_from(kinds: DataFrame, weights: DataFrame) -> DataFrame:
    """``category_counts`` from the shared session-category aggregate.

    The aggregate is first folded to the weights' grain (per user and
    category for user weights, far fewer rows than per session), so only
    that smaller table meets the join.
    """
    keys = [c for c in weights.columns if c != "weight"]
    folded = kinds.groupBy(*keys, "category_id").agg(*[F.sum(f"{k}_n").alias(f"{k}_n") for k in KINDS])
    j = _weighted(folded, weights, keys)
    return j.groupBy("category_id").agg(
        *[F.sum(F.col(f"{k}_n") * F.col("weight")).cast("bigint").alias(f"{k}_count") for k in KINDS]
    )


def session_clicks_from(kinds: DataFrame, weights: DataFrame) -> DataFrame:
    """``session_category_clicks`` from the shared session-category aggregate."""
    keys = [c for c in weights.columns if c != "weight"]
    j = _weighted(kinds.where(F.col("click_n") > 0), weights, keys)
    return j.groupBy("session_id", "category_id").agg(
        F.sum(F.col("click_n") * F.col("weight")).cast("bigint").alias("click_count")
    )


def top_categories(counts: DataFrame, n: int = 10, taskid: int | None = None) -> DataFrame:
    """Categories clicked, ordered and paid, by click, order, pay count (desc), then id."""
    ranked = (
        counts.where((F.col("click_count") > 0) & (F.col("order_count") > 0) & (F.col("pay_count") > 0))
        .orderBy(F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id"))
        .limit(n)
    )
    cols = [F.lit(int(taskid)).cast("bigint").alias("taskid")] if taskid is not None else []
    return ranked.select(*cols, F.col("category_id").alias("categoryid"), "click_count", "order_count", "pay_count")


def session_category_clicks(actions: DataFrame, weights: DataFrame) -> DataFrame:
    """``session_id, category_id, click_count`` (A5); sessions are keyed by id only."""
    keys = [c for c in weights.columns if c != "weight"]
    pre = (
        actions.where(F.col("kind") == "click")
        .groupBy("session_id", *[k for k in keys if k != "session_id"], "category_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    j = _weighted(pre, weights, keys)
    return j.groupBy("session_id", "category_id").agg(
        F.sum(F.col("n") * F.col("weight")).cast("bigint").alias("click_count")
    )


def top_sessions_per_category(clicks: DataFrame, n: int = 10, taskid: int | None = None) -> DataFrame:
    """Top ``n`` sessions of *every* category by clicks (desc), ties by session id."""
    clicks = clicks.where(F.col("category_id").isNotNull()).withColumn("_clicks", -F.col("click_count"))
    first = bucket_offsets(clicks, ["category_id"], ["_clicks"]).where(F.col("rows_before") < F.lit(int(n)))
    if n <= PARTIAL_TOP:
        ranked = rank_in_buckets(clicks, first, ["category_id"], ["_clicks"], ["session_id"], n)
    else:
        near = clicks.join(first.select("category_id", "_clicks"), ["category_id", "_clicks"], "left_semi")
        near = split_large_groups(near, ["category_id", "_clicks"], ["session_id"])
        buckets = ["_clicks", "_bucket"]
        offsets = bucket_offsets(near, ["category_id"], buckets).where(F.col("rows_before") < F.lit(int(n)))
        ranked = rank_in_buckets(near, offsets, ["category_id"], buckets, ["session_id"])
    ranked = ranked.where(F.col("rank") <= F.lit(int(n)))
    cols = [F.lit(int(taskid)).cast("bigint").alias("taskid")] if taskid is not None else []
    return ranked.select(
        *cols,
        F.col("category_id").alias("categoryid"),
        F.col("session_id").alias("sessionid"),
        "click_count",
        F.col("rank").cast("int").alias("rank"),
    )


def top_session_ids(top_sessions: DataFrame) -> DataFrame:
    """Distinct session ids of the top sessions (A10)."""
    return top_sessions.select(F.col("sessionid").alias("session_id")).distinct()


def _detail_columns(taskid: int | None) -> list[Column]:
    cols = [F.lit(int(taskid)).cast("bigint").alias("taskid")] if taskid is not None else []
    return cols + [
        F.col("user_id").alias("userid"),
        F.col("session_id").alias("sessionid"),
        F.col("page_id").alias("pageid"),
        format_time("action_time").alias("action_time"),
        F.col("search_keyword"),
        F.col("click_category_id").cast("string").alias("click_category_id"),
        F.col("click_product_id").cast("string").alias("click_product_id"),
        F.col("order_category_ids"),
        F.col("order_product_ids"),
        F.col("pay_category_ids"),
        F.col("pay_product_ids"),
    ]


def session_detail(
    visits: DataFrame,
    top_sessions: DataFrame,
    taskid: int | None = None,
    kept: list[DataFrame] | None = None,
    measure: bool = True,
) -> DataFrame:
    """Every action of the top sessions (left-semi join on session id, no dedupe).

    The id set is at most ``n`` x categories rows.  It is materialised and
    measured first; when under the broadcast threshold the visit log is
    probed map-side and never shuffled.  Beyond it the log is first probed with
    a bitmap of the ids (``joins.probably_in``), so little more than the result is
    shuffled; the top sessions then join as they are (a semi join needs no
    distinct ids), with an exchange on both sides, so AQE can split a hot
    session.  Without ``measure`` nothing runs or is kept here, and AQE chooses
    the join.
    """
    small = False
    if measure:
        ids, small = broadcast_if_small(top_session_ids(top_sessions), kept)
        if not small:
            visits = probably_in(visits, ids, "session_id")
    if not small:
        ids = top_sessions.select(F.col("sessionid").alias("session_id"))
    return visits.join(ids, "session_id", "left_semi").select(*_detail_columns(taskid))


def session_detail_inner(
    visits: DataFrame,
    top_sessions: DataFrame,
    taskid: int | None = None,
    kept: list[DataFrame] | None = None,
    measure: bool = True,
) -> DataFrame:
    """Inner-join variant: an action repeats once per category its session tops."""
    keys = top_sessions.select(F.col("sessionid").alias("session_id"), "categoryid")
    if measure:
        keys, _ = broadcast_if_small(keys, kept)
    j = visits.join(keys, "session_id", "inner")
    return j.select(*_detail_columns(taskid), "categoryid")
