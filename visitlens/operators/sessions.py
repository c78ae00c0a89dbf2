"""Session rollup (visit log -> one row per session) and the user join.

The rollup is a single hash aggregate on ``(session_id, user_id)`` using only
algebraic aggregates (min, max, count, bool_or), so it is partially
aggregated map-side: a hot session collapses to one row per map task before
the shuffle.  A session's actions are never collected into a list; where
values per session are needed, only their distinct set is kept (bounded by
the number of distinct values).  ``rollup_and_kinds`` computes the rollup,
the session x category counts and the sessions' keywords in one aggregate.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.functions.dates import seconds_between
from visitlens.operators import topn
from visitlens.operators.joins import broadcast_if_small
from visitlens.operators.predicates import listed_marks, mark_listed, session_hit_aggregates
from visitlens.operators.users import user_variants
from visitlens.params import TaskParams

ROLLUP_COLUMNS = ["session_id", "user_id", "start_time", "end_time", "visit_length", "step_length"]
PROFILE_COLUMNS = ["session_id", "user_id", "start_time", "visit_length", "step_length",
                   "age", "professional", "city", "sex", "weight"]


def session_rollup(visits: DataFrame, params: TaskParams | None = None) -> DataFrame:
    """One row per ``(session_id, user_id)``.

    visit_length: whole seconds between the first and last action;
    step_length: number of actions with a session id; start_time: first
    action.  With ``params``, adds ``keyword_hit`` / ``category_hit`` flags
    for the keyword and category filters; the task's date range is not
    applied here (``predicates.date_range`` comes first, as in ``run_task``).
    """
    extra = session_hit_aggregates(params)
    agg = mark_listed(visits, params).groupBy("session_id", "user_id").agg(
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count("session_id").alias("step_length"),
        *extra,
    )
    return agg.select(
        "session_id",
        "user_id",
        "start_time",
        "end_time",
        seconds_between("end_time", "start_time").alias("visit_length"),
        "step_length",
        *[c for c in agg.columns if c not in ROLLUP_COLUMNS],
    )


def session_profile(
    sessions: DataFrame,
    users: DataFrame,
    kept: list[DataFrame] | None = None,
    measure_users: bool = False,
    variants: DataFrame | None = None,
) -> DataFrame:
    """Inner equi-join of sessions to users on ``user_id = userid``.

    Sessions without a user are dropped.  Duplicate user rows are folded
    into ``weight`` (see ``user_variants``): a profile row with weight w
    stands for w identical rows of the reference's joined profile.

    Join strategy: Catalyst broadcasts the user side when its estimate is
    small (a user dimension does not grow with the visit log) and otherwise
    plans a sort-merge join that AQE splits on hot users.  ``measure_users``
    measures the user side first and hints the broadcast from that: one small
    extra job, worth it where the profile is persisted and reused (run_task),
    because on small inputs Catalyst may instead broadcast the session side
    and squeeze the join into the user side's few partitions.  ``variants``
    gives ``user_variants(users)`` where the caller already has it.
    """
    if variants is None:
        variants = user_variants(users)
        if measure_users:
            variants, _ = broadcast_if_small(variants, kept)
    j = sessions.join(variants, sessions["user_id"] == variants["userid"], "inner")
    extra = [c for c in sessions.columns if c not in ROLLUP_COLUMNS]
    return j.select(*[sessions[c] for c in PROFILE_COLUMNS[:5]], "age", "professional", "city", "sex",
                    "weight", *[sessions[c] for c in extra])


def _value_list(values) -> F.Column:
    # distinct values, sorted, comma-joined; a partial collect_set per map
    # task keeps each group as small as its number of distinct values
    return F.array_join(F.transform(F.array_sort(F.collect_set(values)), lambda x: x.cast("string")), ",")


def session_value_lists(visits: DataFrame) -> DataFrame:
    """Per session: the distinct searched keywords and clicked / ordered / paid
    category ids, each sorted and comma-joined (``""`` when none).

    The reference concatenates every value of a session in arrival order; a
    list of all actions is unbounded per session (a hot session would pull
    its whole history into one task), so the distinct set is kept instead.
    """
    return visits.groupBy("session_id", "user_id").agg(
        _value_list(F.col("search_keyword")).alias("search_keywords"),
        _value_list(F.col("click_category_id")).alias("click_category_ids"),
        _value_list(F.col("order_category_ids")).alias("order_category_ids"),
        _value_list(F.col("pay_category_ids")).alias("pay_category_ids"),
    )


def session_values(visits: DataFrame, split_ids: bool = False) -> DataFrame:
    """``session_id, user_id, kind, value, n``: every searched keyword and clicked /
    ordered / paid category field of a session with how often it occurs.

    This is the reference's four concatenated lists in long form: repeats are
    kept as counts, nothing is dropped, and no row grows with the session.
    """
    items = F.concat(
        F.array(F.struct(F.lit("search").alias("kind"), F.col("search_keyword").alias("token"))),
        topn._token_structs("click", F.col("click_category_id").cast("string"), False),
        topn._token_structs("order", F.col("order_category_ids"), split_ids),
        topn._token_structs("pay", F.col("pay_category_ids"), split_ids),
    )
    long = visits.select("session_id", "user_id", F.inline(F.filter(items, lambda s: s["token"].isNotNull())))
    return long.groupBy("session_id", "user_id", "kind", F.col("token").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def rollup_and_kinds(
    visits: DataFrame, params: TaskParams | None = None, split_ids: bool = False, keywords: bool = True
) -> DataFrame:
    """The session rollup, the session x category counts and (with ``keywords``) the
    session's searched keywords from one scan and one (partially aggregated) shuffle.

    Every action yields a base row plus one row per category token and one
    per searched keyword; one ``groupBy(session_id, user_id, category_id,
    keyword)`` then gives the rollup in the groups where both are NULL (they
    hold exactly the session's actions), ``click_n / order_n / pay_n`` where
    ``category_id`` is set, and the distinct keywords where ``keyword`` is set.
    Times and filter flags come from base rows alone and are NULL or false elsewhere.
    Split the result with ``rollup_part`` / ``kinds_part`` / ``keywords_part``;
    ``run_task`` persists it without ``keywords`` (it looks them up for the drawn
    sessions only), so the log is read once for the rollup and the counts.
    """
    items = [F.array(F.struct(F.lit("base").alias("kind"), F.lit(None).cast("string").alias("token")))]
    if keywords:
        items.append(F.array(F.struct(F.lit("search").alias("kind"), F.col("search_keyword").alias("token"))))
    items.append(topn._token_structs("click", F.col("click_category_id").cast("string"), False))
    items += [topn._token_structs(k, F.col(topn._FIELDS[k]), split_ids) for k in ("order", "pay")]
    kind, token = F.col("kind"), F.col("token")
    visits = mark_listed(visits, params)
    of_session = ["action_time", "search_keyword", "click_category_id", *listed_marks(visits)]
    long = visits.select(
        "session_id", "user_id", *of_session,
        F.inline(F.filter(F.concat(*items), lambda s: (s["kind"] == "base") | s["token"].isNotNull())),
    )
    is_category = kind.isin(*topn.KINDS)
    keys = ["session_id", "user_id", "category_id"] + (["keyword"] if keywords else [])
    named = {
        "category_id": F.when(is_category & ~token.isin(*topn.MISSING_TOKENS), token.try_cast("bigint")),
        "keyword": F.when(kind == "search", token),
    }
    long = long.select(
        "session_id", "user_id", "kind",
        *[F.when(kind == "base", F.col(c)).alias(c) for c in of_session],
        *[named[c].alias(c) for c in keys[2:]],
    ).where(reduce(or_, [F.col(c).isNotNull() for c in keys[2:]], kind == "base"))
    return long.groupBy(*keys).agg(
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count_if((kind == "base") & F.col("session_id").isNotNull()).alias("step_length"),
        *session_hit_aggregates(params),
        *[F.count_if(kind == k).alias(f"{k}_n") for k in topn.KINDS],
    )


def rollup_part(combined: DataFrame) -> DataFrame:
    """The ``session_rollup`` rows of a ``rollup_and_kinds`` result."""
    flags = [c for c in combined.columns if c.endswith("_hit")]
    base = F.col("category_id").isNull()
    if "keyword" in combined.columns:
        base &= F.col("keyword").isNull()
    return combined.where(base).select(
        "session_id",
        "user_id",
        "start_time",
        "end_time",
        seconds_between("end_time", "start_time").alias("visit_length"),
        "step_length",
        *flags,
    )


def kinds_part(combined: DataFrame) -> DataFrame:
    """The ``session_category_kinds`` rows of a ``rollup_and_kinds`` result."""
    return combined.where(F.col("category_id").isNotNull()).select(
        "session_id", "user_id", "category_id", "click_n", "order_n", "pay_n"
    )


def keywords_part(combined: DataFrame) -> DataFrame:
    """``session_id, user_id, keyword``: each session's distinct searched keywords."""
    return combined.where(F.col("keyword").isNotNull()).select("session_id", "user_id", "keyword")
