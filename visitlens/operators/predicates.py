"""Session filters (date, age, profession, city, sex, keywords, categories).

Each filter is a Column built once from the task parameters; the conjunction
is one ``where`` that Catalyst can push below the user join (age, profession,
city and sex are user columns) and keep inside whole-stage codegen.

Keyword and category filters ask whether *any* action of the session matches.
Instead of collecting each session's actions into a list, the rollup computes
``bool_or`` of the row-level test (``keyword_hit`` / ``category_hit``): a
partial aggregate, so a session with billions of actions costs nothing extra.
Lists of more than ``LONG_LIST`` items do not become literals: they are a parameter
table that the actions meet in an equi-join (``mark_listed``), which marks the hits.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.operators.joins import COLUMN_OVERHEAD, ROW_OVERHEAD, broadcast_threshold
from visitlens.params import TaskParams, is_empty, tokens

KEYWORD_HIT = "keyword_hit"
CATEGORY_HIT = "category_hit"
#: Items up to which a list is written into the plan.
LONG_LIST = 1000
#: Marks of actions whose keyword / clicked category is in a long list.
KEYWORD_LISTED, CATEGORY_LISTED = "_keyword_listed", "_category_listed"


def date_range(visits: DataFrame, start_date: str | None, end_date: str | None) -> DataFrame:
    """Inclusive string range on ``datestr``; an absent bound is open."""
    out = visits
    if not is_empty(start_date):
        out = out.where(F.col("datestr") >= F.lit(start_date))
    if not is_empty(end_date):
        out = out.where(F.col("datestr") <= F.lit(end_date))
    return out


def age_filter(params: TaskParams) -> Column | None:
    """Inclusive age range; active when either bound is given; NULL age fails."""
    lo, hi = params.age_bounds()
    if lo is None and hi is None:
        return None
    age = F.col("age")
    conds = [age.isNotNull()]
    if lo is not None:
        conds.append(age >= F.lit(lo))
    if hi is not None:
        conds.append(age <= F.lit(hi))
    return reduce(and_, conds)


def list_filter(column: str, raw: str | None, match: str = "token") -> Column | None:
    """Value is one of the comma items ("token") or occurs in the list text ("substring")."""
    if is_empty(raw):
        return None
    c = F.col(column)
    if match == "substring":
        return F.coalesce(F.instr(F.lit(raw), c) > 0, F.lit(False))
    return F.coalesce(c.isin(tokens(raw)), F.lit(False))


def sex_filter(params: TaskParams) -> Column | None:
    if is_empty(params.sex):
        return None
    return F.coalesce(F.col("sex") == F.lit(params.sex), F.lit(False))


def keyword_action_test(params: TaskParams) -> Column | None:
    """Row-level: this action searched a listed keyword (None = filter off)."""
    words = tokens(params.keywords)
    if not words or params.keyword_mode == "ignore":
        return None
    if _is_long(words, params.keyword_mode):
        return F.col(KEYWORD_LISTED)
    kw = F.col("search_keyword")
    if params.keyword_mode == "substring":
        return reduce(lambda a, b: a | b, [F.instr(kw, F.lit(w)) > 0 for w in words])
    return kw.isin(words)


def category_action_test(params: TaskParams) -> Column | None:
    """Row-level: this action clicked a listed category (None = filter off)."""
    ids = tokens(params.category_ids)
    if not ids or params.category_mode == "ignore":
        return None
    if _is_long(ids, params.category_mode):
        return F.col(CATEGORY_LISTED)
    cat = F.col("click_category_id")
    if params.category_mode == "substring":
        text = cat.cast("string")
        return reduce(lambda a, b: a | b, [F.instr(text, F.lit(i)) > 0 for i in ids])
    nums = _numbers(ids)
    return cat.isin(nums) if nums else F.lit(False)


def _numbers(ids: list[str]) -> list[int]:
    """The ids that are 64-bit integers; no click can have any other."""
    return [n for n in (int(i) for i in ids if re.fullmatch(r"-?[0-9]+", i)) if -(1 << 63) <= n < 1 << 63]


def _is_long(items: list[str], mode: str) -> bool:
    return mode == "any" and len(items) > LONG_LIST


def mark_listed(actions: DataFrame, params: TaskParams | None) -> DataFrame:
    """``actions`` with a mark column for every long list of the parameters.

    The list is distributed as a table and joined on the value; it is broadcast if its
    size (known here) is below the session's broadcast limit.  Rows are neither lost nor
    repeated, as the list's items are distinct."""
    if params is None:
        return actions
    lists = []
    words = tokens(params.keywords)
    if _is_long(words, params.keyword_mode):
        lists.append((KEYWORD_LISTED, "search_keyword", "string", set(words)))
    ids = tokens(params.category_ids)
    if _is_long(ids, params.category_mode):
        lists.append((CATEGORY_LISTED, "click_category_id", "bigint", set(_numbers(ids))))
    for mark, column, kind, items in lists:
        table = actions.sparkSession.createDataFrame([(i,) for i in sorted(items)], f"_item {kind}").withColumn(mark, F.lit(True))
        size = sum(len(i.encode()) if isinstance(i, str) else 8 for i in items) + len(items) * (ROW_OVERHEAD + 2 * COLUMN_OVERHEAD)
        if size <= broadcast_threshold(actions):
            table = F.broadcast(table)
        actions = actions.join(table, actions[column] == table["_item"], "left").drop("_item")
    return actions


def listed_marks(actions: DataFrame) -> list[str]:
    """The mark columns ``mark_listed`` added."""
    return [c for c in (KEYWORD_LISTED, CATEGORY_LISTED) if c in actions.columns]


def session_hit_aggregates(params: TaskParams | None) -> list[Column]:
    """Aggregates the rollup adds so the keyword/category filters can run."""
    if params is None:
        return []
    out = []
    kw = keyword_action_test(params)
    if kw is not None:
        out.append(F.coalesce(F.bool_or(F.coalesce(kw, F.lit(False))), F.lit(False)).alias(KEYWORD_HIT))
    cat = category_action_test(params)
    if cat is not None:
        out.append(F.coalesce(F.bool_or(F.coalesce(cat, F.lit(False))), F.lit(False)).alias(CATEGORY_HIT))
    return out


def profile_filters(params: TaskParams, columns: list[str] | None = None) -> list[Column]:
    """The active predicates over a session profile (F2-F7)."""
    preds = [
        age_filter(params),
        list_filter("professional", params.professionals, params.list_match),
        list_filter("city", params.cities, params.list_match),
        sex_filter(params),
    ]
    for test, name in ((keyword_action_test(params), KEYWORD_HIT), (category_action_test(params), CATEGORY_HIT)):
        if test is None:
            continue
        if columns is not None and name not in columns:
            raise ValueError(f"profile lacks {name}: build the rollup with the same TaskParams")
        preds.append(F.col(name))
    return [p for p in preds if p is not None]


def filter_sessions(profile: DataFrame, params: TaskParams) -> DataFrame:
    """Conjunction of every active filter (F8) as one ``where``."""
    preds = profile_filters(params, profile.columns)
    return profile.where(reduce(and_, preds)) if preds else profile
