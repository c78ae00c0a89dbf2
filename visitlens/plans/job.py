"""The task job: one task's five result tables from a visit log and users.

    visits --date range--> one aggregate per (session, user, category|NULL) (persisted)
      --NULL rows--> rollup --join users--> profile (persisted)
        profile --filters--> one global aggregate -> session_aggr_stat
      --category rows--> session x category counts -> top10_category,
        top10_session (persisted) -> session_detail (second visit-log scan)
      profile -> hour quotas + draw; keywords and clicked categories of the drawn
        sessions only, by probing the visit log (third scan) -> session_random_extract

With daily states (``operators.daily``) the aggregate is merged from them instead, and only
the detail export reads the visit log.

Shared intermediates are persisted (MEMORY_AND_DISK: a lost executor's
blocks are recomputed from the short lineage).  ``checkpoint=True`` cuts
the lineage instead, writing to the shared ``spark.checkpoint.dir`` of the
session.  No intermediate passes through the driver; the one value read
back is the single stat row, to refuse a task that matches no session.
The five tables are written beside the old ones and published by one commit
(``sinks.commits``): a failure in any of them leaves all old results as they were.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from visitlens.operators import daily, extract, predicates, sessions, stats, topn
from visitlens.operators.joins import broadcast_if_small
from visitlens.operators.users import user_variants
from visitlens.params import TaskParams
from visitlens.session import checkpoint_dir
from visitlens.schema import RESULT_TABLES
from visitlens.sinks.commits import commit, discard, new_run
from visitlens.sinks.writers import clear_result, write_result


class TaskResults:
    """The five result tables of a task.

    The detail export and the extraction start with a measuring job (their
    small join side is materialised and sized first); they are built lazily
    so that ``write_all`` runs those jobs in the writer threads, side by side
    with the other outputs.
    """

    def __init__(
        self,
        stat: DataFrame,
        top_categories: DataFrame,
        top_sessions: DataFrame,
        detail: Callable[[], DataFrame],
        sample: Callable[[], DataFrame] | None,
    ) -> None:
        self.session_aggr_stat = stat
        self.top10_category = top_categories
        self.top10_session = top_sessions
        self._detail = detail
        self._sample = sample

    @cached_property
    def session_detail(self) -> DataFrame:
        return self._detail()

    @cached_property
    def session_random_extract(self) -> DataFrame | None:
        return self._sample() if self._sample is not None else None

    def tables(self) -> dict[str, Callable[[], DataFrame]]:
        """Table name -> builder of its DataFrame."""
        out = {
            "session_aggr_stat": lambda: self.session_aggr_stat,
            "top10_category": lambda: self.top10_category,
            "top10_session": lambda: self.top10_session,
            "session_detail": lambda: self.session_detail,
        }
        if self._sample is not None:
            out["session_random_extract"] = lambda: self.session_random_extract
        return out


def _keep(df: DataFrame, checkpoint: bool) -> DataFrame:
    if checkpoint:
        checkpoint_dir(df.sparkSession)  # raises when the cluster names no shared folder
        return df.checkpoint(eager=True)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def build_task(
    visits: DataFrame,
    users: DataFrame,
    params: TaskParams,
    taskid: int,
    checkpoint: bool = False,
    require_sessions: bool = False,
    kept: list[DataFrame] | None = None,
    reuse: bool = True,
    states: daily.DailyStates | None = None,
) -> tuple[TaskResults, list[DataFrame]]:
    """Result tables of one task plus the intermediates kept for reuse.

    With ``require_sessions`` the one-row stat is computed first and a task
    that matches no session is refused (ValueError) before any other work;
    the stat table is then that computed row.  Intermediates are added to
    ``kept`` as they are made, so a caller can release them after a failure.
    Without ``reuse`` nothing is kept and nothing runs: one result is to be
    read, and Catalyst prunes what it does not need.  With ``states`` everything
    but the detail export comes from the daily states.
    """
    kept = [] if kept is None else kept

    def keep(df: DataFrame) -> DataFrame:
        if reuse:
            df = _keep(df, checkpoint)
            kept.append(df)
        return df

    dated = predicates.date_range(visits, params.start_date, params.end_date)
    if states is not None:
        days = states.between(params.start_date, params.end_date)
        rolled = daily.rollup_from_daily(*days, params)
        kinds = keep(daily.kinds_from_daily(days.values, params.split_ids))
    else:
        # one scan + one shuffle of the visit log for both the rollup and the
        # session x category counts (persisted, split by category_id NULL / not)
        combined = keep(sessions.rollup_and_kinds(dated, params, params.split_ids, keywords=False))
        rolled, kinds = sessions.rollup_part(combined), sessions.kinds_part(combined)
    variants = user_variants(users)
    if reuse:
        variants, _ = broadcast_if_small(variants, kept)  # aggregated and measured once
    profile = keep(sessions.session_profile(rolled, users, variants=variants))
    filtered = predicates.filter_sessions(profile, params)
    stat = stats.session_aggr_stat(filtered, taskid)
    if require_sessions:
        row = stat.first()  # the one-row result of a global aggregate
        if row is None or not row["session_count"]:
            raise ValueError(f"task {taskid}: no session matches the task parameters")
        stat = stat.sparkSession.createDataFrame([row], stat.schema)

    if params.top_scope == "filtered":
        weights = topn.session_weights(filtered)
    else:
        weights = topn.user_weights(None, variants=variants)
    top_cat = topn.top_categories(topn.category_counts_from(kinds, weights), params.top_n, taskid)
    top_sess = keep(topn.top_sessions_per_category(topn.session_clicks_from(kinds, weights), params.top_n, taskid))
    detail_src = dated if params.restrict_dates else visits

    def detail() -> DataFrame:
        return topn.session_detail(detail_src, top_sess, taskid, kept, measure=reuse)

    def sample() -> DataFrame:
        draw = params.extract_per_day, params.extract_seed, taskid, kept, reuse
        if states is None:
            return extract.random_extract(profile, dated, *draw)
        return extract.random_extract_from_parts(profile, kinds, daily.keywords_from_daily(days.values), *draw)

    return TaskResults(stat, top_cat, top_sess, detail, sample if params.extract_per_day > 0 else None), kept


def write_all(tables: dict[str, DataFrame | Callable[[], DataFrame]], write, parallel: int | None = None) -> dict:
    """Run the independent output jobs concurrently (one driver thread each).

    The small outputs (a stat row, top-10 tables) then overlap with the large
    detail export instead of queueing behind it; Spark schedules the jobs'
    tasks side by side.  A table given as a builder is built in its thread.
    """

    def one(name: str, item):
        return write(name, item() if callable(item) else item)

    workers = parallel or len(tables)
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        futures = {name: pool.submit(one, name, item) for name, item in tables.items()}
        return {name: f.result() for name, f in futures.items()}


def run_task(
    spark: SparkSession,
    visits: DataFrame,
    users: DataFrame,
    params: TaskParams,
    taskid: int,
    out_dir: str,
    checkpoint: bool = False,
    states: daily.DailyStates | None = None,
) -> dict[str, str]:
    """Compute, write and publish the task's result tables; returns table -> path.

    Raises ValueError when no session passes the filters.  Whatever fails, readers keep
    the task's old results in all tables; on success they get all new ones.
    """
    kept: list[DataFrame] = []
    run = new_run()
    try:
        results, _ = build_task(visits, users, params, taskid, checkpoint, require_sessions=True, kept=kept, states=states)
        paths = write_all(results.tables(), lambda name, df: write_result(df, out_dir, name, taskid, run=run))
        if "session_random_extract" not in paths:  # extraction is off: no rows of an earlier run stay
            clear_result(spark, out_dir, "session_random_extract", taskid, run=run)
        commit(spark, out_dir, taskid, run, list(RESULT_TABLES))
        return paths
    except BaseException:
        discard(spark, out_dir, taskid, run, list(RESULT_TABLES))
        raise
    finally:
        for df in kept:
            if df.is_cached:
                df.unpersist()
