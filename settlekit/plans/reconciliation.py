"""The daily reconciliation job: today's counts (Part I), replay of earlier
unmatched days (Part II), publication."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settlekit.functions.periods import as_date
from settlekit.operators.recon import (
    FAILED, CountBranch, CountRequest, count_branches, counts_by_request, reconcile, replay_candidates,
    requests_from_candidates, requests_from_control, select_control,
)
from settlekit.sources.sinks import append_results, register_partition

GROUP = 200     # branches counted by one job


def reconciliation_requests(control: DataFrame, history: DataFrame, run_date, replay_days: int,
                            only_failed: bool = True, audit: DataFrame | None = None) -> list[CountRequest]:
    """Part I requests followed by Part II (replay) requests. With ``audit``, Part I takes
    the control rows of ``select_control``: TRAN tables, and DIM tables that the other
    system reported on the run date. Part II reads history up to the day before the
    run, so never Part I's own results."""
    part1 = requests_from_control(control if audit is None else select_control(control, audit, run_date), run_date)
    candidates = replay_candidates(history, control, run_date, replay_days, only_failed=only_failed)
    part2 = requests_from_candidates(candidates, use_history_sql=not only_failed)
    return part1 + part2


#: SQLSTATE classes that blame the query or its data (cardinality, data, access rule or syntax).
QUERY_ERRORS = ("0A", "21", "22", "42", "P0")


def _blames_query(exc: Exception) -> bool:
    state = getattr(exc, "getSqlState", lambda: None)()
    return state is not None and str(state)[:2] in QUERY_ERRORS


def _counted(branches: list[CountBranch], failed: dict[int, str]) -> list[tuple]:
    """(branch, day, n) rows of the branches, at most one per request. A group that
    fails at run time is halved until the failing branches stand alone, and those
    that count many days are taken day by day. What is not the query's fault (a lost
    executor, a full disk) is raised and marks no table."""
    if not branches:
        return []
    try:
        return [tuple(r) for r in reduce(DataFrame.unionByName, [b.frame for b in branches]).collect()]
    except Exception as exc:
        if not _blames_query(exc):
            raise
        if len(branches) > 1:
            half = len(branches) // 2
            return _counted(branches[:half], failed) + _counted(branches[half:], failed)
        if branches[0].alone is not None:
            daily, bad = branches[0].alone()
            failed.update(bad)
            return _counted(daily, failed)
        text = str(exc).splitlines()[0] if str(exc) else type(exc).__name__
        failed.update(dict.fromkeys(branches[0].request_ids, text))
        return []


def run_reconciliation(spark: SparkSession, control: DataFrame, audit: DataFrame, history: DataFrame, run_date,
                       as_of, replay_days: int, base: str, tables: Mapping[str, DataFrame] | None = None,
                       table: str | None = None, inserted_at: str | None = None,
                       app_id: str | None = None, show: bool = False, only_failed: bool = True,
                       keep_null_audit: bool = False, count_column: int | str | None = None,
                       failed_status: str = FAILED, selected_control: bool = False) -> DataFrame:
    """Count, compare, and append once. Counts are taken first, a group of tables
    per job; a request whose query fails is marked ``failed_status`` and the rest
    goes on. Stored queries give their count in the second column, replayed history
    queries (``only_failed=False``) in the first, unless ``count_column`` says
    otherwise. ``selected_control`` takes Part I from ``select_control``. Nothing after the append writes again: a failing catalog step or print
    raises with the rows in place. Returns the rows of this run as a frame over
    its counted values (one row per request)."""
    requests = reconciliation_requests(control, history, run_date, replay_days, only_failed, audit if selected_control else None)
    if count_column is None:
        count_column = 1 if only_failed else 0
    branches, failed = count_branches(spark, requests, tables, count_column)
    rows: list[tuple] = []
    for lo in range(0, len(branches), GROUP):
        rows += _counted(branches[lo:lo + GROUP], failed)
    counted = spark.createDataFrame(rows, "branch string, day date, n bigint")
    ids = [i for b in branches for i in b.request_ids if i not in failed]
    stamp = inserted_at if inserted_at is not None else dt.datetime.now().isoformat(sep=" ", timespec="milliseconds")
    results = reconcile(spark, requests, audit, as_of, tables, inserted_at=stamp, app_id=app_id,
                        keep_null_audit=keep_null_audit, failed_status=failed_status,
                        counts_override=counts_by_request(spark, requests, ids, counted), extra_failed=failed)
    # one row per request: fixed here, so what is returned and printed is what is written
    results = spark.createDataFrame(results.collect(), results.schema)
    append_results(results, base, run_date)
    if table is not None:
        register_partition(spark, table, run_date)
    if show:
        results.withColumn("extract_date", F.lit(as_date(run_date))).show(max(1, len(requests)), truncate=False)
    return results
