"""Daily row-count reconciliation between this platform and another system.

A control table names the tables to count (with the date column and an
optional stored count query). For every (table, day) request the own count is
compared with the other system's latest audit count, giving a verdict row:
``Y`` equal, ``N`` different, ``F`` the count query failed.

All requests -- today's (Part I) and replays of earlier failed days (Part II)
-- are answered by one plan: per table one scan filtered to the requested days
and grouped by day, unioned, joined to the latest audit rows and to the
verdict. The control rows and the replay list are collected to the driver to
build that plan: they hold one row per table and requested day (at most
``1 + replay days`` days per control row), never table data.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settlekit.functions.periods import as_date
from settlekit.operators.latest import latest_per_key

# Fixed values (must equal the reference): verdicts, constant columns, failure text.
MATCHED, UNMATCHED, FAILED = "Y", "N", "F"
FAILED_SUFFIX = " has failed in "
TEMPLATE_MARKER = "{var1}"

RESULT_SCHEMA = T.StructType([
    T.StructField("gdg_position", T.LongType()),
    T.StructField("gdg_txoppos", T.LongType()),
    T.StructField("gdg_txind", T.StringType()),
    T.StructField("gdg_opcode", T.StringType()),
    T.StructField("gdg_timestamp", T.StringType()),
    T.StructField("gdg_schema", T.StringType()),
    T.StructField("gdg_table", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("count_date", T.StringType()),
    T.StructField("bda_count", T.LongType()),
    T.StructField("vap_count", T.LongType()),
    T.StructField("matched", T.StringType()),
    T.StructField("count_diff", T.LongType()),
    T.StructField("date_column_name", T.StringType()),
    T.StructField("inserted_date", T.StringType()),
    T.StructField("runtime_sql", T.StringType()),
])

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.IntegerType(), False),
    T.StructField("table_id", T.LongType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("count_date", T.DateType()),
    T.StructField("date_column_name", T.StringType()),
    T.StructField("runtime_sql", T.StringType()),
])


@dataclass(frozen=True)
class CountRequest:
    """One (table, day) to count. ``sql`` is a stored count query holding
    ``{var1}`` for the day, or None to count ``table_name`` by ``date_column``.
    ``error`` says why a control or candidate row could not become a request; its
    result is ``F`` and the other requests go on."""
    table_id: int | None
    table_name: str | None
    date_column: str | None
    count_date: dt.date | None
    sql: str | None = None
    error: str | None = None


def count_sql(table: str, date_column: str | None, day: dt.date) -> str:
    """The count query recorded for a request without a stored query."""
    return f"SELECT COUNT(*) FROM {table.lower()} WHERE CAST({date_column} AS DATE) = '{day.isoformat()}'"


def recorded_query(runtime_sql: Column, matched: Column) -> Column:
    """The query of a result row: a failed row's text without the failure behind it."""
    last = F.regexp_replace(runtime_sql, f"(?s){FAILED_SUFFIX}((?!{FAILED_SUFFIX}).)*$", "")
    return F.when(matched == FAILED, last).otherwise(runtime_sql)


def _message(exc: Exception) -> str:
    return str(exc).splitlines()[0] if str(exc) else type(exc).__name__


def runtime_text(req: CountRequest) -> str:
    if req.error is not None:
        return req.error
    if req.sql is not None:
        return req.sql.replace(TEMPLATE_MARKER, f"'{req.count_date.isoformat()}'")
    return count_sql(req.table_name, req.date_column, req.count_date)


def count_date_for(run_date, num_days) -> dt.date:
    """Run date minus ``num_days`` days (NULL counts as 0)."""
    return as_date(run_date) - dt.timedelta(days=int(num_days or 0))


def requests_from_control(control: DataFrame, run_date) -> list[CountRequest]:
    """Part I: one request per control row with ``count_ind = 'Y'``."""
    cols = set(control.columns)
    rows = control.where(F.col("count_ind") == "Y").collect()
    return [_request(r, lambda r: count_date_for(run_date, r["num_days"] if "num_days" in cols else None),
                     str.upper, lambda r: r["sql"] if "sql" in cols else None) for r in rows]


def _request(row, day, name, sql) -> CountRequest:
    """A row as a request; what is wrong with a row is kept in its ``error``."""
    got: dict = {"table_id": None, "table_name": row["table_name"], "date_column": row["date_column_name"], "count_date": None}
    try:
        for key in ("table_id", "table_name"):
            if row[key] is None:
                raise ValueError(f"{key} is NULL")
        got["table_id"] = int(row["table_id"])
        got["table_name"] = name(str(row["table_name"]))
        got["count_date"] = day(row)
        return CountRequest(**got, sql=sql(row))
    except (ValueError, TypeError, OverflowError) as exc:
        return CountRequest(**got, error=_message(exc))


def requests_from_candidates(candidates: DataFrame, use_history_sql: bool = False) -> list[CountRequest]:
    """Part II: one request per replay candidate row. A recorded query that is the
    library's own count of that table and day becomes such a count again, so that
    all days of a table share one scan."""
    made = [_request(r, lambda r: as_date(r["count_date"]), str, lambda r: r["runtime_sql"] if use_history_sql else r["sql"])
            for r in candidates.collect()]
    return [dataclasses.replace(r, sql=None) if r.error is None and r.sql is not None and r.date_column is not None
            and r.sql == count_sql(r.table_name, r.date_column, r.count_date) else r for r in made]


# ---------------------------------------------------------------- own counts

def _day_filter(col: Column, dtype: T.DataType, days: Sequence[dt.date]) -> tuple[Column, Column]:
    """(row filter, day expression) for a date column of any common type.

    Dates compare directly; timestamps get a range filter (pushed to the scan)
    refined by their calendar day; other types are read as dates, as the recorded
    query does, and values that are no date count for no day."""
    if isinstance(dtype, T.DateType):
        return col.isin(*days), col
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        lo, hi = min(days), max(days) + dt.timedelta(days=1)
        lit_type = "timestamp_ntz" if isinstance(dtype, T.TimestampNTZType) else "timestamp"
        rng = (col >= F.lit(lo.isoformat()).cast(lit_type)) & (col < F.lit(hi.isoformat()).cast(lit_type))
        day = F.to_date(col)
        return rng & day.isin(*days), day
    day = col.cast("string").try_cast("date")
    return day.isin(*days), day


class CountSourceError(LookupError):
    """A request names a table or column that cannot be counted."""


def _resolve_table(spark: SparkSession, tables: Mapping[str, DataFrame] | None, name: str) -> DataFrame:
    if tables is not None:
        for key, df in tables.items():
            if key.upper() == name.upper():
                return df
        raise CountSourceError(f"[TABLE_OR_VIEW_NOT_FOUND] The table or view `{name}` cannot be found.")
    return spark.table(name)


def _table_branch(spark, tables, key: str, table_name: str, date_column: str, days: Sequence[dt.date]) -> DataFrame:
    """Counts of one table for the requested days: (branch, day, n), days without rows absent."""
    df = _resolve_table(spark, tables, table_name)
    dtype = df.schema[date_column].dataType          # raises for an unknown column
    cond, day = _day_filter(F.col(date_column), dtype, days)
    return df.where(cond).groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(key).alias("branch"), "day", "n")


def _sql_branch(spark: SparkSession, key: str, req: CountRequest, count_column: int | str) -> DataFrame:
    """The stored query with the day bound as a parameter; the count column by
    name or position (default the second) of its first row. Which row of a result
    of several is first is up to the query."""
    text = req.sql.replace(TEMPLATE_MARKER, ":var1")
    df = spark.sql(text, args={"var1": req.count_date.isoformat()})
    col = df.columns[count_column] if isinstance(count_column, int) else count_column
    value = df.select(F.col(col).cast("bigint").alias("n")).limit(1)   # raises if absent
    return value.select(F.lit(key).alias("branch"), F.lit(req.count_date).alias("day"), "n")


def _template_branch(spark: SparkSession, key: str, template: str, days: Sequence[dt.date], count_column: int | str) -> DataFrame | None:
    """One stored query for many days as one plan: the query becomes a lateral
    subquery of the table of days, from which Catalyst lifts the day predicate to a
    join key. None where that does not give the same result for sure or no single scan:
    a query that may return several rows, or a day that is no join key."""
    first = spark.sql(template.replace(TEMPLATE_MARKER, ":var1"), args={"var1": days[0].isoformat()})
    col = first.columns[count_column] if isinstance(count_column, int) else count_column
    at = [c.lower() for c in first.columns].index(col.lower())
    one_row = first._jdf.queryExecution().optimizedPlan().maxRows()
    if first.columns.count(col) != 1 or not one_row.isDefined() or one_row.get() > 1:
        return None
    names = ", ".join(f"__c{i}" for i in range(len(first.columns)))
    values = ", ".join(f"('{d.isoformat()}')" for d in days)
    body = template.replace(TEMPLATE_MARKER, "__days.__day")
    try:
        every = spark.sql(f"SELECT __days.__day, __q.__c{at} AS n FROM VALUES {values} AS __days(__day), LATERAL ({body}) AS __q({names})")
        plan = every._jdf.queryExecution().executedPlan().toString()
    except Exception:       # a query that cannot be correlated is counted day by day
        return None
    if "NestedLoop" in plan or "Cartesian" in plan:
        return None
    return every.select(F.lit(key).alias("branch"), F.col("__day").cast("date").alias("day"), F.col("n").cast("bigint").alias("n"))


@dataclass
class CountBranch:
    request_ids: list[int]
    frame: DataFrame          # (branch, day, n)
    #: Its days one by one, should they fail together: branches, and {request_id: error}.
    alone: Callable[[], tuple[list["CountBranch"], dict[int, str]]] | None = None


def _branch_key(i: int, req: CountRequest) -> str:
    return f"query {req.sql}" if req.sql is not None else f"table {req.table_name} by {req.date_column}"


def _daily_branches(spark: SparkSession, key: str, requests: Mapping[int, CountRequest],
                    count_column: int | str) -> tuple[list[CountBranch], dict[int, str]]:
    """A stored query day by day, and {request_id: error} for days whose query failed to build."""
    by_day: dict[dt.date, list[int]] = {}
    for i, req in requests.items():
        by_day.setdefault(req.count_date, []).append(i)
    branches, failed = [], {}
    for ids in by_day.values():
        try:
            branches.append(CountBranch(ids, _sql_branch(spark, key, requests[ids[0]], count_column)))
        except Exception as exc:
            failed.update(dict.fromkeys(ids, _message(exc)))
    return branches, failed


def count_branches(spark: SparkSession, requests: Sequence[CountRequest], tables: Mapping[str, DataFrame] | None = None,
                   count_column: int | str = 1) -> tuple[list[CountBranch], dict[int, str]]:
    """One branch per table or stored query (all its requested days), and
    {request_id: error} for requests whose query failed to build. A stored query that
    does not take a table of days is counted day by day."""
    failed: dict[int, str] = {}
    branches: list[CountBranch] = []
    by_table: dict[str, list[int]] = {}
    by_query: dict[str, list[int]] = {}
    for i, req in enumerate(requests):
        if req.error is not None:
            failed[i] = req.error
        elif req.sql is None:
            by_table.setdefault(_branch_key(i, req), []).append(i)
        else:
            by_query.setdefault(_branch_key(i, req), []).append(i)
    for key, ids in by_query.items():
        def each_day(key=key, ids=ids):
            return _daily_branches(spark, key, {i: requests[i] for i in ids}, count_column)

        days, template = sorted({requests[i].count_date for i in ids}), requests[ids[0]].sql
        together = None
        if len(days) > 1 and TEMPLATE_MARKER in template:
            try:
                together = _template_branch(spark, key, template, days, count_column)
            except Exception as exc:  # analysis errors: unknown table, column, syntax
                failed.update(dict.fromkeys(ids, _message(exc)))
                continue
        if together is not None:
            branches.append(CountBranch(ids, together, each_day))
        else:
            daily, bad = each_day()
            branches += daily
            failed.update(bad)
    for key, ids in by_table.items():
        req = requests[ids[0]]
        try:
            if req.date_column is None:
                raise CountSourceError("no date column")
            days = sorted({requests[i].count_date for i in ids})
            branches.append(CountBranch(ids, _table_branch(spark, tables, key, req.table_name, req.date_column, days)))
        except Exception as exc:
            failed.update(dict.fromkeys(ids, _message(exc)))
    return branches, failed


def counts_by_request(spark: SparkSession, requests: Sequence[CountRequest], ids: Sequence[int], counted: DataFrame) -> DataFrame:
    """(request_id, bda_count) for the requests ``ids`` from (branch, day, n); 0 where nothing was counted."""
    wanted = spark.createDataFrame([(i, _branch_key(i, requests[i]), requests[i].count_date) for i in ids],
                                   "request_id int, branch string, day date")
    return wanted.join(counted, ["branch", "day"], "left").select(
        "request_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("bda_count"))


def own_counts(spark: SparkSession, requests: Sequence[CountRequest], tables: Mapping[str, DataFrame] | None = None,
               count_column: int | str = 1) -> tuple[DataFrame | None, dict[int, str]]:
    """One plan counting every request: ((request_id, bda_count) or None,
    {request_id: error} for requests whose query failed to build)."""
    branches, failed = count_branches(spark, requests, tables, count_column)
    if not branches:
        return None, failed
    counted = reduce(DataFrame.unionByName, [b.frame for b in branches])
    return counts_by_request(spark, requests, [i for b in branches for i in b.request_ids], counted), failed


# ---------------------------------------------------------------- audit side

def latest_audit(audit: DataFrame, pairs: DataFrame, as_of, requests: Sequence[CountRequest] = ()) -> DataFrame:
    """Latest audit count per requested (table_name, count_date): audit rows of
    that table and target day extracted between the day and ``as_of``, newest
    extract date then newest insert time first. The requested days and tables
    reach the scan as filters, so only their partitions are read."""
    a = audit.where(F.col("extract_date") <= F.lit(as_date(as_of)))
    if requests:
        days = sorted({r.count_date for r in requests})
        a = a.where((F.col("extract_date") >= F.lit(days[0])) & F.col("target_date").isin(*days)
                    & F.col("table_name").isin(*sorted({r.table_name for r in requests})))
    p = pairs.select("table_name", "count_date").distinct()
    j = a.join(p, (a["table_name"] == p["table_name"]) & (a["target_date"] == p["count_date"])
               & (a["extract_date"] >= p["count_date"]), "left_semi")
    latest = latest_per_key(j, ["table_name", "target_date"], ["extract_date", "inserted_date"])
    return latest.select("table_name", F.col("target_date").alias("count_date"),
                         F.col("record_count").cast("bigint").alias("vap_count"))


# ---------------------------------------------------------------- verdict

def verdict(own: Column, audit: Column, keep_null_audit: bool = False) -> tuple[Column, Column, Column]:
    """(vap_count, matched, count_diff). An absent audit count is 0, so an
    empty day with no audit row matches; with ``keep_null_audit`` the audit
    count stays NULL and only the comparison treats it as 0."""
    other = F.coalesce(audit, F.lit(0).cast("bigint"))
    counted = F.coalesce(own, F.lit(0).cast("bigint"))
    matched = F.when(counted == other, F.lit(MATCHED)).otherwise(F.lit(UNMATCHED))
    return (audit if keep_null_audit else other), matched, (counted - other)


def _constants() -> list[Column]:
    return [F.lit(1).cast("bigint").alias("gdg_position"), F.lit(1).cast("bigint").alias("gdg_txoppos")] + [
        F.lit("1").alias(n) for n in ("gdg_txind", "gdg_opcode", "gdg_timestamp", "gdg_schema", "gdg_table")]


def reconcile(spark: SparkSession, requests: Sequence[CountRequest], audit: DataFrame, as_of,
              tables: Mapping[str, DataFrame] | None = None, inserted_at: str | None = None,
              app_id: str | None = None, keep_null_audit: bool = False, count_column: int | str = 1,
              failed_status: str = FAILED, counts_override: DataFrame | None = None,
              extra_failed: Mapping[int, str] | None = None) -> DataFrame:
    """Verdict rows (``RESULT_SCHEMA``) for every request, in one plan."""
    app = app_id if app_id is not None else spark.sparkContext.applicationId
    inserted = F.lit(inserted_at) if inserted_at is not None else F.current_timestamp().cast("string")
    if counts_override is not None:
        counts, failed = counts_override, dict(extra_failed or {})
    else:
        counts, failed = own_counts(spark, requests, tables, count_column)
    req_rows = [(i, r.table_id, r.table_name, r.count_date, r.date_column, runtime_text(r))
                for i, r in enumerate(requests)]
    if not req_rows:
        return spark.createDataFrame([], RESULT_SCHEMA)
    req = spark.createDataFrame(req_rows, REQUEST_SCHEMA)
    parts = []
    ok_ids = [i for i in range(len(requests)) if i not in failed]
    if ok_ids and counts is not None:
        ok = req.where(F.col("request_id").isin(*ok_ids))
        audit_latest = latest_audit(audit, ok, as_of, [requests[i] for i in ok_ids])
        j = (ok.join(counts, "request_id", "left")
             .join(audit_latest, ["table_name", "count_date"], "left"))
        own = F.coalesce(F.col("bda_count"), F.lit(0).cast("bigint"))
        other, matched, diff = verdict(own, F.col("vap_count"), keep_null_audit)
        parts.append(j.select(
            *_constants(), F.col("table_id").alias("id"), "table_name",
            F.col("count_date").cast("string").alias("count_date"), own.alias("bda_count"),
            other.alias("vap_count"), matched.alias("matched"), diff.alias("count_diff"),
            "date_column_name", inserted.alias("inserted_date"), "runtime_sql"))
    if failed:
        bad = req.where(F.col("request_id").isin(*failed.keys()))
        parts.append(bad.select(
            *_constants(), F.col("table_id").alias("id"), "table_name",
            F.col("count_date").cast("string").alias("count_date"),
            F.lit(0).cast("bigint").alias("bda_count"), F.lit(0).cast("bigint").alias("vap_count"),
            F.lit(failed_status).alias("matched"), F.lit(0).cast("bigint").alias("count_diff"),
            "date_column_name", inserted.alias("inserted_date"),
            F.concat(F.col("runtime_sql"), F.lit(FAILED_SUFFIX + app)).alias("runtime_sql")))
    out = reduce(DataFrame.unionByName, parts)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RESULT_SCHEMA.fields])


# ---------------------------------------------------------------- replay (Part II)

def replay_candidates(history: DataFrame, control: DataFrame, run_date, days: int,
                      only_failed: bool = True) -> DataFrame:
    """Days of the last ``days`` days (before the run date) whose latest result
    is still unmatched with a non-zero audit count, for control rows flagged
    for replay. Table names are upper-cased *before* picking the latest row,
    so 'Abc' and 'ABC' are one table. ``F`` rows are never replayed (their
    audit count is 0). With ``only_failed=False`` every latest row is listed
    and its own recorded query kept (the earlier draft's behaviour), of a failed row
    without the failure text."""
    run = as_date(run_date)
    h = (history.where(F.col("extract_date").between(F.lit(run - dt.timedelta(days=days)),
                                                     F.lit(run - dt.timedelta(days=1))))
         .withColumn("table_name", F.upper("table_name")))
    latest = latest_per_key(h, ["table_name", "count_date"], ["extract_date", "inserted_date"])
    if only_failed:
        latest = latest.where((F.col("matched") == UNMATCHED) & (F.col("vap_count") != 0))
    conf = (control.where(F.col("failed_rerun") == "Y")
            .select("table_id", F.upper("table_name").alias("table_name"), "date_column_name",
                    (F.col("sql") if "sql" in control.columns else F.lit(None).cast("string")).alias("sql")))
    latest = latest.withColumn("runtime_sql", recorded_query(F.col("runtime_sql"), F.col("matched")))
    return (latest.select("table_name", "count_date", "runtime_sql")
            .join(conf, "table_name")
            .select("table_id", "table_name", "date_column_name", "count_date", "sql", "runtime_sql"))


def select_control(control: DataFrame, audit: DataFrame, run_date) -> DataFrame:
    """Control rows to count: every TRAN table, and DIM tables with an audit
    row extracted on the run date (EXISTS, so a control row is listed once; names
    compare without regard to case, as requests do)."""
    live = control.where(F.col("count_ind") == "Y")
    tran = live.where(F.col("table_type") == "TRAN")
    todays = audit.where(F.col("extract_date") == F.lit(as_date(run_date))).select(F.upper("table_name").alias("__name"))
    dim = live.where(F.col("table_type") == "DIM").join(todays, F.upper(live["table_name"]) == F.col("__name"), "left_semi")
    return tran.unionByName(dim)
