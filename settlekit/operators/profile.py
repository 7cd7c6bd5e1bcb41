"""Date profiles: for each query row, sums of its key's event values dated
before the query date, on or after it, exactly k days after it, and after a
horizon -- without pairing queries with events.

Joining queries to events and testing dates pair by pair costs
(#queries x #events) per key. Instead events are pre-aggregated to one row
per (key, event date), so a key's event rows are bounded by its number of
distinct dates, not by its share of the data. Query rows and event rows then
form one stream, partitioned by key and ordered by day number, and RANGE
window frames read the sums off directly:

* ``cum(k)``  UNBOUNDED PRECEDING .. k FOLLOWING   events up to q + k
* ``lt``      cum(-1)                              events before q
* ``ge``      whole partition - cum(-1)            events on or after q
* ``eq{k}``   cum(k) - cum(k - 1)                  events on q + k
* ``gt``      whole partition - cum(h)             events after q + h

Frames bounded only above are accumulated in one pass without buffering
rows per frame.

One shuffle per call; several specs (date pairs) differ only in ordering.
Expressions are SQL text, so a wide profile costs one parse per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ProfileSpec:
    name: str
    event_date: str                   # date column of the events
    query_date: str                   # date column of the queries
    values: tuple[str, ...]           # numeric event columns to sum
    horizon: int | None = None        # adds ``gt`` (after q + horizon)
    exact: bool = False               # adds ``eq0`` .. ``eq{horizon}``


def _q(name: str) -> str:
    return f"`{name}`"


def attach_date_profile(queries: DataFrame, events: DataFrame, keys: Sequence[str], specs: Sequence[ProfileSpec],
                        totals: Mapping[str, str] | None = None) -> DataFrame:
    """``queries`` with, per spec ``s`` and value ``v``, columns ``s_v_lt``,
    ``s_v_ge`` and, with a horizon, ``s_v_gt`` and (``exact``) ``s_v_eq{k}``;
    plus, per ``totals`` entry ``v -> name``, the sum of ``v`` over all the
    key's events whatever their dates. All results are non-NULL (0 when no
    event qualifies); a NULL query date gives 0 for its spec. Events with a
    NULL key are ignored, and queries with a NULL key see none."""
    keys = list(keys)
    totals = dict(totals or {})
    kcols = ", ".join(_q(k) for k in keys)
    ecols = list(dict.fromkeys(s.event_date for s in specs))
    values = list(dict.fromkeys([v for s in specs for v in s.values] + list(totals)))
    key_filter = " AND ".join(f"{_q(k)} IS NOT NULL" for k in keys)

    # only events of keys that have queries; AQE broadcasts the key list when small
    wanted = queries.where(key_filter).select(*keys).distinct()
    ev = (events.where(key_filter)
          .join(wanted, keys, "left_semi")
          .groupBy(*keys, *ecols)
          .agg(*[F.expr(f"SUM({_q(v)}) AS {_q(v)}") for v in values]))
    ev_rows = ev.selectExpr(
        *[_q(k) for k in keys], "false AS __query",
        *[f"unix_date(CAST({_q(s.event_date)} AS DATE)) AS __o{i}" for i, s in enumerate(specs)],
        *[f"CASE WHEN {_q(s.event_date)} IS NOT NULL THEN {_q(v)} ELSE 0 END AS __v{i}_{v}"
          for i, s in enumerate(specs) for v in s.values],
        *[f"{_q(t)} AS __t_{t}" for t in totals])
    q_rows = queries.selectExpr(
        "*", "true AS __query",
        *[f"unix_date(CAST({_q(s.query_date)} AS DATE)) AS __o{i}" for i, s in enumerate(specs)],
        *[f"0 AS __v{i}_{v}" for i, s in enumerate(specs) for v in s.values],
        *[f"0 AS __t_{t}" for t in totals])
    stream = q_rows.unionByName(ev_rows, allowMissingColumns=True)

    out, sweeps, drop = [], [], []
    whole = f"PARTITION BY {kcols}"
    for i, s in enumerate(specs):
        order = f"PARTITION BY {kcols} ORDER BY __o{i}"
        missing = f"__o{i} IS NULL"
        for v in s.values:
            col = f"__v{i}_{v}"

            def cum(k: int, _col=col, _order=order) -> str:
                bound = f"{-k} PRECEDING" if k < 0 else ("CURRENT ROW" if k == 0 else f"{k} FOLLOWING")
                return f"COALESCE(SUM({_col}) OVER ({_order} RANGE BETWEEN UNBOUNDED PRECEDING AND {bound}), 0)"

            def alias(k: int, _i=i, _v=v) -> str:
                return f"__c{_i}_{_v}_{'m' if k < 0 else ''}{abs(k)}"

            total = f"__a{i}_{v}"
            ks = [-1]
            if s.horizon is not None:
                ks += list(range(s.horizon + 1)) if s.exact else [s.horizon]
            sweeps.append(f"COALESCE(SUM({col}) OVER ({whole}), 0) AS {total}")
            sweeps += [f"{cum(k)} AS {alias(k)}" for k in ks]
            drop += [total] + [alias(k) for k in ks]
            out.append(f"CASE WHEN {missing} THEN 0 ELSE {alias(-1)} END AS {s.name}_{v}_lt")
            out.append(f"CASE WHEN {missing} THEN 0 ELSE {total} - {alias(-1)} END AS {s.name}_{v}_ge")
            if s.horizon is not None:
                out.append(f"CASE WHEN {missing} THEN 0 ELSE {total} - {alias(s.horizon)} END AS {s.name}_{v}_gt")
                if s.exact:
                    out += [f"CASE WHEN {missing} THEN 0 ELSE {alias(k)} - {alias(k - 1)} END AS {s.name}_{v}_eq{k}"
                            for k in range(s.horizon + 1)]
    sweeps += [f"COALESCE(SUM(__t_{t}) OVER ({whole}), 0) AS {_q(name)}" for t, name in totals.items()]
    swept = stream.selectExpr("*", *sweeps).where("__query")
    return (swept.selectExpr("*", *out)
            .drop(*drop)
            .drop("__query", *[f"__o{i}" for i in range(len(specs))],
                  *[f"__v{i}_{v}" for i, s in enumerate(specs) for v in s.values],
                  *[f"__t_{t}" for t in totals]))
