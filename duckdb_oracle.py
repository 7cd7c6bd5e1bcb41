"""DuckDB SQL for every registered query, as an independent derivation.

Totals are built bottom-up: amounts get their major value once, refunds and
chargebacks are first summed per deposit, every advice row gets one timing class
and one day bucket per side, and measures are filtered aggregates over those
labels. Windows, requests and latest rows are computed in SQL. Inputs follow the
rules of FIXTURES.md section B.
"""

from __future__ import annotations

import datetime as dt

RUN_DATE = dt.date(1998, 10, 5)
AS_OF = dt.date(1998, 10, 31)
REPLAY_DAYS = 35
INSERTED_AT = "1998-10-05 00:00:00"
APP_ID = "settlekit"

FIXTURE_CTES = """
fx_deposit AS (
  SELECT o.o_custkey % 20 AS merchant_id,
         CONCAT('Merchant ', CAST(o.o_custkey % 20 AS VARCHAR)) AS merchant_name,
         o.o_custkey % 20 % 5 AS organization_id,
         CONCAT('Org ', CAST(o.o_custkey % 20 % 5 AS VARCHAR)) AS organization_name,
         CASE WHEN o.o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'VI'
              WHEN o.o_orderpriority IN ('3-MEDIUM','4-NOT SPECIFIED') THEN 'MC' ELSE 'AX' END AS method_of_payment_code,
         CASE o.o_orderkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'JPY' WHEN 2 THEN 'KWD' ELSE NULL END AS settlement_currency_code,
         CASE o.o_orderkey % 4 WHEN 0 THEN 'US Dollar' WHEN 1 THEN 'Yen' WHEN 2 THEN 'Kuwaiti Dinar' ELSE NULL END AS settlement_currency_desc,
         o.o_orderkey + 1 AS payment_id,
         CASE o.o_orderkey % 4 WHEN 1 THEN CAST(ROUND(o.o_totalprice) AS BIGINT)
              WHEN 2 THEN CAST(ROUND(o.o_totalprice * 1000) AS BIGINT)
              ELSE CAST(ROUND(o.o_totalprice * 100) AS BIGINT) END AS settlement_amount,
         CASE o.o_orderkey % 4 WHEN 1 THEN 0 WHEN 2 THEN 3 ELSE 2 END AS settlement_rpt_precision,
         CAST(NULL AS BIGINT) AS parent_id,
         CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE CAST(o.o_orderdate AS DATE) END AS complete_date,
         CASE o.o_orderstatus WHEN 'F' THEN 'D' WHEN 'O' THEN 'S' ELSE 'A' END AS action_type,
         CAST(o.o_orderdate AS DATE) AS ot_start_ts,
         o.o_orderdate + INTERVAL '8' HOUR AS ot_start_ts_ts,
         CAST(ROUND(o.o_totalprice * 100) AS BIGINT) AS amount,
         CONCAT('ARN', CAST(o.o_orderkey AS VARCHAR)) AS txn_reference_number,
         CAST(o.o_orderdate AS DATE) AS created_date,
         CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 3 AS INT) AS batch_post_day,
         CASE WHEN o.o_orderkey % 11 = 0 THEN '0' ELSE '1' END AS transaction_status
  FROM orders o),
fx_refund AS (
  SELECT d.merchant_id, d.merchant_name, d.organization_id, d.organization_name, d.method_of_payment_code,
         d.settlement_currency_code, d.settlement_currency_desc,
         10000000 + l.l_orderkey * 10 + l.l_linenumber AS payment_id,
         CASE WHEN l.l_linenumber <= 4 THEN d.settlement_amount ELSE CAST(ROUND(l.l_extendedprice) AS BIGINT) END AS settlement_amount,
         d.settlement_rpt_precision,
         CASE WHEN l.l_linenumber = 7 THEN CAST(0 AS BIGINT) ELSE d.payment_id END AS parent_id,
         CASE WHEN l.l_partkey % 17 = 0 THEN NULL ELSE d.created_date + CAST(l.l_partkey % 45 AS INT) END AS complete_date,
         CASE WHEN l.l_linestatus = 'F' THEN 'R' ELSE 'T' END AS action_type,
         d.created_date + CAST(l.l_partkey % 45 AS INT) AS ot_start_ts,
         d.ot_start_ts_ts + CAST(l.l_partkey % 45 AS INT) * INTERVAL '1' DAY AS ot_start_ts_ts,
         CASE WHEN l.l_linenumber <= 4 THEN d.amount ELSE CAST(ROUND(l.l_extendedprice) AS BIGINT) END AS amount,
         CAST(NULL AS VARCHAR) AS txn_reference_number,
         d.created_date + CAST(l.l_partkey % 45 AS INT) AS created_date,
         d.created_date + CAST(l.l_partkey % 45 AS INT) AS batch_post_day,
         '1' AS transaction_status
  FROM lineitem l JOIN fx_deposit d ON d.payment_id = l.l_orderkey + 1
  WHERE l.l_returnflag = 'R'),
fx_payments AS (SELECT * FROM fx_deposit UNION ALL SELECT * FROM fx_refund),
fx_chargeback AS (
  SELECT d.payment_id AS deposit_id,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS chargeback_amount,
         d.method_of_payment_code,
         CASE l.l_linenumber WHEN 1 THEN '0057' WHEN 3 THEN '4837' WHEN 4 THEN '0083' WHEN 6 THEN '4863' ELSE '9999' END AS reason_code,
         d.created_date + CAST((l.l_partkey + l.l_suppkey) % 45 AS INT) AS issuing_bank_day,
         d.ot_start_ts_ts + CAST((l.l_partkey + l.l_suppkey) % 45 AS INT) * INTERVAL '1' DAY AS issuing_bank_day_ts,
         d.created_date + CAST((l.l_partkey + l.l_suppkey) % 45 AS INT) AS open_date,
         CASE WHEN l.l_linestatus = 'F' THEN 'D' ELSE 'C' END AS type,
         CASE l.l_linenumber % 3 WHEN 0 THEN 'FIRST_CHARGEBACK' WHEN 1 THEN 'REPRESENTMENT' ELSE 'ARBITRATION' END AS current_cycle
  FROM lineitem l JOIN fx_deposit d ON d.payment_id = l.l_orderkey + 1
  WHERE l.l_returnflag = 'A'),
fx_advice AS (
  SELECT CONCAT('ARN', CAST(o.o_orderkey AS VARCHAR)) AS acquirer_ref_number,
         CAST(o.o_orderdate AS DATE) + CAST(o.o_custkey % 20 AS INT) AS create_date,
         o.o_orderdate + CAST(o.o_custkey % 20 AS INT) * INTERVAL '1' DAY + INTERVAL '21' HOUR AS create_date_ts
  FROM orders o WHERE o.o_orderkey % 3 <> 1),
fx_daily AS (
  SELECT 'ORDERS' AS t, CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n FROM orders GROUP BY CAST(o_orderdate AS DATE)
  UNION ALL
  SELECT 'LINEITEM' AS t, CAST(l_shipdate AS DATE) AS d, COUNT(*) AS n FROM lineitem GROUP BY CAST(l_shipdate AS DATE)),
fx_audit AS (
  SELECT c.t AS table_name, c.d AS target_date,
         CASE WHEN k.v = 1 THEN c.n + 7 WHEN DAY(c.d) = 15 THEN CAST(0 AS BIGINT)
              WHEN DAY(c.d) % 5 = 0 THEN c.n + 1 ELSE c.n END AS record_count,
         c.d + 1 AS extract_date,
         CASE WHEN k.v = 1 THEN CONCAT(CAST(c.d AS VARCHAR), ' 01:00:00') ELSE CONCAT(CAST(c.d AS VARCHAR), ' 02:00:00') END AS inserted_date
  FROM fx_daily c CROSS JOIN (SELECT 1 AS v UNION ALL SELECT 2 AS v) k),
fx_history AS (
  SELECT c.t AS table_name, CAST(c.d AS VARCHAR) AS count_date, c.n AS bda_count,
         CASE WHEN k.v = 2 THEN c.n WHEN DAY(c.d) = 15 THEN CAST(0 AS BIGINT)
              WHEN DAY(c.d) % 5 = 0 THEN c.n + 1 ELSE c.n END AS vap_count,
         CASE WHEN k.v = 2 THEN 'Y' WHEN DAY(c.d) = 25 THEN 'F' WHEN DAY(c.d) % 5 = 0 THEN 'N' ELSE 'Y' END AS matched,
         CONCAT(CAST(c.d AS VARCHAR), ' 03:00:00') AS inserted_date,
         CONCAT('count of ', c.t) AS runtime_sql,
         CASE WHEN k.v = 2 THEN c.d + 3 ELSE c.d + 1 END AS extract_date
  FROM fx_daily c CROSS JOIN (SELECT 1 AS v UNION ALL SELECT 2 AS v) k
  WHERE k.v = 1 OR DAY(c.d) = 10),
fx_control AS (
  SELECT * FROM (VALUES
    (1, 'orders', 'o_orderdate', 1, 'Y', 'Y', 'TRAN', CAST(NULL AS VARCHAR)),
    (2, 'lineitem', 'l_shipdate', NULL, 'Y', 'Y', 'TRAN', CAST(NULL AS VARCHAR)),
    (3, 'events', 'ts', 2, 'Y', 'N', 'DIM', CAST(NULL AS VARCHAR)),
    (4, 'customer', NULL, 0, 'N', 'N', 'DIM', CAST(NULL AS VARCHAR)),
    (5, 'no_such_table', 'd', 0, 'Y', 'N', 'TRAN', CAST(NULL AS VARCHAR)),
    (6, 'Lineitem', 'l_shipdate', 1, 'Y', 'N', 'DIM', CAST(NULL AS VARCHAR))
  ) t(table_id, table_name, date_column_name, num_days, count_ind, failed_rerun, table_type, sql))
"""


# Schemes with their fraud reason codes.
FRAUD_CODES = {"VI": ("0057", "0075", "0081", "0083"), "MC": ("4837", "4840", "4847", "4862", "4863")}
MONTHS = {12: 13, 3: 3}         # months a period reaches back from the run's month
DAYS = [str(k) for k in range(22)]
CLASSES = ("cbk_prior", "ref_full_prior", "ref_full_after", "not_ref_full")


def major(amount: str, precision: str) -> str:
    """The amount in major units, by a list of the powers of ten."""
    powers = ", ".join(f"{10 ** -p:.6f}" for p in range(7))
    return f"(CAST({amount} AS DECIMAL(20,0)) * (CAST([{powers}] AS DECIMAL(7,6)[]))[{precision} + 1])"


#: The awkward inputs of FIXTURES.md B8 beside the plain ones; ``units`` is the major amount in 10^-18.
_REFERENCE = "CASE WHEN {0} % 3 = 0 THEN '0' ELSE concat('ARN', {0} - {0} % 2) END".format
_TENS = "CAST([" + ", ".join(str(10 ** n) for n in range(19)) + "] AS HUGEINT[])"
SHARED_CTES = f"""
hx_keyed AS (
  SELECT *, CASE WHEN action_type IN ('R', 'T') THEN (payment_id - 10000000) // 10 + 1 ELSE payment_id END AS k FROM fx_payments),
hx_payments AS (
  SELECT * EXCLUDE k REPLACE (
      CAST(k % 20 - 1 AS INTEGER) AS settlement_rpt_precision,
      CASE WHEN k % 20 - 1 <= 16 THEN CAST(CAST(amount AS DECIMAL(18,0)) * 0.01 AS DECIMAL(38,18))
           ELSE CAST(amount AS DECIMAL(38,18)) END AS settlement_amount,
      CASE WHEN settlement_currency_code IS NULL AND k % 2 = 1 THEN '' ELSE settlement_currency_code END AS settlement_currency_code,
      CASE WHEN k % 5 = 0 THEN settlement_currency_desc || ' (old)' ELSE settlement_currency_desc END AS settlement_currency_desc,
      CASE WHEN txn_reference_number IS NOT NULL THEN {_REFERENCE('k')} END AS txn_reference_number),
    CASE WHEN k % 20 - 1 = -1 THEN CAST(amount AS HUGEINT) * CAST(100000000000000000 AS HUGEINT)
         WHEN k % 20 - 1 <= 16 THEN CAST(amount AS HUGEINT) * {_TENS}[18 - k % 20]
         ELSE CAST(amount AS HUGEINT) * {_TENS}[20 - k % 20] END AS units
  FROM hx_keyed),
hx_chargeback AS (SELECT * REPLACE (CAST(chargeback_amount AS DECIMAL(38,18)) AS chargeback_amount) FROM fx_chargeback),
hx_advice AS (
  SELECT {_REFERENCE('k')} AS acquirer_ref_number, create_date, create_date_ts
  FROM (SELECT *, CAST(substr(acquirer_ref_number, 4) AS BIGINT) + 1 AS k FROM fx_advice) WHERE k % 3 <> 0 OR k % 300 = 0)"""
_UNITS_AS_MAJOR = ("CAST(CAST(units // 1000000000000000000 AS VARCHAR) || '.' || "
                   "lpad(CAST(units % 1000000000000000000 AS VARCHAR), 18, '0') AS DECIMAL(38,18))")


def on_shared(sql: str) -> str:
    """A query over the settlement inputs, moved to the awkward ones."""
    usd = major("settlement_amount", "settlement_rpt_precision")
    moved = sql.replace("FROM fx_payments p", "FROM hx_payments p").replace("FROM fx_chargeback c", "FROM hx_chargeback c")
    return moved.replace("FROM fx_advice a", "FROM hx_advice a").replace(usd, _UNITS_AS_MAJOR).replace(
        FIXTURE_CTES, FIXTURE_CTES + "," + SHARED_CTES)


def wide_amounts_sql() -> str:
    return f"""WITH {FIXTURE_CTES},{SHARED_CTES}
SELECT payment_id, action_type, settlement_amount, settlement_rpt_precision, {_UNITS_AS_MAJOR} AS major_amount FROM hx_payments"""


def amt(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(38,18))"


def cnt(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def _bucket(days: str) -> str:
    return f"CASE WHEN {days} < 0 THEN 'prior' WHEN {days} > {DAYS[-1]} THEN 'above_21' ELSE CAST({days} AS VARCHAR) END"


def with_views(period: int) -> str:
    codes = ", ".join(f"('{scheme}', '{c}')" for scheme, some in FRAUD_CODES.items() for c in some)
    usd = major("settlement_amount", "settlement_rpt_precision")
    return f"""WITH {FIXTURE_CTES},
span AS (
  SELECT CAST(m - INTERVAL '{MONTHS[period]}' MONTH AS DATE) AS first_post, CAST(m - INTERVAL '1' DAY AS DATE) AS last_day,
         CAST(m - INTERVAL '{MONTHS[period] + 1}' MONTH + INTERVAL '14' DAY AS DATE) AS first_created
  FROM (SELECT date_trunc('month', DATE '{RUN_DATE}') AS m)),
fraud_codes(scheme, code) AS (VALUES {codes}),
pay_win AS (
  SELECT p.* EXCLUDE (created_date, batch_post_day, transaction_status) FROM fx_payments p, span
  WHERE list_contains(['VI', 'MC'], p.method_of_payment_code) AND p.transaction_status = '1'
    AND p.batch_post_day >= first_post AND p.created_date >= first_created
    AND greatest(p.batch_post_day, p.created_date) <= last_day),
dep_win AS (SELECT * FROM pay_win WHERE list_contains(['D', 'S'], action_type)),
ref_win AS (SELECT * FROM pay_win WHERE list_contains(['T', 'R'], action_type) AND complete_date IS NOT NULL),
cbk_win AS (
  SELECT c.* EXCLUDE (open_date, type, current_cycle) FROM fx_chargeback c, span
  WHERE c.open_date >= first_post AND c.open_date <= last_day AND c.type = 'D' AND c.current_cycle <> 'ARBITRATION'),
dep AS (SELECT *, {usd} AS usd FROM dep_win),
ref AS (SELECT *, {usd} AS usd FROM ref_win),
cbk AS (
  SELECT c.*, f.code IS NOT NULL AS fraud FROM cbk_win c
  LEFT JOIN fraud_codes f ON f.scheme = c.method_of_payment_code AND f.code = c.reason_code),
parent_refunds AS (SELECT parent_id, count(*) AS n, sum(usd) AS s FROM ref GROUP BY ALL),
deposit_cbks AS (
  SELECT deposit_id, count(*) AS n, sum(chargeback_amount) AS s, count(*) FILTER (WHERE fraud) AS fn,
         coalesce(sum(chargeback_amount) FILTER (WHERE fraud), 0) AS fs
  FROM cbk GROUP BY ALL),
dep_volume AS (
  SELECT merchant_id, merchant_name, organization_id, organization_name, settlement_currency_code,
         settlement_currency_desc, method_of_payment_code, count(*) AS vol_deposit_count,
         sum(usd) AS vol_deposit_settlement_amount
  FROM dep WHERE complete_date IS NOT NULL GROUP BY ALL),
dep_refund_totals AS (
  SELECT merchant_id, settlement_currency_code, method_of_payment_code,
         coalesce(sum(p.n), 0) AS excptn_refund_count, sum(p.s) AS excptn_refund_settlement_amount
  FROM dep LEFT JOIN parent_refunds p ON p.parent_id = dep.payment_id
  WHERE dep.complete_date IS NOT NULL GROUP BY ALL),
volume_with_refunds AS (
  SELECT v.* EXCLUDE cur, t.excptn_refund_count, t.excptn_refund_settlement_amount
  FROM (SELECT *, coalesce(settlement_currency_code, '') AS cur FROM dep_volume) v
  JOIN (SELECT * EXCLUDE settlement_currency_code, coalesce(settlement_currency_code, '') AS cur FROM dep_refund_totals) t
  USING (merchant_id, method_of_payment_code, cur)),
cbk_totals AS (
  SELECT merchant_id, settlement_currency_code, settlement_currency_desc, dep.method_of_payment_code,
         sum(k.n) AS excptn_cbks_count, sum(k.s) AS excptn_cbks_amount,
         sum(k.fn) AS excptn_fraud_cbks_count, sum(k.fs) AS excptn_fraud_cbks_amount
  FROM dep JOIN deposit_cbks k ON k.deposit_id = dep.payment_id GROUP BY ALL),
refund_matching AS (
  SELECT merchant_id, settlement_currency_code, settlement_currency_desc, method_of_payment_code,
         count(*) AS excptn_refund_mtch_count, count(*) FILTER (WHERE parent_id > 0) AS excptn_refund_mtch_count_mtchd,
         sum(usd) AS excptn_refund_mtch_amount,
         coalesce(sum(usd) FILTER (WHERE parent_id > 0), 0) AS excptn_refund_mtch_amount_mtchd
  FROM ref GROUP BY ALL),
told AS (
  SELECT a.acquirer_ref_number, a.create_date, CAST(a.create_date_ts AS DATE) AS told_on
  FROM fx_advice a, span WHERE a.create_date >= first_post AND a.create_date <= last_day),
advice_rows AS (
  SELECT merchant_id, payment_id, settlement_currency_code, settlement_currency_desc, method_of_payment_code,
         usd AS frd_deposit_settlement_amount, create_date AS frd_advice_date,
         refunded_on AS frd_refund_date, refunded AS frd_refund_settlement_amount,
         charged_on AS frd_cbk_date, charged AS frd_cbk_amount, CAST(coalesce(fraud, false) AS INT) AS is_fraud_cbk,
         CAST(charged_day - told_on AS INT) AS cbk_days_after_cps_reported,
         CAST(refund_day - told_on AS INT) AS ref_days_after_cps_reported,
         charged_day - told_on < 0 AS frd_cbk_prior, refund_day - told_on < 0 AS frd_refund_prior
  FROM (SELECT * FROM dep WHERE complete_date IS NOT NULL) d
  JOIN told ON told.acquirer_ref_number = d.txn_reference_number
  LEFT JOIN (SELECT deposit_id, issuing_bank_day AS charged_on, chargeback_amount AS charged, fraud,
                    CAST(issuing_bank_day_ts AS DATE) AS charged_day FROM cbk) c ON c.deposit_id = d.payment_id
  LEFT JOIN (SELECT parent_id AS of_deposit, amount AS full_amount, ot_start_ts AS refunded_on, usd AS refunded,
                    CAST(ot_start_ts_ts AS DATE) AS refund_day FROM ref) r
    ON r.of_deposit = d.payment_id AND r.full_amount = d.amount),
labelled AS (
  SELECT *, is_fraud_cbk = 1 AS fraud,
         CASE WHEN frd_cbk_date IS NULL THEN NULL WHEN frd_cbk_date < frd_advice_date THEN 'cbk_prior'
              WHEN frd_refund_date IS NULL THEN 'not_ref_full' WHEN frd_refund_date < frd_advice_date THEN 'ref_full_prior'
              ELSE 'ref_full_after' END AS timing,
         {_bucket("cbk_days_after_cps_reported")} AS cbk_bucket, {_bucket("ref_days_after_cps_reported")} AS ref_bucket
  FROM advice_rows)"""


# ---------------------------------------------------------------- fraud-advice measures over the labels

def _total(value: str, rows: str) -> str:
    return f"coalesce(sum({value}) FILTER (WHERE {rows}), 0)"


def _six(name: str, rows: str, whole: tuple[str, str]) -> list[tuple[str, str]]:
    """Count and amount of deposits, of chargebacks and of fraudulent chargebacks."""
    charged = f"{rows} AND frd_cbk_date IS NOT NULL"
    return [(f"cnt_{name}_total", whole[0]), (f"cnt_{name}_cbks", f"count(*) FILTER (WHERE {charged})"),
            (f"cnt_{name}_frd_cbks", f"count(*) FILTER (WHERE {charged} AND fraud)"), (f"amnt_{name}_total", whole[1]),
            (f"amnt_{name}_cbks", _total("frd_cbk_amount", charged)),
            (f"amnt_{name}_frd_cbks", _total("frd_cbk_amount", f"{charged} AND fraud"))]


def all_measures() -> list[tuple[str, str]]:
    return _six("all", "true", ("count(payment_id)", "sum(frd_deposit_settlement_amount)"))


def class_measures() -> list[tuple[str, str]]:
    return [m for c in CLASSES for m in _six(c, f"timing = '{c}'", (
        f"count(*) FILTER (WHERE timing = '{c}')", _total("frd_deposit_settlement_amount", f"timing = '{c}'")))]


def day_measures(row_counts: bool = False) -> list[tuple[str, str]]:
    """Per bucket; counts of days 2..21 are weighted by the day unless ``row_counts``."""
    out = []
    for b in ("prior", *DAYS, "above_21"):
        weight = int(b) if b.isdigit() and int(b) > 1 and not row_counts else 1
        for what, value in (("cnt", None), ("amnt", ("frd_cbk_amount", "frd_refund_settlement_amount"))):
            for side, name in enumerate(("cbks", "refunds")):
                rows = f"{('cbk', 'ref')[side]}_bucket = '{b}'"
                expr = f"{weight} * count(*) FILTER (WHERE {rows})" if value is None else _total(value[side], rows)
                out.append((f"excptn_{what}_{b}_{name}", expr))
    return out


def typed(name: str, expr: str) -> str:
    kind = cnt if ("cnt_" in name or "count" in name) else amt
    return f"{kind(expr)} AS {name}"


def _measured(measures: list[tuple[str, str]]) -> str:
    body = ",\n  ".join(typed(n, e) for n, e in measures)
    return f"""SELECT merchant_id, settlement_currency_code, settlement_currency_desc, method_of_payment_code,
  {body}
FROM labelled GROUP BY 1, 2, 3, 4"""


def advice_metrics_sql(period: int, measures: list[tuple[str, str]]) -> str:
    return f"{with_views(period)}\n{_measured(measures)}"


def report_select(period: int, extra: str = "") -> str:
    """The driving rows joined to the three totals on merchant, method and the currency with '' for NULL."""
    measures = all_measures() + class_measures() + day_measures()
    keys = ("merchant_id", "merchant_name", "organization_id", "organization_name", "method_of_payment_code",
            "settlement_currency_code", "settlement_currency_desc")
    numbers = ["vol_deposit_count", "excptn_refund_count", "vol_deposit_settlement_amount", "excptn_refund_settlement_amount",
               "excptn_cbks_count", "excptn_cbks_amount", "excptn_fraud_cbks_count", "excptn_fraud_cbks_amount",
               "excptn_refund_mtch_count", "excptn_refund_mtch_amount", "excptn_refund_mtch_count_mtchd",
               "excptn_refund_mtch_amount_mtchd", *[n for n, _ in measures]]
    side = "(SELECT * EXCLUDE (settlement_currency_code, settlement_currency_desc), coalesce(settlement_currency_code, '') AS cur FROM {0})"
    joined = "\n".join(f"LEFT JOIN {side.format(t)} USING (merchant_id, method_of_payment_code, cur)"
                       for t in ("cbk_totals", "refund_matching", "advice_measures"))
    return f"""{with_views(period)},
advice_measures AS ({_measured(measures)})
SELECT {", ".join(f"{k} AS {k.upper()}" for k in keys)},
  CAST(strftime((SELECT last_day FROM span), '%Y-%m-01') AS TIMESTAMP) AS reporting_month_day,
  {", ".join(typed(n, f"coalesce({n}, 0)") for n in numbers)}{extra}
FROM (SELECT *, coalesce(settlement_currency_code, '') AS cur FROM volume_with_refunds)
{joined}"""


# ---------------------------------------------------------------- reconciliation

CONSTANTS = ("CAST(1 AS BIGINT) AS gdg_position, CAST(1 AS BIGINT) AS gdg_txoppos, '1' AS gdg_txind, "
             "'1' AS gdg_opcode, '1' AS gdg_timestamp, '1' AS gdg_schema, '1' AS gdg_table")
_QUERY = "concat('SELECT COUNT(*) FROM ', lower(name), ' WHERE CAST(', date_column_name, ' AS DATE) = ''', day, '''')"

#: Day counts of every table that exists, and the requests of the control rows.
_COUNTED = """per_day AS (
  SELECT t, d, n FROM fx_daily UNION ALL SELECT 'EVENTS', CAST(ts AS DATE), count(*) FROM events GROUP BY ALL),
existing AS (SELECT DISTINCT t FROM per_day)"""
_PART1 = f"""asked AS (
  SELECT table_id, upper(table_name) AS name, date_column_name, DATE '{RUN_DATE}' - coalesce(num_days, 0) AS day
  FROM fx_control WHERE count_ind = 'Y')"""


def _verdicts(keep_null_audit: bool = False) -> str:
    other = "v.told" if keep_null_audit else "coalesce(v.told, 0)"
    return f"""SELECT {CONSTANTS}, CAST(table_id AS BIGINT) AS id, name AS table_name, CAST(day AS VARCHAR) AS count_date,
  CAST(coalesce(c.n, 0) AS BIGINT) AS bda_count,
  CAST(CASE WHEN known THEN {other} ELSE 0 END AS BIGINT) AS vap_count,
  CASE WHEN NOT known THEN 'F' WHEN coalesce(c.n, 0) = coalesce(v.told, 0) THEN 'Y' ELSE 'N' END AS matched,
  CAST(CASE WHEN known THEN coalesce(c.n, 0) - coalesce(v.told, 0) ELSE 0 END AS BIGINT) AS count_diff,
  date_column_name, '{INSERTED_AT}' AS inserted_date,
  {_QUERY} || CASE WHEN known THEN '' ELSE ' has failed in {APP_ID}' END AS runtime_sql
FROM (SELECT *, name IN (SELECT t FROM existing) AS known FROM asked) q
LEFT JOIN per_day c ON c.t = name AND c.d = day
LEFT JOIN (
  SELECT table_name AS whose, target_date, arg_max(record_count, struct_pack(e := extract_date, i := inserted_date)) AS told
  FROM fx_audit WHERE extract_date BETWEEN target_date AND DATE '{AS_OF}' GROUP BY ALL) v
  ON v.whose = name AND v.target_date = day"""


def reconcile_sql(keep_null_audit: bool = False) -> str:
    return f"WITH {FIXTURE_CTES},\n{_COUNTED},\n{_PART1}\n{_verdicts(keep_null_audit)}"


def stored_query(table: str, column: str) -> str:
    """A stored count query of two columns, as control tables hold it."""
    return f"SELECT '{table.upper()}' AS t, COUNT(*) AS n FROM counted_{table} WHERE CAST({column} AS DATE) = {{var1}}"


#: Control rows with stored queries: id, table, column, days back (may be NULL), query.
STORED = [
    (1, "orders", "o_orderdate", 1, stored_query("orders", "o_orderdate")),
    (2, "lineitem", "l_shipdate", None, stored_query("lineitem", "l_shipdate")),
    (3, "events", "ts", 2, stored_query("events", "ts")),
    (4, "orders", "o_orderdate", 10, stored_query("orders", "o_orderdate")),
    (6, "lineitem", "l_shipdate", 3, "SELECT 'LINEITEM' AS t, no_such_column AS n FROM counted_lineitem WHERE l_shipdate = {var1}"),
    (None, "lineitem", "l_shipdate", 4, None),
]


def stored_sql() -> str:
    """Requests with stored queries: the count of the day, or F where the query is bad or the id is missing."""
    text = lambda v: "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
    rows = ",\n  ".join(f"({'NULL' if i is None else i}, {text(t)}, {text(c)}, {'NULL' if d is None else d}, {text(q)})"
                        for i, t, c, d, q in STORED)
    return f"""WITH {FIXTURE_CTES},
{_COUNTED},
control(id, t, date_column_name, num_days, sql) AS (VALUES
  {rows}),
asked AS (
  SELECT *, DATE '{RUN_DATE}' - coalesce(num_days, 0) AS day, id IS NULL OR sql LIKE '%no_such_column%' AS bad FROM control)
SELECT {CONSTANTS}, CAST(a.id AS BIGINT) AS id, CASE WHEN a.id IS NULL THEN a.t ELSE upper(a.t) END AS table_name,
  CASE WHEN a.id IS NOT NULL THEN CAST(day AS VARCHAR) END AS count_date,
  CAST(CASE WHEN bad THEN 0 ELSE coalesce(c.n, 0) END AS BIGINT) AS bda_count,
  CAST(CASE WHEN bad THEN 0 ELSE coalesce(v.told, 0) END AS BIGINT) AS vap_count,
  CASE WHEN bad THEN 'F' WHEN coalesce(c.n, 0) = coalesce(v.told, 0) THEN 'Y' ELSE 'N' END AS matched,
  CAST(CASE WHEN bad THEN 0 ELSE coalesce(c.n, 0) - coalesce(v.told, 0) END AS BIGINT) AS count_diff,
  date_column_name, '{INSERTED_AT}' AS inserted_date,
  CASE WHEN a.id IS NULL THEN 'table_id is NULL' ELSE replace(sql, '{{var1}}', concat(chr(39), CAST(day AS VARCHAR), chr(39))) END
    || CASE WHEN bad THEN ' has failed in {APP_ID}' ELSE '' END AS runtime_sql
FROM asked a LEFT JOIN per_day c ON c.t = upper(a.t) AND c.d = day
LEFT JOIN (
  SELECT table_name AS whose, target_date, arg_max(record_count, struct_pack(e := extract_date, i := inserted_date)) AS told
  FROM fx_audit WHERE extract_date BETWEEN target_date AND DATE '{AS_OF}' GROUP BY ALL) v
  ON v.whose = upper(a.t) AND v.target_date = day"""


def table_counts_sql() -> str:
    return f"""WITH {FIXTURE_CTES},
{_COUNTED},
{_PART1}
SELECT CAST(table_id AS BIGINT) AS id, name AS table_name, CAST(day AS VARCHAR) AS count_date,
       CAST(coalesce(c.n, 0) AS BIGINT) AS bda_count
FROM asked LEFT JOIN per_day c ON c.t = name AND c.d = day WHERE name IN (SELECT t FROM existing)"""


def _replayed(only_failed: bool) -> str:
    wanted = "WHERE last.matched = 'N' AND last.vap_count <> 0" if only_failed else ""
    return f"""newest AS (
  SELECT upper(table_name) AS name, count_date, arg_max(
           struct_pack(matched := matched, vap_count := vap_count, runtime_sql := runtime_sql),
           struct_pack(e := extract_date, i := inserted_date)) AS last
  FROM fx_history
  WHERE date_diff('day', extract_date, DATE '{RUN_DATE}') BETWEEN 1 AND {REPLAY_DAYS} GROUP BY 1, 2),
replayed AS (
  SELECT k.table_id, name, k.date_column_name, count_date, k.sql, last.runtime_sql AS runtime_sql
  FROM newest JOIN fx_control k ON upper(k.table_name) = name AND k.failed_rerun = 'Y' {wanted})"""


def replay_candidates_sql(only_failed: bool = True) -> str:
    return f"""WITH {FIXTURE_CTES},
{_replayed(only_failed)}
SELECT table_id, name AS table_name, date_column_name, count_date, sql, runtime_sql FROM replayed"""


def replay_counts_sql() -> str:
    return f"""WITH {FIXTURE_CTES},
{_COUNTED},
{_replayed(True)},
asked AS (SELECT table_id, name, date_column_name, CAST(count_date AS DATE) AS day FROM replayed)
{_verdicts()}"""


# ---------------------------------------------------------------- reconciliation: selection, templates, recorded queries

_SELECTED = f"""selected AS (
  SELECT * FROM fx_control c WHERE count_ind = 'Y' AND (table_type = 'TRAN' OR table_type = 'DIM' AND EXISTS (
    SELECT 1 FROM fx_audit a WHERE upper(a.table_name) = upper(c.table_name) AND a.extract_date = DATE '{RUN_DATE}')))"""


def select_control_sql() -> str:
    return f"WITH {FIXTURE_CTES},\n{_SELECTED}\nSELECT * FROM selected"


def selected_job_sql() -> str:
    """The daily job over the selected control rows, and the replay of unmatched days."""
    part1 = _PART1.replace("FROM fx_control WHERE count_ind = 'Y'", "FROM selected")
    today = f"WITH {FIXTURE_CTES},\n{_COUNTED},\n{_SELECTED},\n{part1}\n{_verdicts()}"
    return (f"SELECT *, DATE '{RUN_DATE}' AS extract_date FROM ({today}) r\nUNION ALL\n"
            f"SELECT *, DATE '{RUN_DATE}' AS extract_date FROM ({replay_counts_sql()}) p")


def _judged() -> str:
    """Verdict rows of ``asked(id, name, date_column_name, day, text, bad)``."""
    return f"""SELECT {CONSTANTS}, CAST(a.id AS BIGINT) AS id, a.name AS table_name, CAST(a.day AS VARCHAR) AS count_date,
  CAST(CASE WHEN a.bad THEN 0 ELSE coalesce(c.n, 0) END AS BIGINT) AS bda_count,
  CAST(CASE WHEN a.bad THEN 0 ELSE coalesce(v.told, 0) END AS BIGINT) AS vap_count,
  CASE WHEN a.bad THEN 'F' WHEN coalesce(c.n, 0) = coalesce(v.told, 0) THEN 'Y' ELSE 'N' END AS matched,
  CAST(CASE WHEN a.bad THEN 0 ELSE coalesce(c.n, 0) - coalesce(v.told, 0) END AS BIGINT) AS count_diff,
  a.date_column_name, '{INSERTED_AT}' AS inserted_date,
  a.text || CASE WHEN a.bad THEN ' has failed in {APP_ID}' ELSE '' END AS runtime_sql
FROM asked a LEFT JOIN per_day c ON c.t = a.name AND c.d = a.day
LEFT JOIN (
  SELECT table_name AS whose, target_date, arg_max(record_count, struct_pack(e := extract_date, i := inserted_date)) AS told
  FROM fx_audit WHERE extract_date BETWEEN target_date AND DATE '{AS_OF}' GROUP BY ALL) v
  ON v.whose = a.name AND v.target_date = a.day"""


#: Stored queries asked for many days: id, table, column, query.
TEMPLATES = [(1, "orders", "o_orderdate", stored_query("orders", "o_orderdate")),
             (2, "lineitem", "l_shipdate", stored_query("lineitem", "l_shipdate")),
             (3, "events", "ts", stored_query("events", "ts")),
             (4, "orders", "o_orderdate", "SELECT o_orderpriority AS t, no_such AS n FROM counted_orders WHERE o_orderdate = {var1}")]
TEMPLATE_DAYS = 30


def _text(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def _on_day(sql: str, day: str) -> str:
    return f"replace({sql}, '{{var1}}', concat(chr(39), CAST({day} AS VARCHAR), chr(39)))"


def templates_sql() -> str:
    rows = ",\n  ".join(f"({i}, {_text(t.upper())}, {_text(c)}, {_text(q)})" for i, t, c, q in TEMPLATES)
    return f"""WITH {FIXTURE_CTES},
{_COUNTED},
stored(id, name, date_column_name, sql) AS (VALUES
  {rows}),
asked AS (
  SELECT id, name, date_column_name, day, {_on_day('sql', 'day')} AS text, sql LIKE '%no_such%' AS bad
  FROM stored, (SELECT DATE '{RUN_DATE}' - CAST(k AS INTEGER) AS day FROM range(1, {TEMPLATE_DAYS + 1}) r(k)))
{_judged()}"""


#: Control rows whose recorded queries are replayed: id, table, column, days back, query (None: the library's own count).
RECORDED = [(1, "orders", "o_orderdate", 1, None), (2, "lineitem", "l_shipdate", 2, None),
            (4, "orders", "o_orderdate", 10, "SELECT COUNT(*) AS n FROM counted_orders WHERE CAST(o_orderdate AS DATE) = {var1}"),
            (5, "no_such_table", "d", 1, None)]
RECORDED_RUNS = (3, 2, 1)       # days before the run date on which the history was written


def recorded_replay_sql() -> str:
    """Today's counts, and every recorded day again through its own query; failed ones fail again, named once."""
    rows = ",\n  ".join(f"({i}, {_text(t)}, {_text(c)}, {d}, {_text(q)})" for i, t, c, d, q in RECORDED)
    runs = ", ".join(f"({k})" for k in (0, *RECORDED_RUNS))
    plain = _QUERY.replace("name", "t", 1).replace("date_column_name", "c")
    return f"""WITH {FIXTURE_CTES},
{_COUNTED},
control(id, t, c, back, sql) AS (VALUES
  {rows}),
counted AS (
  SELECT k, id, upper(t) AS name, c, day, CASE WHEN sql IS NULL THEN {plain} ELSE {_on_day('sql', 'day')} END AS text
  FROM (SELECT *, DATE '{RUN_DATE}' - k - back AS day FROM control, (VALUES {runs}) r(k))),
asked AS (
  SELECT id, name, c AS date_column_name, day, text, name = 'NO_SUCH_TABLE' AS bad FROM counted WHERE k = 0
  UNION ALL
  SELECT o.id, h.name, o.c, h.day, h.text, h.name = 'NO_SUCH_TABLE' FROM counted h JOIN control o ON upper(o.t) = h.name WHERE h.k > 0)
{_judged()}"""
