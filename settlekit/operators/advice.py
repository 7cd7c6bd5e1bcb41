"""Fraud advice against deposits, full refunds and chargebacks.

``advice_detail`` is the reference's detail view: one row per advice x
deposit x full refund x chargeback. Its size is the product of those counts
per deposit, so the metrics never build it. ``advice_metrics`` computes the same
126 measures from one row per advised deposit:

* Chargebacks are totalled per (deposit, dates) and refunds per (deposit, amount,
  dates), combined on the map side, and kept as one short list per key: as long as
  the key has distinct dates, however many events it has. Advice becomes one list
  of dates per reference the same way.
* A deposit without events needs no dates. Every detail row of it falls into the
  totals alone, so it stays one row weighted by its advice rows.
* A deposit with events becomes one row per span of advice dates between its event
  dates, weighted by the advice rows of that span: dates of one span are before and after
  the same events. However many dates its reference has, a deposit has at most one row
  more than its events have dates. The detail rows of such a row are C x F, with C the
  chargebacks (or one NULL row) and F the full refunds (or one NULL row). Every measure is

      SUM over C x F of CASE WHEN P(chargeback) AND Q(refund) THEN value ELSE 0 END

  with P on the chargeback and Q on the refund alone, so it is a product of two
  counts, or of a count and a sum. Day buckets ask for one side only (the other
  gives its number of rows): each dated total adds once per bucket, for the advice rows
  that put it there.
* What a row adds goes out as (slot, count, amount) and is summed per merchant group
  and slot: 63 slots, each a count and an amount, make the 126 measures. One pass over
  each input, no window, no join of events with advice, nothing written in between.

SUM's NULL semantics: an amount is NULL exactly when every detail row of the group
satisfies the predicate and carries a NULL value, so slots also count those rows.

A reference that many deposits share (a placeholder such as ``'0'``) is split: its
deposits are dealt by a hash over several copies of its one row of advice dates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settlekit.functions.fraud import fraud_flag
from settlekit.functions.money import REPORT_AMOUNT, WHOLE, from_parts, major_parts, minor_to_major
from settlekit.functions.periods import ReportWindow
from settlekit.operators.payments import GROUP4, amount_parts
from settlekit.sources.scans import advice_in_window

# Fixed values (must equal the reference): exact day buckets 0..21 after the advice.
DAY_OFFSETS = tuple(range(0, 22))
CLASSES = ("cbk_prior", "ref_full_prior", "ref_full_after", "not_ref_full")
DAY_BUCKETS = ("prior",) + tuple(str(k) for k in DAY_OFFSETS) + ("above_21",)


def day_weight(bucket: str, row_counts: bool) -> int:
    """What one detail row adds to a day-bucket count: the day number for days
    2..21 (as the reference does), else 1; always 1 with ``row_counts``."""
    if row_counts or not bucket.isdigit():
        return 1
    k = int(bucket)
    return k if k >= 2 else 1


# ---------------------------------------------------------------- measure catalog

@dataclass(frozen=True)
class Measure:
    name: str
    kind: str        # "count" | "dep" | "cbk" | "ref"
    p: str           # chargeback predicate
    q: str           # refund predicate
    weight: int = 1


def measure_catalog(row_counts: bool = False) -> list[Measure]:
    """The 126 fraud-advice measures in report order."""
    ms = [
        Measure("cnt_all_total", "count", "all", "all"),
        Measure("cnt_all_cbks", "count", "nn", "all"),
        Measure("cnt_all_frd_cbks", "count", "nnf", "all"),
        Measure("amnt_all_total", "dep", "all", "all"),
        Measure("amnt_all_cbks", "cbk", "nn", "all"),
        Measure("amnt_all_frd_cbks", "cbk", "nnf", "all"),
    ]
    class_pred = {"cbk_prior": ("lt", "all"), "ref_full_prior": ("ge", "lt"),
                  "ref_full_after": ("ge", "ge"), "not_ref_full": ("ge", "null")}
    for cls in CLASSES:
        p, q = class_pred[cls]
        ms += [
            Measure(f"cnt_{cls}_total", "count", p, q),
            Measure(f"cnt_{cls}_cbks", "count", p, q),
            Measure(f"cnt_{cls}_frd_cbks", "count", p + "f", q),
            Measure(f"amnt_{cls}_total", "dep", p, q),
            Measure(f"amnt_{cls}_cbks", "cbk", p, q),
            Measure(f"amnt_{cls}_frd_cbks", "cbk", p + "f", q),
        ]
    for b in DAY_BUCKETS:
        w = day_weight(b, row_counts)
        ms += [
            Measure(f"excptn_cnt_{b}_cbks", "count", f"day{b}", "all", w),
            Measure(f"excptn_cnt_{b}_refunds", "count", "all", f"day{b}", w),
            Measure(f"excptn_amnt_{b}_cbks", "cbk", f"day{b}", "all"),
            Measure(f"excptn_amnt_{b}_refunds", "ref", "all", f"day{b}"),
        ]
    return ms


FAMILIES = {
    "all": lambda m: "_all_" in m.name,
    "class": lambda m: any(f"_{c}_" in m.name for c in CLASSES),
    "day": lambda m: m.name.startswith("excptn_"),
}


def select_measures(families=("all", "class", "day"), row_counts: bool = False) -> list[Measure]:
    return [m for m in measure_catalog(row_counts) if any(FAMILIES[f](m) for f in families)]


# ---------------------------------------------------------------- reference-form detail

def advice_detail(advice: DataFrame, dep: DataFrame, ref: DataFrame, cbk: DataFrame, w: ReportWindow) -> DataFrame:
    """One row per advice x completed deposit x full refund x chargeback (the
    reference's detail view), dates as calendar days. Output-sized: use for drill-down, not for totals."""
    a = advice_in_window(advice, w).alias("a")
    d = dep.where(F.col("complete_date").isNotNull()).alias("d")
    r = ref.alias("r")
    c = cbk.alias("c")
    j = (a.join(d, F.col("d.txn_reference_number") == F.col("a.acquirer_ref_number"))
          .join(r, (F.col("r.parent_id") == F.col("d.payment_id")) & (F.col("r.amount") == F.col("d.amount")), "left")
          .join(c, F.col("c.deposit_id") == F.col("d.payment_id"), "left"))
    adv_day = F.to_date("a.create_date_ts")
    return j.select(
        F.col("d.merchant_id"), F.col("d.payment_id"), F.col("d.settlement_currency_code"),
        F.col("d.settlement_currency_desc"), F.col("d.method_of_payment_code"),
        minor_to_major("d.settlement_amount", "d.settlement_rpt_precision", dep.schema["settlement_amount"].dataType).alias("frd_deposit_settlement_amount"),
        F.to_date("a.create_date").alias("frd_advice_date"),
        F.to_date("r.ot_start_ts").alias("frd_refund_date"),
        minor_to_major("r.settlement_amount", "r.settlement_rpt_precision", ref.schema["settlement_amount"].dataType).alias("frd_refund_settlement_amount"),
        F.to_date("c.issuing_bank_day").alias("frd_cbk_date"),
        F.col("c.chargeback_amount").alias("frd_cbk_amount"),
        fraud_flag("c.method_of_payment_code", "c.reason_code").alias("is_fraud_cbk"),
        F.datediff(F.to_date("c.issuing_bank_day_ts"), adv_day).alias("cbk_days_after_cps_reported"),
        F.datediff(F.to_date("r.ot_start_ts_ts"), adv_day).alias("ref_days_after_cps_reported"),
        (F.to_date("c.issuing_bank_day_ts") < adv_day).alias("frd_cbk_prior"),
        (F.to_date("r.ot_start_ts_ts") < adv_day).alias("frd_refund_prior"),
    )


def _detail_predicate(kind: str, side: str) -> str | None:
    """SQL predicate of one side on detail rows (None = always true)."""
    if kind == "all":
        return None
    if kind.startswith("day"):
        return _day_pred("cbk_days_after_cps_reported" if side == "c" else "ref_days_after_cps_reported", kind[3:])
    if side == "c":
        base = {"nn": "frd_cbk_date IS NOT NULL", "lt": "frd_cbk_date < frd_advice_date", "ge": "NOT (frd_cbk_date < frd_advice_date)"}
        return f"({base[kind[:-1]]} AND is_fraud_cbk = 1)" if kind.endswith("f") else base[kind]
    return {"lt": "frd_refund_date < frd_advice_date", "ge": "frd_refund_date >= frd_advice_date", "null": "frd_refund_date IS NULL"}[kind]


def _day_pred(days: str, bucket: str) -> str:
    if bucket == "prior":
        return f"{days} <= -1"
    if bucket == "above_21":
        return f"{days} > {DAY_OFFSETS[-1]}"
    return f"{days} = {int(bucket)}"


def advice_metrics_from_detail(detail: DataFrame, families=("all", "class", "day"),
                               row_counts: bool = False) -> DataFrame:
    """The measures aggregated straight from ``advice_detail`` (brute force; the
    cross-check for ``advice_metrics`` on small inputs)."""
    aggs = []
    for m in select_measures(families, row_counts):
        preds = [p for p in (_detail_predicate(m.p, "c"), _detail_predicate(m.q, "r")) if p is not None]
        value = {"count": str(m.weight), "dep": "frd_deposit_settlement_amount", "cbk": "frd_cbk_amount",
                 "ref": "frd_refund_settlement_amount"}[m.kind]
        if m.name == "cnt_all_total":
            expr = "COUNT(payment_id)"
        elif not preds:
            expr = f"SUM({value})"
        else:
            expr = f"SUM(CASE WHEN {' AND '.join(preds)} THEN {value} ELSE 0 END)"
        aggs.append(F.expr(f"{f'CAST({expr} AS BIGINT)' if m.kind == 'count' else expr} AS {m.name}"))
    return detail.groupBy(*GROUP4).agg(*aggs)


# ---------------------------------------------------------------- metrics without pairs

# Slots of what a row adds; day buckets follow from their first slot.
_TOTAL, _NO_ID, _CBKS, _FRAUD, _CLASS, _DAY_CBKS, _DAY_REFUNDS = 0, 1, 2, 3, 10, 100, 200
_CLASS_SIDES = {"cbk_prior": ("lt", "all"), "ref_full_prior": ("ge", "lt"), "ref_full_after": ("ge", "ge"),
                "not_ref_full": ("ge", "null")}

#: A reference on more deposits than this is split, into at most HOT_COPIES parts. The
#: most frequent HOT_REFERENCES are looked at; splitting changes no result.
HOT_ROWS, HOT_COPIES, HOT_REFERENCES = 100_000, 1_000, 1_000


def advice_dates(advice: DataFrame, w: ReportWindow) -> DataFrame:
    """``(acquirer_ref_number, told, told_rows)``: the distinct advice dates of a
    reference with their rows, and all its rows. The list is bounded by the calendar."""
    dated = (advice_in_window(advice, w).where(F.col("acquirer_ref_number").isNotNull())
             .groupBy("acquirer_ref_number", F.to_date("create_date").alias("adv_date"),
                      F.to_date("create_date_ts").alias("adv_day"))
             .agg(F.count(F.lit(1)).alias("m")))
    return dated.groupBy("acquirer_ref_number").agg(
        F.collect_list(F.struct("adv_date", "adv_day", "m")).alias("told"), F.sum("m").alias("told_rows"))


def _dated_totals(events: DataFrame, keys: list[str], sums: list[str], name: str) -> DataFrame:
    """One row per key: ``name`` = list of (date, day, sums) per distinct dates, ``name_rows`` = events."""
    per_date = events.groupBy(*keys, "date", "day").agg(
        *[F.sum(c).cast(T.LongType() if c in ("n", "none", "fraud_n", "fraud_none") else WHOLE).alias(c) for c in sums])
    return per_date.groupBy(*keys).agg(F.collect_list(F.struct("date", "day", *sums)).alias(name),
                                       F.sum("n").alias(f"{name}_rows"))


def chargebacks_by_deposit(cbk: DataFrame) -> DataFrame:
    """Dated chargeback totals per deposit."""
    fraud = fraud_flag("method_of_payment_code", "reason_code") == 1
    amount = major_parts("chargeback_amount", cbk.schema["chargeback_amount"].dataType)
    none = F.col("chargeback_amount").isNull()
    events = cbk.where(F.col("deposit_id").isNotNull()).select(
        F.col("deposit_id").alias("cbk_deposit_id"), F.to_date("issuing_bank_day").alias("date"),
        F.to_date("issuing_bank_day_ts").alias("day"), F.lit(1).alias("n"), amount.whole.alias("whole"),
        amount.rest.alias("rest"), none.cast("int").alias("none"), fraud.cast("int").alias("fraud_n"),
        F.when(fraud, amount.whole).alias("fraud_whole"), F.when(fraud, amount.rest).alias("fraud_rest"),
        (fraud & none).cast("int").alias("fraud_none"))
    return _dated_totals(events, ["cbk_deposit_id"], ["n", "whole", "rest", "none", "fraud_n", "fraud_whole", "fraud_rest", "fraud_none"], "cbks")


def full_refunds_by_deposit(ref: DataFrame) -> DataFrame:
    """Dated refund totals per (parent deposit, amount): those of a deposit's own amount are its full refunds."""
    amount = amount_parts(ref)
    events = ref.where(F.col("parent_id").isNotNull() & F.col("amount").isNotNull()).select(
        F.col("parent_id").alias("ref_parent_id"), F.col("amount").alias("ref_amount"), F.to_date("ot_start_ts").alias("date"),
        F.to_date("ot_start_ts_ts").alias("day"), F.lit(1).alias("n"), amount.whole.alias("whole"), amount.rest.alias("rest"),
        amount.whole.isNull().cast("int").alias("none"))
    return _dated_totals(events, ["ref_parent_id", "ref_amount"], ["n", "whole", "rest", "none"], "refs")


def join_on_reference(dep: DataFrame, told: DataFrame, hot_rows: int = HOT_ROWS, plain: DataFrame | None = None) -> DataFrame:
    """Deposits with the advice dates of their reference, a frequent reference in several parts.
    ``plain``: the same deposits before more columns were joined, if any were.

    The frequent references come from a sketch of bounded size over the deposits (no
    shuffle of references), so the list that is broadcast has at most HOT_REFERENCES rows."""
    plain = dep if plain is None else plain
    top = plain.agg(F.expr(f"approx_top_k(txn_reference_number, {HOT_REFERENCES}, {10 * HOT_REFERENCES})").alias("top"))
    hot = top.select(F.explode("top").alias("t")).where((F.col("t.count") > hot_rows) & F.col("t.item").isNotNull()).select(
        F.col("t.item").alias("__ref"), F.least(F.ceil(F.col("t.count") / hot_rows), F.lit(HOT_COPIES)).cast("int").alias("__copies"))
    parts = F.coalesce("__copies", F.lit(1))
    d = dep.join(F.broadcast(hot), F.col("txn_reference_number") == F.col("__ref"), "left").select(
        *dep.columns, F.pmod(F.xxhash64(*plain.columns), parts).cast("int").alias("__part"))
    t = told.join(F.broadcast(hot), F.col("acquirer_ref_number") == F.col("__ref"), "left").select(
        *told.columns, F.explode(F.sequence(F.lit(0), parts - 1)).alias("__copy"))
    return d.join(t, (F.col("txn_reference_number") == F.col("acquirer_ref_number")) & (F.col("__part") == F.col("__copy"))).drop(
        "__part", "__copy", "acquirer_ref_number")


def advised_deposits(advice: DataFrame, dep: DataFrame, ref: DataFrame, cbk: DataFrame, w: ReportWindow,
                     hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per completed deposit with advice: its advice dates and its dated events.
    The dates, a long list where the reference is shared, come last and are not shuffled again."""
    amount = amount_parts(dep)
    d = (dep.where(F.col("complete_date").isNotNull() & F.col("txn_reference_number").isNotNull())
         .select(*GROUP4, "payment_id", "amount", "txn_reference_number", amount.whole.alias("whole"), amount.rest.alias("rest")))
    c, r = chargebacks_by_deposit(cbk), full_refunds_by_deposit(ref)
    j = d.join(c, F.col("payment_id") == F.col("cbk_deposit_id"), "left")
    j = j.join(r, (F.col("payment_id") == F.col("ref_parent_id")) & (F.col("amount") == F.col("ref_amount")), "left").drop(
        "cbk_deposit_id", "ref_parent_id", "ref_amount")
    return join_on_reference(j, advice_dates(advice, w), hot_rows, plain=d).drop("txn_reference_number")


def _totals(events: str, rel: str, sums: tuple[str, ...]) -> str:
    """SQL: the sums of the events dated ``rel`` (``<`` or ``>=``) the advice date."""
    zero = ", ".join(f"'{c}', CAST(0 AS {'BIGINT' if c.endswith(('n', 'none')) else WHOLE})" for c in sums)
    add = ", ".join(f"'{c}', " + (f"a.{c} + x.{c}" if c.endswith(("n", "none")) else f"CAST(a.{c} + COALESCE(x.{c}, 0) AS {WHOLE})")
                    for c in sums)
    return f"aggregate(filter({events}, x -> x.date {rel} t.adv_date), named_struct({zero}), (a, x) -> named_struct({add}))"


def _adds(slot: str, count: str, whole: str = "0", rest: str = "0", none: str = "0") -> str:
    return (f"named_struct('slot', {slot}, 'cnt', CAST({count} AS BIGINT), 'whole', CAST({whole} AS {WHOLE}), "
            f"'rest', CAST({rest} AS {WHOLE}), 'none', CAST({none} AS BIGINT))")


def _of_deposit(slot: str, count: str) -> str:
    """``count`` detail rows with the deposit's amount."""
    return _adds(slot, count, f"COALESCE({count} * whole, 0)", f"COALESCE({count} * rest, 0)", f"CASE WHEN whole IS NULL THEN {count} ELSE 0 END")


def _of_events(slot: str, times: str, totals: str, prefix: str = "") -> str:
    """The event totals ``totals``, each paired with ``times`` detail rows."""
    return _adds(slot, f"{times} * {totals}.{prefix}n", f"COALESCE({times} * {totals}.{prefix}whole, 0)",
                 f"COALESCE({times} * {totals}.{prefix}rest, 0)", f"{times} * {totals}.{prefix}none")


def _told_rows(keep: str) -> str:
    """SQL: the advice rows of the dates ``t`` that ``keep`` names."""
    return f"aggregate(filter(told, t -> {keep}), CAST(0 AS BIGINT), (a, t) -> a + t.m)"


#: The event dates of a deposit, in order.
_EVENT_DATES = ("array_sort(array_distinct(filter(concat(COALESCE(transform(cbks, x -> x.date), array()), "
                "COALESCE(transform(refs, x -> x.date), array())), d -> d IS NOT NULL)))")
#: Per span of advice dates up to and with the next event date: one date that stands for it, and its advice rows.
_SPANS = ("filter(transform(sequence(0, size(dates)), i -> named_struct("
          "'adv_date', COALESCE(get(dates, i), array_max(told.adv_date)), 'm', "
          + _told_rows("(i = 0 OR t.adv_date > get(dates, i - 1)) AND (i = size(dates) OR t.adv_date <= get(dates, i))")
          + ")), s -> s.m > 0)")


def _dated_adds(first: int, events: str, times: str) -> str:
    """What the dated events add to their day buckets, each once per bucket that advice rows put it in."""
    days = "datediff(x.day, t.adv_day)"
    buckets = (f"concat(transform(filter(told, t -> {days} BETWEEN 0 AND {LAST_DAY}), t -> named_struct('k', {days} + 1, 'm', t.m)), "
               f"array(named_struct('k', 0, 'm', {_told_rows(f'{days} < 0')}), "
               f"named_struct('k', {LAST_DAY + 2}, 'm', {_told_rows(f'{days} > {LAST_DAY}')})))")
    return (f"flatten(transform(filter({events}, x -> x.day IS NOT NULL), x -> "
            f"transform({buckets}, b -> {_of_events(f'{first} + b.k', f'b.m * {times}', 'x')})))")


LAST_DAY = DAY_OFFSETS[-1]


def slot_rows(advised: DataFrame, families=("all", "class", "day")) -> DataFrame:
    """``GROUP4, slot, cnt, whole, rest, none``: what each deposit adds to the slots. Their number
    follows the deposit's events, not the advice dates of its reference."""
    spans = (f"CASE WHEN cbks IS NULL AND refs IS NULL THEN array(named_struct('adv_date', CAST(NULL AS DATE), 'm', told_rows)) "
             f"ELSE {_SPANS} END")
    rows = advised.selectExpr("*", f"{_EVENT_DATES} AS dates").selectExpr("*", f"posexplode({spans}) AS (at, t)").selectExpr(
        *GROUP4, "payment_id", "whole", "rest", "at", "t", "t.m AS m", "told", "cbks", "refs", "GREATEST(COALESCE(cbks_rows, 0), 1) AS nc",
        "GREATEST(COALESCE(refs_rows, 0), 1) AS nf", "COALESCE(refs_rows, 0) AS n_refs")
    charge = ("n", "whole", "rest", "none", "fraud_n", "fraud_whole", "fraud_rest", "fraud_none")
    rows = rows.selectExpr("*", f"{_totals('cbks', '<', charge)} AS lt", f"{_totals('cbks', '>=', charge)} AS ge",
                           f"{_totals('refs', '<', ('n',))}.n AS f_lt", f"{_totals('refs', '>=', ('n',))}.n AS f_ge")
    rows = rows.selectExpr("*", "COALESCE(f_lt, 0) AS q_lt", "COALESCE(f_ge, 0) AS q_ge",
                           "n_refs - COALESCE(f_lt, 0) - COALESCE(f_ge, 0) + CASE WHEN n_refs = 0 THEN 1 ELSE 0 END AS q_null", "nf AS q_all")
    adds = [_of_deposit(str(_TOTAL), "m * nc * nf"), _adds(str(_NO_ID), "CASE WHEN payment_id IS NULL THEN m * nc * nf ELSE 0 END")]
    if "all" in families:
        for side in ("lt", "ge"):
            adds += [_of_events(str(_CBKS), "m * nf", side), _of_events(str(_FRAUD), "m * nf", side, "fraud_")]
    if "class" in families:
        for i, (p, q) in enumerate(_CLASS_SIDES[c] for c in CLASSES):
            adds += [_of_deposit(str(_CLASS + 3 * i), f"m * {p}.n * q_{q}"), _of_events(str(_CLASS + 3 * i + 1), f"m * q_{q}", p),
                     _of_events(str(_CLASS + 3 * i + 2), f"m * q_{q}", p, "fraud_")]
    lists = [f"array({', '.join(adds)})"]
    if "day" in families:
        lists += [f"CASE WHEN at = 0 THEN {adds} END"
                  for adds in (_dated_adds(_DAY_CBKS, "cbks", "nf"), _dated_adds(_DAY_REFUNDS, "refs", "nc"))]
    found = [f"filter(COALESCE({a}, array()), x -> x.cnt > 0)" for a in lists]
    return rows.selectExpr(*GROUP4, f"explode(concat({', '.join(found)})) AS x").selectExpr(*GROUP4, "x.*")


def slot_sums(advised: DataFrame, families=("all", "class", "day")) -> DataFrame:
    """``GROUP4, slot, cnt, whole, rest, none``: what all rows add to each slot."""
    return (slot_rows(advised, families).groupBy(*GROUP4, "slot").agg(*[F.sum(c).alias(c) for c in ("cnt", "whole", "rest", "none")]))


def _slot_of(m: Measure) -> int:
    if m.name.startswith("excptn_"):
        bucket = (m.p if m.p.startswith("day") else m.q)[3:]
        at = {"prior": 0, "above_21": LAST_DAY + 2}.get(bucket)
        return (_DAY_CBKS if m.p.startswith("day") else _DAY_REFUNDS) + (int(bucket) + 1 if at is None else at)
    kind = 0 if m.name.endswith("_total") else 2 if m.name.endswith("_frd_cbks") else 1
    if "_all_" in m.name:
        return (_TOTAL, _CBKS, _FRAUD)[kind]
    return _CLASS + 3 * next(i for i, c in enumerate(CLASSES) if f"_{c}_" in m.name) + kind


def advice_metrics(advice: DataFrame, dep: DataFrame, ref: DataFrame, cbk: DataFrame, w: ReportWindow,
                   families=("all", "class", "day"), row_counts: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Fraud-advice measures per merchant, currency code and description, and
    method -- equal to ``advice_metrics_from_detail(advice_detail(...))``. Lazy: no job
    runs while it is built."""
    sums = slot_sums(advised_deposits(advice, dep, ref, cbk, w, hot_rows), families)
    by_slot = sums.select(*GROUP4, "slot", "cnt", "none", from_parts("whole", "rest").alias("amount")).groupBy(*GROUP4).agg(
        F.map_from_entries(F.collect_list(F.struct("slot", F.struct("cnt", "none", "amount")))).alias("v"))
    out = []
    for m in select_measures(families, row_counts):
        at = f"v[{_slot_of(m)}]"
        if m.kind == "count":
            less = f" - COALESCE(v[{_NO_ID}].cnt, 0)" if m.name == "cnt_all_total" else ""
            out.append(f"COALESCE({at}.cnt, 0) * CAST({m.weight} AS BIGINT){less} AS {m.name}")
        else:
            out.append(f"CASE WHEN COALESCE({at}.none, 0) < v[{_TOTAL}].cnt THEN COALESCE({at}.amount, CAST(0 AS {REPORT_AMOUNT})) END AS {m.name}")
    return by_slot.selectExpr(*GROUP4, *out)
