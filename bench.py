"""Benchmark of the headline queries.

Inputs are derived from the driver's tables once and staged as Parquet in the
shared checkpoint folder (the production jobs read stored tables, not
derivations); that staging is timed separately. Each query then runs
``BENCH_RUNS`` times (default 3) after ``BENCH_WARMUP`` warm-ups (default 2, for
JIT and code-generation caches), executing its whole plan into a no-op sink;
the median is reported. Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from settlekit.functions.periods import report_window  # noqa: E402
from settlekit.operators import advice as A  # noqa: E402
from settlekit.operators import recon as R  # noqa: E402
from settlekit.operators.payments import deposits, refunds  # noqa: E402
from settlekit.operators.summaries import deposit_summaries, refund_match_summary  # noqa: E402
from settlekit.plans.reconciliation import reconciliation_requests  # noqa: E402
from settlekit.plans.report import monthly_exception_report  # noqa: E402
from settlekit.session import local_session  # noqa: E402
from settlekit.sources.fixtures import settlement_inputs  # noqa: E402
from settlekit.sources.scans import chargebacks_in_window, payments_in_range  # noqa: E402
from settlekit.sources.sinks import scratch_path  # noqa: E402

RUN_DATE, AS_OF, REPLAY_DAYS = "1998-10-05", "1998-10-31", 35


def stage(spark, sf_dir):
    inp = settlement_inputs(spark, sf_dir)
    base = scratch_path(spark, "bench-inputs")
    frames = {"payments": inp.payments, "chargebacks": inp.chargebacks, "advice": inp.advice,
              "audit": inp.audit, "history": inp.history, "control": inp.control}
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{base}/{name}")
    staged = {name: spark.read.parquet(f"{base}/{name}") for name in frames}
    return inp, staged


def run_noop(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    warmups = int(os.environ.get("BENCH_WARMUP", "2"))
    spark = local_session(cpus, shuffle_partitions=max(cpus, 8))
    t0 = time.time()
    inp, t = stage(spark, sf_dir)
    staging = time.time() - t0
    tables = inp.countable_tables()

    def report(period, persist=False):
        def run():
            payments = t["payments"].persist() if persist else t["payments"]
            return monthly_exception_report(payments, t["chargebacks"], t["advice"], RUN_DATE, period)
        return run

    def branches(period=12):
        w = report_window(RUN_DATE, period)
        rng = payments_in_range(t["payments"], w)
        return w, deposits(rng), refunds(rng), chargebacks_in_window(t["chargebacks"], w)

    def advice_metrics():
        w, dep, ref, cbk = branches()
        return A.advice_metrics(t["advice"], dep, ref, cbk, w)

    def volume_refunds():
        _, dep, ref, cbk = branches()
        return deposit_summaries(dep, ref, cbk).volume_refunds

    def chargebacks():
        _, dep, ref, cbk = branches()
        return deposit_summaries(dep, ref, cbk).chargebacks

    def refund_match():
        return refund_match_summary(branches()[2])

    def advice_reference_form():
        w, dep, ref, cbk = branches()
        return A.advice_metrics_from_detail(A.advice_detail(t["advice"], dep, ref, cbk, w))

    def advice_maxfields():
        spark.conf.set("spark.sql.codegen.maxFields", "400")
        return advice_metrics()

    def reconcile():
        reqs = reconciliation_requests(t["control"], t["history"], RUN_DATE, REPLAY_DAYS)
        return R.reconcile(spark, reqs, t["audit"], AS_OF, tables, inserted_at="bench", app_id="bench")

    def reconcile_per_request():
        """Baseline shape of the reference: one count job and one audit job per request."""
        reqs = reconciliation_requests(t["control"], t["history"], RUN_DATE, REPLAY_DAYS)
        rows = []
        for i, req in enumerate(reqs):
            counts, failed = R.own_counts(spark, [req], tables)
            own = 0 if failed or counts is None else (counts.collect() or [(0, 0)])[0][1]
            pair = spark.createDataFrame([(req.table_name, req.count_date)], "table_name string, count_date date")
            vap = R.latest_audit(t["audit"], pair, AS_OF).collect()
            rows.append((i, own, vap[0]["vap_count"] if vap else 0))
        return spark.createDataFrame(rows, "request_id int, bda_count bigint, vap_count bigint")

    suite = {
        "report_p12": report(12),
        "report_p3": report(3),
        "report_p12_persisted": report(12, persist=True),
        "advice_metrics_126": advice_metrics,
        "volume_refunds": volume_refunds,
        "chargeback_summary": chargebacks,
        "refund_match_summary": refund_match,
        "reconciliation": reconcile,
        "advice_metrics_126_reference_form": advice_reference_form,
        "advice_metrics_126_maxfields400": advice_maxfields,
        "reconciliation_per_request_jobs": reconcile_per_request,
    }
    only = os.environ.get("BENCH_ONLY")
    if only:
        suite = {k: v for k, v in suite.items() if re.fullmatch(only, k)}
    results = {}
    for name, build in suite.items():
        times = []
        for i in range(warmups + runs):
            spark.catalog.clearCache()
            s = time.time()
            run_noop(build())
            if i >= warmups:
                times.append(time.time() - s)
        spark.conf.unset("spark.sql.codegen.maxFields")
        results[name] = round(statistics.median(times), 3)
    headline = [k for k in ("report_p12", "report_p3", "advice_metrics_126", "reconciliation") if k in results]
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(results[k] for k in headline), 3),
        "unit": "sec",
        "queries": results,
        "staging_sec": round(staging, 3),
        "sf": float(re.search(r"sf([0-9.]+)", sf_dir).group(1)) if re.search(r"sf([0-9.]+)", sf_dir) else None,
        "cpus": cpus,
        "runs": runs,
        "warmups": warmups,
        "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
