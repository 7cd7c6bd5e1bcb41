"""Summarize the physical plans of the headline queries (staged inputs at
``sf_dir``): exchanges, scans with pushed filters and read columns, join
strategies, windows, lineage cuts. Writes Markdown to stdout.

    python tools/plan_facts.py /root/testdata/sf0.01 > PLANS.md
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from settlekit.functions.periods import report_window  # noqa: E402
from settlekit.operators import advice as A  # noqa: E402
from settlekit.operators import recon as R  # noqa: E402
from settlekit.operators.payments import deposits, refunds  # noqa: E402
from settlekit.plans.reconciliation import reconciliation_requests  # noqa: E402
from settlekit.plans.report import monthly_exception_report  # noqa: E402
from settlekit.session import local_session  # noqa: E402
from settlekit.sources.fixtures import settlement_inputs  # noqa: E402
from settlekit.sources.scans import chargebacks_in_window, payments_in_range  # noqa: E402
from settlekit.sources.sinks import scratch_path  # noqa: E402


def facts(name: str, df, spark) -> str:
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    tree = text.split("\n\n")[0]
    count = lambda pat: len(re.findall(pat, tree))
    out = [f"## {name}", "",
           f"- exchanges: {count(r'Exchange')} (of which broadcast: {count(r'BroadcastExchange')})",
           f"- joins: sort-merge {count(r'SortMergeJoin')}, broadcast hash {count(r'BroadcastHashJoin')}, "
           f"shuffled hash {count(r'ShuffledHashJoin')}, nested-loop {count(r'BroadcastNestedLoopJoin')}, "
           f"cartesian {count(r'CartesianProduct')}",
           f"- aggregates: {count(r'HashAggregate')} hash, windows: {count(r'Window ')} "
           f"(group-limited: {count(r'WindowGroupLimit')})",
           f"- scans of checkpointed intermediates: {count(r'Scan ExistingRDD')}",
           f"- Python evaluation nodes: {count(r'Python|ArrowEval|BatchEval')}",
           "", "| scan | pushed filters | columns read |", "| --- | --- | --- |"]
    for sec in text.split("\n\n"):
        if "Scan parquet" not in sec or "Location:" not in sec:
            continue
        loc = re.search(r"Location: \w+ \[[^\]]*/([^/\]]+)\]", sec)
        pushed = re.search(r"PushedFilters: \[(.*)\]", sec)
        schema = re.search(r"ReadSchema: struct<(.*)>", sec)
        cols = schema.group(1).count(":") if schema else 0
        out.append(f"| {loc.group(1) if loc else '?'} | {pushed.group(1)[:160] if pushed else ''} | {cols} |")
    return "\n".join(out) + "\n"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    inp = settlement_inputs(spark, sf_dir)
    base = scratch_path(spark, "plan-inputs")
    for n, df in {"payments": inp.payments, "chargebacks": inp.chargebacks, "advice": inp.advice,
                  "audit": inp.audit, "history": inp.history, "control": inp.control}.items():
        df.write.mode("overwrite").parquet(f"{base}/{n}")
    t = {n: spark.read.parquet(f"{base}/{n}") for n in ("payments", "chargebacks", "advice", "audit", "history",
                                                        "control")}
    w = report_window("1998-10-05", 12)
    rng = payments_in_range(t["payments"], w)
    dep, ref = deposits(rng), refunds(rng)
    cbk = chargebacks_in_window(t["chargebacks"], w)
    print("# Physical plans of the headline queries\n")
    print(f"Generated by `tools/plan_facts.py` over inputs staged from `{sf_dir}` (Spark {spark.version}, AQE on; "
          "initial plans, before run-time re-optimization). Checkpointed intermediates appear as `Scan ExistingRDD`.\n")
    print(facts("monthly exception report (period 12)",
                monthly_exception_report(t["payments"], t["chargebacks"], t["advice"], "1998-10-05", 12), spark))
    print(facts("fraud-advice metrics, factorized (126 measures)", A.advice_metrics(t["advice"], dep, ref, cbk, w),
                spark))
    print(facts("fraud-advice metrics, reference formulation (for comparison)",
                A.advice_metrics_from_detail(A.advice_detail(t["advice"], dep, ref, cbk, w)), spark))
    reqs = reconciliation_requests(t["control"], t["history"], "1998-10-05", 35)
    print(facts("count reconciliation, Part I + Part II, one plan",
                R.reconcile(spark, reqs, t["audit"], "1998-10-31", inp.countable_tables(), inserted_at="x",
                            app_id="x"), spark))


if __name__ == "__main__":
    main()
