"""Physical-plan checks: no Python in the plan, no pair products, filters
and column pruning reach the scans, and the advice path has no join between
events and advice keyed by deposit alone."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "MapInArrow", "PythonMapInArrow")
PAIR_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")
SINKS = {"report_roundtrip", "results_append_roundtrip", "results_in_catalog", "replay_recorded_history"}


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in E.oracle_sql() if n not in SINKS and not re.match(r"op\d+_", n)])
def test_no_python_no_pairs(spark, name):
    plan = plan_text(E.queries()[name](spark, SF))
    for node in PYTHON_NODES + PAIR_NODES:
        assert node not in plan, f"{name}: {node}"


def test_report_scan_pushdown(spark, tmp_path):
    from settlekit.plans.report import monthly_exception_report
    from settlekit.sources.fixtures import settlement_inputs
    inp = settlement_inputs(spark, SF)
    base = str(tmp_path)
    inp.payments.write.parquet(f"{base}/payments")
    inp.chargebacks.write.parquet(f"{base}/chargebacks")
    inp.advice.write.parquet(f"{base}/advice")
    pay = spark.read.parquet(f"{base}/payments")
    rep = monthly_exception_report(pay, spark.read.parquet(f"{base}/chargebacks"),
                                   spark.read.parquet(f"{base}/advice"), "1998-10-05", 12)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = rep._jdf.queryExecution().explainString(mode)
    sections = [s for s in text.split("\n\n") if "Scan parquet" in s and "PushedFilters" in s]
    pay = [s for s in sections if "/payments]" in s]
    assert pay
    for s in pay:
        pushed = re.search(r"PushedFilters: \[(.*)\]", s).group(1)
        assert "created_date" in pushed and "batch_post_day" in pushed and "transaction_status" in pushed
        read = re.search(r"ReadSchema: struct<(.*)>", s).group(1)
        assert read.count(":") < 20          # never all 20 columns
    # advice blocks are checkpointed before the report runs: check their scan on its own
    from settlekit.functions.periods import report_window
    from settlekit.sources.scans import advice_in_window
    adv_plan = advice_in_window(spark.read.parquet(f"{base}/advice"), report_window("1998-10-05", 12))
    adv_text = adv_plan._jdf.queryExecution().explainString(mode)
    assert "GreaterThanOrEqual(create_date,1997-09-01)" in adv_text and "LessThanOrEqual(create_date,1998-09-30)" in adv_text
