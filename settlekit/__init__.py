"""settlekit: card-settlement exception reporting and daily count
reconciliation as Spark DataFrame operators."""

from settlekit.plans.reconciliation import run_reconciliation
from settlekit.plans.report import monthly_exception_report, publish_monthly_report

__all__ = ["monthly_exception_report", "publish_monthly_report", "run_reconciliation"]
