"""Column-level helpers: money scaling, null-as-empty keys, fraud codes, windows."""

from settlekit.functions.fraud import FRAUD_REASON_CODES, fraud_flag, is_fraud
from settlekit.functions.keys import null_as_empty, null_as_empty_join
from settlekit.functions.money import REPORT_AMOUNT, Parts, from_parts, major_parts, minor_parts, minor_to_major, parts_sum
from settlekit.functions.periods import ReportWindow, as_date, report_window, report_window_columns

__all__ = [
    "FRAUD_REASON_CODES", "fraud_flag", "is_fraud", "null_as_empty", "null_as_empty_join",
    "REPORT_AMOUNT", "Parts", "from_parts", "major_parts", "minor_parts", "minor_to_major", "parts_sum", "ReportWindow", "as_date", "report_window",
    "report_window_columns",
]
