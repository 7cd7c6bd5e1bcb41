import datetime as dt
from decimal import Context, Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settlekit.functions import (fraud_flag, from_parts, major_parts, minor_parts, minor_to_major, null_as_empty, parts_sum, report_window,
                                 report_window_columns)


def test_minor_to_major_is_exact(spark):
    # C1
    df = spark.createDataFrame([(1234, 2), (1234, 0), (1234, 3), (1234, 7), (None, 2), (5, None), (0, 40), (3, -2)], "a bigint, p int")
    want = [Decimal("12.34"), Decimal(1234), Decimal("1.234"), Decimal("0.0001234"), None, None, Decimal(0), Decimal(300)]
    for kind in (None, T.LongType()):
        out = df.select(minor_to_major("a", "p", kind))
        assert [r[0] for r in out.collect()] == want
        assert out.schema[0].dataType.simpleString() == "decimal(38,18)"


def test_what_has_no_exact_value_is_an_error_that_names_it(spark):
    for amount, precision in ((7, 19), (100_000, -18), (1, -20)):
        df = spark.createDataFrame([(1, 2), (amount, precision)], "a bigint, p int")
        for kind in (None, T.LongType()):
            with pytest.raises(Exception, match=f"amount {amount} with precision {precision} has no exact value"):
                df.select(minor_to_major("a", "p", kind)).collect()
    df = spark.createDataFrame([(Decimal("0.25"), 17)], "a decimal(10,2), p int")
    with pytest.raises(Exception, match="amount 0.25 with precision 17"):
        df.select(parts_sum(minor_parts("a", "p", df.schema["a"].dataType))).collect()


def test_sums_run_over_neither_part(spark):
    """Large whole parts that cancel out, and rests that add up to whole units."""
    rows = [(9 * 10 ** 18, -17), (-9 * 10 ** 18, -17), (10 ** 18 - 1, 18), (10 ** 18 - 1, 18), (2, 18), (-5, 1), (None, 1)]
    df = spark.createDataFrame(rows, "a bigint, p int")
    for kind in (None, T.LongType()):
        assert df.select(parts_sum(minor_parts("a", "p", kind))).first()[0] == Decimal("1.5")
    with pytest.raises(Exception, match="the total 900000000000000000000 is beyond"):
        spark.createDataFrame([(9, -20 + 1)] * 10, "a bigint, p int").select(parts_sum(minor_parts("a", "p", T.LongType()))).collect()
    empty = spark.createDataFrame([], "a bigint, p int")
    assert empty.select(parts_sum(minor_parts("a", "p", T.LongType()))).first()[0] is None


def test_fractional_amounts_are_exact(spark):
    rows = [("12.345", 2), ("-0.000000000000000001", 0), ("99999999999999999999.5", 1), ("0.0", 18), ("7", 18), (None, 2)]
    wide, want = Context(prec=60), Decimal(0)
    for a, precision in rows:
        want = wide.add(want, Decimal(a or 0).scaleb(-precision, wide))
    df = spark.createDataFrame([(None if a is None else Decimal(a), p) for a, p in rows], "a decimal(38,18), p int")
    assert df.select(parts_sum(minor_parts("a", "p", df.schema["a"].dataType))).first()[0] == want
    major = spark.createDataFrame([(Decimal("-1.25"),), (Decimal("3.50"),), (None,)], "a decimal(18,2)")
    assert major.select(parts_sum(major_parts("a", major.schema["a"].dataType))).first()[0] == Decimal("2.25")


def test_fraud_classifier(spark):
    # C12
    df = spark.createDataFrame([("VI", "0057"), ("MC", "0057"), ("VI", "4837"), ("MC", "4837"), (None, "0057"),
                                ("MC", None)], "m string, r string")
    assert [r[0] for r in df.select(fraud_flag("m", "r")).collect()] == [1, 0, 0, 1, 0, 0]


def test_report_windows():
    # C18
    w3 = report_window("2019-10-05", 3)
    assert (w3.from_created, w3.from_post, w3.to, w3.month) == (
        dt.date(2019, 6, 15), dt.date(2019, 7, 1), dt.date(2019, 9, 30), "2019-09")
    for p in (12, 7):
        w = report_window("2019-10-05", p)
        assert (w.from_created, w.from_post, w.to) == (dt.date(2018, 8, 15), dt.date(2018, 9, 1), dt.date(2019, 9, 30))


def test_report_window_columns_match_python(spark):
    days = [dt.date(2019, 10, 5), dt.date(2020, 3, 31), dt.date(2021, 1, 1), dt.date(2019, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for period in (3, 12):
        c = report_window_columns("d", period)
        rows = df.select("d", c["from_post"], c["from_created"], c["to"], c["month"]).collect()
        for r in rows:
            w = report_window(r[0], period)
            assert (r[1], r[2], r[3], r[4]) == (w.from_post, w.from_created, w.to, w.month)


def test_null_as_empty_is_not_null_safe_equality(spark):
    df = spark.createDataFrame([(None, ""), (None, None), ("a", "a"), ("a", None)], "l string, r string")
    rows = df.select((null_as_empty("l") == null_as_empty("r")).alias("eq"),
                     F.col("l").eqNullSafe(F.col("r")).alias("ns")).collect()
    assert [r.eq for r in rows] == [True, True, True, False]
    assert [r.ns for r in rows] == [False, True, True, False]


def test_shared_dir_is_set_in_local_mode(spark):
    from settlekit.session import shared_dir
    path = shared_dir(spark)
    assert path and spark.sparkContext.getCheckpointDir()
    assert shared_dir(spark) == path           # stable: read, not re-created


def test_minor_to_major_matches_decimal_arithmetic(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    rows = []

    @settings(max_examples=200, deadline=None, derandomize=True)
    @given(st.integers(min_value=-(2 ** 63), max_value=2 ** 63 - 1), st.integers(min_value=-1, max_value=18))
    def collect(amount, precision):
        rows.append((amount, precision))

    collect()
    df = spark.createDataFrame(rows, "a bigint, p int")
    want = [Decimal(a).scaleb(-p, Context(prec=60)) for a, p in rows]
    for kind in (None, T.LongType()):
        assert [r[0] for r in df.select(minor_to_major("a", "p", kind)).collect()] == want
        parts = minor_parts("a", "p", kind)
        assert [r[0] for r in df.select(from_parts(*parts)).collect()] == want
