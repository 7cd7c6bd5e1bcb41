"""Money in minor units to exact major units.

A stored amount of 1234 with a reporting precision of 2 is 12.34. Sums are taken
in two parts, the whole major units (``decimal(38,0)``) and the rest in units of
10^-18 (``decimal(18,0)`` a row), and joined once at the end: neither part runs
over while rows are added, results do not depend on the order of rows, and no
row passes through text where amounts are integers.

What has no exact value -- a precision outside -19..18, digits beyond 10^-18, a
result that ``decimal(38,18)`` cannot hold -- is an error that names the amount
and its precision, or the total. Nothing is rounded and no row drops out. A NULL
amount or precision gives NULL.

``kind`` is the amount column's type. For columns given by name it chooses between
integer arithmetic and the exact decimal path once, when the plan is built; None
means any type.
"""

from __future__ import annotations

from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNIT_DIGITS = 18
WHOLE, REST = "decimal(38,0)", "decimal(18,0)"
REPORT_AMOUNT = "decimal(38,18)"
LEAST_PRECISION = UNIT_DIGITS - 37      # a bigint times 10^19 still has at most 38 digits
_SHORT = 6                              # precisions whose factor fits a short decimal
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


class Parts(NamedTuple):
    """An amount as whole major units and units of 10^-18, both of its sign."""
    whole: Column
    rest: Column

    def map(self, f) -> "Parts":
        return Parts(f(self.whole), f(self.rest))


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _powers_text(exponents, kind: str) -> str:
    return f"array({', '.join(f'CAST({Decimal(10) ** k:f} AS {kind})' for k in exponents)})"


def _powers(exponents, kind: str) -> Column:
    """10 to the given exponents, as a literal array."""
    return F.expr(_powers_text(exponents, kind))


def _integer_parts(amount: str, precision: str) -> Parts:
    """Parts of an integer column by integer arithmetic; SQL text, so one parse a part."""
    a, p = f"CAST({amount} AS BIGINT)", f"CAST({precision} AS INT)"
    inside = f"{p} BETWEEN 0 AND {UNIT_DIGITS}"
    tens = _powers_text(range(UNIT_DIGITS + 1), "BIGINT")
    above = _powers_text(range(1, 1 - LEAST_PRECISION), WHOLE)
    unfit = (f"CAST(raise_error(concat('amount ', CAST({amount} AS STRING), ' with precision ', CAST({precision} AS STRING), "
             f"' has no exact value as {REPORT_AMOUNT}')) AS {WHOLE})")
    whole = (f"CASE WHEN {inside} THEN CAST({a} div get({tens}, {p}) AS {WHOLE}) "
             f"WHEN {amount} IS NULL OR {precision} IS NULL THEN CAST(NULL AS {WHOLE}) "
             f"WHEN {p} BETWEEN {LEAST_PRECISION} AND -1 THEN CAST(CAST({a} AS DECIMAL(19,0)) * get({above}, -{p} - 1) AS {WHOLE}) "
             f"WHEN {a} = 0 THEN CAST(0 AS {WHOLE}) ELSE {unfit} END")
    rest = (f"CASE WHEN {inside} THEN CAST(({a} % get({tens}, {p})) * get({tens}, {UNIT_DIGITS} - {p}) AS {REST}) "
            f"WHEN {amount} IS NULL OR {precision} IS NULL THEN CAST(NULL AS {REST}) ELSE CAST(0 AS {REST}) END")
    return Parts(F.expr(whole), F.expr(rest))


def _unfit(amount: Column, precision: Column, kind: str) -> Column:
    return F.raise_error(F.concat(
        F.lit("amount "), amount.cast("string"), F.lit(" with precision "), precision.cast("string"),
        F.lit(f" has no exact value as {REPORT_AMOUNT}"))).cast(kind)


def _split(value: Column) -> Parts:
    """Parts of a decimal of at most 18 fractional digits."""
    rest = value % F.lit(1).cast("decimal(1,0)")
    return Parts((value - rest).cast(WHOLE), (rest * F.lit(Decimal(10) ** UNIT_DIGITS)).cast(REST))


def _fraction_digits(amount: Column) -> Column:
    return F.length(F.regexp_extract(amount.cast("string"), r"\.(\d*?)0*$", 1))


def _shifted(amount: Column, precision: Column) -> Column:
    """The decimal text of ``amount * 10^-precision``."""
    return F.concat(amount.cast("string"), F.lit("E"), (-precision).cast("string"))


def minor_parts(amount: Column | str, precision: Column | str, kind: T.DataType | None = None) -> Parts:
    """``amount * 10^-precision`` in parts."""
    if isinstance(kind, _INTEGERS) and isinstance(amount, str) and isinstance(precision, str):
        return _integer_parts(amount, precision)
    amount, precision = _column(amount), _column(precision)
    missing = amount.isNull() | precision.isNull()
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        amount = amount.cast(REPORT_AMOUNT)
    text = _shifted(amount, precision)
    value, large = text.try_cast(REPORT_AMOUNT), text.try_cast(WHOLE)
    beyond = _fraction_digits(amount) + precision       # digits behind the point of the result, if positive
    exact = _split(value)
    none, zero = (missing, None), (amount == 0, 0)
    whole = F.when(none[0], F.lit(None).cast(WHOLE)).when(zero[0], F.lit(0).cast(WHOLE))
    whole = (whole.when(beyond > UNIT_DIGITS, _unfit(amount, precision, WHOLE)).when(value.isNotNull(), exact.whole)
             .when(large.isNotNull() & (beyond <= 0), large).otherwise(_unfit(amount, precision, WHOLE)))
    rest = F.when(missing, F.lit(None).cast(REST)).when(value.isNotNull(), exact.rest).otherwise(F.lit(0).cast(REST))
    return Parts(whole, rest)


def major_parts(amount: Column | str, kind: T.DataType | None = None) -> Parts:
    """An amount in major units, in parts."""
    amount = _column(amount)
    if isinstance(kind, _INTEGERS):
        return Parts(amount.cast(WHOLE), F.when(amount.isNotNull(), F.lit(0).cast(REST)))
    if isinstance(kind, T.DecimalType) and kind.scale <= UNIT_DIGITS:
        return _split(amount)
    return minor_parts(amount, F.lit(0), kind)


def from_parts(whole: Column | str, rest: Column | str) -> Column:
    """Sums of parts as ``decimal(38,18)``; an error that names the sum where it does not fit."""
    whole, rest = _column(whole), _column(rest)
    units = F.try_add(F.try_multiply(whole.cast(WHOLE), F.lit(Decimal(10) ** UNIT_DIGITS)), rest.cast(WHOLE)).cast(WHOLE)
    beyond = F.raise_error(F.concat(F.lit("the total "), whole.cast("string"), F.lit(f" is beyond {REPORT_AMOUNT}"))).cast(REPORT_AMOUNT)
    return (F.when(units.isNotNull(), F.concat(units.cast("string"), F.lit(f"E-{UNIT_DIGITS}")).cast(REPORT_AMOUNT))
            .when(whole.isNotNull(), beyond))


def parts_sum(parts: Parts) -> Column:
    """The exact total of an amount, as an aggregate."""
    return from_parts(F.sum(parts.whole), F.sum(parts.rest))


def minor_to_major(amount: Column | str, precision: Column | str, kind: T.DataType | None = None) -> Column:
    """``amount * 10^-precision`` as ``decimal(38,18)``."""
    amount, precision = _column(amount), _column(precision)
    plain = amount.cast(REPORT_AMOUNT) if isinstance(kind, (T.FloatType, T.DoubleType)) else amount
    value = _shifted(plain, precision).try_cast(REPORT_AMOUNT)
    fits = value.isNotNull() & (_fraction_digits(plain) + precision <= UNIT_DIGITS)
    any_type = (F.when(amount.isNull() | precision.isNull(), F.lit(None).cast(REPORT_AMOUNT))
                .when(amount == 0, F.lit(0).cast(REPORT_AMOUNT)).when(fits, value)
                .otherwise(_unfit(amount, precision, REPORT_AMOUNT)))
    if not isinstance(kind, _INTEGERS):
        return any_type
    factor = F.get(_powers(range(0, -_SHORT - 1, -1), "decimal(7,6)"), precision.cast("int"))
    return F.when(precision.between(0, _SHORT), (amount.cast("decimal(20,0)") * factor).cast(REPORT_AMOUNT)).otherwise(any_type)
