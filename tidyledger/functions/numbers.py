"""Rounding and number text for reports.

Reports hold values as text, so the digits themselves are the result. Both
functions run on finished aggregates, a handful of rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_scaled(value: Column, digits: int | Column) -> Column:
    """Round a double half away from zero after scaling it in binary.

    ``F.round`` rounds the decimal text of the double instead, so 1.005 gives
    1.01 there and 1.0 here (1.005 is stored slightly below the half).
    """
    scale = F.pow(F.lit(10.0), digits) if isinstance(digits, Column) else F.lit(10.0**digits)
    size = F.abs(value * scale)
    floor = F.floor(size).cast("double")
    up = F.when(size - floor >= 0.5, 1.0).otherwise(0.0)
    # Doubles from 2**53 on are whole, and floor would leave the long range.
    whole = F.when(size >= 2.0**53, size).otherwise(floor + up)
    # NaN sorts above every number, so it passes through with infinity.
    return F.when(size >= float("inf"), value).otherwise(F.signum(value) * whole / scale)


def double_text(value: Column) -> Column:
    """Shortest decimal text of a double that has at most six decimals.

    Plain notation from 1e-4 up to 1e16, ``1e-05`` and ``1e+16`` outside. From
    1e16 on the last digit is Java's, which is not always the shortest.
    """
    size = F.abs(value)
    plain = F.call_function("format_number", value, F.lit("0.0#####"))
    scientific = F.regexp_replace(value.cast("string"), r"\.0E", "E")
    scientific = F.regexp_replace(scientific, r"E-(\d)$", "e-0$1")
    scientific = F.regexp_replace(scientific, "E-", "e-")
    scientific = F.regexp_replace(scientific, r"E(\d)", "e+$1")
    return (
        F.when(F.isnan(value), "nan")
        .when(value == float("inf"), "inf")
        .when(value == float("-inf"), "-inf")
        .when((size == 0) | ((size >= 1e-4) & (size < 1e16)), plain)
        .otherwise(scientific)
    )


def ratio(numerator: Column, denominator: Column) -> Column:
    """True division of two numbers as doubles; NULL over zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ieee_ratio(numerator: Column, denominator: Column) -> Column:
    """True division of two numbers as doubles; infinite or NaN over zero."""
    top, bottom = numerator.cast("double"), denominator.cast("double")
    # Zero times infinity is NaN, and NULL stays NULL.
    over_zero = F.signum(top) * (bottom + float("inf"))
    return F.coalesce(F.try_divide(top, bottom), over_zero)


def report_value(value: Column, digits: int) -> Column:
    """A rounded double as report text.

    The text names its value many times. Where the value is itself a long
    expression, compute and round it behind fences (see the KPI table).
    """
    return double_text(round_scaled(value, digits))
