"""Safe casts: a value that cannot be read becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    StringType,
)

from tidyledger.functions.dates import BLANKS

# Number texts that are accepted (fixed values), with blanks on either side.
# Type suffixes such as 5d or 5f are not numbers. Digits may be grouped by single
# underscores; the first two patterns are the usual case without any.
_PLAIN = r"(?:\d++(?:\.\d*+)?+|\.\d++)(?:[eE][+-]?\d++)?+"
PLAIN_INTEGER_TEXT = rf"^{BLANKS}[+-]?\d++{BLANKS}\z"
PLAIN_DOUBLE_TEXT = rf"^{BLANKS}[+-]?{_PLAIN}{BLANKS}\z"

_DIGITS = r"\d++(?:_\d++)*+"
_NUMBER = rf"(?:{_DIGITS}(?:\.(?:{_DIGITS})?+)?+|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?+"
# A minus may follow a plus in floating-point texts only.
DOUBLE_TEXT = rf"(?i)^{BLANKS}\+?+-?+(?:{_NUMBER}|inf(?:inity)?+|nan){BLANKS}\z"
INTEGER_TEXT = rf"^{BLANKS}[+-]?{_NUMBER}{BLANKS}\z"
# No blanks behind these.
PREFIXED_TEXT = rf"^{BLANKS}0(?:[xX][0-9a-fA-F]++(?:_[0-9a-fA-F]++)*+|[bB][01]++(?:_[01]++)*+)\z"


def to_double(value: Column, source: DataType = StringType()) -> Column:
    """DOUBLE from text (or from any numeric ``source`` type), else NULL."""
    if not isinstance(source, StringType):
        return value.try_cast("double")
    # Casts know no underscores, no plus before a minus and no sign of NaN.
    rare = F.regexp_replace(value, r"_|\+(?=-)|[+-]++(?=[nN])", "")
    return F.when(value.rlike(PLAIN_DOUBLE_TEXT), value.try_cast("double")).when(
        value.rlike(DOUBLE_TEXT), rare.try_cast("double")
    )


def _prefixed_integer(text: Column) -> Column:
    """INTEGER from hexadecimal 0x or binary 0b text."""
    digits = F.regexp_replace(text, r"_|^\s*0[xXbB]0*(?=.)", "")
    hexadecimal = F.lower(text).contains("x")
    base = F.when(hexadecimal, 16).otherwise(2)
    # Longer ones are out of range, and conv would raise on very long ones.
    fits = F.length(digits) <= F.when(hexadecimal, 8).otherwise(31)
    return F.when(fits, F.call_function("conv", digits, base, F.lit(10)).try_cast("int"))


def to_integer(value: Column, source: DataType = StringType()) -> Column:
    """INTEGER from text, rounded half away from zero, else NULL.

    Text is rounded on its decimal digits (20 places), not on its nearest
    double. A binary floating ``source`` is rounded half to even, as the value
    is then already a double; a decimal one half away from zero.
    """
    if isinstance(source, (FloatType, DoubleType)):
        return F.bround(value.cast("double")).try_cast("int")
    if isinstance(source, DecimalType):
        return F.round(value).try_cast("int")
    if not isinstance(source, StringType):
        return value.try_cast("int")
    digits = F.replace(value, F.lit("_"), F.lit(""))
    rounded = F.coalesce(
        F.round(digits.try_cast("decimal(38,20)")).try_cast("int"),
        # Too wide for the decimal: out of range, or a zero such as 0e400.
        F.when(digits.try_cast("double") == 0, 0),
    )
    return (
        F.when(value.rlike(PLAIN_INTEGER_TEXT), value.try_cast("int"))
        .when(value.rlike(INTEGER_TEXT), rounded)
        .when(value.rlike(PREFIXED_TEXT), _prefixed_integer(value))
    )


def to_key(value: Column, source: DataType = StringType()) -> Column:
    """BIGINT from a whole number or its text, else NULL."""
    if isinstance(source, (IntegralType, StringType)):
        return value.try_cast("bigint")
    raise ValueError(f"the column row_id has the type {source.simpleString()}, not a whole number")


def binary_flag(value: Column) -> Column:
    """0 and 1 as they are, anything else NULL."""
    return F.when(value.isin(0, 1), value)
