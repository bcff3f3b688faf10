"""Business KPIs over the clean table.

Every KPI is a table (kpi_name, kpi_value, kpi_key), all text. The single KPIs
read the clean table directly; :func:`kpi_results` gets all but the median from
one roll-up by month and payment method, because all of their inputs add up.

Tables with one row per month have fewer than 120,000 rows whatever the data
(four-digit years), so a window without partitions, or a broadcast, is safe on
them and on nothing else here.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidyledger.functions import TIERS, double_text, ieee_ratio, month_key, round_scaled
from tidyledger.operators.fence import compute_once
from tidyledger.operators.median import exact_median

# The margin floor of each tier, the tiers whose floor itself
# counts as below target, and the tiers that count as high value.
MARGIN_FLOORS = {"standard": 0.40, "premium": 0.30, "platinum": 0.25}
FLOOR_IS_BELOW = ("platinum",)
HIGH_VALUE_TIERS = ("premium", "platinum")

# Decimals of an amount and of a rate.
AMOUNT_DIGITS = 2
RATE_DIGITS = 6

# KPIs that are one ratio of two additive measures: numerator, denominator, decimals.
RATIOS = {
    "kpi_1": ("gmv", "priced_orders", AMOUNT_DIGITS),
    "kpi_2": ("profit", "gmv", RATE_DIGITS),
    "kpi_3": ("returns", "orders", RATE_DIGITS),
    "kpi_6": ("high_value_gmv", "gmv", RATE_DIGITS),
    "kpi_7": ("below_floor_orders", "tiered_orders", RATE_DIGITS),
}


# Measures that count orders.
COUNTS = ("orders", "priced_orders", "tiered_orders")


# Margins


def _segment() -> Column:
    return F.col("customer_segment")


def _gross_margin() -> Column:
    return ieee_ratio(F.col("order_amount_old") - F.col("cost"), F.col("order_amount_old"))


def _floor_margin() -> Column:
    floors = [F.when(_segment() == tier, floor) for tier, floor in MARGIN_FLOORS.items()]
    return F.coalesce(*floors)


def _is_below_floor() -> Column:
    margin, floor = _gross_margin(), _floor_margin()
    at_floor = _segment().isin(*FLOOR_IS_BELOW) & (margin == floor)
    return (margin < floor) | at_floor


def order_margin_floor(gold: DataFrame) -> DataFrame:
    """Margin of each order beside the floor of its tier; known tiers only."""
    return gold.filter(_segment().isin(*MARGIN_FLOORS)).select(
        "customer_segment",
        _gross_margin().alias("gross_margin"),
        _floor_margin().alias("floor_margin"),
    )


# Additive measures


def _measures(names: Iterable[str]) -> list[Column]:
    amount = F.col("order_amount_old")
    known = _segment().isin(*TIERS)
    available = {
        "orders": F.count(F.lit(1)),
        "priced_orders": F.count(amount),
        "gmv": F.sum(amount),
        "profit": F.sum(amount - F.col("cost")),
        "returns": F.sum("is_return"),
        "high_value_gmv": F.sum(F.when(_segment().isin(*HIGH_VALUE_TIERS), amount).otherwise(0.0)),
        "tiered_orders": F.sum(F.when(known, 1).otherwise(0)),
        "below_floor_orders": F.sum(F.when(known & _is_below_floor(), 1).otherwise(0)),
    }
    return [available[name].alias(name) for name in names]


ALL_MEASURES = (
    "orders",
    "priced_orders",
    "gmv",
    "profit",
    "returns",
    "high_value_gmv",
    "tiered_orders",
    "below_floor_orders",
)


def order_summary(gold: DataFrame) -> DataFrame:
    """All additive measures by month and payment method, in one pass."""
    by_month = gold.withColumn("month_key", month_key(F.col("date")))
    return by_month.groupBy("month_key", "payment_method").agg(*_measures(ALL_MEASURES))


def _sums(names: Iterable[str]) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


# KPI rows


def _no_key() -> Column:
    return F.lit(None).cast("string")


def _number(df: DataFrame, name: str, value: Column, digits: int, key: Column | None = None) -> DataFrame:
    """A KPI row before it is formatted: its number and the decimals to show."""
    return df.select(
        F.lit(name).alias("kpi_name"),
        value.cast("double").alias("value"),
        F.lit(digits).alias("digits"),
        (_no_key() if key is None else key.cast("string")).alias("kpi_key"),
    )


def _formatted(numbers: DataFrame) -> DataFrame:
    """The numbers rounded and as report text.

    Rounding and text name their value many times over. The fences make each a
    column of its own; without them the code for a few KPIs passes the size that
    the JVM accepts.
    """
    numbers = compute_once(numbers, ("value", "digits"))
    rounded = numbers.withColumn("value", round_scaled(F.col("value"), F.col("digits")))
    text = double_text(F.col("value")).alias("kpi_value")
    return compute_once(rounded, ("value",)).select("kpi_name", text, "kpi_key")


def _ratio_value(name: str) -> Column:
    numerator, denominator, _ = RATIOS[name]
    below = F.col(denominator)
    if denominator in COUNTS:
        below = F.nullif(below, F.lit(0))  # over no orders there is no value
    return ieee_ratio(F.col(numerator), below)


def _ratio_kpi(gold: DataFrame, name: str) -> DataFrame:
    totals = gold.agg(*_measures(RATIOS[name][:2]))
    return _formatted(_number(totals, name, _ratio_value(name), RATIOS[name][2]))


def _ratio_numbers(totals: DataFrame) -> DataFrame:
    """One row of measures becomes one row per ratio KPI."""
    rows = [
        F.struct(
            F.lit(name).alias("kpi_name"),
            _ratio_value(name).alias("value"),
            F.lit(digits).alias("digits"),
            _no_key().alias("kpi_key"),
        )
        for name, (_, _, digits) in RATIOS.items()
    ]
    return totals.select(F.inline(F.array(*rows)))


def kpi_1(gold: DataFrame) -> DataFrame:
    """Average order value."""
    return _ratio_kpi(gold, "kpi_1")


def kpi_2(gold: DataFrame) -> DataFrame:
    """Gross margin: all profit over all revenue."""
    return _ratio_kpi(gold, "kpi_2")


def kpi_3(gold: DataFrame) -> DataFrame:
    """Share of orders that were returned."""
    return _ratio_kpi(gold, "kpi_3")


def _median(gold: DataFrame) -> DataFrame:
    middle = exact_median(gold, "order_amount_old")
    return _number(middle, "kpi_4", F.col("median"), AMOUNT_DIGITS)


def kpi_4(gold: DataFrame) -> DataFrame:
    """Median order amount, exact and interpolated."""
    return _formatted(_median(gold))


def _return_rates(by_method: DataFrame) -> DataFrame:
    rate = ieee_ratio(F.col("returns"), F.col("orders"))
    return _number(by_method, "kpi_5", rate, RATE_DIGITS, F.col("payment_method"))


def kpi_5(gold: DataFrame) -> DataFrame:
    """Return rate of each payment method; orders without one form a row."""
    by_method = gold.groupBy("payment_method").agg(*_measures(("returns", "orders")))
    return _formatted(_return_rates(by_method))


def kpi_6(gold: DataFrame) -> DataFrame:
    """Share of revenue from the high-value tiers."""
    return _ratio_kpi(gold, "kpi_6")


def kpi_7(gold: DataFrame) -> DataFrame:
    """Share of orders in a known tier whose margin is below its floor."""
    return _ratio_kpi(gold, "kpi_7")


# Months


def month_gmv(gold: DataFrame) -> DataFrame:
    """Revenue per calendar month."""
    by_month = gold.select(month_key(F.col("date")).alias("month_key"), "order_amount_old")
    return by_month.groupBy("month_key").agg(F.sum("order_amount_old").alias("gmv"))


def month_gmv_lag(monthly: DataFrame) -> DataFrame:
    """Revenue per month beside that of the previous month in the data."""
    order = W.orderBy(F.col("month_key").asc_nulls_last())
    return monthly.withColumn("prev_gmv", F.lag("gmv").over(order))


def _top_month(monthly: DataFrame) -> DataFrame:
    top = monthly.orderBy(F.col("gmv").desc(), F.col("month_key").desc()).limit(1)
    return top.select(
        F.lit("kpi_8").alias("kpi_name"), F.col("month_key").alias("kpi_value"), _no_key().alias("kpi_key")
    )


def _latest_growth(monthly: DataFrame) -> DataFrame:
    latest = month_gmv_lag(monthly).orderBy(F.col("month_key").desc()).limit(1)
    growth = ieee_ratio(F.col("gmv") - F.col("prev_gmv"), F.col("prev_gmv"))
    return _number(latest, "kpi_9", growth, RATE_DIGITS)


def kpi_8(gold: DataFrame) -> DataFrame:
    """The month with the highest revenue, the later one of equals."""
    return _top_month(month_gmv(gold))


def kpi_9(gold: DataFrame) -> DataFrame:
    """Revenue growth of the last month over the previous month in the data."""
    return _formatted(_latest_growth(month_gmv(gold)))


# Payment mix


def payment_month_counts(gold: DataFrame) -> DataFrame:
    """Orders per month and payment method."""
    by_month = gold.select(month_key(F.col("date")).alias("month_key"), "payment_method")
    return by_month.groupBy("month_key", "payment_method").agg(F.count(F.lit(1)).alias("n"))


def payment_month_totals(counts: DataFrame) -> DataFrame:
    """Orders per month."""
    return counts.groupBy("month_key").agg(F.sum("n").alias("total"))


def payment_month_shares(counts: DataFrame) -> DataFrame:
    """Share of each payment method in the orders of its month.

    The month totals are broadcast (one row per month), so the counts stay
    where they are; a window over each month would gather all of its methods.
    """
    counts = compute_once(counts, ("month_key",))
    totals = F.broadcast(payment_month_totals(counts))
    return counts.join(totals, "month_key").select(
        "month_key", "payment_method", ieee_ratio(F.col("n"), F.col("total")).alias("share")
    )


def payment_share_shift(shares: DataFrame) -> DataFrame:
    """Absolute change of each share since the method's previous month in the data."""
    months = W.partitionBy("payment_method").orderBy(F.col("month_key").asc_nulls_last())
    change = F.abs(F.col("share") - F.lag("share").over(months))
    return shares.select("payment_method", "month_key", change.alias("diff"))


def _largest_shift(counts: DataFrame) -> DataFrame:
    shifts = payment_share_shift(payment_month_shares(counts))
    largest = shifts.agg(F.max("diff").alias("diff"))
    return _number(largest, "kpi_10", F.col("diff"), RATE_DIGITS)


def kpi_10(gold: DataFrame) -> DataFrame:
    """The largest change of a payment method's share between two of its months."""
    return _formatted(_largest_shift(payment_month_counts(gold)))


# All together

KPIS = {
    "kpi_1": kpi_1,
    "kpi_2": kpi_2,
    "kpi_3": kpi_3,
    "kpi_4": kpi_4,
    "kpi_5": kpi_5,
    "kpi_6": kpi_6,
    "kpi_7": kpi_7,
    "kpi_8": kpi_8,
    "kpi_9": kpi_9,
    "kpi_10": kpi_10,
}


def kpi_results(gold: DataFrame) -> DataFrame:
    """All KPIs in one table, in two passes over the clean table.

    One pass makes the roll-up that every KPI but the median comes from, the
    other counts equal amounts for the median. The fence keeps the roll-up the
    same for all who read it: pruned for each of them it would be computed for
    each of them.
    """
    summary = compute_once(order_summary(gold), ("month_key", "payment_method", *ALL_MEASURES))
    methods = summary.groupBy("payment_method").agg(*_sums(("returns", "orders")))
    monthly = summary.groupBy("month_key").agg(*_sums(("gmv",)))
    counts = summary.select("month_key", "payment_method", F.col("orders").alias("n"))
    numbers = [
        _ratio_numbers(summary.agg(*_sums(ALL_MEASURES))),
        _median(gold),
        _return_rates(methods),
        _latest_growth(monthly),
        _largest_shift(counts),
    ]
    return _formatted(reduce(DataFrame.unionByName, numbers)).unionByName(_top_month(monthly))
