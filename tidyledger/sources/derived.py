"""Dirty order records derived from a clean ``orders`` table.

Every value is a function of the order itself, so the result grows with the
table and is the same on every run. It has all the defects that the cleaning
layers handle: five date formats and three that must fail, misspelt segments,
text in numbers, flags and hours out of range, exact copies and copies under a
new key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyledger.schema import RAW_COLUMNS

# Which orders come twice, once more under a new key, and how far
# the new keys are away.
COPY_EVERY = 97
REKEY_EVERY = 101
REKEY_OFFSET = 1_000_000_000
# Which lines of a file get a field too many, end after four fields, and have a key
# that is no number: remainders of the key.
SURPLUS_EVERY, CUT_EVERY, NO_KEY_EVERY = 89, 83, 79

_DATE = """
CASE k % 11
  WHEN 0 THEN concat(substr(ds, 9, 2), '-', substr(ds, 6, 2), '-', substr(ds, 1, 4))
  WHEN 1 THEN concat(substr(ds, 9, 2), '.', substr(ds, 6, 2), '.', substr(ds, 1, 4))
  WHEN 2 THEN replace(ds, '-', '.')
  WHEN 3 THEN CASE k % 4 WHEN 0 THEN NULL
                         WHEN 1 THEN replace(ds, '-', '/')
                         WHEN 2 THEN concat(substr(ds, 1, 4), '-13-01')
                         ELSE concat('31-02-', substr(ds, 1, 4)) END
  WHEN 4 THEN concat('  ', ds, ' ')
  WHEN 5 THEN concat(day(d), '-', month(d), '-', substr(ds, 1, 4))
  ELSE ds END
"""

_SEGMENT = """
CASE k % 13
  WHEN 0 THEN 'standrad' WHEN 1 THEN ' Premuim' WHEN 2 THEN 'platnum1' WHEN 3 THEN 'St-and-rad'
  WHEN 4 THEN NULL WHEN 5 THEN 'Premium ' WHEN 6 THEN 'PLATINUM' WHEN 7 THEN 'platinum'
  WHEN 8 THEN 'stand-rad' WHEN 9 THEN 'gold' ELSE 'Standard' END
"""

_AMOUNT = """
CASE k % 17
  WHEN 0 THEN '4.99' WHEN 1 THEN '5.0' WHEN 2 THEN NULL WHEN 3 THEN 'abc' WHEN 4 THEN '-10'
  WHEN 5 THEN concat(' ', amount, '.50 ') WHEN 6 THEN '' WHEN 7 THEN '100'
  ELSE concat(amount, '.25') END
"""

# An amount of 100 gets a cost that puts the order exactly on its margin floor.
_COST = """
CASE WHEN k % 17 = 7 THEN CASE WHEN k % 13 IN (2, 6, 7) THEN '75'
                               WHEN k % 13 IN (1, 5) THEN '70' ELSE '60' END
     WHEN k % 19 = 0 THEN '0' WHEN k % 19 = 1 THEN NULL
     WHEN k % 19 = 2 THEN 'n/a' WHEN k % 19 = 3 THEN '-3'
     ELSE string((amount * (50 + k % 40)) div 100) END
"""

_IS_RETURN = """
CASE k % 23
  WHEN 0 THEN '2' WHEN 1 THEN 'yes' WHEN 2 THEN NULL WHEN 3 THEN '1.0' WHEN 4 THEN ''
  WHEN 5 THEN '1' WHEN 6 THEN '0.4' WHEN 7 THEN '1' WHEN 8 THEN ' 1' ELSE '0' END
"""

_METHOD = """
CASE WHEN o_custkey % 31 = 0 THEN NULL
     ELSE CASE (k + o_custkey) % 5 WHEN 0 THEN 'paypal' WHEN 1 THEN 'bank_transfer'
                                   WHEN 2 THEN 'cash' ELSE 'card' END END
"""

_HOUR = """
CASE k % 29
  WHEN 0 THEN '24' WHEN 1 THEN '-1' WHEN 2 THEN NULL WHEN 3 THEN 'noon'
  WHEN 4 THEN '23.4' WHEN 5 THEN '23.5' ELSE string(k % 24) END
"""


def dirty_orders(orders: DataFrame) -> DataFrame:
    """The raw table, in one pass: each order becomes an array of its copies.

    All columns come out of that array, so the layers above see plain columns
    as they would from a file, and the expressions here run once per order.
    ``array_compact`` also ends the compiled stage: together with the layers
    the code would be too large for the JVM to compile.
    """
    columns = {
        "date": _DATE,
        "customer_segment": _SEGMENT,
        "order_amount_old": _AMOUNT,
        "cost": _COST,
        "is_return": _IS_RETURN,
        "payment_method": _METHOD,
        "hour_of_day": _HOUR,
    }

    def copy(key: str) -> str:
        return f"named_struct('row_id', {key}, {', '.join(f"'{name}', {name}" for name in columns)})"

    copies = f"""
        inline(array_compact(array(
            {copy("k")},
            CASE WHEN k % {COPY_EVERY} = 0 THEN {copy("k")} END,
            CASE WHEN k % {REKEY_EVERY} = 0 THEN {copy(f"k + {REKEY_OFFSET}")} END
        )))
    """
    return (
        orders.selectExpr(
            "o_orderkey AS k",
            "o_custkey",
            "date(o_orderdate) AS d",
            "bigint(floor(o_totalprice)) AS amount",
        )
        .selectExpr("*", "string(d) AS ds")
        .selectExpr("k", *(f"{expression} AS {name}" for name, expression in columns.items()))
        .selectExpr(copies)
    )


def read_dirty_orders(spark: SparkSession, directory: str) -> DataFrame:
    """The raw table from ``<directory>/orders.parquet``."""
    return dirty_orders(spark.read.parquet(f"{directory}/orders.parquet"))


def damaged_lines(raw: DataFrame) -> DataFrame:
    """The raw orders as lines of CSV (column ``line``), a few of them malformed."""
    fields = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    line, key = F.to_csv(F.struct(*RAW_COLUMNS), fields), F.col("row_id")
    return raw.select(
        F.when(key % SURPLUS_EVERY == 0, F.concat(line, F.lit(",surplus")))
        .when(key % CUT_EVERY == 0, F.substring_index(line, ",", 4))
        .when(key % NO_KEY_EVERY == 0, F.concat(F.lit("x"), line))
        .otherwise(line)
        .alias("line")
    )
