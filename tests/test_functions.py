"""Column functions against DuckDB's own functions, on edge cases and random text."""

from __future__ import annotations

import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

from tidyledger import functions as fn

DATES = """
2024-05-01|2024-5-1|5-1-2024|05-01-2024|12-05-24|1-1-1|99-1-1|31-02-2024|29-02-2023|29-02-2024
2024-02-30|2024-13-01| 2024-05-01 |2024 -05-01|2024- 05-01|2024-05-01x|2024-05-01 10:00|20240501
12345-01-01|01-01-12345|005-01-2024|2024-005-01|2024-05-001|+2024-05-01|-2024-05-01|2024.05.01
01.05.2024|1.5-2024|2024--05-01|2024/05/01|-|--|.|1-2-3|32-1-1|1-32-1|1-13-1|13-13-13|31-12-9999
9999-12-31|2024-05|2024|0099-05-01|5-1-99|123-1-1|1-1-123|00-00-0000|1-0-2024|2024-0-1|n/a
2024-05-01-|2024-05-01-02|a-b-c|01-Jan-2024|1e3-01-01|2024-0x1-01|100-1-1|10-10-10|31-04-2024
""".replace("\n", "|").strip("|").split("|")
DATES += ["", "\t2024-05-01\n", "\v1-2-2024\f\r", "\xa02024-05-01", "2024-05-01\x85", "2024-05-01 "]
DATES += ["\x1c2024-05-01", "２０２４-05-01", "2024-05-01\n\n", "2024-05-01\x00", " " + "1-1-2024"]

NUMBERS = """
1|1.0|0.5|-0.5|23.4|23.5|1e1| 1|1 |+1|+ 1|--1|-1|1.|.5|.|e|1e|1e400|2147483647|2147483648|2147483647.4
2147483647.5|-2147483648|-2147483648.5|1e-3|5e-1|4.9e-1|true|inf|nan|1d|1f|1D|1.5F|1L|01|00|1_000|1_0.5
1__0|_1|1_|1._5|1.5_5|.5_5|1_.5|._5|1.5_|-.5|+.5|-1_0|1e1_0|5.e1|.e1|.5e1|1_0e1|1e+|1e-|Infinity|-inf
+inf|INF|NaN|-nan|+nan|infinity | inf|infin|-infinity|+infinity|1e99|1e+0|1.e|1.0e|1_e1|1e_1|0.49999999999999999
0.5000000001|1,000|12 3|1e0.5|15e-1|25e-1|149e-2|1.4e0|1.2.3|-0|-0.0|-0.4|1e01|1e0001|5.5e-1|0.05e1|0.049e1
45e-2|0.5e0|2147483647e0|21474836474e-1|21474836475e-1|-21474836485e-1|-21474836484e-1|1.5e-0|999e-3
0x1A|0X1a|0b11|0B1|0x1_A|0x_1|0x| 0x1A|0x1A |+0x1A|-0x1A|0b2|0b|0b1_1|0x1.0|0x1e1|0x1p3|0xFFFFFFFF|0x7FFFFFFF
0x0|0b0|0x000000000001|0x123456789012345678901|0o17|00x1|4.99|5.0|abc|n/a|-10|100|1e-400|0e400|$5|5%|1.5E+1
99999999999999999999|1e10|-1.5|-2.5|2.5|1.5|0.1e|e5|E|+|-|+-1|1-|5 5|1e 5|1 e5
""".replace("\n", "|").strip("|").split("|")
NUMBERS += ["", "\t1", "1\n", "\v\f\r1", "\xa01", "1\xa0", "\x001", "1\x00", "1\x1f", "\x1f1", "1\x7f", "١", "１"]
NUMBERS += ["1\x85", "1 ", "5.5\n\n", "nan "]

SEGMENTS = """
standrad|Premuim| platnum |St-and-rad|stand-rad|PLATINUM|Premium |gold|platnum1|1platnum|pla_tnum|-standrad-
standrad |st andrad|STANDRAD|premu1im|standard1|pr3muim|prem-uim.|İstandrad|platnuM|stand\trad|standrad\n
\tgold|ΑΣ|ΣΑ|İ|Straße|ÀÉ|ß|premuimpremuim|premuım|standrad😀|😀standrad|s😀tandrad|Ⅷ|ǅ|K|Å
""".replace("\n", "|").strip("|").split("|")
SEGMENTS += ["", " ", "\xa0Gold　", " platnum ", "​gold", "standrad\xa0\xa0", "standrad "]


def random_texts(alphabet: str, count: int, longest: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randint(0, longest))) for _ in range(count)]


def same(left, right) -> bool:
    if isinstance(left, float) and isinstance(right, float):
        both_nan = math.isnan(left) and math.isnan(right)
        return both_nan or (left == right and math.copysign(1, left) == math.copysign(1, right))
    return left == right


def check(spark, duck, values, kind, column, sql):
    """``column`` on Spark and ``sql`` on DuckDB give the same for each value."""
    frame = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    got = {r.i: r.y for r in frame.select("i", column.alias("y")).collect()}
    arrow = pa.string() if kind == "string" else pa.float64()
    duck.register("t", pa.table({"i": range(len(values)), "x": pa.array(values, arrow)}))
    want = dict(duck.execute(f"SELECT i, {sql} AS y FROM t").fetchall())
    wrong = [(values[i], got[i], want[i]) for i in want if not same(got[i], want[i])]
    assert not wrong, wrong[:20]


TRY_DATE = """CAST(coalesce(try_strptime(replace(x, '.', '-'), '%Y-%m-%d'),
    try_strptime(replace(x, '.', '-'), '%d-%m-%Y')) AS DATE)"""


def test_parse_date(spark, duck):
    values = DATES + random_texts("0123-. ", 4000, 10, 1) + random_texts("012-", 4000, 10, 2)
    rng = random.Random(3)
    for _ in range(4000):
        parts = [str(rng.randint(0, 40)), str(rng.randint(0, 14)), str(rng.randint(1, 10100))]
        rng.shuffle(parts)
        values.append(rng.choice("-.").join(p.zfill(rng.randint(1, 4)) for p in parts))
    # Year 0 is the same day on both sides but has no Python value.
    text = fn.canonical_date(fn.parse_date(F.col("x")))
    check(spark, duck, values + [None], "string", text, f"strftime({TRY_DATE}, '%d-%m-%Y')")


def test_month_key(spark, duck):
    values = [v for v in DATES if v] + [f"{d:02}-{m:02}-{y:04}" for d, m, y in [(1, 1, 0), (9, 12, 7)]]
    month = fn.month_key(fn.canonical_date(fn.parse_date(F.col("x"))))
    check(spark, duck, values, "string", month, f"strftime({TRY_DATE}, '%Y-%m')")


def test_dates_do_not_depend_on_the_time_zone(spark):
    days = ["2018-11-04", "0012-05-24", "1582-10-10", "1883-11-18", "9999-12-31"]
    frame = spark.createDataFrame([(d,) for d in days], "x string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        # Midnight of 2018-11-04 does not exist there.
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        rows = frame.select(fn.canonical_date(fn.parse_timestamp(F.col("x")))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r[0] for r in rows] == ["-".join(reversed(d.split("-"))) for d in days]


def test_parse_timestamp_type(spark):
    frame = spark.createDataFrame([(" 2024.05.01 ",)], "x string")
    out = frame.select(fn.parse_timestamp(F.col("x")).alias("t"))
    assert out.dtypes == [("t", "timestamp_ntz")]
    assert str(out.first().t) == "2024-05-01 00:00:00"


NOISE = random_texts("0159.eE+-_ ", 6000, 8, 4) + random_texts("01.5", 3000, 25, 5) + random_texts("0xb1aF_ ", 3000, 7, 6)


def test_to_double(spark, duck):
    check(spark, duck, NUMBERS + NOISE + [None], "string", fn.to_double(F.col("x")), "try_cast(x AS DOUBLE)")


def test_to_integer(spark, duck):
    # "1e5." (a dot after the exponent) is read by DuckDB as an integer only.
    odd = [v for v in NUMBERS + NOISE if not (v.strip().endswith(".") and "e" in v.lower())]
    check(spark, duck, odd + [None], "string", fn.to_integer(F.col("x")), "try_cast(x AS INTEGER)")


def test_numeric_sources(spark, duck):
    doubles = [0.5, 1.5, 2.5, -0.5, 23.4, 2147483647.4, 2147483647.5, -2147483648.5, 1e10, float("inf")]
    check(spark, duck, doubles, "double", fn.to_integer(F.col("x"), DoubleType()), "try_cast(x AS INTEGER)")
    check(spark, duck, doubles, "double", fn.to_double(F.col("x"), DoubleType()), "try_cast(x AS DOUBLE)")
    frame = spark.sql("SELECT CAST(2.5 AS DECIMAL(5,1)) AS x")
    assert frame.select(fn.to_integer(F.col("x"), DecimalType(5, 1))).first()[0] == 3


def test_clean_text(spark, duck):
    noise = random_texts(" \xa0 \tΣσİiIaA-é", 4000, 6, 7)
    check(spark, duck, SEGMENTS + noise + [None], "string", fn.clean_text(F.col("x")), "lower(trim(x))")


def test_strip_first_non_letter(spark, duck):
    noise = random_texts("ab-1 é😀\n", 3000, 6, 8)
    column = fn.strip_first_non_letter(F.col("x"))
    check(spark, duck, SEGMENTS + noise + [None], "string", column, "regexp_replace(x, '[^a-z]', '')")


def test_map_typos(spark, duck):
    rng = random.Random(9)
    noise = []
    for _ in range(3000):
        word = list(rng.choice([*fn.TYPOS, *fn.TIERS]))
        for _ in range(rng.randint(0, 2)):
            word.insert(rng.randint(0, len(word)), rng.choice("-1 éx"))
        noise.append("".join(word))
    column = fn.map_typos(F.col("x"))
    sql = """coalesce(CASE regexp_replace(x, '[^a-z]', '') WHEN 'standrad' THEN 'standard'
        WHEN 'premuim' THEN 'premium' WHEN 'platnum' THEN 'platinum' END, x)"""
    check(spark, duck, SEGMENTS + noise + [None], "string", column, sql)


def test_map_typos_does_not_skip_words_that_strip_to_a_typo(spark):
    frame = spark.createDataFrame([("a-b",), ("ab",)], "x string")
    out = frame.select(fn.map_typos(F.col("x"), {"ab": "done"}, ("a-b", "ab")))
    assert [r[0] for r in out.collect()] == ["done", "done"]


def test_binary_flag(spark):
    frame = spark.createDataFrame([(v,) for v in (0, 1, 2, -1, None)], "x int")
    out = frame.select(fn.binary_flag(F.col("x"))).collect()
    assert [r[0] for r in out] == [0, 1, None, None, None]


@pytest.mark.parametrize("digits", [2, 6])
def test_report_value(spark, duck, digits):
    rng = random.Random(digits)
    values = [0.0, -0.0, 1.005, 2.675, -1.005, 0.0001, 0.00001, 0.000005, 1e-7, 1e14, 1e15, 1e16, 1.5e17]
    values += [9007199254740993.0, 4503599627370497.5, 1e300, float("inf"), float("-inf"), float("nan"), -0.001, 0.5, 100.0]
    values += [rng.uniform(-1, 1) for _ in range(20_000)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-8, 16) for _ in range(20_000)]
    values += [rng.randint(0, 10**7) / 10**6 for _ in range(20_000)]
    values += [(2 * rng.randint(0, 10**5) + 1) / 2 / 10**digits for _ in range(20_000)]
    sql = f"CAST(round(x, {digits}) AS VARCHAR)"
    check(spark, duck, values, "double", fn.report_value(F.col("x"), digits), sql)


def test_ratio_of_nothing_is_null(spark):
    out = spark.sql("SELECT CAST(NULL AS BIGINT) AS a, 0L AS b, 1 AS c, 2 AS d").select(
        fn.ratio(F.col("a"), F.col("b")), fn.ratio(F.col("b"), F.col("b")), fn.ratio(F.col("c"), F.col("d"))
    )
    assert tuple(out.first()) == (None, None, 0.5)
