"""The oracle: what each registered query must return, as DuckDB SQL.

Written with DuckDB's own functions (try_strptime, try_cast, regexp_replace,
median, round), so that it checks the Spark expressions and does not repeat
them. The raw table is built by UNION ALL here and by exploding keys on Spark.
"""

from __future__ import annotations

RAW = """
WITH b AS (
  SELECT o_orderkey AS k, o_custkey AS ck, CAST(CAST(o_orderdate AS DATE) AS STRING) AS ds,
         CAST(floor(o_totalprice) AS BIGINT) AS amt
  FROM orders
), s AS (
  SELECT k AS row_id,
    CASE k % 11
      WHEN 0 THEN substr(ds,9,2) || '-' || substr(ds,6,2) || '-' || substr(ds,1,4)
      WHEN 1 THEN substr(ds,9,2) || '.' || substr(ds,6,2) || '.' || substr(ds,1,4)
      WHEN 2 THEN replace(ds,'-','.')
      WHEN 3 THEN CASE WHEN k % 4 = 0 THEN NULL WHEN k % 4 = 1 THEN replace(ds,'-','/')
                       WHEN k % 4 = 2 THEN substr(ds,1,4) || '-13-01' ELSE '31-02-' || substr(ds,1,4) END
      WHEN 4 THEN '  ' || ds || ' '
      WHEN 5 THEN CAST(CAST(substr(ds,9,2) AS INT) AS STRING) || '-' || CAST(CAST(substr(ds,6,2) AS INT) AS STRING) || '-' || substr(ds,1,4)
      ELSE ds END AS date,
    CASE k % 13
      WHEN 0 THEN 'standrad' WHEN 1 THEN ' Premuim' WHEN 2 THEN 'platnum1' WHEN 3 THEN 'St-and-rad'
      WHEN 4 THEN NULL WHEN 5 THEN 'Premium ' WHEN 6 THEN 'PLATINUM' WHEN 7 THEN 'platinum' WHEN 8 THEN 'stand-rad'
      WHEN 9 THEN 'gold' ELSE 'Standard' END AS customer_segment,
    CASE k % 17
      WHEN 0 THEN '4.99' WHEN 1 THEN '5.0' WHEN 2 THEN NULL WHEN 3 THEN 'abc' WHEN 4 THEN '-10' WHEN 5 THEN ' ' || CAST(amt AS STRING) || '.50 '
      WHEN 6 THEN '' WHEN 7 THEN '100' ELSE CAST(amt AS STRING) || '.25' END AS order_amount_old,
    CASE WHEN k % 17 = 7 THEN CASE WHEN k % 13 IN (2,6,7) THEN '75' WHEN k % 13 IN (1,5) THEN '70' ELSE '60' END
      WHEN k % 19 = 0 THEN '0' WHEN k % 19 = 1 THEN NULL WHEN k % 19 = 2 THEN 'n/a' WHEN k % 19 = 3 THEN '-3'
      ELSE CAST(CAST(floor(CAST(amt * (50 + k % 40) AS DOUBLE) / CAST(100 AS DOUBLE)) AS BIGINT) AS STRING) END AS cost,
    CASE k % 23
      WHEN 0 THEN '2' WHEN 1 THEN 'yes' WHEN 2 THEN NULL WHEN 3 THEN '1.0' WHEN 4 THEN '' WHEN 5 THEN '1' WHEN 6 THEN '0.4' WHEN 7 THEN '1' WHEN 8 THEN ' 1' ELSE '0' END AS is_return,
    CASE WHEN ck % 31 = 0 THEN NULL WHEN (k + ck) % 5 = 0 THEN 'paypal' WHEN (k + ck) % 5 = 1 THEN 'bank_transfer' WHEN (k + ck) % 5 = 2 THEN 'cash' ELSE 'card' END AS payment_method,
    CASE k % 29
      WHEN 0 THEN '24' WHEN 1 THEN '-1' WHEN 2 THEN NULL WHEN 3 THEN 'noon' WHEN 4 THEN '23.4' WHEN 5 THEN '23.5' ELSE CAST(k % 24 AS STRING) END AS hour_of_day
  FROM b
), raw AS (
  SELECT * FROM s
  UNION ALL SELECT * FROM s WHERE row_id % 97 = 0
  UNION ALL SELECT row_id + 1000000000 AS row_id, date, customer_segment, order_amount_old, cost, is_return, payment_method, hour_of_day FROM s WHERE row_id % 101 = 0
)
"""

PARSED = """
, parsed AS (
  SELECT row_id,
         coalesce(try_strptime(d, '%Y-%m-%d'), try_strptime(d, '%d-%m-%Y')) AS parsed_dt,
         lower(trim(customer_segment)) AS customer_segment_raw,
         try_cast(amount_text AS DOUBLE) AS order_amount_old,
         try_cast(cost_text AS DOUBLE) AS cost,
         try_cast(flag_text AS INTEGER) AS is_return,
         payment_method,
         try_cast(hour_text AS INTEGER) AS hour_of_day
  FROM (SELECT row_id, replace(date, '.', '-') AS d, customer_segment, order_amount_old AS amount_text,
               cost AS cost_text, is_return AS flag_text, payment_method, hour_of_day AS hour_text
        FROM raw) AS texts
)
"""

NORMALISED = """
, spelling(wrong, correct) AS (
  VALUES ('standrad', 'standard'), ('premuim', 'premium'), ('platnum', 'platinum')
), normalised AS (
  SELECT row_id, parsed_dt, strftime(CAST(parsed_dt AS DATE), '%d-%m-%Y') AS date,
         coalesce(correct, customer_segment_raw) AS customer_segment,
         order_amount_old, cost,
         if(is_return BETWEEN 0 AND 1, is_return, NULL) AS is_return,
         payment_method, hour_of_day
  FROM parsed LEFT JOIN spelling ON wrong = regexp_replace(customer_segment_raw, '[^a-z]', '')
)
"""

FILTERED = """
, filtered AS (
  SELECT * FROM normalised
  WHERE parsed_dt IS NOT NULL AND is_return IS NOT NULL
    AND order_amount_old >= 5 AND cost > 0 AND hour_of_day >= 0 AND hour_of_day < 24
)
"""

# Copies are found by grouping, with NULLs equal.
GOLD = """
, copies AS (
  SELECT row_id, date, customer_segment, order_amount_old, cost, is_return, payment_method,
         hour_of_day, count(*) AS copies
  FROM filtered GROUP BY ALL
), gold AS (
  SELECT * EXCLUDE (copies) FROM copies
), dated AS (
  SELECT *, strftime(strptime(date, '%d-%m-%Y'), '%Y-%m') AS month_key FROM gold
)
"""

TO_PARSED = RAW + PARSED
TO_NORMALISED = TO_PARSED + NORMALISED
TO_FILTERED = TO_NORMALISED + FILTERED
TO_GOLD = TO_FILTERED + GOLD

MONTHLY = """
, monthly AS (
  SELECT month_key, sum(order_amount_old) AS gmv FROM dated GROUP BY ALL
), growth AS (
  SELECT month_key, gmv, lag(gmv) OVER (ORDER BY month_key) AS prev_gmv FROM monthly
)
"""

MIX = """
, mix AS (
  SELECT month_key, payment_method, count(*) AS n,
         CAST(sum(count(*)) OVER (PARTITION BY month_key) AS BIGINT) AS total
  FROM dated GROUP BY month_key, payment_method
), shares AS (
  SELECT month_key, payment_method, n / total AS share FROM mix
), shifts AS (
  SELECT payment_method, month_key,
         abs(share - lag(share) OVER (PARTITION BY payment_method ORDER BY month_key)) AS diff
  FROM shares
)
"""

MARGINS = """
, floors(tier, floor_margin, at_floor) AS (
  VALUES ('standard', CAST(0.40 AS DOUBLE), false), ('premium', CAST(0.30 AS DOUBLE), false),
         ('platinum', CAST(0.25 AS DOUBLE), true)
), margins AS (
  SELECT customer_segment, (order_amount_old - cost) / order_amount_old AS gross_margin,
         floor_margin, at_floor
  FROM gold JOIN floors ON tier = customer_segment
)
"""


def _first(table: str, n: int) -> str:
    return f"SELECT * FROM {table} ORDER BY ALL LIMIT {n}"


def _profile(table: str, column: str, count: str) -> str:
    return f"SELECT {column}, count(*) AS {count} FROM {table} GROUP BY {column}"


def _kpi(name: str, value: str, source: str, key: str = "NULL") -> str:
    return (
        f"SELECT '{name}' AS kpi_name, CAST({value} AS VARCHAR) AS kpi_value, "
        f"CAST({key} AS VARCHAR) AS kpi_key FROM {source}"
    )


NULLS = """
  count(*) AS total_rows,
  count(*) - count(date) AS null_date,
  count(*) - count(customer_segment) AS null_customer_segment,
  count(*) - count(order_amount_old) AS null_order_amount_old,
  count(*) - count(cost) AS null_cost,
  count(*) - count(is_return) AS null_is_return,
  count(*) - count(payment_method) AS null_payment_method,
  count(*) - count(hour_of_day) AS null_hour_of_day
"""

IMPACT = """
  count(*) - count(parsed_dt) AS bad_date,
  count(*) FILTER (WHERE NOT coalesce(order_amount_old >= 5, false)) AS bad_amount,
  count(*) FILTER (WHERE NOT coalesce(cost > 0, false)) AS bad_cost,
  count(*) - count(is_return) AS bad_return_flag,
  count(*) FILTER (WHERE hour_of_day IS NULL OR hour_of_day < 0 OR hour_of_day > 23) AS bad_hour
"""

KPI = {
    "kpi_1": _kpi("kpi_1", "round(sum(order_amount_old) / count(order_amount_old), 2)", "gold"),
    "kpi_2": _kpi("kpi_2", "round(sum(order_amount_old - cost) / sum(order_amount_old), 6)", "gold"),
    "kpi_3": _kpi("kpi_3", "round(avg(is_return), 6)", "gold"),
    "kpi_4": _kpi("kpi_4", "round(median(order_amount_old), 2)", "gold"),
    "kpi_5": _kpi("kpi_5", "round(avg(is_return), 6)", "gold GROUP BY payment_method", "payment_method"),
    "kpi_6": _kpi(
        "kpi_6",
        "round(coalesce(sum(order_amount_old) FILTER (WHERE customer_segment = 'premium' OR "
        "customer_segment = 'platinum'), 0) / sum(order_amount_old), 6)",
        "gold",
    ),
    "kpi_7": _kpi(
        "kpi_7",
        "round(count(*) FILTER (WHERE gross_margin < floor_margin OR "
        "(at_floor AND gross_margin = floor_margin)) / nullif(count(*), 0), 6)",
        "margins",
    ),
    "kpi_8": _kpi(
        "kpi_8",
        "max(month_key)",
        "monthly WHERE gmv = (SELECT max(gmv) FROM monthly)",
    ),
    "kpi_9": _kpi(
        "kpi_9",
        "round((gmv - prev_gmv) / prev_gmv, 6)",
        "growth WHERE month_key = (SELECT max(month_key) FROM growth)",
    ),
    "kpi_10": _kpi("kpi_10", "round(max(diff), 6)", "shifts"),
}

TO_KPI = TO_GOLD + MARGINS + MONTHLY + MIX

ORACLE = {
    # Profiles and checks
    "profile_sample": RAW + _first("raw", 20),
    "null_audit": RAW + f"SELECT {NULLS} FROM raw",
    "segment_profile_raw": RAW + _profile("raw", "customer_segment", "nbr_segments"),
    "payment_profile_raw": RAW + _profile("raw", "payment_method", "nbr_methods"),
    "parse_health": TO_PARSED
    + "SELECT count(*) AS total_rows, count(*) - count(parsed_dt) AS date_parse_failures FROM parsed",
    "parsed_sample": TO_PARSED + _first("parsed", 10),
    "segment_profile_normalised": TO_NORMALISED
    + _profile("normalised", "customer_segment", "nbr_segments"),
    "rule_impact": TO_NORMALISED + f"SELECT {IMPACT} FROM normalised",
    "kept_after_filter": TO_FILTERED + "SELECT count(*) AS kept_after_filter FROM filtered",
    "distinct_rows": TO_GOLD + "SELECT count(*) AS distinct_rows FROM gold",
    "gold_sample": TO_GOLD + _first("gold", 10),
    "stage_row_counts": TO_GOLD
    + """
SELECT * FROM (
  SELECT 1 AS stage_no, 'raw' AS stage, count(*) AS row_count FROM raw
  UNION ALL SELECT 2, 'parsed', count(*) FROM parsed
  UNION ALL SELECT 3, 'normalised', count(*) FROM normalised
  UNION ALL SELECT 4, 'filtered', count(*) FROM filtered
  UNION ALL SELECT 5, 'final', count(*) FROM gold
) AS counts""",
    "segment_mapping_profile": TO_NORMALISED
    + """
SELECT raw.customer_segment AS raw_segment,
       coalesce(correct, lower(trim(raw.customer_segment))) AS customer_segment,
       count(*) AS nbr_rows
FROM raw LEFT JOIN spelling ON wrong = regexp_replace(lower(trim(raw.customer_segment)), '[^a-z]', '')
GROUP BY ALL""",
    "duplicate_rows": TO_GOLD + "SELECT * FROM copies WHERE copies > 1",
    "quality_summary": TO_FILTERED
    + f"""
SELECT * FROM (SELECT {NULLS} FROM raw) AS nulls
POSITIONAL JOIN (SELECT count(*) - count(parsed_dt) AS date_parse_failures FROM parsed) AS dates
POSITIONAL JOIN (SELECT {IMPACT} FROM normalised) AS impact
POSITIONAL JOIN (SELECT count(*) AS kept_after_filter FROM filtered) AS kept""",
    # Cleaning layers
    "parse_dates": TO_PARSED
    + """
SELECT raw.row_id, raw.date, d.parsed_dt
FROM raw, LATERAL (
  SELECT coalesce(try_strptime(replace(raw.date, '.', '-'), '%Y-%m-%d'),
                  try_strptime(replace(raw.date, '.', '-'), '%d-%m-%Y')) AS parsed_dt
) AS d""",
    "silver_parsed": TO_PARSED + "SELECT * FROM parsed",
    "segment_typo_map": TO_NORMALISED
    + """
SELECT p.row_id, p.customer_segment_raw, coalesce(correct, p.customer_segment_raw) AS customer_segment
FROM parsed AS p LEFT JOIN spelling
  ON wrong = regexp_replace(p.customer_segment_raw, '[^a-z]', '')""",
    "silver_normalised": TO_NORMALISED + "SELECT * FROM normalised",
    "silver_filtered": TO_FILTERED + "SELECT * FROM filtered",
    "clean_table": TO_GOLD + "SELECT * FROM gold",
    "dedup_business_key": TO_FILTERED
    + """
SELECT min(row_id) AS row_id, date, customer_segment, order_amount_old, cost, is_return,
       payment_method, hour_of_day
FROM filtered GROUP BY ALL""",
    # Steps of the KPIs
    "month_gmv": TO_KPI + "SELECT * FROM monthly",
    "month_gmv_lag": TO_KPI + "SELECT * FROM growth",
    "payment_month_counts": TO_KPI + "SELECT month_key, payment_method, n FROM mix",
    "payment_month_totals": TO_KPI + "SELECT DISTINCT month_key, total FROM mix",
    "payment_month_shares": TO_KPI + "SELECT * FROM shares",
    "payment_share_shift": TO_KPI + "SELECT * FROM shifts",
    "order_margin_floor": TO_KPI + "SELECT customer_segment, gross_margin, floor_margin FROM margins",
    "order_summary": TO_KPI
    + """
SELECT month_key, payment_method, count(*) AS orders, count(order_amount_old) AS priced_orders,
       sum(order_amount_old) AS gmv, sum(order_amount_old - cost) AS profit,
       CAST(sum(is_return) AS BIGINT) AS returns,
       coalesce(sum(order_amount_old) FILTER (WHERE customer_segment IN ('platinum', 'premium')), 0)
         AS high_value_gmv,
       count(tier) AS tiered_orders,
       count(*) FILTER (WHERE (order_amount_old - cost) / order_amount_old < floor_margin OR
         (at_floor AND (order_amount_old - cost) / order_amount_old = floor_margin)) AS below_floor_orders
FROM dated LEFT JOIN floors ON tier = customer_segment
GROUP BY month_key, payment_method""",
    # KPIs
    **{name: TO_KPI + sql for name, sql in KPI.items()},
    "kpi_results": TO_KPI + "\nUNION ALL ".join(KPI.values()),
}

# The same tables read through temporary views.
ORACLE["clean_table_from_views"] = ORACLE["clean_table"]
ORACLE["kpi_results_from_views"] = ORACLE["kpi_results"]

# The raw table through files and the catalog. Of a line with fields too few, or with a
# key that is no number, what can be read stays; a surplus field makes it malformed only.
# An empty field of a file is NULL.
READ_BACK = RAW + """
, lines AS (
  SELECT *, row_id % 89 = 0 AS surplus, row_id % 89 <> 0 AND row_id % 83 = 0 AS cut,
    row_id % 89 <> 0 AND row_id % 83 <> 0 AND row_id % 79 = 0 AS no_key
  FROM raw
), read_back AS (
  SELECT CASE WHEN NOT no_key THEN row_id END AS row_id, date, customer_segment,
    nullif(order_amount_old, '') AS order_amount_old,
    CASE WHEN NOT cut THEN cost END AS cost, CASE WHEN NOT cut THEN nullif(is_return, '') END AS is_return,
    CASE WHEN NOT cut THEN payment_method END AS payment_method,
    CASE WHEN NOT cut THEN hour_of_day END AS hour_of_day, surplus OR cut OR no_key AS malformed
  FROM lines
)
"""
ORACLE["csv_import"] = READ_BACK + "SELECT * FROM read_back"
ORACLE["csv_run"] = (
    READ_BACK
    + PARSED.replace("FROM raw)", "FROM read_back)")
    + NORMALISED
    + FILTERED
    + GOLD
    + """
SELECT (SELECT count(*) FROM read_back WHERE malformed) AS malformed_lines,
  (SELECT count(*) FROM parsed) AS total_rows,
  (SELECT count(*) FROM parsed WHERE parsed_dt IS NULL) AS date_parse_failures,
  (SELECT count(*) FROM filtered) AS kept_after_filter, (SELECT count(*) FROM gold) AS clean_rows"""
)
ORACLE["parquet_import"] = RAW + "SELECT * FROM raw"
ORACLE["catalog_table"] = RAW + "SELECT * FROM raw"
