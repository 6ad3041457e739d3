"""The registered queries as SQL for an independent engine.

Money is summed as decimals and turned into doubles at the very end, and
rounded ratios are worked out in whole cents, so that both engines must agree
to the last digit.
"""

from __future__ import annotations

SALES = """
priced AS (
  SELECT 'T' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS transaction_id,
         l_orderkey || '-' || l_linenumber AS line_id,
         printf('CUST%05d', o_custkey) AS customer_id,
         'V' || s_suppkey AS venue_id,
         s_name AS venue_name,
         CASE s_nationkey % 3 WHEN 0 THEN 'Hotel' WHEN 1 THEN 'Pub' ELSE 'Restaurant' END AS venue_type,
         n_name AS city,
         r_name AS region,
         l_shipdate + to_minutes((l_partkey * 37 + l_suppkey * 11 + l_linenumber * 101) % 1440) AS transaction_ts,
         p_name AS item_name,
         p_type AS category,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(p_retailprice AS DECIMAL(8,2)) AS unit_price,
         CAST(round(l_discount * 100) AS INTEGER) AS discount_pct,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'App' WHEN '4-NOT SPECIFIED' THEN 'Card'
              WHEN '5-LOW' THEN 'Cash' ELSE 'Contactless' END AS payment_method
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
grossed AS (
  SELECT *, CAST(unit_price * quantity AS DECIMAL(8,2)) AS gross_amount FROM priced
),
discounted AS (
  SELECT *, CAST(round(gross_amount * discount_pct * 0.01, 2) AS DECIMAL(8,2)) AS discount_amount FROM grossed
),
sales AS (
  SELECT *,
         CAST(gross_amount - discount_amount AS DECIMAL(8,2)) AS net_amount,
         CAST(transaction_ts AS DATE) AS transaction_date,
         strftime(transaction_ts, '%H:%M:%S') AS transaction_time,
         isodow(transaction_ts) >= 6 AS is_weekend,
         dayname(transaction_ts) AS day_of_week,
         monthname(transaction_ts) AS month,
         CAST(month(transaction_ts) AS INTEGER) AS month_num,
         CAST(CAST(transaction_ts AS DATE) + 1 AS TIMESTAMP) + INTERVAL 6 HOUR AS loaded_at
  FROM discounted
)"""


def _money(expression: str, name: str) -> str:
    return f"CAST({expression} AS DOUBLE) AS {name}"


def _count(expression: str, name: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {name}"


def _mean(column: str, name: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / count({column}) AS {name}"


def _cents(amount: str) -> str:
    return f"CAST(({amount}) * 100 AS HUGEINT)"


def _text(day: str) -> str:
    return f"strftime({day}, '%Y-%m-%d') AS {day}"


def _query(body: str, *ctes: str) -> str:
    return "WITH " + ",".join([SALES, *ctes]) + "\n" + body


STAGED = f"""
  transaction_id, venue_id, venue_name, venue_type, city, region, payment_method,
  {_text('transaction_date')}, transaction_time, transaction_ts, day_of_week, month, month_num, is_weekend,
  item_name, category, quantity, {_money('unit_price', 'unit_price')}, {_money('gross_amount', 'gross_amount')},
  discount_pct, {_money('discount_amount', 'discount_amount')}, {_money('net_amount', 'net_amount')}, loaded_at"""

DAILY = f"""
  {_count('count(*)', 'transaction_count')},
  {_count('sum(quantity)', 'items_sold')},
  {_money('sum(gross_amount)', 'gross_revenue')},
  {_money('sum(discount_amount)', 'total_discounts')},
  {_money('sum(net_amount)', 'net_revenue')},
  {_mean('net_amount', 'avg_transaction_value')}"""

DAILY_KEYS = "sales.transaction_date, venue_id, venue_name, venue_type, city, region"
DAILY_SHOWN = DAILY_KEYS.replace(
    "sales.transaction_date", "strftime(sales.transaction_date, '%Y-%m-%d') AS transaction_date"
)

VENUE_SUMMARY = f"""
SELECT venue_id, venue_name, venue_type, city,
  {_count('count(*)', 'total_transactions')},
  {_count('sum(quantity)', 'total_items_sold')},
  {_money('sum(net_amount)', 'total_net_revenue')},
  {_mean('net_amount', 'avg_transaction_value')},
  {_money('max(net_amount)', 'highest_transaction')},
  strftime(min(transaction_date), '%Y-%m-%d') AS first_date,
  strftime(max(transaction_date), '%Y-%m-%d') AS last_date
FROM sales
WHERE {{condition}}
GROUP BY venue_id, venue_name, venue_type, city"""


def _monthly(where: str, growth_if_previous_is_zero: str) -> str:
    months = f"""
months AS (
  SELECT month_num, month, venue_type, count(*) AS n, sum(net_amount) AS net, sum(discount_amount) AS discounts,
         lag(sum(net_amount)) OVER (PARTITION BY venue_type ORDER BY month_num) AS prev
  FROM sales {where}
  GROUP BY month_num, month, venue_type
),
cents AS (
  SELECT *, {_cents('net - prev')} AS d, {_cents('prev')} AS p FROM months
)"""
    return _query(
        f"""
SELECT month_num, month, venue_type,
  {_count('n', 'transactions')},
  {_money('net', 'net_revenue')},
  {_money('discounts', 'discounts_given')},
  CAST(net AS DOUBLE) / n AS avg_basket,
  {_money('prev', 'prev_month_revenue')},
  CASE WHEN p = 0 THEN {growth_if_previous_is_zero}
       ELSE CAST(sign(d) * ((2000 * abs(d) + p) // (2 * p)) AS DOUBLE) / 10 END AS mom_growth_pct
FROM cents""",
        months,
    )


def _history(key: str, key_name: str, previous: str, ladder: str) -> str:
    return f"""
visits AS (
  SELECT transaction_id, venue_id, venue_type, transaction_ts, net_amount, {key} AS {key_name},
         row_number() OVER (PARTITION BY {key} ORDER BY transaction_ts, transaction_id) AS customer_visit_number,
         lag(transaction_ts) OVER (PARTITION BY {key} ORDER BY transaction_ts, transaction_id) AS {previous}
  FROM sales
),
history AS (
  SELECT *, CAST(date_diff('day', {previous}, transaction_ts) AS INTEGER) AS days_since_last_visit,
         CASE WHEN customer_visit_number = 1 THEN 'New Guest'
              {ladder} END AS customer_loyalty_segment
  FROM visits
)"""


def _history_shown(key_name: str, previous: str) -> str:
    return f"""
SELECT transaction_id, venue_id, venue_type, transaction_ts, {_money('net_amount', 'net_amount')}, {key_name},
       {_count('customer_visit_number', 'customer_visit_number')}, {previous}, days_since_last_visit,
       customer_loyalty_segment
FROM history"""


_DAYS = "date_diff('day', {previous}, transaction_ts)"
SEGMENT_HISTORY = _history(
    "md5(payment_method || city || venue_type)",
    "customer_surrogate_id",
    "previous_transaction_ts",
    f"""WHEN {_DAYS.format(previous='previous_transaction_ts')} <= 7 THEN 'High-Frequency Loyal'
              WHEN {_DAYS.format(previous='previous_transaction_ts')} <= 30 THEN 'Standard Returning'
              ELSE 'Churned / Reactivated Guest'""",
)
CUSTOMER_HISTORY = _history(
    "customer_id",
    "customer_id",
    "previous_visit_ts",
    f"""WHEN {_DAYS.format(previous='previous_visit_ts')} <= 30 THEN '<=30d'
              WHEN {_DAYS.format(previous='previous_visit_ts')} <= 90 THEN '<=90d'
              WHEN {_DAYS.format(previous='previous_visit_ts')} <= 180 THEN '<=180d'
              ELSE '>180d'""",
)

RETENTION = """
retention AS (
  SELECT CAST(date_trunc('month', transaction_ts) AS DATE) AS forecast_month, venue_type, customer_loyalty_segment,
         count(DISTINCT transaction_id) AS bookings, count(*) AS n, sum(net_amount) AS revenue,
         CAST(sum(days_since_last_visit) AS DOUBLE) / count(days_since_last_visit) AS gap
  FROM history
  GROUP BY 1, 2, 3
)"""


def _mean_cents(amount: str, n: str) -> str:
    """Average of a non-negative amount, rounded half up to cents."""
    return f"CAST((2 * {_cents(amount)} + {n}) // (2 * {n}) AS DOUBLE) / 100"


def _percent(part: str, whole: str) -> str:
    """Percentage with one place, rounded half up."""
    return f"CAST((2000 * CAST({part} AS HUGEINT) + {whole}) // (2 * {whole}) AS DOUBLE) / 10"


RETENTION_SHOWN = f"""
SELECT {_text('forecast_month')}, venue_type, customer_loyalty_segment, {_count('bookings', 'total_bookings')},
  {_money('revenue', 'realized_revenue')}, gap AS average_days_between_visit,
  {_mean_cents('revenue', 'n')} AS customer_lifetime_value_increment
FROM retention"""

REVENUE_TREND = f"""
SELECT {_text('forecast_month')}, {_money('revenue', 'realized_revenue')},
  {_mean_cents('revenue', 'n')} AS customer_lifetime_value_increment
FROM (SELECT CAST(date_trunc('month', transaction_ts) AS DATE) AS forecast_month, sum(net_amount) AS revenue,
        CAST(count(*) AS HUGEINT) AS n
      FROM sales GROUP BY 1)"""

# Rows whose id repeats and whose amount is missing at the largest quantity.
FLAWED = """
flawed AS (
  SELECT * REPLACE (line_id AS transaction_id, CASE WHEN quantity < 50 THEN net_amount END AS net_amount) FROM sales
)"""


# Built load by load, and equal to what one run over all rows gives.
SAME_AS = {
    "visit_history_carried": "visit_history",
    "visit_history_by_customer_carried": "visit_history_by_customer",
    "fct_venue_performance_refreshed": "fct_venue_performance",
    "fct_retention_by_customer_refreshed": "fct_retention_by_customer",
}


def oracle_sql() -> dict[str, str]:
    reports = _reports()
    return reports | {name: reports[whole] for name, whole in SAME_AS.items()}


def _reports() -> dict[str, str]:
    found = {
        "stg_transactions": _query(f"SELECT {STAGED} FROM sales"),
        "derive_amounts": _query(f"""
SELECT transaction_id, {_money('gross_amount', 'gross_amount')}, {_money('discount_amount', 'discount_amount')},
       {_money('net_amount', 'net_amount')}
FROM sales"""),
        "derive_calendar": _query(f"""
SELECT transaction_id, customer_id, {_text('transaction_date')}, transaction_time, day_of_week, month, month_num,
       is_weekend
FROM sales"""),
        "weekend_uplift": _query(f"""
SELECT transaction_id, {_text('transaction_date')}, {_money('unit_price', 'unit_price')},
       CASE WHEN isodow(transaction_ts) >= 5 THEN CAST(round(unit_price * 1.15, 2) AS DOUBLE)
            ELSE CAST(unit_price AS DOUBLE) END AS uplifted_price
FROM sales"""),
        "incremental_extract": _query(f"""
SELECT customer_id, {STAGED} FROM sales WHERE loaded_at >= TIMESTAMP '2000-01-02 06:00:00' - INTERVAL 25 HOUR"""),
        "latest_per_transaction": _query(
            f"""
SELECT customer_id, {STAGED} FROM newest WHERE place = 1""",
            """
newest AS (
  SELECT * REPLACE (line_id AS transaction_id),
         row_number() OVER (PARTITION BY line_id ORDER BY loaded_at DESC, customer_id DESC, venue_id DESC,
           venue_name DESC, venue_type DESC, city DESC, region DESC, transaction_date DESC, transaction_time DESC,
           transaction_ts DESC, item_name DESC, category DESC, quantity DESC, unit_price DESC, gross_amount DESC,
           discount_pct DESC, discount_amount DESC, net_amount DESC, payment_method DESC) AS place
  FROM sales
)""",
        ),
        "daily_revenue": _query(f"SELECT {DAILY_SHOWN}, {DAILY} FROM sales GROUP BY {DAILY_KEYS}"),
        "daily_revenue_weekend_split": _query(f"""
SELECT {DAILY_SHOWN}, {DAILY},
  CAST(coalesce(sum(net_amount) FILTER (is_weekend), 0) AS DOUBLE) AS weekend_revenue,
  CAST(coalesce(sum(net_amount) FILTER (NOT is_weekend), 0) AS DOUBLE) AS weekday_revenue
FROM sales GROUP BY {DAILY_KEYS}"""),
        "category_performance": _query(f"""
SELECT venue_type, category, item_name,
  {_count('count(*)', 'times_ordered')},
  {_count('sum(quantity)', 'total_quantity')},
  {_money('sum(net_amount)', 'total_revenue')},
  {_mean('unit_price', 'avg_price')},
  CAST(rank() OVER (PARTITION BY venue_type ORDER BY sum(net_amount) DESC) AS INTEGER) AS revenue_rank_in_venue_type
FROM sales GROUP BY venue_type, category, item_name"""),
        "top_items_ranked": _query(f"""
SELECT venue_type, category, item_name,
  {_count('count(*)', 'times_ordered')},
  {_count('sum(quantity)', 'total_quantity_sold')},
  {_money('sum(net_amount)', 'total_revenue')},
  {_mean('unit_price', 'avg_unit_price')},
  CAST(rank() OVER (PARTITION BY venue_type ORDER BY sum(net_amount) DESC) AS INTEGER) AS revenue_rank
FROM sales GROUP BY venue_type, category, item_name
QUALIFY revenue_rank <= 10"""),
        "payment_split": _query(
            f"""
SELECT payment_method, venue_type, {_count('n', 'transaction_count')}, {_money('net', 'total_revenue')},
  {_percent('n', 'whole')} AS pct_of_venue_transactions
FROM methods""",
            """
methods AS (
  SELECT payment_method, venue_type, count(*) AS n, sum(net_amount) AS net,
         CAST(sum(count(*)) OVER (PARTITION BY venue_type) AS HUGEINT) AS whole
  FROM sales GROUP BY payment_method, venue_type
)""",
        ),
        "venue_summary": _query(VENUE_SUMMARY.format(
            condition="venue_id = 'V7' AND transaction_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'")),
        "venue_summary_default": _query(VENUE_SUMMARY.format(
            condition="transaction_date BETWEEN DATE '2000-05-31' AND DATE '2000-06-30'")),
        "top_items": _query(f"""
SELECT venue_type, category, item_name,
  {_count('sum(quantity)', 'total_sold')},
  {_money('sum(net_amount)', 'total_revenue')},
  {_mean('unit_price', 'avg_unit_price')},
  {_count('count(DISTINCT transaction_date)', 'days_sold')}
FROM sales WHERE venue_type = 'Pub'
GROUP BY venue_type, category, item_name
ORDER BY sum(net_amount) DESC, venue_type, category, item_name LIMIT 5"""),
        "monthly_trend": _monthly("WHERE year(transaction_date) = 1998", "NULL"),
        "monthly_trend_default": _monthly("WHERE year(transaction_date) = 2000", "NULL"),
        "monthly_trend_all_years": _monthly("", "0"),
        "fct_venue_performance": _query(f"""
SELECT venue_id, venue_name, venue_type, city, region, category, item_name, day_of_week, month,
  {_count('sum(quantity)', 'total_units_sold')},
  {_count('count(DISTINCT transaction_id)', 'total_transactions')},
  {_money('sum(gross_amount)', 'total_gross_revenue')},
  {_money('sum(discount_amount)', 'total_discounts_given')},
  {_money('sum(net_amount)', 'total_net_revenue')},
  {_mean('unit_price', 'average_item_price')},
  max(loaded_at) AS last_pipeline_update
FROM sales GROUP BY venue_id, venue_name, venue_type, city, region, category, item_name, day_of_week, month"""),
        "visit_history": _query(_history_shown("customer_surrogate_id", "previous_transaction_ts"), SEGMENT_HISTORY),
        "visit_history_by_customer": _query(_history_shown("customer_id", "previous_visit_ts"), CUSTOMER_HISTORY),
        "fct_retention": _query(RETENTION_SHOWN, SEGMENT_HISTORY, RETENTION),
        "fct_retention_by_customer": _query(RETENTION_SHOWN, CUSTOMER_HISTORY, RETENTION),
        "venue_breakdown": _query(
            f"SELECT venue_name, {_count('count(*)', 'transactions')} FROM sales GROUP BY venue_name"),
        "category_breakdown": _query(
            f"SELECT category, {_count('count(*)', 'transactions')} FROM sales GROUP BY category"),
        "total_revenue": _query(f"SELECT {_money('sum(net_amount)', 'total_revenue')} FROM sales"),
        "sample_rows": _query(f"SELECT customer_id, {STAGED} FROM sales ORDER BY transaction_id LIMIT 3"),
        "dq_summary": _query(
            f"""
SELECT *, CASE WHEN null_amounts = 0 AND duplicate_ids = 0 AND negative_amounts = 0
          THEN 'PASSED' ELSE 'FAILED' END AS check_status
FROM (
  SELECT {_count('count(*)', 'total_rows')},
    {_count('sum(CASE WHEN net_amount IS NULL THEN 1 ELSE 0 END)', 'null_amounts')},
    {_count('count(*) - count(DISTINCT transaction_id)', 'duplicate_ids')},
    {_count('sum(CASE WHEN net_amount < 0 THEN 1 ELSE 0 END)', 'negative_amounts')}
  FROM sales
)"""),
        "test_unique": _query(
            f"""
SELECT transaction_id, {_count('count(*)', 'n_records')} FROM flawed
GROUP BY transaction_id HAVING count(*) > 1""",
            FLAWED,
        ),
        "test_not_null": _query(
            f"SELECT 'net_amount' AS column_name, customer_id, {STAGED} FROM flawed WHERE net_amount IS NULL", FLAWED),
        "test_accepted_values": _query(f"""
SELECT venue_type AS value_field, {_count('count(*)', 'n_records')} FROM sales
WHERE venue_type NOT IN ('Hotel', 'Pub') GROUP BY venue_type"""),
        "source_tests": _query(
            f"""
SELECT test_name, {_count('failures', 'failures')}, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (
  SELECT 'not_null_transaction_id' AS test_name, count(*) FILTER (transaction_id IS NULL) AS failures FROM flawed
  UNION ALL SELECT 'not_null_transaction_ts', count(*) FILTER (transaction_ts IS NULL) FROM flawed
  UNION ALL SELECT 'not_null_net_amount', count(*) FILTER (net_amount IS NULL) FROM flawed
  UNION ALL SELECT 'accepted_values_venue_type',
         count(DISTINCT venue_type) FILTER (venue_type NOT IN ('Hotel', 'Pub', 'Restaurant')) FROM flawed
  UNION ALL SELECT 'unique_transaction_id', count(*)
         FROM (SELECT transaction_id FROM flawed GROUP BY transaction_id HAVING count(*) > 1)
)""",
            FLAWED,
        ),
        "dash_kpis": _query(f"""
SELECT {_money('sum(net_amount)', 'net_revenue')}, {_count('sum(quantity)', 'units_sold')},
  {_money('sum(discount_amount)', 'total_discounts')}
FROM sales WHERE region = 'EUROPE'"""),
        "dash_category": _query(
            f"SELECT category, {_money('sum(net_amount)', 'net_revenue')} FROM sales GROUP BY category"),
        "dash_category_city": _query(f"""
SELECT category, {_money('sum(net_amount)', 'net_revenue')} FROM sales
WHERE region = 'EUROPE' AND city = 'NATION_18' GROUP BY category"""),
        "dash_city_type_region": _query(f"""
SELECT city, venue_type, {_money('sum(net_amount)', 'net_revenue')} FROM sales
WHERE region = 'ASIA' GROUP BY city, venue_type"""),
        "dash_city_type": _query(f"""
SELECT city, venue_type, {_money('sum(net_amount)', 'net_revenue')} FROM sales GROUP BY city, venue_type"""),
        "dash_loyalty_share": _query(
            f"""
SELECT customer_loyalty_segment, {_count('n', 'bookings')}, {_percent('n', 'whole')} AS share_pct
FROM shares""",
            SEGMENT_HISTORY,
            RETENTION,
            """
shares AS (
  SELECT customer_loyalty_segment, sum(bookings) AS n, CAST(sum(sum(bookings)) OVER () AS HUGEINT) AS whole
  FROM retention GROUP BY customer_loyalty_segment
)""",
        ),
        "dash_revenue_trend": _query(REVENUE_TREND),
        "dash_revenue_trend_repeated": _query(REVENUE_TREND),
        "csv_round_trip": _query(f"SELECT customer_id, {STAGED.rpartition(', loaded_at')[0]} FROM sales"),
    }
    # What one scan for all reports must give is what each report gives alone.
    alone = {
        "one_scan_daily_revenue": "daily_revenue_weekend_split",
        "one_scan_category_performance": "category_performance",
        "one_scan_top_items": "top_items_ranked",
        "one_scan_payment_split": "payment_split",
        "one_scan_monthly_trend": "monthly_trend_all_years",
    }
    return found | {name: found[report] for name, report in alone.items()}
