"""Every registered query over a folder of order tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.operators import dashboard, guests, increments, marts, quality, reports, sales, sequences
from salesmart.operators.derive import with_amounts, with_calendar, with_weekend_uplift
from salesmart.operators.staging import stg_transactions
from salesmart.plans import refresh, visit_store
from salesmart.schema import LOAD_COLUMNS
from salesmart.sources import csv_sales
from salesmart.sources.harness import sales_from_orders
from salesmart.sources.shared import new_path, scratch, shared_dir, store

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """Money as doubles and dates as text, for comparison across engines."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double").alias(field.name)
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string").alias(field.name)
        columns.append(column)
    return df.select(*columns)


def flawed(rows: DataFrame) -> DataFrame:
    """Sales that fail tests: short ids repeat, and the largest quantity has
    lost its amount."""
    return short_ids(rows).withColumn("net_amount", F.when(F.col("quantity") < 50, F.col("net_amount")))


def short_ids(rows: DataFrame) -> DataFrame:
    """Ids cut to order and line number, which occur more than once."""
    short = F.substring_index(F.substring(F.col("transaction_id"), 2, 80), "-", 2)
    return rows.withColumn("transaction_id", short)


def _venues(rows: DataFrame) -> DataFrame:
    return marts.fct_venue_performance(stg_transactions(rows))


def _visits(rows: DataFrame) -> DataFrame:
    # The fact is a join here, which must not run once per reading.
    return guests.visit_history(stg_transactions(rows), store_input=True)


def _retention(rows: DataFrame) -> DataFrame:
    return guests.fct_retention(_visits(rows))


def _through_csv(rows: DataFrame) -> DataFrame:
    """The load columns written as CSV in the shared folder and read again."""
    spark = rows.sparkSession
    path = f"{shared_dir(spark)}/sales-csv-{uuid4().hex}"
    csv_sales.write_sales_csv(rows.select(*LOAD_COLUMNS), path, compression="gzip")
    return csv_sales.read_sales_csv(spark, path)


# Years of the loads below, in the order they come: all but the first are late.
LOADS = [(1998, 2001), (1995, 1996), (1997, 1997)]


def _loads(rows: DataFrame) -> list[DataFrame]:
    year = F.year("transaction_date")
    return [rows.filter(year.between(first, last)) for first, last in LOADS]


def _carried(rows: DataFrame, how: sequences.Sequence) -> DataFrame:
    """A visit history extended load by load."""
    base = new_path(rows.sparkSession, "visit-store")
    # Each load stores its own rows once; the choice of years reaches the scan.
    for load in _loads(rows):
        visit_store.extend(load, base, how)
    return visit_store.history(rows.sparkSession, base, how)


def _refreshed_venues(rows: DataFrame) -> DataFrame:
    """The venue mart after a refresh with each load."""
    spark, folder = rows.sparkSession, new_path(rows.sparkSession, "venue-parts")
    with scratch(spark):
        # What a refresh reads, and only as long as there are loads.
        rows = store(rows.select(*marts.MART_COLUMNS, "transaction_date"), "sales", compression="zstd")
        for k, load in enumerate(_loads(rows)):
            seen = rows.filter(F.year("transaction_date").isin(*[y for a, b in LOADS[: k + 1] for y in range(a, b + 1)]))
            refresh.refresh_venue_performance(seen, folder, [r[0] for r in load.select("transaction_date").distinct().collect()])
    return refresh.read_venue_performance(spark, folder)


def _refreshed_retention(rows: DataFrame) -> DataFrame:
    """The retention mart after a refresh with each load."""
    spark, how = rows.sparkSession, sequences.CUSTOMERS
    base, folder = new_path(spark, "visit-store"), new_path(spark, "retention-parts")
    for load in _loads(rows):
        refresh.refresh_retention(spark, base, folder, how, [visit_store.extend(load, base, how)])
    return refresh.read_retention(spark, folder)


# Each entry maps the sales fact to a result.
REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "stg_transactions": stg_transactions,
    "derive_amounts": lambda s: with_amounts(s.select("transaction_id", "unit_price", "quantity", "discount_pct")).drop(
        "unit_price", "quantity", "discount_pct"
    ),
    "derive_calendar": lambda s: with_calendar(s.select("transaction_id", "customer_id", "transaction_ts")).drop(
        "transaction_ts"
    ),
    "weekend_uplift": lambda s: with_weekend_uplift(s, into="uplifted_price").select(
        "transaction_id", "transaction_date", "unit_price", "uplifted_price"
    ),
    "incremental_extract": lambda s: increments.incremental_extract(s, as_of=datetime(2000, 1, 2, 6)),
    "latest_per_transaction": lambda s: increments.latest_per_transaction(short_ids(s)),
    "daily_revenue": sales.daily_revenue,
    "daily_revenue_weekend_split": sales.daily_revenue_weekend_split,
    "category_performance": sales.category_performance,
    "top_items_ranked": sales.top_items_ranked,
    "payment_split": sales.payment_split,
    "venue_summary": lambda s: sales.venue_summary(
        s, as_of=date(2000, 6, 30), venue_id="V7", start_date=date(1997, 1, 1), end_date=date(1998, 12, 31)
    ),
    "venue_summary_default": lambda s: sales.venue_summary(s, as_of=date(2000, 6, 30)),
    "top_items": lambda s: sales.top_items(s, venue_type="Pub", top_n=5),
    "monthly_trend": lambda s: sales.monthly_trend(s, year=1998),
    "monthly_trend_default": lambda s: sales.monthly_trend(s, as_of=date(2000, 6, 30)),
    "monthly_trend_all_years": sales.monthly_trend_all_years,
    "one_scan_daily_revenue": lambda s: reports.all_reports(s)["daily_revenue"],
    "one_scan_category_performance": lambda s: reports.all_reports(s)["category_performance"],
    "one_scan_top_items": lambda s: reports.all_reports(s)["top_items"],
    "one_scan_payment_split": lambda s: reports.all_reports(s)["payment_split"],
    "one_scan_monthly_trend": lambda s: reports.all_reports(s)["monthly_trend"],
    "fct_venue_performance": _venues,
    "visit_history": _visits,
    "visit_history_by_customer": lambda s: guests.visit_history_by_customer(s, store_input=True),
    "fct_retention": _retention,
    "fct_retention_by_customer": lambda s: guests.fct_retention(guests.visit_history_by_customer(s, store_input=True)),
    "visit_history_carried": lambda s: _carried(s, sequences.SEGMENTS),
    "visit_history_by_customer_carried": lambda s: _carried(s, sequences.CUSTOMERS),
    "fct_venue_performance_refreshed": _refreshed_venues,
    "fct_retention_by_customer_refreshed": _refreshed_retention,
    "venue_breakdown": lambda s: sales.value_counts(s, "venue_name"),
    "category_breakdown": lambda s: sales.value_counts(s, "category"),
    "total_revenue": sales.total_revenue,
    "sample_rows": sales.first_rows,
    "dq_summary": quality.dq_summary,
    "test_unique": lambda s: quality.unique(flawed(s), "transaction_id"),
    "test_not_null": lambda s: quality.not_null(flawed(s)),
    "test_accepted_values": lambda s: quality.accepted_values(s, "venue_type", ["Hotel", "Pub"]),
    "source_tests": lambda s: quality.source_tests(flawed(s)),
    "dash_kpis": lambda s: dashboard.dash_kpis(_venues(s), region="EUROPE"),
    "dash_category": lambda s: dashboard.dash_category(_venues(s)),
    "dash_category_city": lambda s: dashboard.dash_category(_venues(s), region="EUROPE", city="NATION_18"),
    "dash_city_type": lambda s: dashboard.dash_city_type(_venues(s)),
    "dash_city_type_region": lambda s: dashboard.dash_city_type(_venues(s), region="ASIA"),
    "dash_loyalty_share": lambda s: dashboard.dash_loyalty_share(_retention(s)),
    "dash_revenue_trend": lambda s: dashboard.dash_revenue_trend(stg_transactions(s)),
    "dash_revenue_trend_repeated": lambda s: dashboard.dash_revenue_trend(stg_transactions(short_ids(s))),
    "csv_round_trip": _through_csv,
}


def queries() -> dict[str, Query]:
    """The reports over the fact, which is planned once per session and folder."""
    facts: dict[tuple[SparkSession, str], DataFrame] = {}

    def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
        if (spark, sf_dir) not in facts:
            facts[spark, sf_dir] = sales_from_orders(spark, sf_dir)
        return facts[spark, sf_dir]

    def over_orders(report: Callable[[DataFrame], DataFrame]) -> Query:
        return lambda spark, sf_dir: portable(report(fact(spark, sf_dir)))

    return {name: over_orders(report) for name, report in REPORTS.items()}
