"""Build every published result from the raw table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from salesmart.operators import sales
from salesmart.operators.guests import fct_retention, visit_history, visit_history_by_customer
from salesmart.operators.increments import latest_per_transaction
from salesmart.operators.marts import fct_venue_performance
from salesmart.operators.quality import source_tests
from salesmart.operators.staging import stg_transactions
from salesmart.sources.shared import scratch
from salesmart.sources.tables import create_quality_log, log_quality, publish_table, publish_view, read_sales_table

MART_SCHEMA = "analytics"


def publish_views(raw: DataFrame) -> dict[str, DataFrame]:
    """The reports that take no arguments, as views."""
    reports = {
        "vw_daily_revenue": sales.daily_revenue_weekend_split,
        "vw_category_performance": sales.category_performance,
        "vw_top_items": sales.top_items_ranked,
        "vw_payment_split": sales.payment_split,
        "vw_monthly_trend": sales.monthly_trend_all_years,
    }
    return {name: publish_view(report(raw), name) for name, report in reports.items()}


def build_marts(
    spark: SparkSession, raw_table: str, *, schema: str | None = MART_SCHEMA, newest_only: bool = False
) -> dict[str, DataFrame]:
    """Staging as a view, visit history inlined, and the marts as tables.

    ``newest_only``: of the rows of one id, as overlapping copies and rows stamped
    again leave them, the one loaded last counts.
    """
    raw = read_sales_table(spark, raw_table)
    staged = publish_view(stg_transactions(latest_per_transaction(raw) if newest_only else raw), "stg_transactions")
    with scratch(spark):
        by_guest = visit_history_by_customer(latest_per_transaction(raw) if newest_only else raw)
        marts = {
            "fct_venue_performance": fct_venue_performance(staged),
            "fct_retention": fct_retention(visit_history(staged)),
            "fct_retention_by_customer": fct_retention(by_guest),
        }
        return {name: publish_table(mart, name, schema=schema) for name, mart in marts.items()}


def build_all(
    spark: SparkSession,
    raw_table: str,
    *,
    schema: str | None = MART_SCHEMA,
    newest_only: bool = False,
    quality_log: str | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """Build the marts, publish the views, log the quality check if there is a log,
    and return the result of the tests on the raw table."""
    build_marts(spark, raw_table, schema=schema, newest_only=newest_only)
    raw = read_sales_table(spark, raw_table)
    publish_views(raw)
    if quality_log is not None:
        create_quality_log(spark, quality_log)
        log_quality(raw, quality_log, as_of=as_of)
    return source_tests(raw)
