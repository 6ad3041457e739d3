"""Revenue reports over the sales fact."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.amounts import mean_money, percent_of, quotient, total
from salesmart.operators.numbering import rank_descending
from salesmart.schema import ITEM, VENUE


def daily_revenue(sales: DataFrame) -> DataFrame:
    return _daily(sales)


def daily_revenue_weekend_split(sales: DataFrame) -> DataFrame:
    """Daily revenue with the part made on weekends and on other days."""
    weekend = F.col("is_weekend")
    return _daily(
        sales,
        total(F.when(weekend, F.col("net_amount")).otherwise(0)).alias("weekend_revenue"),
        total(F.when(~weekend, F.col("net_amount")).otherwise(0)).alias("weekday_revenue"),
    )


def _daily(sales: DataFrame, *more) -> DataFrame:
    return sales.groupBy("transaction_date", *VENUE).agg(
        F.count("*").alias("transaction_count"),
        F.sum("quantity").alias("items_sold"),
        total("gross_amount").alias("gross_revenue"),
        total("discount_amount").alias("total_discounts"),
        total("net_amount").alias("net_revenue"),
        mean_money("net_amount").alias("avg_transaction_value"),
        *more,
    )


def category_performance(sales: DataFrame) -> DataFrame:
    """Each item's sales and its revenue rank within the venue type."""
    items = sales.groupBy(*ITEM).agg(
        F.count("*").alias("times_ordered"),
        F.sum("quantity").alias("total_quantity"),
        total("net_amount").alias("total_revenue"),
        mean_money("unit_price").alias("avg_price"),
    )
    return rank_items(items)


def rank_items(items: DataFrame) -> DataFrame:
    return rank_descending(items, group="venue_type", measure="total_revenue", rank="revenue_rank_in_venue_type")


def top_items_ranked(sales: DataFrame, *, ranks: int = 10) -> DataFrame:
    """Items ranked up to ``ranks`` in their venue type, ties included.

    Spark limits the rank before the shuffle too, so a window task receives
    each map task's leading items only.
    """
    items = sales.groupBy(*ITEM).agg(
        F.count("*").alias("times_ordered"),
        F.sum("quantity").alias("total_quantity_sold"),
        total("net_amount").alias("total_revenue"),
        mean_money("unit_price").alias("avg_unit_price"),
    )
    return leading_items(items, ranks)


def leading_items(items: DataFrame, ranks: int) -> DataFrame:
    best_first = Window.partitionBy("venue_type").orderBy(F.desc("total_revenue"))
    return items.withColumn("revenue_rank", F.rank().over(best_first)).filter(F.col("revenue_rank") <= ranks)


def payment_split(sales: DataFrame) -> DataFrame:
    """Payment methods per venue type with their share of its transactions."""
    return with_share(
        sales.groupBy("payment_method", "venue_type").agg(
            F.count("*").alias("transaction_count"), total("net_amount").alias("total_revenue")
        )
    )


def with_share(methods: DataFrame) -> DataFrame:
    whole_type = F.sum("transaction_count").over(Window.partitionBy("venue_type"))
    return methods.withColumn("pct_of_venue_transactions", percent_of(F.col("transaction_count"), whole_type))


def venue_summary(
    sales: DataFrame,
    *,
    as_of: date,
    venue_id: str | None = None,
    start_date: date | None = None,
    end_date: date | None = None,
) -> DataFrame:
    """Totals per venue between two dates, both included.

    A date left out defaults on its own: the start to 30 days before ``as_of``
    and the end to ``as_of``.
    """
    start = start_date or as_of - timedelta(days=30)
    end = end_date or as_of
    sales = sales.filter(F.col("transaction_date").between(start, end))
    if venue_id is not None:
        sales = sales.filter(F.col("venue_id") == venue_id)
    keys = ["venue_id", "venue_name", "venue_type", "city"]
    return (
        sales.groupBy(*keys)
        .agg(
            F.count("*").alias("total_transactions"),
            F.sum("quantity").alias("total_items_sold"),
            total("net_amount").alias("total_net_revenue"),
            mean_money("net_amount").alias("avg_transaction_value"),
            F.max("net_amount").alias("highest_transaction"),
            F.min("transaction_date").alias("first_date"),
            F.max("transaction_date").alias("last_date"),
        )
        .orderBy(F.desc("total_net_revenue"), *keys)
    )


def top_items(sales: DataFrame, *, venue_type: str | None = None, top_n: int = 10) -> DataFrame:
    """The ``top_n`` items by revenue over all venue types together."""
    if venue_type is not None:
        sales = sales.filter(F.col("venue_type") == venue_type)
    return (
        sales.groupBy(*ITEM)
        .agg(
            F.sum("quantity").alias("total_sold"),
            total("net_amount").alias("total_revenue"),
            mean_money("unit_price").alias("avg_unit_price"),
            F.count_distinct("transaction_date").alias("days_sold"),
        )
        .orderBy(F.desc("total_revenue"), *ITEM)
        .limit(top_n)
    )


def monthly_trend(sales: DataFrame, *, as_of: date | None = None, year: int | None = None) -> DataFrame:
    """One year by month and venue type with growth over the month before.

    The year left out is that of ``as_of``.  Growth is NULL without a month
    before or if it made nothing.  The year is a date range so that it reaches
    the scan.
    """
    if year is None:
        if as_of is None:
            raise ValueError("monthly_trend needs a year, or the day to take it from")
        year = as_of.year
    in_year = F.col("transaction_date").between(date(year, 1, 1), date(year, 12, 31))
    previous = F.col("prev_month_revenue")
    growth = F.when(previous != 0, _growth(previous))
    return _monthly(sales.filter(in_year)).withColumn("mom_growth_pct", growth).orderBy(
        "venue_type", "month_num", "month"
    )


def monthly_trend_all_years(sales: DataFrame) -> DataFrame:
    """As ``monthly_trend`` with all years folded together by month number.

    Growth is 0 here if the month before made nothing.
    """
    return with_growth(_monthly(sales))


def with_growth(months: DataFrame) -> DataFrame:
    previous = F.col("prev_month_revenue")
    zero = F.when((previous == 0) & F.col("net_revenue").isNotNull(), F.lit(0))
    growth = F.when(previous != 0, _growth(previous)).otherwise(zero)
    return months.withColumn("mom_growth_pct", growth).orderBy("venue_type", "month_num", "month")


def _growth(previous: Column) -> Column:
    """Percent with one place."""
    return quotient((F.col("net_revenue") - previous) * 100, F.nullif(previous, F.lit(0)), 1)


def _monthly(sales: DataFrame) -> DataFrame:
    return with_previous(
        sales.groupBy("month_num", "month", "venue_type").agg(
            F.count("*").alias("transactions"),
            total("net_amount").alias("net_revenue"),
            total("discount_amount").alias("discounts_given"),
            mean_money("net_amount").alias("avg_basket"),
        )
    )


def with_previous(months: DataFrame) -> DataFrame:
    # After the aggregate a venue type has one row per month of the year.
    by_month = Window.partitionBy("venue_type").orderBy("month_num", "month")
    return months.withColumn("prev_month_revenue", F.lag("net_revenue").over(by_month))


def value_counts(sales: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return sales.groupBy(column).agg(F.count("*").alias("transactions")).orderBy(F.desc("transactions"), column)


def total_revenue(sales: DataFrame) -> DataFrame:
    return sales.agg(total("net_amount").alias("total_revenue"))


def first_rows(sales: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` sales by id, as a look at the data."""
    return sales.orderBy(*[F.col(c) for c in sales.columns]).limit(n)
