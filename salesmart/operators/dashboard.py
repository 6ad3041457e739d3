"""Dashboard figures, read from the marts and the visits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.amounts import mean_rounded, percent_of, total
from salesmart.functions.dates import month_start


def dash_kpis(venues: DataFrame, *, region: str | None = None, city: str | None = None) -> DataFrame:
    """Net revenue, units and discounts, for one region or city if given."""
    return _chosen(venues, region, city).agg(
        total("total_net_revenue").alias("net_revenue"),
        F.sum("total_units_sold").alias("units_sold"),
        total("total_discounts_given").alias("total_discounts"),
    )


def dash_category(venues: DataFrame, *, region: str | None = None, city: str | None = None) -> DataFrame:
    """Net revenue by category, for one region or city if given."""
    chosen = _chosen(venues, region, city)
    return chosen.groupBy("category").agg(total("total_net_revenue").alias("net_revenue"))


def dash_city_type(venues: DataFrame, *, region: str | None = None, city: str | None = None) -> DataFrame:
    """Net revenue by city and venue type, for one region or city if given."""
    chosen = _chosen(venues, region, city)
    return chosen.groupBy("city", "venue_type").agg(total("total_net_revenue").alias("net_revenue"))


def _chosen(venues: DataFrame, region: str | None, city: str | None) -> DataFrame:
    for column, value in (("region", region), ("city", city)):
        if value is not None:
            venues = venues.filter(F.col(column) == value)
    return venues


def dash_loyalty_share(retention: DataFrame) -> DataFrame:
    """Share of bookings by loyalty segment."""
    # One row per segment is left here, so a single window over all is small.
    everything = Window.partitionBy(F.lit(0))
    return (
        retention.groupBy("customer_loyalty_segment")
        .agg(F.sum("total_bookings").alias("bookings"))
        .withColumn("share_pct", percent_of(F.col("bookings"), F.sum("bookings").over(everything)))
    )


def dash_revenue_trend(visits: DataFrame) -> DataFrame:
    """Revenue and average net amount per visit by month.

    Takes staged sales or a visit history, not the retention mart: the mart
    counts distinct ids, and an average over them is wrong where ids repeat.
    """
    return (
        visits.groupBy(month_start(F.col("transaction_ts")).alias("forecast_month"))
        .agg(
            total("net_amount").alias("realized_revenue"),
            mean_rounded("net_amount", 2).alias("customer_lifetime_value_increment"),
        )
        .orderBy("forecast_month")
    )
