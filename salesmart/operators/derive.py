"""Columns of a sale that follow from its price, quantity and time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions import amounts
from salesmart.functions.dates import calendar


def with_weekend_uplift(rows: DataFrame, *, into: str = "unit_price") -> DataFrame:
    """Raise the unit price of sales made from Friday to Sunday."""
    return rows.withColumn(into, amounts.weekend_price(F.col("unit_price"), F.to_date("transaction_ts")))


def with_amounts(rows: DataFrame) -> DataFrame:
    """Gross, discount and net from unit price, quantity and percentage."""
    return (
        rows.withColumn("gross_amount", amounts.gross_amount(F.col("unit_price"), F.col("quantity")))
        .withColumn("discount_amount", amounts.discount_amount(F.col("gross_amount"), F.col("discount_pct")))
        .withColumn("net_amount", amounts.net_amount(F.col("gross_amount"), F.col("discount_amount")))
    )


def with_calendar(rows: DataFrame) -> DataFrame:
    """Date, time, day, month and weekend flag from the time of the sale."""
    return rows.withColumns(calendar(F.col("transaction_ts")))
