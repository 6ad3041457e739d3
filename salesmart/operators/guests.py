"""Visit sequences and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.amounts import mean, mean_rounded, total
from salesmart.functions.dates import day_gap, month_start
from salesmart.functions.guests import CUSTOMER_BANDS, SEGMENT_BANDS, LoyaltyBands, segment_key
from salesmart.operators.numbering import ROWS_PER_TASK, visit_numbers
from salesmart.sources.shared import store


def visit_history(
    staged: DataFrame, *, store_input: bool = False, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Visits in time order per pseudo-guest, with gap and loyalty segment.

    The pseudo-guest hashes payment method, city and venue type, so it stands
    for many people: nearly everybody counts as returning.  Use
    ``visit_history_by_customer`` to follow individual guests.

    Sequencing reads its input twice or more.  ``store_input`` keeps the few
    columns it needs, which pays off if ``staged`` is not a stored table.
    """
    return _history(
        staged,
        key=segment_key(),
        key_name="customer_surrogate_id",
        previous="previous_transaction_ts",
        bands=SEGMENT_BANDS,
        few_keys=True,
        store_input=store_input,
        rows_per_task=rows_per_task,
    )


def visit_history_by_customer(
    sales: DataFrame, *, store_input: bool = False, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Visits in time order per guest, in bands of 30, 90 and 180 days."""
    return _history(
        sales,
        key=F.col("customer_id"),
        key_name="customer_id",
        previous="previous_visit_ts",
        bands=CUSTOMER_BANDS,
        few_keys=False,
        store_input=store_input,
        rows_per_task=rows_per_task,
    )


def _history(
    sales: DataFrame,
    *,
    key: Column,
    key_name: str,
    previous: str,
    bands: LoyaltyBands,
    few_keys: bool,
    store_input: bool,
    rows_per_task: int,
) -> DataFrame:
    visits = sales.select(
        "transaction_id", "venue_id", "venue_type", "transaction_ts", "net_amount", key.alias(key_name)
    )
    if store_input:
        visits = store(visits, "visits")
    numbered = visit_numbers(
        visits,
        key=key_name,
        ts="transaction_ts",
        ties=["transaction_id"],
        number="customer_visit_number",
        previous=previous,
        few_keys=few_keys,
        rows_per_task=rows_per_task,
    )
    return numbered.withColumn(
        "days_since_last_visit", day_gap(F.col(previous), F.col("transaction_ts"))
    ).withColumn(
        "customer_loyalty_segment",
        bands.label(F.col("customer_visit_number"), F.col("days_since_last_visit")),
    )


def fct_retention(history: DataFrame) -> DataFrame:
    """Bookings, revenue and visit gaps by month, venue type and segment.

    The last measure is the plain average of the net amount per visit.
    """
    return (
        history.groupBy(
            month_start(F.col("transaction_ts")).alias("forecast_month"), "venue_type", "customer_loyalty_segment"
        )
        .agg(
            F.count_distinct("transaction_id").alias("total_bookings"),
            total("net_amount").alias("realized_revenue"),
            mean("days_since_last_visit").alias("average_days_between_visit"),
            mean_rounded("net_amount", 2).alias("customer_lifetime_value_increment"),
        )
        .orderBy(F.desc("forecast_month"), F.desc("total_bookings"), "venue_type", "customer_loyalty_segment")
    )
