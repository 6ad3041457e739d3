"""All reports without arguments from one scan of the sales.

The reports group the same measures by different columns.  One aggregate with
grouping sets computes them all; its result, which has a row per group of each
report, is stored, and every report is read from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.amounts import mean_money, total
from salesmart.operators import sales as reports
from salesmart.schema import ITEM, VENUE
from salesmart.sources.shared import store

#: Columns of each grouping set; the first of each is in no other.
GROUPS = {
    "day": ("transaction_date", *VENUE),
    "item": ("item_name", *(c for c in ITEM if c != "item_name")),
    "payment": ("payment_method", "venue_type"),
    "month": ("month_num", "month", "venue_type"),
}


def grouped(sales: DataFrame) -> DataFrame:
    """One row per group of each set, and which ``grouping`` it is.

    Rows are combined before the only shuffle.  Of the columns that a set does not
    have, its rows are null; a null among a set's own columns is a group.
    """
    columns = list(dict.fromkeys(c for group in GROUPS.values() for c in group))
    sets = [[F.col(c) for c in group] for group in GROUPS.values()]
    which = F.coalesce(*(F.when(F.grouping(group[0]) == 0, F.lit(name)) for name, group in GROUPS.items()))
    weekend = F.col("is_weekend")
    return sales.groupingSets(sets, *columns).agg(
        which.alias("grouping"),
        F.count("*").alias("n"),
        F.sum("quantity").alias("quantity"),
        total("gross_amount").alias("gross"),
        total("discount_amount").alias("discount"),
        total("net_amount").alias("net"),
        mean_money("net_amount").alias("mean_net"),
        mean_money("unit_price").alias("mean_price"),
        total(F.when(weekend, F.col("net_amount")).otherwise(0)).alias("weekend_net"),
        total(F.when(~weekend, F.col("net_amount")).otherwise(0)).alias("weekday_net"),
    )


def all_reports(sales: DataFrame, *, ranks: int = 10) -> dict[str, DataFrame]:
    """The reports by name, equal to those of ``operators.sales``.

    ``sales`` is scanned once, when this is called; the reports then show that
    moment.  Inside ``scratch`` they last until its end.
    """
    stored = store(grouped(sales), "reports")

    def part(name: str, **measures: str) -> DataFrame:
        rows = stored.where(F.col("grouping") == name)
        return rows.select(*GROUPS[name], *(F.col(own).alias(shown) for shown, own in measures.items()))

    return {
        "daily_revenue": part(
            "day", transaction_count="n", items_sold="quantity", gross_revenue="gross", total_discounts="discount",
            net_revenue="net", avg_transaction_value="mean_net", weekend_revenue="weekend_net", weekday_revenue="weekday_net",
        ),
        "category_performance": reports.rank_items(
            part("item", times_ordered="n", total_quantity="quantity", total_revenue="net", avg_price="mean_price")
        ),
        "top_items": reports.leading_items(
            part("item", times_ordered="n", total_quantity_sold="quantity", total_revenue="net", avg_unit_price="mean_price"), ranks
        ),
        "payment_split": reports.with_share(part("payment", transaction_count="n", total_revenue="net")),
        "monthly_trend": reports.with_growth(
            reports.with_previous(part("month", transactions="n", net_revenue="net", discounts_given="discount", avg_basket="mean_net"))
        ),
    }
