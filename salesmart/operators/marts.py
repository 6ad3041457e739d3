"""The venue performance mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.amounts import mean_money, total
from salesmart.schema import VENUE


ITEM_SOLD = [*VENUE, "category", "item_name"]
WHEN = ["day_of_week", "month"]
#: All that the mart is made from.
MART_COLUMNS = [
    *ITEM_SOLD, *WHEN, "transaction_id", "quantity", "unit_price", "gross_amount", "discount_amount", "net_amount", "loaded_at",
]


def fct_venue_performance(staged: DataFrame, *, pieces: int | None = None) -> DataFrame:
    """Sales per venue, item, weekday and month name, all years together.

    Rows are shuffled once, by group, and ids are counted in place: the texts of a
    group are most of a row, and a second shuffle would move them again.  A group
    has one task, which spills; even one item of one venue has a group for each
    weekday and month.

    ``pieces``: tasks hold one of so many pieces of a weekday and month, for a writer
    by these.
    """
    if pieces is None:
        return _performance(staged.repartition(*ITEM_SOLD, *WHEN), [*ITEM_SOLD, *WHEN])
    piece = F.pmod(F.xxhash64(*ITEM_SOLD), F.lit(pieces))
    rows = staged.withColumn("__piece", piece).repartition(*WHEN, "__piece")
    # It follows from the group, and tells the planner that groups are together.
    return _performance(rows, [*ITEM_SOLD, *WHEN, "__piece"]).drop("__piece")


def _performance(rows: DataFrame, group: list[str]) -> DataFrame:
    return rows.groupBy(*group).agg(
        F.sum("quantity").alias("total_units_sold"),
        F.count_distinct("transaction_id").alias("total_transactions"),
        total("gross_amount").alias("total_gross_revenue"),
        total("discount_amount").alias("total_discounts_given"),
        total("net_amount").alias("total_net_revenue"),
        mean_money("unit_price").alias("average_item_price"),
        F.max("loaded_at").alias("last_pipeline_update"),
    )
