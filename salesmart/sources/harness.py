"""The sales fact built from the order tables the queries are checked on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.dates import padded_id
from salesmart.operators.derive import with_amounts, with_calendar
from salesmart.schema import SALES

# The columns used, declared so that no footer has to be read to plan a query.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_discount double, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_type string, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}

# Order lines carry no time of day, so minutes are spread over the day.
PRICED = {
    "transaction_id": "concat('T', concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey))",
    "venue_id": "concat('V', s_suppkey)",
    "venue_name": "s_name",
    "venue_type": "CASE s_nationkey % 3 WHEN 0 THEN 'Hotel' WHEN 1 THEN 'Pub' ELSE 'Restaurant' END",
    "city": "n_name",
    "region": "r_name",
    "transaction_ts": "l_shipdate + make_dt_interval(0, 0,"
    " CAST((l_partkey * 37 + l_suppkey * 11 + l_linenumber * 101) % 1440 AS INT), 0)",
    "item_name": "p_name",
    "category": "p_type",
    "quantity": "CAST(l_quantity AS INT)",
    "unit_price": "CAST(p_retailprice AS DECIMAL(8,2))",
    "discount_pct": "CAST(round(l_discount * 100) AS INT)",
    "payment_method": "CASE o_orderpriority WHEN '1-URGENT' THEN 'App' WHEN '4-NOT SPECIFIED' THEN 'Card'"
    " WHEN '5-LOW' THEN 'Cash' ELSE 'Contactless' END",
}


def sales_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 24 columns of the fact, one row per order line.

    Lines are shuffled while they are numbers: to their orders, then to their
    parts, and names are added in place after that.  Orders and parts grow with
    the lines, so these two joins are shuffled at any size and what they move
    grows with the rows; skewed keys are split at run time.  The planner
    broadcasts suppliers, and their nations and regions, one by one: of a join
    among them it would not know that it is small.
    """

    def table(name: str) -> DataFrame:
        return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")

    lines = (
        table("lineitem")
        .join(table("orders").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("part").hint("merge"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    priced = lines.select(
        *[F.expr(sql).alias(name) for name, sql in PRICED.items()],
        padded_id("CUST", 5, F.col("o_custkey")).alias("customer_id"),
    )
    return with_calendar(with_amounts(priced)).withColumn(
        "loaded_at",
        # The daily load runs at six in the morning after the sale.
        F.date_add("transaction_date", 1).cast("timestamp_ntz") + F.expr("INTERVAL 6 HOURS"),
    ).select(*SALES.names)

