"""The sales fact, its log tables and the column lists operators share."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(8, 2)

# One row per sold line.  Names and types are fixed: they must equal those of
# the tables a user already has.
SALES = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("venue_id", T.StringType(), False),
        T.StructField("venue_name", T.StringType(), False),
        T.StructField("venue_type", T.StringType(), False),
        T.StructField("city", T.StringType(), False),
        T.StructField("region", T.StringType(), False),
        T.StructField("transaction_date", T.DateType(), False),
        T.StructField("transaction_time", T.StringType(), False),
        T.StructField("transaction_ts", T.TimestampNTZType(), False),
        T.StructField("item_name", T.StringType(), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("quantity", T.IntegerType(), False),
        T.StructField("unit_price", MONEY, False),
        T.StructField("gross_amount", MONEY, False),
        T.StructField("discount_pct", T.IntegerType(), False),
        T.StructField("discount_amount", MONEY, False),
        T.StructField("net_amount", MONEY, False),
        T.StructField("payment_method", T.StringType(), False),
        T.StructField("is_weekend", T.BooleanType(), False),
        T.StructField("day_of_week", T.StringType(), False),
        T.StructField("month", T.StringType(), False),
        T.StructField("month_num", T.IntegerType(), False),
        T.StructField("loaded_at", T.TimestampNTZType(), False),
    ]
)

LOAD_COLUMNS = [name for name in SALES.names if name != "loaded_at"]

# The stored raw table also keeps the day of loading, as its first partition
# column: a daily extract then opens the files of two days only.
LOAD_DAY = "loaded_on"

SALES_CSV = T.StructType([SALES[name] for name in LOAD_COLUMNS])

RUN_LOG = T.StructType(
    [
        T.StructField("log_id", T.IntegerType(), False),
        T.StructField("pipeline_name", T.StringType(), False),
        T.StructField("run_timestamp", T.TimestampNTZType(), False),
        T.StructField("rows_copied", T.LongType()),
        T.StructField("run_status", T.StringType(), False),
        T.StructField("notes", T.StringType()),
    ]
)

QUALITY_LOG = T.StructType(
    [
        T.StructField("check_timestamp", T.TimestampNTZType(), False),
        T.StructField("total_rows", T.LongType()),
        T.StructField("null_amounts", T.LongType()),
        T.StructField("duplicate_ids", T.LongType()),
        T.StructField("negative_amounts", T.LongType()),
        T.StructField("check_status", T.StringType()),
    ]
)

# Fixed value: the venue types the quality test accepts.
VENUE_TYPES = ["Hotel", "Pub", "Restaurant"]

VENUE = ["venue_id", "venue_name", "venue_type", "city", "region"]
ITEM = ["venue_type", "category", "item_name"]
