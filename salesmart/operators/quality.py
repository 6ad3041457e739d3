"""Data-quality checks.  A test returns its failing rows; none means it passed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.schema import VENUE_TYPES

# Columns the source must always fill.
REQUIRED = ["transaction_id", "transaction_ts", "net_amount"]


def unique(rows: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row.  NULL is no value."""
    return (
        rows.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def not_null(rows: DataFrame, columns: Sequence[str] = REQUIRED) -> DataFrame:
    """One row per missing value, with the name of its column, in one scan.

    The filter comes first so that the scan can skip parts with nothing missing.
    """
    incomplete = rows.filter(reduce(Column.__or__, [F.col(c).isNull() for c in columns]))
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return incomplete.select(F.explode(missing).alias("column_name"), "*")


def accepted_values(rows: DataFrame, column: str, values: Sequence[str] = VENUE_TYPES) -> DataFrame:
    """Values outside the list with their number of rows.  NULL passes."""
    return (
        rows.filter(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count("*").alias("n_records"))
    )


def source_tests(rows: DataFrame) -> DataFrame:
    """The five tests on the raw table: failures and PASS or FAIL of each.

    One scan: ids and the venue types that are not accepted are counted as
    values of two kinds, and what is missing is summed along with the ids.
    """
    missing = {f"not_null_{c}": F.col(c).isNull().cast("bigint") for c in REQUIRED}
    nothing = {name: F.lit(0).cast("bigint") for name in missing}
    id_entry = _entry("id", F.col("transaction_id").cast("string"), missing)
    venue_entry = F.when(~F.col("venue_type").isin(*VENUE_TYPES), _entry("venue", F.col("venue_type"), nothing))
    by_value = (
        rows.select(F.explode(F.array_compact(F.array(id_entry, venue_entry))).alias("entry"))
        .select("entry.*")
        .groupBy("kind", "value")
        .agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in missing])
    )
    repeated = (F.col("kind") == "id") & F.col("value").isNotNull() & (F.col("n") > 1)
    tests = {name: F.coalesce(F.sum(name), F.lit(0)) for name in missing} | {
        "accepted_values_venue_type": F.count_if(F.col("kind") == "venue"),
        "unique_transaction_id": F.count_if(repeated),
    }
    return (
        by_value.agg(*[n.cast("bigint").alias(name) for name, n in tests.items()])
        .unpivot([], [*tests], "test_name", "failures")
        .withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL"))
    )


def _entry(kind: str, value: Column, counters: dict[str, Column]) -> Column:
    return F.struct(F.lit(kind).alias("kind"), value.alias("value"), *[n.alias(c) for c, n in counters.items()])


def dq_summary(rows: DataFrame) -> DataFrame:
    """One row of counters and PASSED or FAILED.

    Sums over an empty table are NULL, which is not 0: it counts as FAILED.
    """
    passed = (F.col("null_amounts") == 0) & (F.col("duplicate_ids") == 0) & (F.col("negative_amounts") == 0)
    return rows.agg(
        F.count("*").alias("total_rows"),
        F.sum(F.when(F.col("net_amount").isNull(), 1).otherwise(0)).alias("null_amounts"),
        (F.count("*") - F.count_distinct("transaction_id")).alias("duplicate_ids"),
        F.sum(F.when(F.col("net_amount") < 0, 1).otherwise(0)).alias("negative_amounts"),
    ).withColumn("check_status", F.when(passed, "PASSED").otherwise("FAILED"))
