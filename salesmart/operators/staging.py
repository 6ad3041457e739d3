"""Raw sales to staged sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.schema import MONEY, SALES

# Everything but the guest's id.
STAGED_COLUMNS = [name for name in SALES.names if name != "customer_id"]
WHOLE_NUMBERS = ["quantity", "discount_pct"]
AMOUNTS = ["unit_price", "gross_amount", "discount_amount", "net_amount"]


def stg_transactions(transactions: DataFrame, columns: list[str] = STAGED_COLUMNS) -> DataFrame:
    """Staged columns, or some of them, with their declared types.

    Under ANSI mode, Spark's default, a value that does not fit its type is an
    error instead of NULL.
    """
    types = dict.fromkeys(WHOLE_NUMBERS, "int") | dict.fromkeys(AMOUNTS, MONEY)
    return transactions.select(
        *[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in columns]
    )
