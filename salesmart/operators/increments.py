"""What a daily copy takes from the source and what it may skip."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.schema import LOAD_DAY

# Fixed value: a daily run reads one hour more than a day.
WINDOW = timedelta(hours=25)


def incremental_extract(sales: DataFrame, *, as_of: datetime, window: timedelta = WINDOW) -> DataFrame:
    """Rows loaded since ``as_of - window``, that moment included.

    The bound is a constant on a bare column, so it reaches the scan; with the
    raw table's day of loading at hand, other days' files are not even opened.
    """
    since = as_of - window
    rows = sales.filter(F.col("loaded_at") >= F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz"))
    if LOAD_DAY in sales.columns:
        rows = rows.filter(F.col(LOAD_DAY) >= since.date()).drop(LOAD_DAY)
    return rows


def latest_per_transaction(sales: DataFrame, *, key: str = "transaction_id") -> DataFrame:
    """The row loaded last for each id; equal rows count once.

    An aggregate, not a window: rows of one id that a task reads merge before the
    shuffle.  Rows are sorted for it at their full width.
    """
    rest = [c for c in sales.columns if c not in (key, "loaded_at")]
    newest = F.max(F.struct("loaded_at", *rest)).alias("newest")
    return sales.groupBy(key).agg(newest).select(key, "newest.*").select(*sales.columns)


def not_yet_copied(batch: DataFrame, target: DataFrame, *, as_of: datetime, window: timedelta = WINDOW) -> DataFrame:
    """Rows of ``batch`` that ``target`` lacks, one per id.

    Only the part of ``target`` inside the window is compared, by id and time of
    loading: a row stamped again is a new version and is appended next to the old
    one.  ``latest_per_transaction`` takes the newest when reading.
    """
    copied = incremental_extract(target, as_of=as_of, window=window).select("transaction_id", "loaded_at").distinct()
    return latest_per_transaction(batch).join(copied, ["transaction_id", "loaded_at"], "left_anti").select(
        *batch.columns
    )
