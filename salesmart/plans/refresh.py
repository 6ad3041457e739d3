"""Reports kept up to date by the parts that new rows touch.

A report is stored in parts that follow from the day of sale: a day, or a month and
weekday, or a month.  A load changes the parts its days fall in; these are computed
anew from the rows of their days and take the place of the old ones, and the files of
all other parts stay as they are.  Raw rows by day of sale are read for those days
only.  What is written depends on the raw rows alone, so a refresh that was lost, or
is done twice, is simply done again.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.guests import fct_retention
from salesmart.operators.marts import MART_COLUMNS, fct_venue_performance
from salesmart.operators.sales import daily_revenue_weekend_split
from salesmart.operators.sequences import Sequence
from salesmart.operators.staging import STAGED_COLUMNS, stg_transactions
from salesmart.plans import visit_store
from salesmart.schema import LOAD_DAY
from salesmart.sources.shared import scratch

#: Parts of the venue mart: it has a row for each name of a month and of a weekday, and
#: these follow from the date (``derive.with_calendar``).
MONTH, WEEKDAY = "part_month", "part_weekday"
_DAY = "transaction_date"


def touched_days(raw: DataFrame, since: datetime) -> list[date]:
    """Days of sale of the rows loaded since then: as many as the loads have days."""
    rows = raw.filter(F.col("loaded_at") >= F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz"))
    if LOAD_DAY in raw.columns:
        rows = rows.filter(F.col(LOAD_DAY) >= since.date())
    return sorted(r[0] for r in rows.select(_DAY).distinct().collect())


#: Tasks that a part of the venue mart is computed and written by, at most.
PIECES = 16
#: Rows aggregated at a time, as far as the parts allow: what they shuffle is on disk.
ROWS_PER_SLICE = 20_000_000


def _slices(sizes: dict) -> list[list]:
    """The parts, given with their rows, in groups of ``ROWS_PER_SLICE`` rows at most, or one by one."""
    slices, room = [], 0
    for part, rows in sizes.items():
        if not slices or rows > room:
            slices.append([])
            room = ROWS_PER_SLICE
        slices[-1].append(part)
        room -= rows
    return slices


def _replace_parts(result: DataFrame, folder: str, parts: list[str], *, rebalance: bool = True) -> None:
    """Write ``result`` by parts; a part that is written takes the place of the old one."""
    result = result.hint("rebalance", *parts) if rebalance else result
    writer = result.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*parts).parquet(folder)


def refresh_daily_revenue(raw: DataFrame, folder: str, days: Iterable[date]) -> None:
    """Daily revenue of ``days``, in a part for each day."""
    rows = raw.filter(F.col(_DAY).isin(*days))
    _replace_parts(daily_revenue_weekend_split(rows), folder, [_DAY])


def read_daily_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)


def _venue_parts(day: Column) -> tuple[Column, Column]:
    return F.month(day), F.weekday(day)


def refresh_venue_performance(raw: DataFrame, folder: str, days: Iterable[date]) -> None:
    """The venue mart's rows of the months and weekdays that ``days`` fall in.

    Their ids are counted over all days of these parts, so an id that occurs on
    several of them counts once.  84 parts cover any calendar.  ``raw`` needs the mart's
    columns and the day of sale, and is read once for each slice of the parts.
    """
    month, weekday = _venue_parts(F.col(_DAY))
    # A part for each of the days at most; on the column of the day this picks folders.
    parts = sorted({(d.month, d.weekday()) for d in days})
    numbered = raw.withColumn("__number", month * 7 + weekday)
    numbered = numbered.filter(F.col("__number").isin(*[m * 7 + w for m, w in parts]))
    with scratch(raw.sparkSession):
        sizes = dict(sorted(tuple(r) for r in numbered.groupBy("__number").count().collect()))
        for some in _slices(sizes):
            rows = raw.filter((month * 7 + weekday).isin(*some))
            first = F.min(F.struct(*[c.alias(n) for c, n in zip(_venue_parts(F.col(_DAY)), (MONTH, WEEKDAY), strict=True)]))
            numbers = rows.groupBy("month", "day_of_week").agg(first.alias("__part")).select("month", "day_of_week", "__part.*")
            # A row for each of the parts at most.
            staged = stg_transactions(rows, [c for c in STAGED_COLUMNS if c in MART_COLUMNS])
            mart = fct_venue_performance(staged, pieces=PIECES).join(F.broadcast(numbers), ["month", "day_of_week"])
            _replace_parts(mart, folder, [MONTH, WEEKDAY], rebalance=False)


def read_venue_performance(spark: SparkSession, folder: str) -> DataFrame:
    mart = spark.read.parquet(folder).drop(MONTH, WEEKDAY)
    first = ["venue_id", "venue_name", "venue_type", "city", "region", "category", "item_name", "day_of_week", "month"]
    return mart.select(*first, *[c for c in mart.columns if c not in first])


def refresh_retention(spark: SparkSession, visits: str, folder: str, how: Sequence, versions: Iterable[int]) -> None:
    """The retention mart's months in which these versions of the history number visits.

    A late visit moves later ones, whose months the version then holds as well.
    """
    months = visit_store.months_of(spark, visits, how, versions)
    with scratch(spark):
        for some in _slices(visit_store.sizes(spark, visits, how, months)):
            rows = visit_store.history(spark, visits, how, some)
            mart = fct_retention(rows).withColumn("month", F.col("forecast_month"))
            _replace_parts(mart, folder, ["month"])


def read_retention(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder).drop("month")


def refresh_all(raw: DataFrame, base: str, how: Sequence, *, since: datetime) -> list[date]:
    """One load into the history and all reports below ``base``; its days of sale."""
    days = touched_days(raw, since)
    if days:
        spark = raw.sparkSession
        refresh_daily_revenue(raw, f"{base}/daily", days)
        refresh_venue_performance(raw, f"{base}/venues", days)
        loaded = raw.filter(F.col("loaded_at") >= F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz"))
        version = visit_store.extend(loaded, f"{base}/visits", how, load=since.isoformat())
        refresh_retention(spark, f"{base}/visits", f"{base}/retention", how, [version])
    return days
