"""The daily copy of new sales into the raw table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from salesmart.operators.increments import incremental_extract, not_yet_copied
from salesmart.sources.tables import append_batch, append_rows, batch_rows, finish_batches, log_run, read_sales_table


def read_database_table(spark: SparkSession, options: dict[str, str], table: str) -> DataFrame:
    """A table of a database to extract from; filters on it run there.

    ``options`` are Spark's JDBC options, with ``partitionColumn`` and bounds
    to read in parallel.
    """
    return spark.read.format("jdbc").options(**options).option("dbtable", table).load()


def copy_increment(
    source: DataFrame, target: str, *, as_of: datetime, dedupe: bool = False, batch: str | None = None
) -> int:
    """Append the rows of the last 25 hours and return how many they are.

    Daily runs overlap by an hour, and rows in the overlap are appended twice.
    ``dedupe`` leaves out what the target already holds.  A ``batch`` is appended
    once, however often it is copied.
    """
    spark = source.sparkSession
    if batch is not None:
        finish_batches(spark, target)
        done = batch_rows(spark, target, batch)
        if done is not None:
            return done
    rows = incremental_extract(source, as_of=as_of)
    if dedupe:
        copied = read_sales_table(spark, target, load_day=True)
        rows = not_yet_copied(rows, copied, as_of=as_of)
    return append_rows(rows, target) if batch is None else append_batch(rows, target, batch)


def daily_copy(
    source: DataFrame,
    target: str,
    run_log: str,
    *,
    name: str,
    as_of: datetime,
    dedupe: bool = False,
) -> DataFrame:
    """Copy the increment, log the run and return its log row.

    Name and time make a batch: a run that is repeated, after it ended or after it
    was lost at any step, changes nothing that the first one did and does the rest.
    """
    batch = f"{name} {as_of.isoformat()}"
    copied = copy_increment(source, target, as_of=as_of, dedupe=dedupe, batch=batch)
    return log_run(source.sparkSession, run_log, pipeline_name=name, rows_copied=copied, as_of=as_of, batch=batch)
