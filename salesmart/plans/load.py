"""Load CSV files into the raw table."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from salesmart.sources.csv_sales import read_good_files
from salesmart.sources.shared import scratch
from salesmart.sources.tables import append_rows, replace_rows


class Loaded(NamedTuple):
    """Rows appended, and the files left out with their bad rows."""

    rows: int
    rejected: DataFrame


def load_csv(
    spark: SparkSession,
    path: str | list[str],
    table: str,
    *,
    replace: bool = False,
    multiline: bool = False,
    as_of: datetime | None = None,
) -> Loaded:
    """Append all files without a bad row; with ``replace`` their rows become all
    that the table holds.

    The files are read and checked before the table is touched: a wrong path is
    an error, and if no good row is found, or the load fails later, the table stays
    as it is.  The parsed copy is deleted after the load.
    """
    with scratch(spark):
        good, checked = read_good_files(spark, path, multiline=multiline)
        rows = 0
        if not good.isEmpty():
            rows = (replace_rows if replace else append_rows)(good, table, as_of=as_of)
        # One small row for each file, as when the driver listed them.
        rejected = spark.createDataFrame(checked.collect(), checked.schema)
    return Loaded(rows, rejected)
