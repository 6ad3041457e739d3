"""Sales as CSV files.

Columns are found by the names in each file's header, in any order; further
columns are left out.  Fields may be quoted, with quotes inside doubled.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.schema import LOAD_COLUMNS, SALES_CSV
from salesmart.sources.shared import store

CORRUPT = "_corrupt_record"
FILE = "source_file"
# A path is a few hundred bytes, so this many fit any executor.
BROADCAST_FILES = 100_000
# Different headers in one load; more point to files that are no sales.
LAYOUTS = 1000
# About 200 MB of text.
ROWS_PER_FILE = 1_000_000
# Texts of a flag.
FLAGS = {"true": True, "1": True, "false": False, "0": False}


class CheckedFiles(NamedTuple):
    """Rows of the good files, and path and bad rows of each rejected one."""

    rows: DataFrame
    rejected: DataFrame


class _Layouts(NamedTuple):
    """Files by header, and path and number of lines of those that lack a column."""

    files: dict[tuple[str, ...], list[str]]
    lacking: list[tuple[str, int]]


def _layouts(spark: SparkSession, path: str | list[str]) -> _Layouts:
    """What the first line of each file says.

    The driver gets one line per file, which is what it also holds to list them.
    """
    line = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    first = (
        spark.read.text(path)
        .select(F.col("_metadata.file_path").alias(FILE), line.alias("line"))
        .groupBy(FILE)
        .agg(F.min("line").alias("line"), F.count("*").alias("lines"))
        .select(FILE, F.col("line.value").alias("header"), "lines")
    )
    files, lacking = defaultdict(list), []
    for name, header, lines in first.collect():
        columns = tuple(c.strip() for c in next(csv.reader([header.removeprefix("﻿")]), []))
        if set(LOAD_COLUMNS) <= set(columns):
            files[columns].append(name)
        else:
            lacking.append((name, lines - 1))
    if len(files) > LAYOUTS:
        raise ValueError(f"{len(files)} different headers; at most {LAYOUTS} are expected")
    return _Layouts(dict(files), lacking)


def _parsed(spark: SparkSession, files: dict[tuple[str, ...], list[str]], multiline: bool) -> DataFrame:
    """All load columns, the text of rows that do not parse, and their file.

    Flags are read as text, as they may be 0 and 1; a name that a header repeats
    counts where it stands first.
    """
    parts = []
    for header, paths in files.items():
        fields = []
        for i, name in enumerate(header):
            known = name in LOAD_COLUMNS and name not in header[:i]
            kind = SALES_CSV[name].dataType if known and name != "is_weekend" else T.StringType()
            fields.append(T.StructField(name if known else f"_other_{i}", kind))
        schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
        reader = spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        rows = reader.option("multiLine", multiline).csv(paths)
        parts.append(rows.select(*LOAD_COLUMNS, CORRUPT, F.col("_metadata.file_path").alias(FILE)))
    if not parts:
        schema = T.StructType([*SALES_CSV.fields, T.StructField(CORRUPT, T.StringType()), T.StructField(FILE, T.StringType())])
        return spark.createDataFrame([], schema)
    # At most LAYOUTS parts, and one for files of one kind.
    rows = reduce(DataFrame.unionByName, parts)
    flag = F.lower(F.trim("is_weekend"))
    value = reduce(lambda when, kv: when.when(flag == kv[0], kv[1]), FLAGS.items(), F)
    unknown = F.col("is_weekend").isNotNull() & ~flag.isin(*FLAGS)
    return rows.withColumns({"is_weekend": value, CORRUPT: F.coalesce(CORRUPT, F.when(unknown, F.col("is_weekend")))})


def read_sales_csv(spark: SparkSession, path: str | list[str], *, multiline: bool = False) -> DataFrame:
    """Typed sales; a value that does not parse is an error, as is a file that lacks
    a column, whichever columns are asked for.  Rows that a filter leaves out may
    not be looked at.

    ``multiline`` allows line breaks in quoted fields; a file is then read by one
    task.
    """
    files, lacking = _layouts(spark, path)
    if lacking:
        raise ValueError(f"columns are missing in {', '.join(sorted(name for name, _ in lacking))}")
    rows = _parsed(spark, files, multiline)
    error = F.raise_error(F.concat(F.lit("MALFORMED_RECORD in "), F.col(FILE), F.lit(": "), F.col(CORRUPT))).cast("boolean")
    # The filter names every column, so that none is left out of parsing.
    parsed = F.hash(*LOAD_COLUMNS) >= -(2**31)
    return rows.filter(F.when(F.col(CORRUPT).isNotNull(), error).otherwise(parsed)).select(*LOAD_COLUMNS)


def write_sales_csv(sales: DataFrame, path: str, *, compression: str | None = None) -> None:
    """Files with a header each.  Compressed ones are read by one task each, so they
    are kept to ``ROWS_PER_FILE``."""
    writer = sales.write.option("header", True).option("quote", '"').option("escape", '"')
    if compression is not None:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", ROWS_PER_FILE)
    writer.csv(path)


def read_good_files(spark: SparkSession, path: str | list[str], *, multiline: bool = False) -> CheckedFiles:
    """Skip every file in which any row is bad, or which lacks a column.

    A row is bad if it does not parse or leaves a column empty; all rows of a file
    that lacks a column are.  Files are parsed once into a stored table; finding
    the bad ones then reads only the columns that say so.
    """
    files, lacking = _layouts(spark, path)
    empty = reduce(Column.__or__, [F.col(c).isNull() for c in LOAD_COLUMNS])
    parsed = store(
        _parsed(spark, files, multiline).select(*LOAD_COLUMNS, (F.col(CORRUPT).isNotNull() | empty).alias("bad"), FILE),
        "parsed-csv",
    )
    rejected = store(parsed.filter("bad").groupBy(FILE).agg(F.count("*").alias("bad_rows")), "rejected-csv")

    n_rejected = rejected.count()
    good = parsed
    if n_rejected:
        skip = rejected.select(FILE)
        if n_rejected <= BROADCAST_FILES:
            skip = F.broadcast(skip)
        good = parsed.join(skip, FILE, "left_anti")
    if lacking:
        rejected = rejected.unionByName(spark.createDataFrame(lacking, f"{FILE} string, bad_rows long"))
    return CheckedFiles(good.select(*LOAD_COLUMNS), rejected)
