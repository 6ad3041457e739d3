"""Stored tables: raw sales, run log, quality log and published results."""

from __future__ import annotations

import json
from datetime import datetime
from urllib.parse import quote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.operators.quality import dq_summary
from salesmart.schema import LOAD_COLUMNS, LOAD_DAY, QUALITY_LOG, RUN_LOG, SALES
from salesmart.sources.shared import delete
from salesmart.sources.versions import exists, files_below, move_file, names_in, publish_file, read_file

PARTITIONS = [LOAD_DAY, "transaction_date"]
# Folder of a table, hidden from its readers, for batches on their way.
BATCHES = "_batches"
# Fixed value: schema of tables that name none.
DEFAULT_SCHEMA = "default"


def _ddl(schema: T.StructType) -> str:
    return ", ".join(
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
    )


def _moment(as_of: datetime | None) -> Column:
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def table_folder(spark: SparkSession, table: str) -> str:
    """Where the rows of a table are."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.where("col_name = 'Location'").first()["data_type"].rstrip("/")


def _new_folder(spark: SparkSession, table: str) -> str:
    """A folder for the next version of a table, beside the one it was created with."""
    return f"{table_folder(spark, table).split('.versions/')[0]}.versions/{uuid4().hex}"


def _switch(spark: SparkSession, table: str, folder: str) -> None:
    """Make ``folder`` what the table holds, in one change of the catalogue.

    The version before stays, for those who read it and to go back to; older ones
    and what failed builds left are deleted.  One build of a table at a time.
    """
    before = table_folder(spark, table)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    versions = folder.rsplit("/", 1)[0]
    kept = {folder.rsplit("/", 1)[1], before.rsplit("/", 1)[1]}
    for name in names_in(spark, versions):
        if name not in kept:
            delete(spark, f"{versions}/{name}")


def _create_sales_table(spark: SparkSession, table: str) -> None:
    """The raw table by day of loading and of sale, if it is not there.

    Days are found in its folder and not listed in the catalogue, so that a change
    of the folder changes them all at once.
    """
    setting = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        columns = f"{_ddl(SALES)}, {LOAD_DAY} date"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY ({', '.join(PARTITIONS)})")
    finally:
        spark.conf.set(setting, before)


def replace_sales_table(spark: SparkSession, table: str) -> None:
    """Create the raw table, or empty it; the rows before stay in their folder."""
    _create_sales_table(spark, table)
    folder = _new_folder(spark, table)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    _switch(spark, table, folder)


def replace_rows(rows: DataFrame, table: str, *, as_of: datetime | None = None) -> int:
    """Make ``rows`` all that the raw table holds and return their number.

    They are written to a folder of their own first: if that fails, the table is as
    it was, and a reader sees the rows before or the new ones, never none.
    """
    spark = rows.sparkSession
    _create_sales_table(spark, table)
    folder = _new_folder(spark, table)
    n = _write_days(rows, as_of, lambda out: out.parquet(folder))
    _switch(spark, table, folder)
    return n


def to_load(rows: DataFrame, *, as_of: datetime | None = None) -> DataFrame:
    """The load columns, all filled, with ``loaded_at`` stamped if absent."""
    columns = [_required(c) for c in LOAD_COLUMNS]
    columns.append(_required("loaded_at") if "loaded_at" in rows.columns else _moment(as_of).alias("loaded_at"))
    return rows.select(*columns)


def _required(column: str) -> Column:
    missing = F.raise_error(F.lit(f"{column} must not be NULL")).cast(SALES[column].dataType)
    return F.when(F.col(column).isNotNull(), F.col(column)).otherwise(missing).alias(column)


def _write_days(rows: DataFrame, as_of: datetime | None, write) -> int:
    """Write a batch by day and return its number of rows, counted on the way.

    The rebalance gives each day few files and cuts a large day into several tasks.
    """
    counted = Observation()
    batch = to_load(rows, as_of=as_of).withColumn(LOAD_DAY, F.to_date("loaded_at")).hint("rebalance", *PARTITIONS)
    write(batch.observe(counted, F.count(F.lit(1)).alias("rows")).write.partitionBy(*PARTITIONS))
    return counted.get["rows"]


def append_rows(rows: DataFrame, table: str, *, as_of: datetime | None = None) -> int:
    """Append a batch to the raw table and return its number of rows."""
    return _write_days(rows, as_of, lambda out: out.mode("append").format("parquet").saveAsTable(table))


def batch_rows(spark: SparkSession, table: str, batch: str) -> int | None:
    """Rows of a batch that the raw table holds, None if it does not hold it."""
    marker = _marker(table_folder(spark, table), batch)
    return json.loads(read_file(spark, marker))["rows"] if exists(spark, marker) else None


def append_batch(rows: DataFrame, table: str, batch: str, *, as_of: datetime | None = None) -> int:
    """Append a batch once, however often it is tried, and return its number of rows.

    The rows are written to a hidden folder of the table.  A marker with the name of
    the batch then lists their files: from there on the batch counts, and its files
    are moved to their days.  A run after a crash writes anew before the marker and
    goes on moving after it; a batch that has its marker is not read again.
    """
    spark = rows.sparkSession
    finish_batches(spark, table)
    done = batch_rows(spark, table, batch)
    if done is not None:
        return done
    folder = table_folder(spark, table)
    hidden = f"{folder}/{BATCHES}/{uuid4().hex}"
    n = _write_days(rows, as_of, lambda out: out.parquet(hidden))
    files = [f for f in files_below(spark, hidden) if f.endswith(".parquet")]
    if not publish_file(spark, _marker(folder, batch), json.dumps({"rows": n, "from": hidden.rsplit("/", 1)[1], "files": files})):
        # Another run of this batch was first.
        delete(spark, hidden)
    finish_batches(spark, table)
    return batch_rows(spark, table, batch)


def finish_batches(spark: SparkSession, table: str) -> None:
    """Move what batches with a marker still have in their hidden folder."""
    folder = table_folder(spark, table)
    names = names_in(spark, f"{folder}/{BATCHES}")
    for name in names:
        if name.endswith(".json"):
            batch = json.loads(read_file(spark, f"{folder}/{BATCHES}/{name}"))
            if batch["from"] in names:
                for file in batch["files"]:
                    move_file(spark, f"{folder}/{BATCHES}/{batch['from']}/{file}", f"{folder}/{file}")
                delete(spark, f"{folder}/{BATCHES}/{batch['from']}")
    spark.catalog.refreshTable(table)


def _marker(folder: str, batch: str) -> str:
    return f"{folder}/{BATCHES}/{quote(batch, safe='')}.json"


def read_sales_table(spark: SparkSession, table: str, *, load_day: bool = False) -> DataFrame:
    """The 24 columns of the fact, and the day of loading if asked for."""
    return spark.table(table).select(*SALES.names, *[LOAD_DAY] * load_day)


def create_run_log(spark: SparkSession, table: str) -> None:
    """A log with a small file per run, named by its id."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_ddl(RUN_LOG)}) USING json")


def log_run(
    spark: SparkSession,
    table: str,
    *,
    pipeline_name: str,
    rows_copied: int | None = None,
    run_status: str = "SUCCESS",
    notes: str | None = None,
    as_of: datetime | None = None,
    batch: str | None = None,
) -> DataFrame:
    """Log one run under the next id and return its row.

    The id is taken by creating the run's file, which must not exist yet; of several
    writers one gets it and the others try the next, so ids are different and
    without gaps.  A ``batch`` is logged once: a second time its row is returned.
    """
    folder = table_folder(spark, table)
    if batch is not None:
        logged = spark.read.schema(_logged_batches()).json(folder).where(F.col("batch") == batch)
        if row := logged.orderBy("log_id").first():
            spark.catalog.refreshTable(table)
            return spark.table(table).where(F.col("log_id") == row["log_id"])
    moment = as_of or spark.range(1).select(_moment(None)).first()[0]
    entry = {
        "pipeline_name": pipeline_name,
        "run_timestamp": moment.isoformat(),
        "rows_copied": rows_copied,
        "run_status": run_status,
        "notes": notes,
        "batch": batch,
    }
    log_id = _last_id(spark, folder) + 1
    while not publish_file(spark, _run_file(folder, log_id), json.dumps({"log_id": log_id} | entry) + "\n"):
        log_id += 1
    spark.catalog.refreshTable(table)
    return spark.table(table).where(F.col("log_id") == log_id)


def _logged_batches() -> T.StructType:
    return T.StructType([RUN_LOG["log_id"], T.StructField("batch", T.StringType())])


def _run_file(folder: str, log_id: int) -> str:
    return f"{folder}/run-{log_id:010d}.json"


def _last_id(spark: SparkSession, folder: str) -> int:
    """The highest id; ids have no gaps, so it is searched by halves."""
    high = 1
    while exists(spark, _run_file(folder, high)):
        high *= 2
    low = high // 2
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if exists(spark, _run_file(folder, middle)) else (low, middle)
    return low


def run_history(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).orderBy(F.desc("run_timestamp"), F.desc("log_id"))


def create_quality_log(spark: SparkSession, table: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_ddl(QUALITY_LOG)}) USING parquet")


def log_quality(sales: DataFrame, table: str, *, as_of: datetime | None = None) -> None:
    """Check the whole table and append the summary."""
    summary = dq_summary(sales).withColumn("check_timestamp", _moment(as_of))
    summary.select(*QUALITY_LOG.names).write.insertInto(table)


def schema_name(custom: str | None, default: str = DEFAULT_SCHEMA) -> str:
    """The schema a result is published in: the custom name trimmed and in
    capitals, or the default as it is."""
    return default if custom is None else custom.strip().upper()


def publish_table(result: DataFrame, name: str, *, schema: str | None = None) -> DataFrame:
    """Rebuild a stored result and return it as read back.

    The new rows are written aside and then take the place of the old ones, which
    stay in their folder until the next build.  Only a result whose columns have
    changed is a new table, for a moment without rows.
    """
    spark = result.sparkSession
    target = schema_name(schema)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {target}")
    table = f"{target}.{name}"
    wanted = [(f.name, f.dataType) for f in result.schema]
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, source="parquet", schema=result.schema)
    folder = _new_folder(spark, table)
    result.write.parquet(folder)
    if [(f.name, f.dataType) for f in spark.table(table).schema] != wanted:
        spark.sql(f"DROP TABLE {table}")
        spark.catalog.createTable(table, source="parquet", schema=result.schema)
    _switch(spark, table, folder)
    return spark.table(table)


def publish_view(result: DataFrame, name: str) -> DataFrame:
    """Make a result available to SQL under a name without storing it."""
    result.createOrReplaceTempView(name)
    return result.sparkSession.table(name)
