"""Intermediate tables in the folder every executor can reach."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_dir(spark: SparkSession) -> str:
    """Folder named by the session, or a scratch folder for a master whose
    executors are threads of the driver."""
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="salesmart-"))
    return spark.sparkContext.getCheckpointDir()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """What is stored inside lasts until the end of the block.

    It goes to one folder, which is deleted at the end, also after an error.
    DataFrames that read it must have been used by then.  What a query inside
    shuffles is deleted when that query ends, not when the driver collects garbage.
    """
    folder = f"{shared_dir(spark)}/scratch-{uuid4().hex}"
    token, before = _scratch.set(folder), spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield folder
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)
        _scratch.reset(token)
        delete(spark, folder)


def delete(spark: SparkSession, folder: str) -> None:
    """``folder`` and all in it, in whatever store it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder, or in the ``scratch`` block's, not used before."""
    return f"{_scratch.get() or shared_dir(spark)}/{name}-{uuid4().hex}"


def store(df: DataFrame, name: str, *, by: Iterable[str] = (), compression: str | None = None) -> DataFrame:
    """Write ``df`` once, in folders ``by`` these columns, and read it back.

    What depends on it is not computed again when executors are lost, later
    readers scan only the columns they need, and its size is known to the
    planner.  It stays until the ``scratch`` block around the call ends; without
    one, until the folder of the session is cleaned.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path, partitionBy=list(by), compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def store_counted(df: DataFrame, name: str, **how) -> tuple[DataFrame, int]:
    """``store``, and the number of rows, counted while they are written."""
    counted = Observation()
    stored = store(df.observe(counted, F.count(F.lit(1)).alias("rows")), name, **how)
    return stored, counted.get["rows"]
