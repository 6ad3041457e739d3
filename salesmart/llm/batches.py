"""Row functions over Arrow batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of texts that are taken at once.  Cuts fall on rows, so a longer text is a
#: slice of its own.
SLICE_BYTES = 1_000_000


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


#: Applications whose executors have this package.
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for each application, so that it need
    not be installed there.  Spark hands the file on to every executor, late ones
    included."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).parents[1]
    archive = Path(tempfile.mkdtemp(prefix=f"{package.name}-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def map_batches(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str
) -> DataFrame:
    """``mapInArrow`` with a function of this package."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about ``most`` bytes, so that a batch of long
    texts is not unpacked at once."""
    if batch.num_rows == 0:
        return
    rows = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def append_columns(df: DataFrame, inputs: list[str], make: Callable[[], Callable[..., list[list]]], ddl: str, most: int = SLICE_BYTES) -> DataFrame:
    """``df`` and new columns.  ``make()`` once per partition; what it returns
    takes the ``inputs`` as lists and returns one list per new column.  The new
    columns replace those of the same name; what the row holds besides is
    passed on untouched.  ``most``: bytes of a slice."""
    added = schema_of(ddl)
    rest = [c for c in df.columns if c not in added.names]
    schema = T.StructType([df.schema[c] for c in rest] + added.fields)
    needed = list(dict.fromkeys(rest + inputs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        columns_of = make()
        for batch in batches:
            for part in slices(batch, most):
                new = columns_of(*(part.column(c).to_pylist() for c in inputs))
                arrays = [part.column(c).cast(arrow.field(c).type) for c in rest]
                arrays += [pa.array(values, arrow.field(name).type) for values, name in zip(new, added.names, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return map_batches(df.select(*needed), run, schema)
