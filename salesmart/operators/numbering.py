"""Row numbers, previous values and ranks inside groups of any size.

A window puts one group into one task.  That is the right plan while groups
fit, so ``visit_numbers`` first counts them.  Groups above ``rows_per_task`` are
cut into ordered parts that fit, as many as their rows ask for; each part is
numbered on its own, and the totals of the parts before it are added.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.sources.shared import store, store_counted

ROWS_PER_TASK = 5_000_000
# A year has 35,000 such pieces: few enough for one task even over decades, and
# short enough that a key with billions of rows fits rows_per_task in each.
PIECE_MINUTES = 15
COPIES_PER_STEP = 100_000
# Bands of a measure while it grows by a factor of e.
BANDS_PER_E = 1000
# Small tables with up to so many rows are broadcast; their number is counted.
BROADCAST_ROWS = 100_000


def visit_numbers(
    rows: DataFrame,
    *,
    key: str,
    ts: str,
    ties: list[str],
    number: str,
    previous: str,
    few_keys: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add each row's position within ``key`` by time and the ``ts`` before it.

    Rows equal in ``ts`` are ordered by ``ties``, then by the other columns, so
    only exact copies are interchangeable.  ``few_keys``: large keys hold most rows,
    so that pieces are counted over all rows, without a join before.
    """
    order = [ts, *ties, *[c for c in rows.columns if c not in (key, ts, *ties)]]
    # Never NULL, so that equal keys meet in ordinary equi-joins below.
    name = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit(""))
    minute = F.unix_date(F.to_date(ts)) * 1440 + F.hour(ts) * 60 + F.minute(ts)
    piece = F.coalesce(F.floor(minute / PIECE_MINUTES).cast("int"), F.lit(-(10**9)))
    counted = [F.count("*").alias("__rows"), F.max(ts).alias("__last")]
    group = ["__group", "__piece"]

    keys = rows.groupBy(name.alias("__group")).agg(F.count("*").alias("__rows"))
    large_keys, n_large = store_counted(keys.filter(F.col("__rows") > rows_per_task), "large-keys")
    if not n_large:
        return _numbered(rows, [key], order, ts, number, previous)

    large_keys = _small(large_keys.select("__group", F.lit(True).alias("__is_large")), n_large)
    pieces = (
        rows.withColumn("__group", name)
        .join(large_keys, "__group", "left")
        .withColumn("__piece", F.when(F.col("__is_large"), piece).otherwise(0))
    )
    # One row per large key and piece: as long as the calendar, not the data.
    if few_keys:
        sizes = rows.groupBy(name.alias("__group"), piece.alias("__piece")).agg(*counted)
        sizes = store(sizes.join(large_keys, "__group", "left_semi"), "pieces")
    else:
        sizes = store(pieces.filter("__is_large").groupBy(*group).agg(*counted), "pieces")
    pieces = pieces.drop("__is_large")
    earlier = Window.partitionBy("__group").orderBy("__piece")
    offsets = sizes.select(
        *group,
        F.sum("__rows").over(earlier.rowsBetween(Window.unboundedPreceding, -1)).alias("__before"),
        F.lag("__last").over(earlier).alias("__last_before"),
    )
    crowded, n_crowded = store_counted(sizes.filter(F.col("__rows") > rows_per_task), "crowded-pieces")

    if not n_crowded:
        parts = [_numbered(pieces, group, order, ts, number, previous)]
    else:
        slices = -(-crowded.agg(F.sum("__rows")).first()[0] // rows_per_task)
        crowded = _small(crowded.select(*group), n_crowded)
        parts = [
            _numbered(pieces.join(crowded, group, "left_anti"), group, order, ts, number, previous),
            _numbered_in_slices(pieces.join(crowded, group, "left_semi"), group, order, ts, number, previous, slices),
        ]
    finished = [
        part.join(offsets, group, "left").select(
            *rows.columns,
            (F.col(number) + F.coalesce("__before", F.lit(0))).alias(number),
            F.when(F.col(number) == 1, F.col("__last_before")).otherwise(F.col(previous)).alias(previous),
        )
        for part in parts
    ]
    return reduce(DataFrame.unionByName, finished)


def rank_descending(rows: DataFrame, *, group: str, measure: str, rank: str) -> DataFrame:
    """Add ``RANK()`` of ``measure`` within ``group``, largest first.

    Nothing runs when this is called.  The rank of a value is one more than the
    rows that hold a larger one, so distinct values are ranked, weighted by
    their rows.  Values fall in bands that follow the order of the measure: a
    window numbers the values of one band, and the rows of the bands above it
    are added from a table with a row for each band.
    """
    values = rows.groupBy(group, measure).agg(F.count("*").alias("__weight")).withColumn("__band", _band(measure))
    part = [F.col(group), F.col("__band")]
    above = Window.partitionBy(*part).orderBy(F.desc(measure)).rowsBetween(Window.unboundedPreceding, -1)
    numbered = values.withColumn("__above", F.coalesce(F.sum("__weight").over(above), F.lit(0)))
    bands = values.groupBy(F.col(group).alias("__of"), F.col("__band").alias("__in")).agg(F.sum("__weight").alias("__rows"))
    higher = Window.partitionBy("__of").orderBy(F.desc("__in")).rowsBetween(Window.unboundedPreceding, -1)
    bands = bands.select("__of", "__in", F.coalesce(F.sum("__rows").over(higher), F.lit(0)).alias("__before"))
    in_band = F.col(group).eqNullSafe(F.col("__of")) & (F.col("__band") == F.col("__in"))
    ranked = numbered.join(bands, in_band).select(
        F.col(group).alias("__group"),
        F.col(measure).alias("__value"),
        (F.col("__before") + F.col("__above") + 1).cast("int").alias(rank),
    )
    same = F.col(group).eqNullSafe(F.col("__group")) & F.col(measure).eqNullSafe(F.col("__value"))
    return rows.join(ranked, same).select(*rows.columns, rank)


def _band(measure: str) -> Column:
    """A whole number that never falls as the measure grows; NULL is lowest.  At
    most a few hundred thousand bands cover every number, each a tenth of a
    percent wide or less."""
    value = F.col(measure).cast("double")
    band = F.floor(F.signum(value) * F.log1p(F.abs(value) * 100) * BANDS_PER_E)
    return F.coalesce(band, F.lit(-(2**40)))


def _small(table: DataFrame, n: int) -> DataFrame:
    """``table`` of ``n`` rows, sent to all tasks if that is few; else the planner
    decides, and a shuffled join works as well."""
    return F.broadcast(table) if n <= BROADCAST_ROWS else table


def _numbered(
    rows: DataFrame, group: list[str], order: list[str], ts: str, number: str, previous: str
) -> DataFrame:
    in_order = Window.partitionBy(*group).orderBy(*order)
    return rows.select(
        "*",
        F.row_number().over(in_order).cast("bigint").alias(number),
        F.lag(ts).over(in_order).alias(previous),
    )


def _numbered_in_slices(
    rows: DataFrame, group: list[str], order: list[str], ts: str, number: str, previous: str, slices: int
) -> DataFrame:
    """Number rows crowded into one piece, however many share one moment, in
    ``slices`` parts of about the same size.

    Exact copies become one row with a count, after which the order has no
    ties and range partitioning can cut anywhere.  Copies are restored last.
    """
    distinct = rows.groupBy(*rows.columns).agg(F.count("*").alias("__copies"))
    firsts = _first_numbers(distinct, group, [F.asc(c) for c in order], "__copies", number, ts, previous, slices)

    single = firsts.filter("__copies = 1").drop("__copies")
    repeated = (
        firsts.filter("__copies > 1")
        .withColumn("__step", F.explode(F.expr(f"sequence(0, (__copies - 1) div {COPIES_PER_STEP})")))
        .repartition(*group, number, "__step")
        .withColumn(
            "__copy",
            F.explode(
                F.expr(
                    f"sequence(__step * {COPIES_PER_STEP},"
                    f" least(__copies, (__step + 1) * {COPIES_PER_STEP}) - 1)"
                )
            ),
        )
        .withColumn(previous, F.when(F.col("__copy") == 0, F.col(previous)).otherwise(F.col(ts)))
        .withColumn(number, F.col(number) + F.col("__copy"))
        .drop("__copies", "__step", "__copy")
    )
    return single.unionByName(repeated)


def _first_numbers(
    rows: DataFrame,
    group: list[str],
    order: list[Column],
    weight: str,
    number: str,
    carry: str | None = None,
    previous: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Give each row one more than the weights before it in its group.

    ``group`` and ``order`` together must identify a row.  Spark samples them
    to cut all rows into even ordered slices; a group may span many slices and
    a slice may hold many groups.  With ``carry``, also give the value it had
    in the row before.
    """
    part = [*group, "__slice"]
    within = Window.partitionBy(*part).orderBy(*order)
    added = [
        (F.sum(weight).over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col(weight) + 1).alias(number)
    ]
    if carry:
        added.append(F.lag(carry).over(within).alias(previous))
    # Stored, because which row is in which slice must not be decided twice.
    sliced = store(
        _in_ranges(rows, slices, *group, *order).withColumn("__slice", F.spark_partition_id()).select("*", *added),
        "slices",
    )

    totals = sliced.groupBy(*part).agg(
        F.sum(weight).alias("__weight"), F.max(carry).alias("__last") if carry else F.lit(None).alias("__last")
    )
    earlier = Window.partitionBy(*group).orderBy("__slice")
    # Only the first group of a slice can have begun before it: one row per
    # slice at most, whatever the data.
    begun = totals.select(
        *[F.col(c).alias(f"__begun_{c}") for c in part],
        F.sum("__weight").over(earlier.rowsBetween(Window.unboundedPreceding, -1)).alias("__before"),
        F.lag("__last").over(earlier).alias("__last_before"),
    ).filter("__before IS NOT NULL")

    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__begun_{c}")) for c in part])
    result = sliced.join(_small(begun, slices or 0), same, "left")
    columns = [F.col(c) for c in rows.columns]
    if carry:
        first = F.col(number) == 1
        columns.append(F.when(first, F.col("__last_before")).otherwise(F.col(previous)).alias(previous))
    columns.append((F.col(number) + F.coalesce("__before", F.lit(0))).alias(number))
    return result.select(*columns)


def _in_ranges(rows: DataFrame, n: int | None, *columns: Column | str) -> DataFrame:
    """Even ordered slices: ``n`` of them, or as many as the session shuffles into."""
    return rows.repartitionByRange(n, *columns) if n else rows.repartitionByRange(*columns)
