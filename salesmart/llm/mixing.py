"""Sources mixed to target weights by repeating and drawing documents.

A document is taken as often as the whole part of its source's rate says, and once
more with a probability equal to the rest.  The draw is a hash of the document's
id, held against the point below which the draws hold that share of the source's
words.  Held against the bare share instead, a few long documents would carry a
source far from its target.

Everything here is DataFrame expressions.  Sizes are summed by source before the
shuffle; the table of sources is stored, so that the planner knows its size when
it joins it to the documents: as a broadcast below its threshold, else shuffled,
with a crowded source split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.sources.shared import store

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: A source is repeated at most so often.
MOST = 3
SEED = 42
#: Tasks that number the sources.
NUMBERING_TASKS = 16

_WORDS = r"[^\x20\x09-\x0D]+"
#: A draw is one of so many equal steps, and has so many hexadecimal digits.
STEPS, _DIGITS = 4096, 3


def size_of(text: str = "text") -> Column:
    """Words between blanks; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(_WORDS)), F.lit(0)).cast("long")


def draw(doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> Column:
    """A step from 0 to below ``STEPS`` that depends on the id alone, or on the text
    where the id is null."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.col(text), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, _DIGITS), 16, 10).cast("int")


def numbered(sources: DataFrame, tasks: int = NUMBERING_TASKS) -> DataFrame:
    """Position of each source by code point, null last, without one task for all:
    ranges are numbered apart and moved by the sizes of those before."""
    ranged = store(
        sources.repartitionByRange(tasks, F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()),
        "mix-ranges",
    )
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # One row for each of the ranges: a window over all of them is small.
    before = F.expr("sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    earlier = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.expr("row_number() OVER (PARTITION BY part ORDER BY source ASC NULLS LAST) - 1")
    return (
        ranged.withColumn("place", within)
        .join(earlier, "part")
        .select("source", "source_size", (F.col("before") + F.col("place")).alias("place"))
    )


def source_targets(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """source, source_size, target, ``whole`` (copies that each of its documents has)
    and ``cut`` (documents drawn below it have one more), one row per source.

    Targets share the size of all documents by weight.  One that would exceed
    ``most`` times its source stops there, and what it leaves is shared by weight
    among the rest, until none exceeds.  Each round is one aggregate of the
    sources to a single row; there are as many rounds as targets stop in turn.
    """
    drawn = docs.select("source", draw(seed=seed).alias("step"), size_of().alias("size"))
    steps = store(drawn.groupBy("source", "step").agg(F.sum("size").alias("size")), "mix-steps")
    sizes = steps.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sources = store(numbered(sizes).select("source", "source_size", weight.cast("long").alias("weight")), "mix-sources")
    limit = F.col("source_size") * most
    whole = sources.agg(F.sum("source_size")).first()[0] or 0
    share, shared_by, stopped = 0, 1, -1
    while True:
        # A source stops if weight * share / shared_by exceeds its limit.
        stops = F.col("weight").cast("decimal(38,0)") * share > limit.cast("decimal(38,0)") * shared_by if stopped >= 0 else F.lit(False)
        row = sources.agg(
            F.count_if(stops).alias("n"),
            F.coalesce(F.sum(F.when(stops, limit)), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~stops, F.col("weight"))), F.lit(0)).alias("weights"),
        ).first()
        if row["n"] == stopped or not row["weights"]:
            break
        share, shared_by, stopped = whole - row["held"], row["weights"], row["n"]
    free = F.col("weight") * share / F.lit(shared_by)
    target = F.least(free, limit.cast("double"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = sources.select("source", "source_size", target.alias("target")).withColumn("whole", F.floor(rate))
    targets = store(targets.withColumn("more", (rate - F.floor(rate)) * F.col("source_size")), "mix-rates")
    cut = _cuts(steps, targets.select(F.col("source").alias("_source"), "more"))
    joined = targets.join(cut, F.col("source").eqNullSafe(F.col("_source")), "left")
    cut = F.coalesce(F.col("cut"), F.lit(0))
    return store(joined.select("source", "source_size", "target", "whole", cut.alias("cut")), "mix-targets")


def _cuts(steps: DataFrame, more: DataFrame) -> DataFrame:
    """The cut of each source below which its documents' words are nearest to
    ``more``; the lower of two.  A source has at most ``STEPS`` rows here."""
    upto = F.expr("sum(size) OVER (PARTITION BY source ORDER BY step)")
    summed = steps.withColumn("upto", upto).join(more, F.col("source").eqNullSafe(F.col("_source")))
    best = F.min(F.struct(F.abs(F.col("upto") - F.col("more")).alias("off"), (F.col("step") + 1).alias("cut"))).alias("best")
    found = summed.groupBy("_source", "more").agg(best)
    return found.select("_source", F.when(F.col("best.off") < F.col("more"), F.col("best.cut")).otherwise(0).alias("cut"))


def mix(docs: DataFrame, targets: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with size, source_size, target and ``copies``, by ``targets`` made with
    the same seed.

    The draw belongs to the document, so reruns and lost executors decide alike,
    and repeated rows of a document too.  A source without words has target 0 and
    its documents no copies.  Null is a source like any other.  Columns of these
    names in ``docs`` are replaced.
    """
    made = ("size", "source_size", "target", "copies", "whole", "cut")
    own = docs.drop(*made).withColumn("size", size_of())
    joined = own.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left")
    extra = F.when(draw(seed=seed) < F.col("cut"), 1).otherwise(0)
    return joined.withColumn("copies", (F.col("whole") + extra).cast("long")).drop("_source", "whole", "cut")


def emit(mixed: DataFrame) -> DataFrame:
    """Each row as many times as it has copies."""
    repeated = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return mixed.where(F.col("copies") > 0).withColumn("_copy", repeated).drop("_copy")
