"""Visit numbers carried forward from a state per key.

The state of a key is its number of visits and its last visit.  New visits after it
are numbered from there, without a look at older ones.  A late visit, one before the
last, moves all that follow: the visits of that key from its place on are numbered
again, and only those.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.dates import day_gap
from salesmart.functions.guests import CUSTOMER_BANDS, SEGMENT_BANDS, LoyaltyBands, segment_key
from salesmart.operators.numbering import ROWS_PER_TASK, visit_numbers

TS, ID, NUMBER = "transaction_ts", "transaction_id", "customer_visit_number"
#: Columns of a visit in the order that sorts it within its key.
ORDER = [TS, ID, "venue_id", "venue_type", "net_amount"]


@dataclass(frozen=True)
class Sequence:
    """How visits are grouped and labelled."""

    key_name: str
    previous: str
    bands: LoyaltyBands
    few_keys: bool

    def key(self) -> Column:
        return segment_key() if self.key_name == "customer_surrogate_id" else F.col(self.key_name)

    def visits(self, sales: DataFrame) -> DataFrame:
        return sales.select(*ORDER, self.key().alias(self.key_name))

    def labelled(self, numbered: DataFrame) -> DataFrame:
        gap = day_gap(F.col(self.previous), F.col(TS))
        rows = numbered.withColumn("days_since_last_visit", gap)
        return rows.withColumn("customer_loyalty_segment", self.bands.label(F.col(NUMBER), F.col("days_since_last_visit")))


SEGMENTS = Sequence("customer_surrogate_id", "previous_transaction_ts", SEGMENT_BANDS, True)
CUSTOMERS = Sequence("customer_id", "previous_visit_ts", CUSTOMER_BANDS, False)


def name_of(key: str) -> Column:
    """The key as text that is never NULL, so that equal keys meet in equi-joins."""
    return F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit(""))


def key_of(name: Column) -> Column:
    """The key, a text, that ``name_of`` gave this name."""
    return F.when(name != "", F.substring(name, 2, 2**31 - 1))


def place() -> Column:
    """What sorts a visit within its key; structs compare as the window does, NULL first."""
    return F.struct(*ORDER)


def state_of(visits: DataFrame, key: str) -> DataFrame:
    """(name, n, last): visits and the last one of each key."""
    return visits.groupBy(name_of(key).alias("name")).agg(F.count(F.lit(1)).alias("n"), F.max(place()).alias("last"))


def late_keys(batch: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """(name, since): keys of ``batch`` with a visit before the last known one, and the
    first such visit.  A visit equal to the last one follows it."""
    firsts = batch.groupBy(name_of(key).alias("name")).agg(F.min(place()).alias("since"))
    return firsts.join(state, "name").where(F.col("since") < F.col("last")).select("name", "since")


def moved_visits(known: DataFrame, late: DataFrame, key: str) -> DataFrame:
    """Known visits that follow a late one."""
    late = late.select(F.col("name").alias("__late"), "since")
    # Name and place are worked out in the join, so that no shuffle carries them.
    return known.join(late, (name_of(key) == F.col("__late")) & (place() > F.col("since"))).select(*known.columns)


def marked_visits(known: DataFrame, late: DataFrame, key: str) -> DataFrame:
    """Known visits with ``moved``: whether they follow a late one of their key."""
    late = late.select(F.col("name").alias("__late"), "since")
    rows = known.join(late, name_of(key) == F.col("__late"), "left")
    return rows.select(*known.columns, F.coalesce(place() > F.col("since"), F.lit(False)).alias("moved"))


def continued(
    batch: DataFrame, state: DataFrame, moved: DataFrame | None, how: Sequence, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """The visits of ``batch`` and the ``moved`` ones (numbered visits), numbered.

    Where a key has moved visits, counting starts before the first of them; else
    after the last known visit.  Keys have any size: see ``visit_numbers``.
    """
    key, columns = how.key_name, batch.columns
    before = state.select(F.col("name").alias("__name"), F.col("n").alias("__n"), F.col(f"last.{TS}").alias("__last"))
    if moved is not None:
        start = moved.groupBy(name_of(key).alias("__moved")).agg(
            F.count(F.lit(1)).alias("__behind"), F.min_by(how.previous, NUMBER).alias("__first")
        )
        before = before.join(start, F.col("__name") == F.col("__moved"), "left").select(
            "__name",
            (F.col("__n") - F.coalesce("__behind", F.lit(0))).alias("__n"),
            F.when(F.col("__behind").isNull(), F.col("__last")).otherwise(F.col("__first")).alias("__last"),
        )
        batch = batch.unionByName(moved.select(*columns))
    # Numbered by the name, which the state is joined by: rows are shuffled once for both.
    numbered = visit_numbers(
        batch.select(*ORDER, name_of(key).alias("__key")),
        key="__key",
        ts=TS,
        ties=ORDER[1:],
        number=NUMBER,
        previous=how.previous,
        few_keys=how.few_keys,
        rows_per_task=rows_per_task,
    )
    first = F.col(NUMBER) == 1
    named = numbered.join(before, F.col("__key") == F.col("__name"), "left").withColumn(key, key_of(F.col("__key")))
    return named.select(
        *columns,
        (F.col(NUMBER) + F.coalesce("__n", F.lit(0))).alias(NUMBER),
        F.when(first, F.col("__last")).otherwise(F.col(how.previous)).alias(how.previous),
    )


def next_state(state: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """New state of the keys of ``batch``."""
    new = state_of(batch, key)
    old = state.select("name", F.col("n").alias("__n"), F.col("last").alias("__last"))
    return new.join(old, "name", "left").select(
        "name", (F.col("n") + F.coalesce("__n", F.lit(0))).alias("n"), F.greatest("last", "__last").alias("last")
    )


def newest_state(states: DataFrame) -> DataFrame:
    """Of several states of a key the newest, which has counted most visits."""
    newest = F.max_by(F.struct("n", "last"), "n").alias("s")
    return states.groupBy("name").agg(newest).select("name", "s.n", "s.last")


def live(visits: DataFrame, moves: DataFrame, key: str) -> DataFrame:
    """Numbered ``visits`` (with the ``version`` that wrote them) without those that a
    later version numbered again.  ``moves``: (name, since, version)."""
    # Name and place are worked out in the join, so that no shuffle carries them.
    again = [name_of(key) == F.col("__late"), F.col("version") < F.col("__moved"), place() > F.col("since")]
    moves = moves.select(F.col("name").alias("__late"), "since", F.col("version").alias("__moved"))
    return visits.join(moves, reduce(Column.__and__, again), "left_anti")
