"""A stored visit history that daily loads extend."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.dates import month_start
from salesmart.operators import sequences
from salesmart.operators.numbering import BROADCAST_ROWS, ROWS_PER_TASK
from salesmart.operators.sequences import NUMBER, ORDER, TS, Sequence
from salesmart.sources.shared import scratch, store, store_counted
from salesmart.sources.versions import commit, current, drop_unlisted, new_folder

#: Parts of the keys: a late visit reopens the files of its key's part only.
PARTS = 8
#: Late keys up to so many are named to the scan, which skips files by them.
NAMED_KEYS = 1000
#: Visits numbered at a time, as far as the parts allow: what they shuffle is on disk.
ROWS_PER_SLICE = 20_000_000
COMPRESSION = "zstd"
_STATE = "name string, n bigint, last struct<transaction_ts:timestamp_ntz,transaction_id:string,venue_id:string,venue_type:string,net_amount:decimal(8,2)>"
_MOVES = _STATE.replace("n bigint, last", "since") + ", version int"
_VISITS = (
    "transaction_ts timestamp_ntz, transaction_id string, venue_id string, venue_type string, net_amount decimal(8,2),"
    " {key} string, customer_visit_number bigint, {previous} timestamp_ntz, version int, name string, load string, part int, month date"
)


def _part(name: Column) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(PARTS)).cast("int")


def _read(spark: SparkSession, base: str, names: list[str], schema: str) -> DataFrame:
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{name}" for name in names])


def _visits(spark: SparkSession, base: str, contents: dict, how: Sequence) -> DataFrame:
    rows = _read(spark, base, contents.get("visits", []), _VISITS.format(key=how.key_name, previous=how.previous))
    for written in contents.get("rewritten", []):
        # Folders, so that they are not listed to be read.
        old = F.col("load").isin([name.removeprefix("load=") for name in written["visits"]]) & F.col("part").isin(written["parts"])
        if written["month"]:
            old &= F.coalesce(F.col("month") >= F.lit(date.fromisoformat(written["month"])), F.lit(False))
        rows = rows.where(~old)
    return rows


def _live(spark: SparkSession, base: str, contents: dict, how: Sequence, visits: DataFrame) -> DataFrame:
    if not contents.get("moves"):
        return visits
    moves = _read(spark, base, contents["moves"], _MOVES)
    # Counted when they were written.
    moves = F.broadcast(moves) if contents["moved_keys"] <= BROADCAST_ROWS else moves
    return sequences.live(visits, moves, how.key_name)


def extend(sales: DataFrame, base: str, how: Sequence, *, load: str | None = None, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Number the visits of one load and make them part of the history in ``base``.

    Reads the state of the keys and, for keys with late visits, the visits from the
    first late one on; visits of other keys are not read.  Loads may come in any
    order and rows may repeat: the history equals a full run over all of them.
    Returns the version; a load without rows makes none.  A named ``load`` is taken
    once: a second time its version is returned and nothing is done.  A load that fails leaves the version before; two at a
    time on one folder end in a ``Conflict`` for one.

    Moved visits are left where they were and their keys noted, to be passed over by
    readers.  With more late keys than are broadcast, readers would shuffle all visits
    for that: the months from the first late visit on are then written anew in the
    parts with late visits, and readers leave the old folders out.

    Numbers are made for as many parts of the keys at a time as ``ROWS_PER_SLICE`` allows.
    """
    spark = sales.sparkSession
    number, contents = current(spark, base)
    if load is not None and load in contents.get("loads", {}):
        return contents["loads"][load]
    with scratch(spark):
        batch = how.visits(sales).withColumn("part", _part(sequences.name_of(how.key_name)))
        batch, rows = store_counted(batch, "load", by=["part"], compression=COMPRESSION)
        if not rows:
            return number
        state = sequences.newest_state(_read(spark, base, contents.get("state", []), _STATE))
        touched = batch.select(sequences.name_of(how.key_name).alias("name")).distinct()
        state = store(state.join(touched, "name", "left_semi"), "state")
        late, n_late = store_counted(sequences.late_keys(batch, state, how.key_name), "late")
        reach = reached(late) if n_late else None
        rewrite = n_late > BROADCAST_ROWS
        if rewrite:
            rows += _candidates(spark, base, contents, how, reach).count()
        name = new_folder("load=")
        for parts in _slices(-(-rows // ROWS_PER_SLICE)):
            with scratch(spark):
                own = _part(F.col("name")).isin(parts)
                some, kept, moved = batch.where(F.col("part").isin(parts)).drop("part"), None, None
                if n_late:
                    known = moved_candidates(spark, base, contents, how, late, n_late, reach, parts)
                if rewrite:
                    known = store(sequences.marked_visits(known, late.where(own), how.key_name), "known", compression=COMPRESSION)
                    moved, kept = known.where("moved").drop("moved"), known.where("NOT moved").drop("moved")
                elif n_late:
                    moved = store(sequences.moved_visits(known, late.where(own), how.key_name), "moved")
                numbered = sequences.continued(some, state.where(own), moved, how, rows_per_task)
                numbered = numbered if kept is None else numbered.unionByName(kept)
                _write(numbered.withColumn("version", F.lit(number + 1)), f"{base}/{name}", how)
        if rewrite:
            written = {"visits": contents.get("visits", []), "parts": reach.parts, "month": reach.month and reach.month.isoformat()}
            contents["rewritten"] = [*contents.get("rewritten", []), written]
        contents["visits"] = [*contents.get("visits", []), name]
        contents["loads"] = contents.get("loads", {}) | ({load: number + 1} if load is not None else {})
        name = new_folder("state-")
        sequences.next_state(state, batch, how.key_name).write.parquet(f"{base}/{name}")
        contents["state"] = [*contents.get("state", []), name]
        if n_late and not rewrite:
            name = new_folder("moves-")
            late.withColumn("version", F.lit(number + 1)).write.parquet(f"{base}/{name}")
            contents["moves"] = [*contents.get("moves", []), name]
            contents["moved_keys"] = contents.get("moved_keys", 0) + n_late
        commit(spark, base, number + 1, contents)
    return number + 1


def _slices(n: int) -> list[list[int]]:
    """The parts of the keys in ``n`` groups, or one by one."""
    n = min(n, PARTS)
    return [list(range(k, PARTS, n)) for k in range(n)]


def _write(visits: DataFrame, folder: str, how: Sequence) -> None:
    """Add numbered visits to a folder, by part of the keys and month, sorted by key."""
    (
        visits.withColumn("part", _part(sequences.name_of(how.key_name)))
        .withColumn("month", month_start(F.col(TS)))
        .hint("rebalance", "part", "month")
        .withColumn("name", sequences.name_of(how.key_name))
        .sortWithinPartitions("part", "month", "name", NUMBER)
        .write.mode("append")
        .parquet(folder, partitionBy=["part", "month"], compression=COMPRESSION)
    )


class Reach(NamedTuple):
    """Parts of the keys with late visits, and the month of the first; none if it has no time."""

    parts: list[int]
    month: date | None


def reached(late: DataFrame) -> Reach:
    since = F.col(f"since.{TS}")
    parts, month, timeless = late.agg(F.collect_set(_part(F.col("name"))), F.min(month_start(since)), F.count_if(since.isNull())).first()
    return Reach(sorted(parts), None if timeless else month)


def _candidates(spark: SparkSession, base: str, contents: dict, how: Sequence, reach: Reach, parts: Iterable[int] | None = None) -> DataFrame:
    of = [p for p in reach.parts if parts is None or p in parts]
    visits = _visits(spark, base, contents, how).where(F.col("part").isin(*of) if of else F.lit(False))
    return visits if reach.month is None else visits.where(F.col("month") >= F.lit(reach.month))


def moved_candidates(
    spark: SparkSession,
    base: str,
    contents: dict,
    how: Sequence,
    late: DataFrame,
    n_late: int,
    reach: Reach | None = None,
    parts: Iterable[int] | None = None,
) -> DataFrame:
    """Live visits in the parts (of these, if given) and from the months where late visits fall."""
    visits = _candidates(spark, base, contents, how, reach or reached(late), parts)
    # Where folders are written anew, they need the visits of all keys.
    if n_late <= min(NAMED_KEYS, BROADCAST_ROWS):
        visits = visits.where(F.col("name").isin(*[r["name"] for r in late.select("name").collect()]))
    return _live(spark, base, contents, how, visits).select(*ORDER, how.key_name, NUMBER, how.previous)


def months_of(spark: SparkSession, base: str, how: Sequence, versions: Iterable[int]) -> list[date | None]:
    """Months in which these versions number visits, or wrote them anew."""
    _, contents = current(spark, base)
    rows = _visits(spark, base, contents, how).where(F.col("version").isin(*versions))
    return [r["month"] for r in rows.select("month").distinct().collect()]


def sizes(spark: SparkSession, base: str, how: Sequence, months: list[date | None]) -> dict[date | None, int]:
    """Visits stored for each of these months, with those that were numbered again."""
    _, contents = current(spark, base)
    rows = _visits(spark, base, contents, how).groupBy("month").count().collect()
    return {r["month"]: r["count"] for r in rows if r["month"] in months}


def history(spark: SparkSession, base: str, how: Sequence, months: list[date | None] | None = None) -> DataFrame:
    """The history as ``visit_history`` or ``visit_history_by_customer`` gives it, of all
    months or of some."""
    _, contents = current(spark, base)
    rows = _visits(spark, base, contents, how)
    if months is not None:
        rows = rows.where(F.col("month").isin(*[m for m in months if m]) | (F.col("month").isNull() & F.lit(None in months)))
    rows = _live(spark, base, contents, how, rows)
    return how.labelled(rows.select("transaction_id", "venue_id", "venue_type", TS, "net_amount", how.key_name, NUMBER, how.previous))


def compact(spark: SparkSession, base: str, how: Sequence) -> int:
    """Rewrite the live visits and the newest state as one folder each, and delete what
    only older versions list.  Readers of older versions must have ended."""
    number, contents = current(spark, base)
    visits, state = new_folder("load="), new_folder("state-")
    rows = _live(spark, base, contents, how, _visits(spark, base, contents, how))
    _write(rows.drop("load", "part", "month", "name"), f"{base}/{visits}", how)
    sequences.newest_state(_read(spark, base, contents.get("state", []), _STATE)).write.parquet(f"{base}/{state}")
    commit(spark, base, number + 1, {"visits": [visits], "state": [state], "loads": contents.get("loads", {})})
    drop_unlisted(spark, base, {visits, state})
    return number + 1
