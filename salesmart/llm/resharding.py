"""Rows moved between shards so that new capacities are met with the fewest bytes.

Rows are grouped in blocks by a hash of doc_id and text within their old shard; a row that
is large beside a shard is a block of its own.  A minimum-cost flow from the old
shards to the new capacities says how many bytes go where; whole blocks are then
chosen to carry it.  Sizes are summed by Spark; the driver sees blocks, of which
there is a fixed number, and never rows.  A layout is a folder of ``shard=``
partitions; the files of affected shards are then written anew, and a file that is
created once says when the new ones hold, so that a lost run can be finished.
"""

from __future__ import annotations

import json
from collections import Counter, defaultdict, deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from salesmart.sources import versions
from salesmart.sources.shared import delete, new_path

#: Shards of the layout that the query starts from.
OLD_SHARDS = 32
SHARDS = 40
#: Blocks of one old shard; a row above 1 / (shards * BLOCKS) of all bytes is a
#: block of its own, so there are at most shards * BLOCKS of these as well.
BLOCKS = 128
ROW_BYTES = 16
#: Bytes of the blocks of one shard that are sorted and written by one task.
PIECE_BYTES = 128_000_000
#: Says, in a layout, which files are to be deleted and moved.  Its name, like that
#: of the folder of new files, hides it from readers.
SWITCH = "_switch.json"


def size_of(text: str = "text") -> Column:
    """UTF-8 bytes and a fixed part for the row."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def crc_of(text: str = "text") -> Column:
    return F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def hashed_shard(shards: int = OLD_SHARDS) -> Column:
    """A layout that depends on doc_id alone."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")


class Flow:
    """Minimum-cost flow by cheapest augmenting paths."""

    def __init__(self, nodes: int) -> None:
        self.edges: list[list[int]] = []  # to, capacity left, cost; the reverse edge is next
        self.out: list[list[int]] = [[] for _ in range(nodes)]

    def add(self, a: int, b: int, capacity: int, cost: int) -> int:
        for at, edge in ((a, [b, capacity, cost]), (b, [a, 0, -cost])):
            self.out[at].append(len(self.edges))
            self.edges.append(edge)
        return len(self.edges) - 2

    def used(self, edge: int) -> int:
        return self.edges[edge ^ 1][1]

    def run(self, source: int, sink: int) -> None:
        while (via := self._cheapest(source, sink)) is not None:
            path, at = [], sink
            while at != source:
                path.append(via[at])
                at = self.edges[via[at] ^ 1][0]
            amount = min(self.edges[e][1] for e in path)
            for e in path:
                self.edges[e][1] -= amount
                self.edges[e ^ 1][1] += amount

    def _cheapest(self, source: int, sink: int) -> dict[int, int] | None:
        cost, via, todo, waiting = {source: 0}, {}, deque([source]), {source}
        while todo:
            at = todo.popleft()
            waiting.discard(at)
            for e in self.out[at]:
                to, left, price = self.edges[e]
                if left > 0 and cost[at] + price < cost.get(to, 1 << 62):
                    cost[to], via[to] = cost[at] + price, e
                    if to not in waiting:
                        waiting.add(to)
                        todo.append(to)
        return via if sink in cost else None


def transfers(sizes: dict[int, int], capacities: dict[int, int]) -> dict[tuple[int, int], int]:
    """Bytes from each old shard to each new one, itself included.  A byte that
    stays costs nothing, one that moves costs one."""
    old, new = sorted(sizes), sorted(capacities)
    flow = Flow(len(old) + len(new) + 2)
    source, sink = len(old) + len(new), len(old) + len(new) + 1
    for i, a in enumerate(old):
        flow.add(source, i, sizes[a], 0)
    for j, b in enumerate(new):
        flow.add(len(old) + j, sink, capacities[b], 0)
    moves = {(a, b): flow.add(i, len(old) + j, sizes[a], int(a != b)) for i, a in enumerate(old) for j, b in enumerate(new)}
    flow.run(source, sink)
    return {pair: n for pair, e in moves.items() if (n := flow.used(e))}


@dataclass
class Block:
    name: str
    old: int
    size: int
    rows: int


def place(blocks: list[Block], capacities: dict[int, int]) -> dict[str, int]:
    """A new shard for each block.  In each old shard the largest blocks first take
    the way with the most bytes left in the flow; then single blocks go from the
    fullest shard to the emptiest while that brings them closer."""
    sizes: dict[int, int] = defaultdict(int)
    for b in blocks:
        sizes[b.old] += b.size
    left: dict[int, dict[int, int]] = defaultdict(dict)
    for (a, b), n in transfers(dict(sizes), capacities).items():
        left[a][b] = n
    load = dict.fromkeys(capacities, 0)
    held: dict[int, list[Block]] = {shard: [] for shard in capacities}
    for b in sorted(blocks, key=lambda b: (-b.size, b.name)):
        ways = left[b.old]
        to = max(ways, key=lambda s: (ways[s], s == b.old, -s))
        ways[to] -= b.size
        load[to] += b.size
        held[to].append(b)
    spare = {s: load[s] - capacities[s] for s in load}
    for _ in range(4 * len(blocks)):
        full, empty = max(spare, key=lambda s: (spare[s], -s)), min(spare, key=lambda s: (spare[s], s))
        gap = spare[full] - spare[empty]
        fitting = [b for b in held[full] if 0 < b.size < gap]
        if not fitting:
            break
        b = min(fitting, key=lambda b: (abs(2 * b.size - gap), b.name))
        held[full].remove(b)
        held[empty].append(b)
        spare[full] -= b.size
        spare[empty] += b.size
    return {b.name: shard for shard, own in held.items() for b in own}


def with_block(sized: DataFrame, total: int, shards: int, blocks: int) -> DataFrame:
    """``sized`` (doc_id, size, text_crc32, old_shard, ...) and the name of each row's block."""
    number = F.pmod(F.shiftright(F.xxhash64("doc_id", "text_crc32"), 8), F.lit(blocks))
    alone = F.concat_ws("-", F.lit("row"), "old_shard", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "size")
    shared = F.concat_ws("-", F.lit("block"), "old_shard", number)
    return sized.withColumn("block", F.when(F.col("size") * (shards * blocks) > total, alone).otherwise(shared))


def _sized(docs: DataFrame, old: Column) -> DataFrame:
    own = docs.withColumn("old_shard", old.cast("int")).drop("shard", "slot", "block", "piece", "before")
    return own.withColumns({"size": size_of(), "text_crc32": crc_of()})


def _blocks(sized: DataFrame, shards: int, blocks: int) -> tuple[DataFrame, list[Block], int]:
    """Rows with their block, all blocks, and the bytes of all."""
    total = sized.agg(F.sum("size")).first()[0] or 0
    named = with_block(sized, total, shards, blocks)
    found = named.groupBy("block", "old_shard").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    return named, [Block(r["block"], r["old_shard"], r["size"], r["rows"]) for r in found], total


def _slotted(named: DataFrame, known: list[Block], to: dict[str, int]) -> DataFrame:
    """Rows with shard and slot.  Rows are shuffled once, by pieces of shards, so
    that what comes out can be written as it lies."""
    rows, size, piece, placed = Counter(), Counter(), Counter(), []
    tasks: dict[tuple[int, int], int] = {}
    for b in sorted(known, key=lambda b: b.name):
        shard = to[b.name]
        if size[shard] and size[shard] + b.size > PIECE_BYTES:
            size[shard], piece[shard] = 0, piece[shard] + 1
        task = tasks.setdefault((shard, piece[shard]), len(tasks))
        placed.append((b.name, shard, task, rows[shard]))
        rows[shard] += b.rows
        size[shard] += b.size
    # At most 2 * shards * blocks rows, as for ``known``.
    where = F.broadcast(named.sparkSession.createDataFrame(placed, "block string, shard int, piece int, before long"))
    # Each piece is a task of its own.
    dealt = named.join(where, "block").repartitionById(max(1, len(tasks)), "piece")
    nth = F.expr("row_number() OVER (PARTITION BY piece, block ORDER BY doc_id, text_crc32, size) - 1")
    return dealt.withColumn("slot", (F.col("before") + nth).cast("long")).drop("block", "piece", "before")


def reshard(docs: DataFrame, shards: int = SHARDS, old_shard: Column | None = None, blocks: int = BLOCKS) -> DataFrame:
    """``docs`` with size, text_crc32, old_shard, shard and slot (gapless from 0 in
    its shard, by block and doc_id).  Capacities are equal shares of all bytes.

    A null text has no bytes and the checksum of none.  Repeated rows and rows
    without a doc_id are rows like any other; rows that agree in doc_id and text
    share a block.  Columns of these names are replaced.
    """
    named, known, total = _blocks(_sized(docs, hashed_shard() if old_shard is None else old_shard), shards, blocks)
    return _slotted(named, known, place(known, dict.fromkeys(range(shards), -(-total // shards))))


def _moves(resharded: DataFrame) -> set[tuple[int, int]]:
    """Old and new shard of all rows."""
    return {(r["old_shard"], r["shard"]) for r in resharded.select("old_shard", "shard").distinct().collect()}  # one row for each pair


def _affected(moves: set[tuple[int, int]]) -> list[int]:
    return sorted({shard for pair in moves if pair[0] != pair[1] for shard in pair})


def affected(resharded: DataFrame) -> list[int]:
    """Shards that give or take rows, ascending."""
    return _affected(_moves(resharded))


def _write(rows: DataFrame, path: str) -> None:
    rows.drop("old_shard").sortWithinPartitions("shard", "slot").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).option("compression", "zstd").partitionBy("shard").parquet(path)


def rewrite(resharded: DataFrame, path: str) -> list[int]:
    """The files of affected shards written anew below ``path``, a folder of
    ``shard=`` partitions; those of other shards stay as they are.  Each file is
    sorted by slot.

    New files are complete before ``SWITCH`` names them and the old ones.  A run lost
    before that leaves the old layout, one lost after it is finished by ``recover``,
    which ``read_layout`` calls.  One rewrite of a layout at a time: a second one is
    refused.  ``resharded`` may read ``path``, but must not be used afterwards.
    """
    spark, moves = resharded.sparkSession, _moves(resharded)
    shards = _affected(moves)
    if not shards:
        return shards
    folder = versions.new_folder("_anew-")
    _write(resharded.where(F.col("shard").isin(shards)), f"{path}/{folder}")
    drained = [f"shard={shard}" for shard in sorted(set(shards) - {new for _, new in moves})]
    given = tuple(f"shard={shard}/" for shard in shards)
    old = [f for f in versions.files_below(spark, path) if f.startswith(given)]
    new = [f for f in versions.files_below(spark, f"{path}/{folder}") if f.startswith(given)]
    if not versions.publish_file(spark, f"{path}/{SWITCH}", json.dumps({"folder": folder, "old": old + drained, "new": new})):
        raise versions.Conflict(f"another rewrite of {path} is not finished")
    recover(spark, path)
    return shards


def recover(spark: SparkSession, path: str) -> None:
    """Finish a rewrite of the layout at ``path`` that was lost after its new files
    were complete.  Each step may be done already."""
    if not versions.exists(spark, f"{path}/{SWITCH}"):
        return
    todo = json.loads(versions.read_file(spark, f"{path}/{SWITCH}"))
    for name in todo["old"]:
        delete(spark, f"{path}/{name}")
    for name in todo["new"]:
        versions.move_file(spark, f"{path}/{todo['folder']}/{name}", f"{path}/{name}")
    delete(spark, f"{path}/{todo['folder']}")
    delete(spark, f"{path}/{SWITCH}")


def write_layout(docs: DataFrame, path: str, old_shard: Column | None = None) -> None:
    """``docs`` with size, text_crc32 and slot as a new layout by ``old_shard``."""
    named, known, _ = _blocks(_sized(docs, hashed_shard() if old_shard is None else old_shard), SHARDS, BLOCKS)
    _write(_slotted(named, known, {b.name: b.old for b in known}), path)


def read_layout(docs: DataFrame, path: str) -> DataFrame:
    """The rows of a layout of ``docs``, with size and text_crc32 of the texts that are in its files."""
    recover(docs.sparkSession, path)
    own = [f for f in docs.schema if f.name not in ("old_shard", "shard", "slot", "block", "piece", "before", "size", "text_crc32")]
    schema = StructType([*own, StructField("slot", LongType()), StructField("shard", IntegerType())])
    return docs.sparkSession.read.schema(schema).parquet(path).withColumns({"size": size_of(), "text_crc32": crc_of()})


def reshard_files(docs: DataFrame, shards: int = SHARDS, old_shard: Column | None = None) -> DataFrame:
    """The whole way: ``docs`` laid out by ``old_shard`` in the shared folder, placed
    anew, affected files written anew, and what all files then hold."""
    path = new_path(docs.sparkSession, "shards")
    write_layout(docs, path, old_shard)
    rewrite(reshard(read_layout(docs, path), shards, F.col("shard")), path)
    return read_layout(docs, path)
