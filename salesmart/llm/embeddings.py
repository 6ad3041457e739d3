"""Near duplicates among embeddings of one label, by tiles compared in PCA order.

Vectors are turned so that their leading components hold the most of them.  Tiles
are ranges of one label along the first component, cut by size, so that a hot label
gets many.  Two tiles are compared unless their bounds lie too far apart; within,
products of the leading components come first, and a pair is given up as soon as
what it has and the product of the norms of what is left cannot reach the threshold.
A comparison sends on a count and a tie to the smallest vector for each row that
has links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.batches import map_batches, schema_of
from salesmart.llm.components import connected
from salesmart.sources.shared import store

THRESHOLD = 0.98
#: Vectors that the directions are fitted on, at most: those of the smallest hashes.
#: Directions only decide how early a pair is given up, never whether it is linked.
SAMPLE = 4096
#: Bytes of the vectors in a tile.
TILE_BYTES = 16_000_000
#: Components after which a pair may be given up.
STEPS = (8, 16, 32, 64, 128, 256, 512)
#: Components whose bounds a tile keeps.
BOUNDS = 4
#: Rows and columns compared at once, and pairs carried on at once.
ROWS, COLUMNS, PAIRS = 512, 4096, 100_000
#: Rounding that a bound allows for; pairs so close are decided on the vectors as given.
SLACK = 1e-9
_LEFT = 40


class Tile(NamedTuple):
    start: int
    unit: np.ndarray
    given: np.ndarray
    tails: list[np.ndarray]


def steps(width: int) -> list[int]:
    return [s for s in STEPS if s < width] + [width]


def unit_rows(given: np.ndarray) -> np.ndarray:
    """Rows of length one; none may be zero."""
    scaled = given / np.abs(given).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def principal(unit: np.ndarray) -> np.ndarray:
    """Orthonormal directions as columns, the one that holds most first."""
    _, directions = np.linalg.eigh(unit.T @ unit)
    return np.ascontiguousarray(directions[:, ::-1])


def make_tile(start: int, given: np.ndarray, turn: np.ndarray | None) -> Tile:
    unit = unit_rows(given)
    unit = unit if turn is None else unit @ turn
    square = unit**2
    return Tile(start, unit, given, [np.sqrt(square[:, s:].sum(axis=1)) for s in steps(unit.shape[1])])


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows with rows, on the vectors as given."""
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def linked(a: Tile, rows: slice, b: Tile, columns: slice, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (in the tiles) of the pairs that reach the threshold."""
    x, y, least = a.unit[rows], b.unit[columns], threshold - SLACK
    cuts = steps(x.shape[1])
    value = x[:, : cuts[0]] @ y[:, : cuts[0]].T
    i, j = np.nonzero(value + np.outer(a.tails[0][rows], b.tails[0][columns]) >= least)
    if len(i) > value.size // 8:
        # Most go on: whole products are cheaper than picked ones.
        value = x @ y.T
        i, j = np.nonzero(value >= least)
        value = value[i, j]
    else:
        value = value[i, j]
        for step, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False), start=1):
            for at in range(0, len(i), PAIRS):
                part = slice(at, at + PAIRS)
                value[part] += np.einsum("ij,ij->i", x[i[part], low:high], y[j[part], low:high])
            alive = value + a.tails[step][rows][i] * b.tails[step][columns][j] >= least
            i, j, value = i[alive], j[alive], value[alive]
    close = np.flatnonzero(np.abs(value - threshold) <= SLACK)
    sure = np.ones(len(i), bool)
    for at in range(0, len(close), PAIRS):
        part = close[at : at + PAIRS]
        sure[part] = cosine(a.given[rows][i[part]], b.given[columns][j[part]]) >= threshold
    return i[sure] + rows.start, j[sure] + columns.start


def compare(a: Tile, b: Tile, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, links, smallest node it hangs together with by links of these tiles) of
    the rows that have links; ``a`` and ``b`` may be one tile."""
    same = a.start == b.start
    n, m = len(a.unit), 0 if same else len(b.unit)
    count = np.zeros(n + m, np.int64)
    parent = np.arange(n + m)
    nodes = np.concatenate([a.start + np.arange(n), b.start + np.arange(m)])

    def top(k: int) -> int:
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    for r in range(0, n, ROWS):
        rows = slice(r, min(r + ROWS, n))
        for c in range(r if same else 0, len(b.unit), COLUMNS):
            columns = slice(c, min(c + COLUMNS, len(b.unit)))
            i, j = linked(a, rows, b, columns, threshold)
            if same:
                later = j > i
                i, j = i[later], j[later]
            if not len(i):
                continue
            j = j if same else j + n
            count += np.bincount(i, minlength=n + m) + np.bincount(j, minlength=n + m)
            # Ties that span what these pairs connect, then one at a time.
            for u, v in spanning(i, j):
                u, v = top(u), top(v)
                parent[max(u, v)] = min(u, v)
    has = np.flatnonzero(count)
    root = np.array([top(k) for k in has.tolist()], np.int64)
    # Tiles are compared in ascending order, so the smallest place is the smallest node.
    return nodes[has], count[has], nodes[root] if len(has) else nodes[:0]


def spanning(i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """(place, smallest place it is connected to) for the places of pairs."""
    places, codes = np.unique(np.concatenate([i, j]), return_inverse=True)
    u, v = codes[: len(i)], codes[len(i) :]
    least = np.arange(len(places))
    while True:
        before = least.copy()
        low = np.minimum(least[u], least[v])
        np.minimum.at(least, u, low)
        np.minimum.at(least, v, low)
        least = least[least]
        if (least == before).all():
            return list(zip(places.tolist(), places[least].tolist(), strict=True))


def usable(embedding: str, label: str) -> Column:
    """Whether a row can have links: label and vector are there, all components are
    finite numbers, and one is not zero."""
    vector = F.col(embedding).cast("array<double>")
    finite = F.forall(vector, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    return F.coalesce(F.col(label).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def fit(vectors: DataFrame, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Directions for each length of ``vectors`` (vector) in a bounded sample."""
    rows = vectors.orderBy(F.xxhash64("vector"), "vector").limit(sample).select("vector").collect()
    by_width: dict[int, list] = {}
    for (vector,) in rows:
        by_width.setdefault(len(vector), []).append(vector)
    return {width: principal(unit_rows(np.array(found, np.float64))) for width, found in by_width.items()}


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


_TILES = "start long, of string, width int, n int, low array<double>, high array<double>, ids array<long>, vectors binary"


def tiles(vectors: DataFrame, turns: dict[int, np.ndarray], tile_bytes: int = TILE_BYTES) -> DataFrame:
    """Tiles of ``vectors`` (vec_id, of, vector), stored: rows of one label and length
    along the first direction, of ``tile_bytes`` at most (one row at least).  Its
    rows are numbered from ``start``."""
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(turns)  # as large as the sample allows
    turned_schema = schema_of("vec_id long, of string, width int, vector array<double>, row long, lead array<double>, first double")

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column(2).to_numpy()
            lead = np.zeros((batch.num_rows, BOUNDS))
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                unit = unit_rows(_vectors(batch.column(3).take(pa.array(at)), width))
                unit = unit @ shared.value[width][:, :BOUNDS] if width in shared.value else unit[:, :BOUNDS]
                lead[at, : unit.shape[1]] = unit
            leads = pa.ListArray.from_arrays(np.arange(len(lead) + 1, dtype=np.int32) * BOUNDS, lead.reshape(-1))
            yield pa.RecordBatch.from_arrays([*batch.columns, leads, pa.array(lead[:, 0])], names=turned_schema.names)

    # Equal rows are told apart by where they are read, so that ranges can cut them.
    row = F.monotonically_increasing_id().alias("row")
    turned = map_batches(vectors.select("vec_id", "of", F.size("vector").alias("width"), "vector", row), turn, turned_schema)
    total = vectors.agg(F.sum(F.size("vector") * F.lit(8).cast("long"))).first()[0] or 0
    ranges = max(spark.sparkContext.defaultParallelism, -(-total // tile_bytes))
    keys = ["of", "width", "first", "row"]
    ranged = turned.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    tile_schema = schema_of(_TILES)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << _LEFT
        key, held, n = None, [], 0

        def close() -> pa.RecordBatch:
            nonlocal number, n
            ids = pa.concat_arrays([c[0] for c in held])
            lead = np.concatenate([_vectors(c[2], BOUNDS) for c in held])
            vectors = np.concatenate([_vectors(c[1], key[1]) for c in held])
            row = [number, key[0], key[1], n, lead.min(axis=0).tolist(), lead.max(axis=0).tolist(), ids.to_pylist(), vectors.tobytes()]
            number, n = number + n, 0
            held.clear()
            arrays = [pa.array([value], type_) for value, type_ in zip(row, _TILE_TYPES, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=tile_schema.names)

        for batch in batches:
            of, width = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            at = 0
            while at < batch.num_rows:
                most = max(1, tile_bytes // (8 * width[at]))
                if held and (key != (of[at], width[at]) or n >= most):
                    yield close()
                key, end = (of[at], width[at]), at + 1
                while end < batch.num_rows and end - at < most - n and (of[end], width[end]) == key:
                    end += 1
                part = batch.slice(at, end - at)
                held.append((part.column(0), part.column(3), part.column(5)))
                n, at = n + end - at, end
        if held:
            yield close()

    return store(map_batches(ranged, pack, tile_schema), "tiles")


_TILE_TYPES = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.binary()]


def tile_pairs(found: DataFrame, threshold: float) -> DataFrame:
    """(a, b) by start, a <= b, of tiles between which a link is possible.

    Linked unit vectors are at most sqrt(2 - 2 * threshold) apart.  Tiles meet by
    the steps of that width along the first direction that they cover.
    """
    reach = max(float(np.sqrt(max(2 - 2 * threshold, 0))), 1e-3)
    low, high = F.col("low"), F.col("high")
    steps_covered = F.sequence(F.floor(low[0] / reach), F.floor((high[0] + reach + SLACK) / reach))
    meta = found.select("start", "of", "width", "low", "high", "n", F.floor(low[0] / reach).alias("begin"), F.explode(steps_covered).alias("step"))
    a, b = meta.alias("a"), meta.alias("b")
    gaps = [F.greatest(F.col("a.low")[k] - F.col("b.high")[k], F.col("b.low")[k] - F.col("a.high")[k], F.lit(0.0)) for k in range(BOUNDS)]
    near = reduce(Column.__add__, [g * g for g in gaps]) <= reach * reach + SLACK
    once = F.col("a.step") == F.greatest("a.begin", "b.begin")
    same = reduce(Column.__and__, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("of", "width", "step")])
    order = (F.col("a.start") < F.col("b.start")) | ((F.col("a.start") == F.col("b.start")) & (F.col("a.n") > 1))
    return a.join(b, same & order & once & near).select(F.col("a.start").alias("a"), F.col("b.start").alias("b"))


def tile_links(found: DataFrame, turns: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """(node, n, root): for each comparison of two tiles, the rows with links, how many,
    and the smallest row they hang together with in it."""
    shared = found.sparkSession.sparkContext.broadcast(turns)
    schema = schema_of("node long, n long, root long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                a, b, width, one, two = (batch.column(c)[k].as_py() for c in range(5))
                turn = shared.value.get(width)
                first = make_tile(a, np.frombuffer(one).reshape(-1, width), turn)
                second = first if a == b else make_tile(b, np.frombuffer(two).reshape(-1, width), turn)
                columns = compare(first, second, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=schema.names)

    pairs = store(tile_pairs(found, threshold), "tile-pairs")
    first = found.select(F.col("start").alias("a"), "width", F.col("vectors").alias("one"))
    second = found.select(F.col("start").alias("b"), F.col("vectors").alias("two"))
    return map_batches(pairs.join(first, "a").join(second, "b").select("a", "b", "width", "one", "two"), run, schema)


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    tile_bytes: int = TILE_BYTES,
) -> DataFrame:
    """vec_id, n_links (other rows linked directly), component_id (smallest vec_id
    reachable) and kept (vec_id is component_id), one row per row of ``vectors``.

    Rows link if label and length are equal and the cosine, in doubles, is
    ``threshold`` or more.  A row without label, or whose vector is null, zero,
    empty or holds a null or non-finite component, links with nothing.  Repeated
    rows are rows like others and link with each other; rows without vec_id count
    as links, but name a component only if all of its rows have none (then null,
    and kept).  An empty table gives no rows; other columns are left out.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("_vector"), F.col(label).alias("_label"))
    good = usable("_vector", "_label")
    used = rows.where(good).select("vec_id", F.col("_label").cast("string").alias("of"), F.col("_vector").cast("array<double>").alias("vector"))
    turns = fit(used)
    found = tiles(used, turns, tile_bytes)
    ties = store(tile_links(found, turns, threshold), "ties")
    counts = ties.groupBy("node").agg(F.sum("n").alias("n_links"))
    roots = store(connected(ties.select(F.col("node").alias("u"), F.col("root").alias("v"))), "roots")
    nodes = found.select("start", F.posexplode("ids").alias("place", "vec_id")).select((F.col("start") + F.col("place")).alias("node"), "vec_id")
    linked_rows = store(nodes.join(roots, "node").join(counts, "node").select("node", "vec_id", "n_links", "root"), "linked")
    classes = linked_rows.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    of_links = linked_rows.join(classes, "root").select("vec_id", "n_links", "component_id")
    alone = nodes.join(linked_rows.select("node"), "node", "left_anti").select("vec_id").unionByName(rows.where(~good).select("vec_id"))
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return of_links.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
