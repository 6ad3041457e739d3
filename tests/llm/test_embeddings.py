from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    """By rows: links, smallest vec_id of the component, kept."""

    def unit(row):
        _, vector, label = row
        if label is None or not vector or any(x is None or not math.isfinite(x) for x in vector) or not any(vector):
            return None
        vector = np.array(vector, np.float32).astype(float)
        return vector / np.linalg.norm(vector)

    units = [unit(r) for r in rows]
    n = len(rows)
    near = [
        [
            j for j in range(n)
            if i != j and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
            and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold
        ]
        for i in range(n)
    ]
    out, seen = [None] * n, set()
    for i in range(n):
        if i in seen:
            continue
        todo, group = [i], {i}
        while todo:
            for j in near[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        seen |= group
        least = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
        for j in group:
            out[j] = (rows[j][0], len(near[j]), least, rows[j][0] == least)
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(11)
    out = []

    def add(vector, label):
        out.append((1000 - len(out), [float(x) for x in np.float32(vector)], label))

    for label in (1, 2, 3):
        for _ in range(60):
            add(draw.normal(size=24), label)
    for _ in range(12):  # groups of near copies, one of them a third of all rows
        centre = draw.normal(size=24)
        for _ in range(3):
            add(centre + draw.normal(size=24) * 0.08, 2)
    centre = draw.normal(size=24)
    for _ in range(150):
        add((centre + draw.normal(size=24) * 0.05) * draw.uniform(0.01, 100), 1)
    for angle in np.arange(0, 1.5, 0.15):  # a chain whose ends are far apart
        add([math.cos(angle), math.sin(angle), *[0] * 22], 3)
    return out


def test_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows)
    assert sum(n > 0 for _, n, _, _ in want) > 180
    assert got(embeddings.near_duplicates(df)) == want
    # Tiles of 10 rows: every label in many, the large group between them.
    assert got(embeddings.near_duplicates(df, tile_bytes=10 * 24 * 8)) == want
    assert got(embeddings.near_duplicates(df, threshold=0.9, tile_bytes=4000)) == brute(rows, 0.9)


def test_odd_rows(spark):
    v, w = [3.0, 4.0], [4.0, 3.0]
    rows = [
        (1, v, 1), (1, v, 1), (2, v, 2), (3, v, None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1), (7, [math.nan, 1.0], 1),
        (8, [math.inf, 1.0], 1), (9, [3.0, 4.0, 0.0], 1), (None, v, 1), (None, [-4.0, 3.0], 1), (10, [], 1), (11, [6e30, 8e30], 1),
        (12, [3e-30, 4e-30], 1), (13, w, 1), (None, [-4.0, 3.0], 1), (14, [-3.0, -4.0], 1),
    ]
    want = brute(rows)
    assert (1, 4, 1, True) in want and (None, 1, None, True) in want
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(embeddings.near_duplicates(df)) == want
    clashing = df.withColumns({c: F.lit("mine") for c in ("of", "row", "width", "start", "vector", "n_links", "kept", "node")})
    assert got(embeddings.near_duplicates(clashing)) == want
    assert got(embeddings.near_duplicates(df.where("false"))) == []
    assert got(embeddings.near_duplicates(df.where("label IS NULL"))) == [(3, 0, 3, True)]


def test_equal_rows_are_cut_into_tiles(spark):
    df = spark.range(3000).select(F.lit(None).cast("long").alias("vec_id"), F.array(*[F.lit(1.0)] * 4).alias("vector"), F.lit("a").alias("of"))
    found = embeddings.tiles(df, {}, tile_bytes=100 * 4 * 8).select("n").collect()
    assert sum(r["n"] for r in found) == 3000 and max(r["n"] for r in found) <= 100


@pytest.mark.parametrize("width", [1, 5, 8, 9, 40])
def test_bounds_lose_no_pair(width):
    draw = np.random.default_rng(width)
    given = draw.normal(size=(300, width)) * np.linspace(3, 0.1, width)
    given[100:200] = given[:100] + draw.normal(size=(100, width)) * 0.1
    turn = embeddings.principal(embeddings.unit_rows(given))
    tile = embeddings.make_tile(0, given, turn)
    every = slice(0, 300)
    for threshold in (0.5, 0.9, 0.98, 0.9999):
        i, j = embeddings.linked(tile, every, tile, every, threshold)
        unit = given / np.linalg.norm(given, axis=1, keepdims=True)
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(unit @ unit.T >= threshold)), strict=True))


def test_directions_hold_most_first():
    draw = np.random.default_rng(0)
    unit = embeddings.unit_rows(draw.normal(size=(500, 6)) * [0.1, 5, 1, 0.1, 3, 0.1])
    held = ((unit @ embeddings.principal(unit)) ** 2).sum(axis=0)
    assert (np.diff(held) <= 1e-9).all()


def test_far_tiles_do_not_meet(spark):
    tiles = [(0, "a", 2, 5, [0.9] * 4, [0.95] * 4), (10, "a", 2, 5, [0.1] * 4, [0.2] * 4), (20, "a", 2, 5, [0.8] * 4, [0.85] * 4), (30, "b", 2, 1, [0.9] * 4, [0.9] * 4)]
    found = spark.createDataFrame(tiles, "start long, of string, width int, n int, low array<double>, high array<double>")
    assert sorted(tuple(r) for r in embeddings.tile_pairs(found, 0.98).collect()) == [(0, 0), (0, 20), (10, 10), (20, 20)]
