"""Near duplicates by SimHash fingerprints and BK-trees.

Fingerprints that differ in at most ``RADIUS`` bits are linked.  Cut into five
parts, two such fingerprints agree in two parts at least, so they meet in one of
ten shards, each named by a pair of parts and their values.  A shard's tree is
built where its fingerprints meet.  A crowded shard is cut into pieces of a set
size, and each piece's tree is searched by one other piece per task.  Trees are
sent by the shuffle and not as one broadcast, as their number grows with the
documents and no bound holds for it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.batches import append_columns, map_batches, schema_of
from salesmart.llm.components import connected
from salesmart.sources.shared import store

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Fingerprints in one piece of a crowded shard.
PIECE = 2000
#: Bits of the parts, from the low end.
PARTS = (13, 13, 13, 13, 12)
_AGREE = len(PARTS) - RADIUS
#: Shingles whose bits are counted at once.
_CHUNK = 50_000
_ALL = (1 << 64) - 1


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of word shingles, unsigned; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate([[0], ends[:-1]])[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        stops = (ends[shingle - 1 :] - 1).tolist()
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(ones * 2 > len(hashes)).tolist())


def signed(code: int) -> int:
    return code - (1 << 64) if code >> 63 else code


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` and ``fp``, the fingerprint as a signed long."""

    def task():
        return lambda texts: [[signed(fingerprint(t, shingle)) for t in texts]]

    return append_columns(docs, [text], task, "fp long")


class BkTree:
    """Children of a node are keyed by their distance to it."""

    def __init__(self) -> None:
        self.codes: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, code: int) -> None:
        new, at = len(self.codes), 0
        self.codes.append(code)
        self.children.append({})
        while new:
            nxt = self.children[at].setdefault((code ^ self.codes[at]).bit_count(), new)
            if nxt == new:
                return
            at = nxt

    def near(self, code: int, radius: int) -> Iterator[int]:
        """Numbers of the nodes within the radius, by insertion from 0."""
        todo = [0] if self.codes else []
        codes, children = self.codes, self.children
        while todo:
            at = todo.pop()
            distance = (code ^ codes[at]).bit_count()
            if distance <= radius:
                yield at
            edges = children[at]
            if edges:
                low, high = distance - radius, distance + radius
                if len(edges) <= 2 * radius:
                    todo += [child for d, child in edges.items() if low <= d <= high]
                else:
                    todo += [edges[d] for d in range(low, high + 1) if d in edges]


def stars(codes: list[int], pieces: list[int], radius: int) -> list[tuple[int, int]]:
    """(code, smallest code linked to it through this shard) for codes, signed, of
    one or two pieces.  Of two pieces, the first is the tree and the second asks."""
    unsigned = [c & _ALL for c in codes]
    parent = list(range(len(codes)))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    first = min(pieces)
    tree, numbers = BkTree(), []
    both = max(pieces) != first
    if both:
        for i, code in enumerate(unsigned):
            if pieces[i] == first:
                tree.add(code)
                numbers.append(i)
    for i, code in enumerate(unsigned):
        if both and pieces[i] == first:
            continue
        for hit in tree.near(code, radius):
            a, b = top(i), top(numbers[hit])
            parent[max(a, b, key=codes.__getitem__)] = min(a, b, key=codes.__getitem__)
        if not both:
            tree.add(code)
            numbers.append(i)
    return [(codes[i], codes[top(i)]) for i in range(len(codes)) if top(i) != i]


def _shards(fp: Column) -> Column:
    """The shards of a fingerprint, one for each choice of parts."""
    offsets = np.cumsum((0, *PARTS)).tolist()
    value = [F.shiftrightunsigned(fp, offsets[i]).bitwiseAND(F.lit((1 << n) - 1)) for i, n in enumerate(PARTS)]
    names = []
    for number, chosen in enumerate(combinations(range(len(PARTS)), _AGREE)):
        name = F.lit(number).cast("long")
        for i in chosen:
            name = F.shiftleft(name, PARTS[i]).bitwiseOR(value[i])
        names.append(name)
    return F.array(*names)


def links(codes: DataFrame, radius: int = RADIUS, piece: int = PIECE) -> DataFrame:
    """(u, v): within each shard, every fingerprint tied to the smallest of those
    it hangs together with; as many rows as fingerprints at most, never all pairs.

    ``codes`` has distinct fp.
    """
    if radius > RADIUS:
        raise ValueError(f"the parts are cut for at most {RADIUS} bits")
    dealt = codes.select("fp", F.explode(_shards(F.col("fp"))).alias("shard"))
    crowded = store(
        dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > piece)
        .select("shard", F.ceil(F.col("n") / piece).cast("int").alias("pieces")),
        "crowded-shards",
    )
    dealt = dealt.join(crowded, "shard", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    # Each piece meets itself and every other one, once.
    dealt = dealt.withColumn("piece", own).select(
        "fp", "shard", "piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other")
    )
    dealt = dealt.select("shard", F.least("piece", "other").alias("a"), F.greatest("piece", "other").alias("b"), "piece", "fp")
    keys = ["shard", "a", "b"]
    schema = schema_of("u long, v long")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple[int, int]] = []

        def close() -> None:
            if len(held) > 1:
                out.extend(stars([r[4] for r in held], [r[3] for r in held], radius))
            held.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[:3] != held[0][:3]:
                    close()
                held.append(row)
            yield _pairs(out)
            out.clear()
        close()
        yield _pairs(out)

    return map_batches(dealt.repartition(*keys).sortWithinPartitions(*keys, "fp"), search, schema)


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["u", "v"])


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, piece: int = PIECE) -> DataFrame:
    """doc_id, text_hash (of the whole text), fp, root (a fingerprint that names
    the class) and component_id (its smallest doc_id), one row per row of ``docs``.

    Null texts are empty, and a text without words has fingerprint zero like any
    other such text.  Rows that repeat count once as a fingerprint.  Rows without
    a doc_id belong to a class but never name it; a class of such rows only has
    component_id null.
    """
    text_hash = F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")
    prints = with_fingerprint(docs.select("doc_id", "text", text_hash), shingle=shingle)
    prints = store(prints.select("doc_id", "text_hash", "fp"), "fingerprints")
    codes = store(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "codes")
    nodes = store(connected(links(codes.select("fp"), radius, piece)), "roots")
    linked = nodes.join(codes, F.col("node") == F.col("fp")).groupBy("root").agg(F.min("first").alias("smallest"))
    linked = store(linked, "classes")
    classes = codes.join(nodes.join(linked, "root").withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp",
        F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("smallest")).alias("component_id"),
    )
    # Stored on both sides, so that a fingerprint with very many rows can be split.
    return prints.join(store(classes, "fingerprint-classes"), "fp")


def keep_one(docs: DataFrame, members: DataFrame) -> DataFrame:
    """One row of ``docs`` for each class of ``members``: that of the smallest
    doc_id (rows without one come last), then of the smallest hash of its text,
    then of the smallest lang, source and n_chars."""
    best = members.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("best"))
    kept = store(best.select(F.col("best.doc_id").alias("_id"), F.col("best.text_hash").alias("_hash")), "kept")
    own = docs.withColumn("_text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))
    rest = [c for c in ("lang", "source", "n_chars") if c in docs.columns]
    order = ", ".join(rest) or "doc_id"
    first = F.expr(f"row_number() OVER (PARTITION BY doc_id, _text_hash ORDER BY {order})")
    return own.join(kept, same, "left_semi").withColumn("_nth", first).where("_nth = 1").drop("_nth", "_text_hash")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
