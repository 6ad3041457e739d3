"""Fingerprints that keep every shingle hash below a fixed fraction.

The share of hashes that is kept does not depend on the length of a text, so
sketches of unequal texts compare and merge: below the smaller of two limits each
holds all hashes of its text.  A text with few shingles keeps its ``LEAST``
smallest hashes, and its limit rises accordingly.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.batches import map_batches, schema_of, slices

SHINGLE = 5
#: The fraction kept is one over this.
SCALE = 8
LEAST = 32
#: Bytes of texts that are one task's range of ids.
RANGE_BYTES = 128_000_000
#: An id of more rows than this is parted by hash if it fills several ranges.
HOT_ROWS = 10_000
_TOP = (1 << 64) - 1
#: Word hashes remembered by a task.
_WORDS = 200_000

PAIRED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


class Hasher:
    """Shingle hashes of texts, equal in every task."""

    def __init__(self, shingle: int = SHINGLE) -> None:
        self.shingle = shingle
        self.known: dict[bytes, int] = {}

    def shingles(self, text: str) -> np.ndarray:
        """Distinct hashes of word shingles, ascending.  Fewer words than a shingle
        are one shingle; A-Z count as lower case."""
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > _WORDS:
            self.known.clear()
        known = self.known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.shingle, len(words))
        mixed = np.zeros(len(words) - n + 1, np.uint64)
        for k in range(n):
            mixed = (mixed ^ codes[k : len(codes) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        return np.unique(mixed ^ (mixed >> np.uint64(32)))


class Sketch:
    """``hashes``: all of a text's up to ``limit``, ascending."""

    def __init__(self, limit: int, hashes: np.ndarray) -> None:
        self.limit, self.hashes = limit, hashes

    @classmethod
    def of(cls, shingles: np.ndarray, scale: int = SCALE, least: int = LEAST) -> Sketch:
        limit = _TOP // scale
        n = int(np.searchsorted(shingles, np.uint64(limit), "right"))
        if n < least:
            n = min(least, len(shingles))
            limit = _TOP if n == len(shingles) else int(shingles[n - 1])
        return cls(limit, shingles[:n])

    def below(self, limit: int) -> np.ndarray:
        return self.hashes[: int(np.searchsorted(self.hashes, np.uint64(limit), "right"))]

    def merged(self, other: Sketch) -> Sketch:
        """The sketch of both texts' shingles together."""
        limit = min(self.limit, other.limit)
        return Sketch(limit, np.union1d(self.below(limit), other.below(limit)))

    def containment(self, other: Sketch) -> float:
        """Estimated share of the smaller set of shingles that lies in the larger.
        Texts without words are like each other and like nothing else."""
        limit = min(self.limit, other.limit)
        a, b = self.below(limit), other.below(limit)
        if not len(self.hashes) and not len(other.hashes):
            return 1.0
        if not len(a) or not len(b):
            return 0.0
        return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))

    def text(self) -> str:
        """The limit and the hashes, 16 hexadecimal digits each."""
        return f"{self.limit:016x}" + self.hashes.astype(">u8").tobytes().hex()

    @classmethod
    def read(cls, text: str) -> Sketch:
        values = np.frombuffer(bytes.fromhex(text), ">u8").astype(np.uint64)
        return cls(int(values[0]), values[1:])


def edited(text: str, following: str) -> str:
    """The last quarter replaced by the beginning of what follows."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _share(docs: DataFrame, ranges: int, hot_rows: int) -> tuple[list[tuple[int, int, int]], list[int | None]]:
    """Last keys (id known, id, hash) of all ranges but the last one, ascending, and
    the ids whose rows are parted by hash: those that fill several ranges, and have
    more than ``hot_rows`` rows."""
    cuts = [k / ranges for k in range(1, ranges)]
    quantiles = F.percentile_approx("doc_id", cuts, 10 * ranges) if cuts else F.lit(None)
    rows, known, found = docs.agg(F.count(F.lit(1)), F.count("doc_id"), quantiles).first()
    times = sorted(Counter(found or []).items())
    missing = (rows - known) * ranges // max(rows, 1)  # ranges that rows without an id would fill
    groups = [(0, 0, None, missing, rows - known)] if known < rows else []
    groups += [(1, key, key, n, n * known // ranges) for key, n in times]
    bounds, hot = [], []
    for has_id, key, own, n, held in groups:
        if n > 1 and held > hot_rows:
            hot.append(own)
            bounds += [(has_id, key, j * (1 << 64) // n - (1 << 63)) for j in range(1, n)]
        bounds.append((has_id, key, (1 << 63) - 1))
    return bounds, hot


def _keys(keys: list[tuple[int, int, int]]) -> str:
    return "array(" + ",".join(f"named_struct('known', {has_id}, 'id', {key}L, 'code', {code}L)" for has_id, key, code in keys) + ")"


def _before(bounds: list[tuple[int, int, int]], key: str) -> Column:
    """How many of ``bounds`` (ascending) lie before ``key``: first among every
    so-manieth, then among those between, 2 * sqrt(n) comparisons of n."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    parts = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    first = F.size(F.filter(F.expr(_keys([part[-1] for part in parts])), lambda b: b < F.col(key)))
    inner = F.get(F.expr("array(" + ",".join(map(_keys, parts)) + ")"), first)
    found = first * step + F.coalesce(F.size(F.filter(inner, lambda b: b < F.col(key))), F.lit(0))
    return F.least(found, F.lit(len(bounds)))  # behind all bounds there is no part


def in_ranges(docs: DataFrame, ranges: int, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, int]:
    """Rows dealt by ranges of doc_id (of one id that fills several ranges, of the
    text's hash), each range with the first row of the next one that has rows
    (``tail``), the last with the first row of all; and the number of ranges.

    The text is shuffled once, and one row for each range besides.  The driver holds
    a few numbers for each range.
    """
    spark = docs.sparkSession
    bounds, hot = _share(docs, ranges, hot_rows)
    text = F.coalesce("text", F.lit(""))
    ids = [key for key in hot if key is not None]
    parted = F.col("doc_id").isNull() if None in hot else F.lit(False)
    parted = parted | F.coalesce(F.col("doc_id").isin(ids), F.lit(False)) if ids else parted
    own = docs.select("doc_id", text.alias("text"), F.when(parted, F.xxhash64(text)).otherwise(0).alias("code"))
    known = F.col("doc_id").isNotNull().cast("int").alias("known")
    key = F.struct(known, F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), F.col("code").cast("long").alias("code"))
    dealt = own.withColumn("key", key).withColumn("range", _before(bounds, "key"))
    firsts = dealt.groupBy("range").agg(F.min("key").alias("first")).collect()  # one row for each range
    rows = sorted((r["range"], tuple(r["first"])) for r in firsts)
    before = [(at, first, rows[i - 1][0]) for i, (at, first) in enumerate(rows)]
    table = F.broadcast(spark.createDataFrame(before, "range int, first struct<known:int,id:long,code:long>, before int"))
    heads = dealt.join(table, "range").where("key = first")
    tails = heads.groupBy(F.col("before").alias("range"), "doc_id", "code").agg(F.min("text").alias("text"))
    columns = ["range", "tail", "doc_id", "code", "text"]
    tails = tails.withColumn("tail", F.lit(True)).select(columns)
    return dealt.withColumn("tail", F.lit(False)).select(columns).union(tails), len(bounds) + 1


def fingerprint_with_next(
    docs: DataFrame, ranges: int | None = None, shingle: int = SHINGLE, scale: int = SCALE, least: int = LEAST, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per document: its sketch, that of its text edited with the next
    document's, and how alike these and the next document's are.

    Null texts are empty.  Rows of one doc_id follow each other by text, or by the
    text's hash if there are more than ``hot_rows`` of them and they fill several
    ranges; rows without a doc_id come first.  A single row is its own next one.
    ``ranges``: a task each; by default as many as their texts ask for.
    """
    if ranges is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        ranges = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    dealt, ranges = in_ranges(docs, ranges, hot_rows)
    schema = schema_of(PAIRED)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(shingle)
        sketch = lambda text: Sketch.of(hasher.shingles(text), scale, least)
        held: tuple | None = None
        for batch in batches:
            for part in slices(batch):
                out = []
                for tail, doc_id, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    own = sketch(text)
                    if held is not None:
                        key, before, known = held
                        changed = edited(before, text)
                        other = known if changed == before else sketch(changed)
                        sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
                        out.append((key, len(before), sha, known.text(), other.text(), known.containment(other), known.containment(own)))
                    held = None if tail else (doc_id, text, own)
                columns = list(zip(*out, strict=True)) or [()] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=schema.names)

    # Each range is a task of its own.
    placed = dealt.repartitionById(ranges, "range").sortWithinPartitions("tail", "doc_id", "code", "text")
    return map_batches(placed.select("tail", "doc_id", "text"), pair, schema)


_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
