"""Ranked search by words with Block-Max MaxScore.

Documents are dealt to shards.  A shard keeps, for every term asked for, its
postings in blocks that are packed and carry the largest score in them.  A query
walks the essential lists only, those without which no document can get among the
best; of the others, whole lists first and block maxima next tell whether a
candidate can still get there, and only then is a block unpacked.  Each shard gives
its best documents, which are merged.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.batches import map_batches, schema_of, slices
from salesmart.sources.shared import store

TOP = 20
#: Postings in a block, postings in a shard (about), documents of a shard that are
#: scored at once.
BLOCK, POSTINGS, SPAN = 128, 2_000_000, 4096
#: UTF-8 bytes of queries that are searched at once; more are searched in parts.
PART_BYTES = 16_000_000
# Scores are whole numbers, weights thousandths, and a document's
# length counts for a quarter.
UNIT, EVEN, QUARTER, SATURATION = 1_000_000_000, 100, 25, 12

#: Bytes of terms, A-Z in lower case; all others are blanks.  Bytes from 0x80 on
#: belong to terms, so this works on UTF-8 without decoding.
_TERMS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERMS).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_factor(lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    return EVEN - QUARTER + (QUARTER * lengths * documents) // max(total, 1)


def impacts(weights: np.ndarray | int, times: np.ndarray, factors: np.ndarray) -> np.ndarray:
    return weights * ((UNIT * times) // (1000 * times + SATURATION * factors))


class Postings(NamedTuple):
    """What a shard keeps.  ``lists`` are slices of the blocks, by number of the term;
    ``bound`` has the largest score of each."""

    factors: np.ndarray
    terms: np.ndarray
    begins: np.ndarray
    bound: np.ndarray
    last: np.ndarray
    best: np.ndarray
    at: np.ndarray
    payload: bytes


def pack(numbers: np.ndarray) -> bytes:
    """Width in bytes, then the numbers."""
    width = 1 if numbers.max() < 1 << 8 else 2 if numbers.max() < 1 << 16 else 4
    return bytes([width]) + numbers.astype(f"<u{width}").tobytes()


def unpack(payload: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    width = payload[at]
    return np.frombuffer(payload, f"<u{width}", n, at + 1).astype(np.int64), at + 1 + n * width


def index_postings(factors: np.ndarray, docs: np.ndarray, terms: np.ndarray, times: np.ndarray, weights: np.ndarray) -> Postings:
    """Postings (document, term, times) of one shard, by document."""
    order = np.argsort(terms, kind="stable")
    docs, terms, times = docs[order], terms[order], times[order]
    score = impacts(weights[terms], times, factors[docs])
    known, firsts = np.unique(terms, return_index=True)
    ends = np.append(firsts[1:], len(terms))
    begins, last, best, at, out, size = [0], [], [], [], [], 0
    for first, end in zip(firsts.tolist(), ends.tolist(), strict=True):
        before = -1
        for low in range(first, end, BLOCK):
            high = min(low + BLOCK, end)
            packed = pack(np.diff(docs[low:high], prepend=before)) + pack(times[low:high])
            before = docs[high - 1]
            last.append(before)
            best.append(score[low:high].max())
            at.append(size)
            out.append(packed)
            size += len(packed)
        begins.append(len(last))
    bound = np.maximum.reduceat(score, firsts) if len(firsts) else score
    numbers = [np.array(x, np.int64) for x in (known, begins, bound, last, best, at)]
    return Postings(factors, *numbers, b"".join(out))


class Shard:
    """Postings with the blocks that were unpacked."""

    def __init__(self, postings: Postings, counts: np.ndarray, weights: np.ndarray) -> None:
        self.p, self.counts, self.weights = postings, counts, weights
        self.place = {term: k for k, term in enumerate(postings.terms.tolist())}
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.spans: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def block(self, k: int, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of one block of list ``k``."""
        if number not in self.blocks:
            n = int(self.counts[number])
            before = -1 if number == self.p.begins[k] else int(self.p.last[number - 1])
            gaps, at = unpack(self.p.payload, int(self.p.at[number]), n)
            times, _ = unpack(self.p.payload, at, n)
            docs = np.cumsum(gaps) + before
            self.blocks[number] = docs, impacts(int(self.weights[self.p.terms[k]]), times, self.p.factors[docs])
        return self.blocks[number]

    def span(self, k: int, start: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (counted from ``start``) and scores of list ``k`` in one span, from
        the blocks that reach into it."""
        if (k, start) not in self.spans:
            low, high = int(self.p.begins[k]), int(self.p.begins[k + 1])
            first, end = low + np.searchsorted(self.p.last[low:high], (start, start + SPAN))
            blocks = [self.block(k, b) for b in range(first, min(end + 1, high))]
            docs = np.concatenate([b[0] for b in blocks]) if blocks else np.zeros(0, np.int64)
            score = np.concatenate([b[1] for b in blocks]) if blocks else docs
            a, b = np.searchsorted(docs, (start, start + SPAN))
            self.spans[k, start] = docs[a:b] - start, score[a:b]
        return self.spans[k, start]

    def search(self, query: list[tuple[int, int]], top: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, documents) of the best ``top`` with a score above 0, best first and
        equal ones by document; ``query`` has (term, times)."""
        p = self.p
        lists = sorted((int(p.bound[self.place[t]]) * n, self.place[t], n) for t, n in query if t in self.place)
        lists = [x for x in lists if x[0] > 0]
        upto = np.cumsum([0] + [x[0] for x in lists])  # upto[e]: most that the first e lists give
        scores, docs, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for start in range(0, len(p.factors), SPAN):
            # The first lists together cannot bring a document above the least.
            essential = int(np.searchsorted(upto, least, "right")) - 1
            if essential >= len(lists):
                break
            sums = np.zeros(min(SPAN, len(p.factors) - start), np.int64)
            for _, k, n in lists[essential:]:
                held, score = self.span(k, start)
                sums[held] += n * score
            found = np.flatnonzero(sums)
            found = found[sums[found] + upto[essential] > least]
            if not len(found):
                continue
            value, found = sums[found], found + start
            if essential:
                value, found = self._others(lists[:essential], value, found, least)
            better = value > least
            value, found = np.concatenate([scores, value[better]]), np.concatenate([docs, found[better]])
            order = np.lexsort((found, -value))[:top]
            scores, docs = value[order], found[order]
            if len(scores) == top:
                # Later documents have larger numbers, so equal scores do not get in.
                least = int(scores[-1])
        return scores, docs

    def _others(self, lists: list[tuple[int, int, int]], value: np.ndarray, found: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Complete the scores of candidates by the lists that are not essential."""
        p = self.p
        rows = []
        for _, k, n in lists:
            low, high = int(p.begins[k]), int(p.begins[k + 1])
            number = low + np.searchsorted(p.last[low:high], found)
            most = np.where(number < high, n * p.best[np.minimum(number, high - 1)], 0)
            rows.append((number, most))
        rest = sum(most for _, most in rows)
        alive = np.flatnonzero(value + rest > least)
        value, found, rest = value[alive], found[alive], rest[alive]
        for (_, k, n), (number, most) in zip(reversed(lists), reversed(rows), strict=True):
            number, most = number[alive], most[alive]
            value, rest = value.copy(), rest - most
            for b in np.unique(number[most > 0]).tolist():
                held, score = self.block(k, b)
                here = np.flatnonzero(number == b)
                place = np.minimum(np.searchsorted(held, found[here]), len(held) - 1)
                hit = held[place] == found[here]
                value[here[hit]] += n * score[place[hit]]
            on = value + rest > least
            alive, value, found, rest = alive[on], value[on], found[on], rest[on]
        return value, found


_SHARD = "shard int, ids array<long>, factors binary, terms binary, begins binary, bound binary, last binary, best binary, at binary, counts binary, payload binary"


def _forward(docs: DataFrame, number_of: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms), and the terms asked for with their times, stored."""
    shared = docs.sparkSession.sparkContext.broadcast(number_of)  # terms of one part of the queries
    schema = schema_of("doc_id long, n long, terms array<int>, times array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in slices(batch):
                n, terms, times = [], [], []
                for text in part.column(1).to_pylist():
                    found = terms_of(text)
                    n.append(len(found))
                    counted = Counter(known[t] for t in found if t in known)
                    terms.append(list(counted.keys()))
                    times.append(list(counted.values()))
                lists = [pa.array(x, pa.list_(pa.int32())) for x in (terms, times)]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(n, pa.int64()), *lists], names=schema.names)

    return store(map_batches(docs.select("doc_id", "text"), run, schema), "terms")


def build_index(docs: DataFrame, number_of: dict[bytes, int], postings: int = POSTINGS) -> tuple[DataFrame, np.ndarray]:
    """The stored index of the terms ``number_of`` names over all rows of ``docs``, a row
    per shard, and the weights of the terms.

    Rows without a term asked for count in the statistics and are in no shard.
    Rows are dealt by where they were read, so neither a repeated or missing
    doc_id nor a common term makes a shard larger; their number follows the
    postings.
    """
    spark = docs.sparkSession
    forward = _forward(docs, number_of)
    sums = forward.agg(
        F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("total"), F.sum(F.size("terms")).alias("postings")
    ).first()
    documents, total = sums["documents"], sums["total"] or 0
    holding = np.zeros(max(len(number_of), 1), np.int64)
    # A row per term asked for at most.
    for row in forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        holding[row["term"]] = row["count"]
    weights = np.array([weight(documents, int(df)) for df in holding], np.int64)
    shared = spark.sparkContext.broadcast(weights)

    shards = max(spark.sparkContext.defaultParallelism, -(-(sums["postings"] or 0) // postings))
    shard = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    dealt = forward.where(F.size("terms") > 0).withColumn("shard", shard)
    # Equal scores go by doc_id, so documents are numbered in that order.
    dealt = dealt.repartitionById(shards, "shard").sortWithinPartitions("shard", F.asc_nulls_last("doc_id"))
    schema = schema_of(_SHARD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            held.clear()
            lengths = table["n"].to_numpy()
            sizes = np.diff(np.concatenate([[0], np.cumsum([len(x) for x in table["terms"]])]))
            terms, times = (np.concatenate([c.flatten().to_numpy() for c in table[name].chunks]).astype(np.int64) for name in ("terms", "times"))
            factors = length_factor(lengths, documents, total)
            found = index_postings(factors, np.repeat(np.arange(len(lengths)), sizes), terms, times, shared.value)
            counts = _block_counts(found, np.bincount(np.searchsorted(found.terms, terms), minlength=len(found.terms)))
            blobs = [x.astype(np.int64).tobytes() for x in (*found[:-1], counts)]
            row = [table["shard"][0].as_py(), table["doc_id"].to_pylist(), *blobs, found.payload]
            types = [pa.int32(), pa.list_(pa.int64())] + [pa.binary()] * 9
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=schema.names)

        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                if held and low < high and held[0].column("shard")[0].as_py() != numbers[low]:
                    yield close()
                if low < high:
                    held.append(batch.slice(low, high - low))
        if held:
            yield close()

    return store(map_batches(dealt.select("shard", "doc_id", "n", "terms", "times"), run, schema), "index"), weights


def _block_counts(found: Postings, sizes: np.ndarray) -> np.ndarray:
    """Postings in each block; all but the last of a list are full."""
    counts = np.full(len(found.last), BLOCK, np.int64)
    if len(sizes):
        counts[found.begins[1:] - 1] = (sizes - 1) % BLOCK + 1
    return counts


def search(index: DataFrame, weights: np.ndarray, queries: list[list[tuple[int, int]]], top: int = TOP) -> DataFrame:
    """(query, doc_id, score): the best of every shard for each query, by its place."""
    shared = index.sparkSession.sparkContext.broadcast((weights, queries))  # one part of the queries
    schema = schema_of("query int, doc_id long, score long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, queries = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                arrays = [np.frombuffer(batch.column(c)[k].as_py(), np.int64) for c in range(2, 10)]
                shard = Shard(Postings(*arrays[:7], batch.column(10)[k].as_py()), arrays[7], weights)
                ids = batch.column(1)[k].values
                for number, query in enumerate(queries):
                    scores, docs = shard.search(query, top)
                    columns = [pa.array([number] * len(docs), pa.int32()), ids.take(pa.array(docs)), pa.array(scores, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(index, run, schema)


def best_documents(docs: DataFrame, items: DataFrame, top: int = TOP, postings: int = POSTINGS, part_bytes: int = PART_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``top`` documents for each row of
    ``items`` (item_id, text), highest first, equal scores by ascending doc_id.

    Null, empty and wordless texts have no terms: as items they get no rows, as
    documents they are not counted.  Repeated items each get their rows, repeated
    documents each a rank; rows without doc_id come last among equal scores.  Terms
    that no document holds add nothing, and other columns are left out.  Empty
    tables give no rows.  The driver holds one part of the items at a time.
    """
    spark = docs.sparkSession
    items = items.select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    if parts > 1:
        items = store(items.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts))), "items")
    found = []
    for part in range(parts):
        chosen = items if parts == 1 else items.where(F.col("part") == part)
        rows = sorted(((r["item_id"], terms_of(r["text"])) for r in chosen.collect()), key=repr)
        number_of = {t: k for k, t in enumerate(sorted({t for _, terms in rows for t in terms}))}
        index, weights = build_index(docs, number_of, postings)
        queries = [sorted(Counter(number_of[t] for t in terms).items()) for _, terms in rows]
        names = spark.createDataFrame([(k, r[0]) for k, r in enumerate(rows)], f"query int, item_id {dict(items.dtypes)['item_id']}")
        best_first = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = search(index, weights, queries, top).withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= top)
        found.append(best.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
