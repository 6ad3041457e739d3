"""Words of documents that a benchmark repeats.

One Aho-Corasick automaton holds every window of ``WINDOW`` consecutive words of
every item.  A text is normalised, scanned once, and what is found is carried
back to words and to offsets of the original text.
"""

from __future__ import annotations

import functools
import re
from collections import defaultdict

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.batches import append_columns

WINDOW = 13

#: UTF-8 bytes of item texts in one automaton, which takes some 500 bytes for each of
#: them in every worker.  A larger benchmark is scanned in as many passes as it takes;
#: the driver holds the items of one pass at a time.
PASS_BYTES = 1_000_000

#: Each byte as part of a word in lower case, or as a blank.  Bytes from 0x80 on
#: belong to words, so this works on UTF-8 without decoding.
_NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

MATCHES = "n_words long, hits array<struct<start:long,end:long>>, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split()


def windows(text: str | None) -> set[tuple[bytes, ...]]:
    words = words_of(text)
    if len(words) <= WINDOW:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + WINDOW]) for i in range(len(words) - WINDOW + 1)}


def _spaced(words) -> str:
    # One character for each byte: positions count bytes of the normalised text.
    return " " + b" ".join(words).decode("latin-1") + " "


class Matcher:
    """All windows of some items.  ``items`` holds (item_id, text)."""

    def __init__(self, items: list[tuple[str, str | None]]):
        owners: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
        for item, text in items:
            for window in windows(text):
                owners[window].add(item)
        self.automaton = ahocorasick.Automaton()
        for window, ids in owners.items():
            self.automaton.add_word(_spaced(window), (len(window), ids))
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges of word numbers inside windows, end exclusive, and the items."""
        if self.empty or not words:
            return [], set()
        text = _spaced(words)
        found = list(self.automaton.iter(text))
        if not found:
            return [], set()
        # Word k ends at the blank that is number k + 1.
        blanks = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 0x20)
        ends = np.searchsorted(blanks, [at for at, _ in found])
        lengths = np.array([length for _, (length, _) in found])
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, ends - lengths, 1)
        np.add.at(change, ends, -1)
        inside = np.concatenate([[False], np.cumsum(change[:-1]) > 0, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)), set().union(*(ids for _, (_, ids) in found))


@functools.lru_cache(maxsize=1)
def _matcher(shared) -> Matcher:
    """One automaton for each worker process and broadcast."""
    return Matcher(shared.value)


def _passes(benchmark: DataFrame, pass_bytes: int) -> list[DataFrame]:
    """Disjoint parts of the items, each of about ``pass_bytes`` at most."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // pass_bytes) or 1
    if n == 1:
        return [items]
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


def find_benchmark(docs: DataFrame, benchmark: DataFrame, pass_bytes: int = PASS_BYTES, spans: bool = True) -> DataFrame:
    """``docs`` and n_words, ``hits`` (ranges in code points of the original text,
    end exclusive; ranges of word numbers if ``spans`` is false) and ``items``.

    Rows are not moved: a document is scanned where it is read.  A null or empty
    text has no words; an item without words has no window; a null item_id counts
    as 'null', repeated items as one.  Columns of these names in ``docs`` are
    replaced.
    """
    spark = docs.sparkSession
    found = docs.withColumns({"hits": F.lit(None).cast("array<struct<start:long,end:long>>"), "items": F.lit(None).cast("array<string>")})
    for part in _passes(benchmark, pass_bytes):
        shared = spark.sparkContext.broadcast([tuple(r) for r in part.distinct().collect()])
        found = append_columns(found, ["text", "hits", "items"], functools.partial(_scan, shared, spans), MATCHES)
    return found


def _scan(shared, spans: bool):
    matcher = _matcher(shared)

    def columns(texts, hits_before, items_before):
        out = [], [], []
        for text, hits, items in zip(texts, hits_before, items_before, strict=True):
            words = words_of(text)
            ranges, ids = matcher.find(words)
            if spans and ranges:
                bounds = [m.span() for m in _WORD.finditer(text)]
                ranges = [(bounds[a][0], bounds[b - 1][1]) for a, b in ranges]
            ranges = merged(ranges + [(h["start"], h["end"]) for h in hits or []])
            out[0].append(len(words))
            out[1].append([{"start": a, "end": b} for a, b in ranges])
            out[2].append(sorted(ids.union(items or [])))
        return out

    return columns


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of ranges; those that touch are joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``docs`` and n_words, n_hit, items and ``contaminated``: at least a twentieth
    of the words lie inside windows."""
    found = find_benchmark(docs, benchmark, pass_bytes, spans=False)
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda total, h: total + h["end"] - h["start"])
    return found.withColumn("n_hit", hit).drop("hits").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )
