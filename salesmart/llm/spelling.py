"""Spelling variants: words one edit apart, and the frequent form each goes back to.

Asymmetric q-chunks find the pairs.  The longer word of a pair is cut into two
disjoint chunks of half its length; the other gives all its positional grams of
that length.  One inserted, deleted or replaced letter leaves one of the chunks
whole and moves it by one place at most, so every pair meets in a join of chunks
with grams whose places differ by one at most.  What meets is verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.batches import map_batches, schema_of, slices
from salesmart.sources.shared import store, store_counted

#: Code points and occurrences of a word, at least.
LETTERS, OCCURRENCES = 7, 2
#: A word goes back to one that is so many times as frequent.
TIMES = 10
#: Words that a task counts before it sends them on.
_HELD = 200_000


def _runs(text: str | None, letters: int) -> list[str]:
    """Runs of letters of ``letters`` code points or more, A-Z in lower case."""
    low = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    return re.findall("[a-zÀ-ÿ]{%d,}" % letters, low)


def misspelt(doc_id: int | None, run: str, every: int) -> str:
    """``run``, without one of its letters where ``every`` divides the checksum of
    document and run.  A null doc_id counts as 'null'."""
    code = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
    if code % every:
        return run
    at = code % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, every: int | None = None, letters: int = LETTERS, occurrences: int = OCCURRENCES) -> DataFrame:
    """word and n (occurrences over all rows of ``docs``), one row per word.

    ``every``: one in so many runs of a document loses a letter (``misspelt``), a
    source of known misspellings.  Null and empty texts have no words, repeated
    rows count each time, and a run of any length is one word.
    """
    schema = schema_of("word string, n long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            columns = [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())]
            total.clear()
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in batches:
            for part in slices(batch):
                for doc_id, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    for run, n in Counter(_runs(text, letters)).items():
                        word = misspelt(doc_id, run, every) if every else run
                        if len(word) >= letters:
                            total[word] += n
                    if len(total) > _HELD:
                        yield flush()
        yield flush()

    counted = map_batches(docs.select("doc_id", "text"), count, schema)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


def _letters_set(word: Column) -> Column:
    """The letters of a word as bits, code points modulo 64: one edit changes two
    of them at most."""
    bits = F.transform(F.split(word, ""), lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c) % 64))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda all_, bit: all_.bitwiseOR(bit))


def _gram(word: Column, at: Column | int, q: Column) -> Column:
    return F.substring(word, F.lit(at) + 1 if isinstance(at, int) else at + 1, q)


def links(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): each pair of words (word, n) one edit apart, once.

    A pair is longer word and shorter one, or of equal lengths the larger one and
    the smaller.  Grams more than one place from a chunk join with nothing and are
    not written.  Both sides are plain exchanges by a hash of length, chunk and
    letters, so a chunk that very many words share is split between tasks, and
    the join gives verified pairs only.
    """
    words = words.withColumn("length", F.length("word")).withColumn("bits", _letters_set(F.col("word")))
    chunks = words.withColumn("q", F.floor(F.col("length") / 2).cast("int")).select(
        F.col("word").alias("a"),
        F.col("n").alias("a_n"),
        F.col("bits").alias("a_bits"),
        F.col("length").alias("a_length"),
        F.col("q"),
        F.posexplode(F.array(_gram(F.col("word"), 0, F.col("q")), _gram(F.col("word"), F.col("q"), F.col("q")))).alias("chunk", "gram"),
    )
    chunks = chunks.select("a", "a_n", "a_bits", "a_length", "q", "chunk", F.xxhash64("a_length", "chunk", "gram").alias("key"))

    # Words give grams to chunks of their own length and of the next.
    grams = words.select(
        F.col("word").alias("b"),
        F.col("n").alias("b_n"),
        F.col("bits").alias("b_bits"),
        F.col("length").alias("b_length"),
        F.explode(F.array(F.col("length"), F.col("length") + 1)).alias("met"),
    )
    grams = grams.withColumn("r", F.floor(F.col("met") / 2).cast("int"))
    places = [(0, F.lit(0)), (0, F.lit(1)), (1, F.col("r") - 1), (1, F.col("r")), (1, F.col("r") + 1)]
    keys = [
        F.when(at + F.col("r") <= F.col("b_length"), F.xxhash64("met", F.lit(chunk), _gram(F.col("b"), at, F.col("r"))))
        for chunk, at in places
    ]
    grams = grams.select("b", "b_n", "b_bits", "b_length", F.explode(F.array_distinct(F.array_compact(F.array(*keys)))).alias("key"))

    first = _gram(F.col("a"), 0, F.col("q"))
    by_first = (_gram(F.col("b"), 0, F.col("q")) == first) | (_gram(F.col("b"), 1, F.col("q")) == first)
    met = (
        (chunks["key"] == grams["key"])
        & ((F.col("a_length") > F.col("b_length")) | ((F.col("a_length") == F.col("b_length")) & (F.col("a") > F.col("b"))))
        & (F.bit_count(F.col("a_bits").bitwiseXOR(F.col("b_bits"))) <= 2)
        # By its second chunk a pair counts only if it did not meet by the first.
        & ((F.col("chunk") == 0) | ~by_first)
        & (F.levenshtein("a", "b", 1) == 1)
    )
    return chunks.join(grams, met).select("a", "a_n", "b", "b_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form (word, form): where following forms ends.

    Each round doubles the steps taken, and forms are at least ``TIMES`` as
    frequent as their words, so a few rounds reach the end of any chain.
    """
    at = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved, n = store_counted(at.join(onward, "root").select("word", F.col("next").alias("root")), "moved-roots")
        if not n:
            return at
        at = store(at.join(moved.select("word"), "word", "left_anti").unionByName(moved), "roots")


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """word, n, n_near (words one edit apart), form (the most frequent of them, the
    smallest of equal ones, if ``times`` as frequent), form_n and root, one row
    per row of ``words`` (word, n), whose words are distinct.

    Equal code points are equal letters: no case or accent is folded here.  A word
    without near words has n_near 0, no form, and is its own root; an empty table
    gives none.
    """
    words = store(words.select("word", "n"), "vocabulary")
    ends = F.array(
        F.struct(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("near")).alias("by")),
        F.struct(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("less"), F.col("a").alias("near")).alias("by")),
    )
    near = links(words).select(F.explode(ends).alias("end")).select("end.*")
    near = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("by").alias("best"))
    frequent = -F.col("best.less") >= times * F.col("n")
    found = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"),
        F.when(frequent, -F.col("best.less")).alias("form_n"),
    )
    found = store(found, "forms")
    ended = roots(found.where("form IS NOT NULL").select("word", "form"))
    return found.join(ended, "word", "left").withColumn("root", F.coalesce("root", "word"))
