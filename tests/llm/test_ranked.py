from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm import ranked


def brute(docs, items, top=20):
    docs = [(key, Counter(ranked.terms_of(text))) for key, text in docs]
    sizes = [sum(c.values()) for _, c in docs]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    holding = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for (key, counted), size in zip(docs, sizes, strict=True):
            score = 0
            for term, times in Counter(ranked.terms_of(text)).items():
                if tf := counted[term]:
                    m = 75 + (25 * size * n) // total
                    score += times * ranked.weight(n, holding[term]) * ((10**9 * tf) // (1000 * tf + 12 * m))
            if score:
                found.append((-score, key is None, key or 0, key))
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found, key=lambda f: f[:3])[:top], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    return [" ".join(draw.choices(words, weights, k=draw.randrange(1, 60))) for _ in range(700)]


ITEMS = [(1, "w0 w1 w59 w40"), (2, "W7 w7, w3!"), (3, None), (4, ""), (5, "nowhere"), (6, "w0"), (6, "w30 w31 w32 w33"), (None, "w2")]


def test_against_brute_force(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, texts[5])] * 3 + [(None, texts[9])] * 30 + [(900, None), (901, ""), (902, "!?")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = brute(rows, ITEMS)
    assert got(ranked.best_documents(docs, items)) == want
    # Many small shards, and items in several parts.
    assert got(ranked.best_documents(docs, items, postings=300, part_bytes=20)) == want


def test_shard_skips_what_cannot_win(monkeypatch):
    monkeypatch.setattr(ranked, "BLOCK", 8)
    monkeypatch.setattr(ranked, "SPAN", 64)
    draw, skipped = np.random.default_rng(5), []
    for trial in range(10):
        docs = 4000
        factors = draw.integers(75, 300, docs)
        weights = np.array([5, 20, 300, 4000, 9000])
        shares = [0.9, 0.5, 0.1, 0.03, 0.01]
        at = [(d, t) for d in range(docs) for t in range(5) if draw.random() < shares[t]]
        d, t = (np.array(x) for x in zip(*at, strict=True))
        times = draw.integers(1, 400 if trial % 2 else 4, len(d))
        found = ranked.index_postings(factors, d, t, times, weights)
        counts = ranked._block_counts(found, np.bincount(t, minlength=5))
        shard = ranked.Shard(found, counts, weights)
        query = [(0, 1), (1, 2), (3, 1), (4, 3)]
        sums = np.zeros(docs, np.int64)
        for term, n in query:
            here = t == term
            sums[d[here]] += n * ranked.impacts(weights[term], times[here], factors[d[here]])
        order = np.lexsort((np.arange(docs), -sums))[:10]
        scores, best = shard.search(query, 10)
        assert best.tolist() == order.tolist() and scores.tolist() == sums[order].tolist()
        # Most blocks of the common list were never unpacked.
        common = range(int(found.begins[0]), int(found.begins[1]))
        skipped.append(sum(b not in shard.blocks for b in common) / len(common))
    assert np.mean(skipped) > 0.5


def test_blocks_come_back():
    for numbers in ([0], [255, 256], [70_000, 1]):
        packed = ranked.pack(np.array(numbers))
        back, end = ranked.unpack(b"x" + packed, 1, len(numbers))
        assert back.tolist() == numbers and end == 1 + len(packed)


def test_awkward_rows(spark, awkward, clashing, no_docs):
    items = spark.createDataFrame([(1, "the grey ROOF"), (2, "naïve 東京"), (3, "x" * 100_000)], "item_id int, text string")
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    want = brute(rows, [tuple(r) for r in items.collect()])
    assert got(ranked.best_documents(awkward, items)) == want
    assert got(ranked.best_documents(clashing, items.withColumn("rank", F.lit(0)))) == want
    assert got(ranked.best_documents(no_docs, items)) == []
    assert got(ranked.best_documents(awkward, items.where("false"))) == []
