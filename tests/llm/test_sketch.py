from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from salesmart.llm import sketch


def text(draw, n):
    return " ".join(f"w{draw.randrange(10_000)}" for _ in range(n))


def of(words):
    return sketch.Sketch.of(sketch.Hasher().shingles(words))


def shingles(words):
    split = words.lower().split()
    return {tuple(split[i : i + 5]) for i in range(max(1, len(split) - 4))} if split else set()


def test_hashes_below_the_fraction_and_none_missing():
    all_hashes = sketch.Hasher().shingles(text(random.Random(1), 5000))
    own = sketch.Sketch.of(all_hashes)
    assert own.limit == sketch._TOP // sketch.SCALE
    assert own.hashes.tolist() == [h for h in all_hashes.tolist() if h <= own.limit]
    assert abs(len(own.hashes) * sketch.SCALE / len(all_hashes) - 1) < 0.15


@pytest.mark.parametrize("n", [3, 40, 300, 20_000])
def test_containment_against_sets(n):
    draw = random.Random(n)
    long = text(draw, 20_000)
    part = " ".join(long.split()[1000 : 1000 + n])
    other = text(draw, n)
    assert of(part).containment(of(long)) > 0.9 if n >= 40 else True
    assert of(other).containment(of(long)) < 0.05
    half = " ".join(part.split()[: n // 2]) + " " + other
    a, b = shingles(half), shingles(part)
    true = len(a & b) / min(len(a), len(b))
    assert abs(of(half).containment(of(part)) - true) < 0.2


def test_merge_is_the_sketch_of_both():
    draw = random.Random(4)
    a, b = text(draw, 3000), text(draw, 2000)
    joined = sketch.Sketch.of(np.union1d(sketch.Hasher().shingles(a), sketch.Hasher().shingles(b)))
    assert of(a).merged(of(b)).text() == joined.text()
    assert sketch.Sketch.read(of(a).text()).text() == of(a).text()
    small = of("a b c d e f").merged(of(a))
    assert small.containment(of(a)) == 1.0


def test_word_memory_does_not_change_results(monkeypatch):
    words = text(random.Random(5), 500)
    want = sketch.Hasher().shingles(words).tolist()
    monkeypatch.setattr(sketch, "_WORDS", 10)
    hasher = sketch.Hasher()
    hasher.shingles(text(random.Random(6), 500))
    assert hasher.shingles(words).tolist() == want


def check(docs, ranges):
    rows = sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    texts = [r["text"] or "" for r in rows]
    want = []
    for i, t in enumerate(texts):
        nxt = texts[(i + 1) % len(texts)]
        changed = t[: len(t) - len(t) // 4] + nxt[: len(t) // 4]
        want.append((rows[i]["doc_id"], len(t), hashlib.sha256(changed.encode()).hexdigest(), of(t).text(), of(changed).text(), of(t).containment(of(changed)), of(t).containment(of(nxt))))
    found = sketch.fingerprint_with_next(docs, ranges).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))


@pytest.mark.parametrize("ranges", [1, 2, 7, 50])
def test_next_document_across_ranges(spark, make_docs, ranges):
    draw = random.Random(ranges)
    rows = [(i * 3 - 20, text(draw, draw.randrange(60)), None, None, None) for i in range(40)]
    check(make_docs(rows).repartition(5), ranges)


def test_awkward_rows(awkward, clashing, no_docs, make_docs):
    for ranges in (1, 4, 20):
        check(awkward, ranges)
    assert sketch.fingerprint_with_next(clashing, 4).count() == awkward.count()
    assert sketch.fingerprint_with_next(no_docs, 4).collect() == []
    check(make_docs([(5, "only one " * 9, None, None, None)]), 3)


@pytest.mark.parametrize("shared", [None, 50])
def test_hot_ids_are_parted(make_docs, shared):
    draw = random.Random(9)
    docs = make_docs([(shared if i % 3 == 0 else i, text(draw, 8), None, None, None) for i in range(1500)])
    dealt, n = sketch.in_ranges(docs, 16, hot_rows=100)
    rows = dealt.collect()
    held = [sum(r["range"] == k and not r["tail"] for r in rows) for k in range(n)]
    assert sum(held) == 1500 and max(held) <= 2 * 1500 / 16
    assert sum(r["tail"] for r in rows) == sum(h > 0 for h in held)

    # Rows follow each other by id, then by hash within the parted one; in one range alike.
    found = [sketch.fingerprint_with_next(docs, k, hot_rows=100) for k in (16, 64)]
    assert sorted(map(tuple, found[0].collect()), key=repr) == sorted(map(tuple, found[1].collect()), key=repr)
    codes = docs.select("doc_id", "text", sketch.F.xxhash64("text").alias("h")).collect()
    order = sorted(codes, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["h"]))
    texts = [r["text"] for r in order]
    want = [hashlib.sha256(sketch.edited(t, u).encode()).hexdigest() for t, u in zip(texts, texts[1:] + texts[:1], strict=True)]
    assert sorted(r["edited_sha256"] for r in found[0].collect()) == sorted(want)


def test_places_among_many_bounds(spark):
    bounds = [(0, 0, 5), *((1, i * i, (1 << 63) - 1) for i in range(300))]
    keys = [(0, 0, 5), (0, 0, 6), (1, 0, 0), (1, 10, 0), (1, 299 * 299, 7), (1, 10**9, 0)]
    table = spark.createDataFrame([(k,) for k in keys], "key struct<known:int,id:long,code:long>")
    got = [r[0] for r in table.select(sketch._before(bounds, "key")).collect()]
    assert got == [sum(b < k for b in bounds) for k in keys]
