from __future__ import annotations

import random

import numpy as np
from llm.test_llm_queries import brute_components, brute_fingerprint

from salesmart.llm import simhash
from salesmart.llm.components import connected


def near(draw, code, bits):
    for b in draw.sample(range(64), bits):
        code ^= 1 << b
    return code


def cloud(seed, n):
    """Codes in chains and clusters, and some apart."""
    draw = random.Random(seed)
    codes = [draw.getrandbits(64) for _ in range(10)]
    while len(codes) < n:
        codes.append(near(draw, draw.choice(codes), draw.choice([1, 2, 3, 3, 4, 5])))
    return list(dict.fromkeys(codes))


def test_tree_finds_what_a_scan_finds():
    codes = cloud(1, 400)
    tree = simhash.BkTree()
    for c in codes:
        tree.add(c)
    for q in codes[::7]:
        assert sorted(tree.near(q, 3)) == [i for i, c in enumerate(codes) if (q ^ c).bit_count() <= 3]
    assert list(simhash.BkTree().near(5, 3)) == []


def test_classes_do_not_depend_on_the_size_of_pieces(spark):
    codes = cloud(2, 300)
    frame = spark.createDataFrame([(simhash.signed(c),) for c in codes], "fp long")
    ids = [simhash.signed(c) for c in codes]
    want = dict(zip(ids, brute_components(ids, np.array(codes, np.uint64)), strict=True))
    for piece in (2000, 7, 2):
        got = {r["node"]: r["root"] for r in connected(simhash.links(frame, piece=piece)).collect()}
        assert {i: got.get(i, i) for i in ids} == want


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(100, 100 + i) for i in range(1, 50)]
    found = {r["node"]: r["root"] for r in connected(spark.createDataFrame([*chain, *star, (7, 7), (1, 0)], "u long, v long")).collect()}
    assert found == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(50)}
    assert connected(spark.createDataFrame([], "u long, v long")).collect() == []


def test_fingerprints_of_short_texts():
    for text in (None, "", "  \t", "one", "one two", "A b C", "a b c d", "é   x y"):
        assert simhash.fingerprint(text) == brute_fingerprint(text)
    assert simhash.fingerprint("A\x0bB\x0cC\rD") == simhash.fingerprint("a b c d")


def test_awkward_rows(awkward, clashing, no_docs):
    rows = simhash.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    by_text = {r["fp"]: r["component_id"] for r in rows}
    assert by_text[0] == 1  # null, empty, blank and null id; the smallest id names the class
    same = {r["component_id"] for r in rows if r["fp"] == simhash.signed(simhash.fingerprint(awkward.collect()[6]["text"]))}
    assert same == {5}
    kept = simhash.keep_one(awkward, simhash.near_duplicates(awkward)).collect()
    assert len(kept) == len({r["root"] for r in rows})
    assert {r["doc_id"] for r in kept} == {1, 4, 5, 6, 7, 8, 9} - ({7} if len(kept) == 6 else set())
    assert simhash.near_duplicates(clashing).count() == len(rows)
    assert simhash.near_duplicates(no_docs).collect() == []
    assert simhash.keep_one(no_docs, simhash.near_duplicates(no_docs)).collect() == []


def test_rows_without_any_id(make_docs):
    docs = make_docs([(None, "a b c d", None, None, None), (None, "a b c d", "en", None, None)])
    rows = simhash.near_duplicates(docs).collect()
    assert [r["component_id"] for r in rows] == [None, None]
    assert simhash.keep_one(docs, simhash.near_duplicates(docs)).count() == 1
