from __future__ import annotations

import random
import re

from conftest import ROOT

from salesmart.llm import decontaminate as dc

ITEMS = "item_id long, text string"


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(text, items):
    own, hit, ids = words(text), set(), set()
    for key, item in items:
        w = words(item)
        n = min(13, len(w))
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(own) - n + 1):
            if n and tuple(own[i : i + n]) in grams:
                hit.update(range(i, i + n))
                ids.add("null" if key is None else str(key))
    return len(own), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(own)


def random_case(seed):
    draw = random.Random(seed)
    vocabulary = ["a", "B", "ab", "é", "É", "1", "x9", "東"]
    gaps = [" ", ", ", "\n", "-", "_", "  "]
    make = lambda n: "".join(draw.choice(vocabulary) + draw.choice(gaps) for _ in range(n))
    items = [(i, make(draw.choice([0, 1, 3, 12, 13, 14, 30]))) for i in range(8)]
    docs = []
    for i in range(60):
        text = make(draw.randrange(40))
        if draw.random() < 0.6:
            text += " ".join(words(draw.choice(items)[1])).upper() + " " + make(draw.randrange(20))
        docs.append((i, text, None, None, None))
    return docs, items


def test_against_brute_force(spark, make_docs):
    for seed in range(4):
        docs, items = random_case(seed)
        bench = spark.createDataFrame(items, ITEMS)
        for pass_bytes in (dc.PASS_BYTES, 40):
            for r in dc.contamination(make_docs(docs), bench, pass_bytes).collect():
                assert (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) == brute(r["text"], items)


def test_offsets_in_the_original(spark, make_docs):
    item = " ".join(f"w{i}" for i in range(15))
    text = f"É before: {item.upper().replace(' ', ' -- ')}; after"
    row = dc.find_benchmark(make_docs([(1, text, None, None, None)]), spark.createDataFrame([(4, item)], ITEMS)).first()
    assert [text[h["start"] : h["end"]] for h in row["hits"]] == [item.upper().replace(" ", " -- ")]


def test_awkward_rows(spark, awkward, clashing, no_docs):
    items = [(None, "the cat sat on the mat while rain fell on the old grey roof"), (1, None), (2, ""), (3, "the cat"), (3, "the cat"), (4, "?!")]
    bench = spark.createDataFrame(items, ITEMS)
    rows = dc.contamination(awkward, bench).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) == brute(r["text"], items)
    again = dc.contamination(clashing, bench)
    assert again.columns.count("items") == 1 and again.count() == len(rows)
    assert dc.contamination(no_docs, bench).collect() == []
    none = dc.contamination(awkward, spark.createDataFrame([], ITEMS)).collect()
    assert {(r["n_hit"], r["contaminated"]) for r in none} == {(0, False)}


def test_memory_of_a_whole_pass():
    """An automaton of ``PASS_BYTES`` of items, in a process of its own."""
    import subprocess
    import sys

    code = """
import random, resource
from salesmart.llm import decontaminate as d
draw = random.Random(1)
words = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(20000)]
items = [(str(i), " ".join(draw.choices(words, k=100))) for i in range(d.PASS_BYTES // 700)]
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
matcher = d.Matcher(items)
assert matcher.find(d.words_of(items[5][1]))[0] == [(0, 100)]
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=str(ROOT))
    assert int(out.stdout.split()[-1]) < 700
