from __future__ import annotations

import random
import re
from collections import Counter
from fractions import Fraction

import pytest

from salesmart.llm import mixing


def brute_targets(sizes, weights=mixing.WEIGHTS, most=mixing.MOST):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, stopped = {}, set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in stopped)
        total = sum(weight[s] for s in names if s not in stopped)
        target = {s: Fraction(most * sizes[s]) if s in stopped else Fraction(weight[s] * left, total) for s in names} if total else target
        above = {s for s in names if s not in stopped and target[s] > most * sizes[s]}
        if not above:
            return target
        stopped |= above


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("seed", range(4))
def test_targets_against_brute_force(make_docs, seed):
    draw = random.Random(seed)
    names = [None, "a", "B", "é", "z", "\U0001f600", "～", "", "ab", "b0"][: draw.randrange(2, 11)]
    rows = []
    for name in names:
        rows += [(len(rows) + i, "w " * draw.choice([0, 1, 5, 300]), None, name, None) for i in range(draw.randrange(1, 30))]
    sizes = Counter(dict.fromkeys(names, 0))
    for _, text, _, name, _ in rows:
        sizes[name] += size(text)
    found = {r["source"]: r for r in mixing.source_targets(make_docs(rows).repartition(3)).collect()}
    want = brute_targets(dict(sizes))
    assert {s: r["source_size"] for s, r in found.items()} == dict(sizes)
    for s, r in found.items():
        assert abs(r["target"] - float(want[s])) < 1e-6 * max(1, float(want[s]))
    assert abs(sum(r["target"] for r in found.values()) - sum(sizes.values())) < 1e-6 * sum(sizes.values()) + 1e-9


def test_taken_is_near_the_target_and_reruns_agree(make_docs):
    draw = random.Random(9)
    rows = [(i, "w " * draw.randrange(1, 40), None, draw.choice("aaaaaabcd"), None) for i in range(20_000)]
    docs = make_docs(rows)
    mixed = mixing.mix(docs, mixing.source_targets(docs))
    taken, target = Counter(), {}
    first = mixed.collect()
    for r in first:
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
    for s, t in target.items():
        assert abs(taken[s] - t) < 0.05 * t
    again = mixing.mix(docs.repartition(7), mixing.source_targets(docs)).collect()
    assert {(r["doc_id"], r["copies"]) for r in again} == {(r["doc_id"], r["copies"]) for r in first}
    assert mixing.emit(mixed).count() == sum(r["copies"] for r in first)


def test_no_python_in_the_plan(spark, capsys):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    mixing.mix(docs, mixing.source_targets(docs)).explain("formatted")
    plan = capsys.readouterr().out
    assert not re.search("Python|Pandas|Arrow", plan)


def test_awkward_rows(awkward, clashing, no_docs):
    rows = mixing.mix(awkward, mixing.source_targets(awkward)).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert r["size"] == size(r["text"])
    assert {r["source"]: r["target"] for r in rows}[None] == pytest.approx(float(brute_targets(_sizes(rows))[None]))
    again = mixing.mix(clashing, mixing.source_targets(clashing))
    assert again.columns.count("size") == again.columns.count("copies") == 1
    assert again.count() == len(rows)
    assert mixing.emit(again).columns == again.columns
    assert mixing.mix(no_docs, mixing.source_targets(no_docs)).collect() == []


def _sizes(rows):
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
    return dict(sizes)


def test_only_texts_without_words(make_docs):
    docs = make_docs([(1, None, None, "a", None), (2, "", None, "b", None)])
    rows = mixing.mix(docs, mixing.source_targets(docs)).collect()
    assert {(r["target"], r["copies"]) for r in rows} == {(0.0, 0)}
