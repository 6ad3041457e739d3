from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from salesmart.llm import quality

WORDS = [f"word{i}" for i in range(200)]


def bags_of(n, seed):
    draw = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = [draw.choice(WORDS) for _ in range(draw.randrange(20, 400))]
        if i % 3 == 0:  # one passage of junk among others
            at = draw.randrange(len(words))
            words[at:at] = ["SPAM!!"] * 80
        texts.append(" ".join(words))
        labels.append(int(i % 3 != 0))
    return texts, labels


def test_slopes_against_differences():
    draw = np.random.default_rng(1)
    model = quality.Model()
    figures, first, labels = draw.normal(size=(7, quality._FEATURES)), np.array([0, 3, 4]), np.array([1.0, 0.0, 1.0])

    def loss():
        score = model.forward(figures, first)["score"]
        return -np.mean(labels * np.log(score) + (1 - labels) * np.log(1 - score))

    slopes = model.slopes(model.forward(figures, first), first, labels)
    for name, part in model.parts.items():
        for at in list(np.ndindex(part.shape))[:5]:
            kept = part[at]
            part[at] = kept + 1e-6
            up = loss()
            part[at] = kept - 1e-6
            down = loss()
            part[at] = kept
            assert abs((up - down) / 2e-6 - slopes[name][at]) < 1e-6, name


def test_attention_adds_up_and_finds_the_passage():
    texts, labels = bags_of(300, 1)
    model = quality.Model().fit([quality.describe(t) for t in texts], np.array(labels, float))
    bags = [quality.describe(t) for t in bags_of(60, 2)[0]]
    first = np.cumsum([0] + [len(b) for b in bags[:-1]])
    found = model.forward(np.concatenate(bags), first)
    assert np.allclose(np.add.reduceat(found["attention"], first), 1)
    assert np.mean((found["score"] > 0.5) == (np.arange(60) % 3 != 0)) > 0.95


def test_passages_cover_whole_texts():
    assert quality.describe(" ".join(WORDS)).shape == (4, quality._FEATURES)
    for text in (None, "", " \n"):
        assert (quality.describe(text) == 0).all() and len(quality.describe(text)) == 1


def test_awkward_rows(make_docs, awkward, clashing, no_docs):
    texts, labels = bags_of(120, 3)
    sample = make_docs([(i, t, None, None, None) for i, t in enumerate(texts)]).withColumn("quality", (F.col("doc_id") % 3 != 0).cast("int"))
    model = quality.train(sample.select("text", "quality"))
    rows = quality.score(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    again = quality.score(awkward.repartition(5), model).collect()
    assert np.allclose(sorted(r["score"] for r in rows), sorted(r["score"] for r in again), rtol=1e-9)
    again = quality.score(clashing, model)
    assert again.columns.count("score") == 1 and again.count() == len(rows)
    assert quality.score(no_docs, model).collect() == []
    assert quality.train(no_docs.select("text", F.lit(1).alias("quality"))) is None
    assert {r["score"] for r in quality.score(awkward, None).collect()} == {0.0}
