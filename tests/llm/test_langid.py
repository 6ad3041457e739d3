from __future__ import annotations

import random
from itertools import product

import numpy as np
from pyspark.sql import functions as F

from salesmart.llm import langid

ENGLISH = "the quick brown fox jumps over the lazy dog while the other animals watch with interest from behind the fence"
GERMAN = "der schnelle braune fuchs springt über den faulen hund während die anderen tiere hinter dem zaun neugierig zuschauen"
RUSSIAN = "быстрая коричневая лиса прыгает через ленивую собаку пока другие звери смотрят"


def shuffled(draw, text, n):
    words = text.split()
    return " ".join(draw.choice(words) for _ in range(n))


def model(make_docs):
    draw = random.Random(0)
    rows = [(i, shuffled(draw, t, 80), lang, None, None) for i in range(20) for t, lang in ((ENGLISH, "en"), (GERMAN, "de"), (RUSSIAN, "ru"))]
    return langid.train(make_docs([*rows, (99, "whatever", None, None, None), (98, None, "en", None, None)]))


def test_path_is_the_best_of_all():
    draw = np.random.default_rng(1)
    lengths = [1, 5, 3, 6, 1, 2]
    text = np.repeat(np.arange(len(lengths)), lengths)
    scores = draw.normal(0, 2, (len(text), 3)).astype(np.float32)
    found = langid.best_path(scores, text, penalty=1.5)
    for i in range(len(lengths)):
        own = scores[text == i].astype(float)
        value = lambda path: sum(own[t, k] for t, k in enumerate(path)) - 1.5 * sum(a != b for a, b in zip(path, path[1:], strict=False))
        best = max(value(p) for p in product(range(3), repeat=len(own)))
        assert abs(value(found[text == i].tolist()) - best) < 1e-6


def test_spans_of_a_mixed_text(make_docs):
    text = f"{ENGLISH}. {RUSSIAN}! {GERMAN}"
    row = langid.identify(make_docs([(1, text, None, None, None)]), model(make_docs)).first()
    assert [s["lang"] for s in row["spans"]] == ["en", "ru", "de"]
    assert [text[s["start"] : s["end"]] for s in row["spans"]] == [ENGLISH, RUSSIAN, GERMAN]
    assert 0.3 < row["score"] < 0.6


def test_one_document_in_ten_thousand_is_known(spark, make_docs):
    dutch = "de snelle bruine vos springt over de luie hond terwijl andere dieren vanachter het hek met belangstelling toekijken"
    draw = random.Random(5)
    common = spark.range(9999).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, GERMAN).otherwise(ENGLISH).alias("text"))
    common = common.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "de").otherwise("en"))
    known = langid.train(common.unionByName(make_docs([(9999, dutch, "nl")], "doc_id long, text string, lang string")))
    texts = [(i, shuffled(draw, text, 30), lang, None, None) for i in range(10) for text, lang in ((dutch, "nl"), (ENGLISH, "en"), (GERMAN, "de"))]
    rows = langid.identify(make_docs([*texts, (99, RUSSIAN + " " + dutch, "nl", None, None)]), known).collect()
    assert [r["lang_pred"] for r in rows if r["doc_id"] < 99] == [lang for _, _, lang, _, _ in texts]
    assert rows[-1]["spans"][-1]["lang"] == "nl"


def test_slices_and_batches_do_not_matter(spark, make_docs, monkeypatch):
    draw = random.Random(3)
    docs = make_docs([(i, shuffled(draw, draw.choice([ENGLISH, GERMAN, RUSSIAN]), draw.randrange(50)), None, None, None) for i in range(60)])
    known = model(make_docs)
    want = langid.identify(docs, known).orderBy("doc_id").collect()
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    monkeypatch.setattr(langid, "SLICE_BYTES", 100)
    labels = langid._task(type("Shared", (), {"value": known}), True)(texts)
    assert labels[0] == [r["lang_pred"] for r in want]
    assert [[s["end"] for s in spans] for spans in labels[2]] == [[s["end"] for s in r["spans"]] for r in want]


def test_awkward_rows(awkward, clashing, no_docs, make_docs):
    known = model(make_docs)
    rows = langid.identify(awkward, known).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert (r["score"] == 0) == (not letters) and 0 <= r["score"] <= 1
    again = langid.identify(clashing, known)
    assert again.columns.count("score") == 1 and again.count() == len(rows)
    assert langid.identify(no_docs, known).collect() == []
    untrained = langid.train(no_docs)
    assert {r["lang_pred"] for r in langid.identify(awkward, untrained).collect()} == {"und"}
    single = langid.train(make_docs([(1, ENGLISH, "en", None, None)]))
    assert {r["lang_pred"] for r in langid.identify(awkward.where(F.length("text") > 9), single).collect()} == {"en"}
