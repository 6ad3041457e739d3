"""Each stage against brute force on its own input, and the whole run."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from comparing import connect
from conftest import SF_DIR
from llm.test_decontaminate import brute as brute_contamination
from llm.test_llm_queries import brute_components, brute_fingerprint
from llm.test_mixing import brute_targets, size

import corpus_pipeline
from salesmart.llm import langid, mixing
from salesmart.sources.shared import store

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(store(stage(spark, kept[-1], SF_DIR), name))
    return [k.collect() for k in kept]


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_stages_return_the_columns_of_documents(steps):
    assert [list(rows[0].asDict()) for rows in steps[:-1]] == [corpus_pipeline.COLUMNS] * 5


def test_language_keeps_documents_in_one_language(spark, steps):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    known = langid.train(docs.where(~corpus_pipeline.held_out()))
    script = langid.words_of([r["text"] for r in steps[0]])
    label = langid.best_path(known.scores(script), script.text)
    letters = np.zeros((len(steps[0]), len(known.langs)))
    np.add.at(letters, (script.text, label), script.end - script.start)
    want = [r["doc_id"] for r, n in zip(steps[0], letters, strict=True) if n.sum() and n.max() >= corpus_pipeline.LEAST_SHARE * n.sum()]
    assert ids(steps[1]) == sorted(want)


def test_near_duplicates_keep_one_of_each_class(steps):
    keys = [r["doc_id"] for r in steps[1]]
    prints = np.array([brute_fingerprint(r["text"]) for r in steps[1]], np.uint64)
    assert ids(steps[2]) == sorted(set(brute_components(keys, prints)))


def test_decontamination(steps):
    items = connect(SF_DIR).execute("SELECT item_id, text FROM benchmark").fetchall()
    want = [r["doc_id"] for r in steps[2] if not brute_contamination(r["text"], items)[3]]
    assert ids(steps[3]) == sorted(want)


def test_mixing(steps):
    sizes = Counter()
    for r in steps[3]:
        sizes[r["source"]] += size(r["text"])
    targets, taken, copies = brute_targets(dict(sizes)), Counter(), Counter(ids(steps[4]))
    for r in steps[3]:
        rate = float(targets[r["source"]] / sizes[r["source"]])
        assert int(rate) <= copies[r["doc_id"]] <= int(rate) + 1
        taken[r["source"]] += copies[r["doc_id"]] * size(r["text"])
    assert abs(sum(taken.values()) - sum(sizes.values())) < 0.15 * sum(sizes.values())


def test_sharding(steps):
    assert ids(steps[5]) == ids(steps[4])
    sizes = Counter()
    for r in steps[5]:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= max(r["size"] for r in steps[5])


def test_run(spark, steps):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, steps[5]))


def test_awkward_rows_through_all_stages(spark, awkward, clashing, no_docs, tables):
    items = spark.createDataFrame([(1, "the cat sat"), (None, None)], "item_id long, text string")
    folder = tables(benchmark=items)
    for docs in (awkward, clashing, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            docs = store(stage(spark, docs, folder), name)
        docs.collect()
    none = STAGES["near_duplicates"](spark, no_docs, folder)
    assert none.columns == corpus_pipeline.COLUMNS and none.collect() == []
    assert mixing.emit(mixing.mix(no_docs, mixing.source_targets(no_docs))).collect() == []
