"""Corpus statistics of the toxicity operator cover all labelled rows, whatever the classifier's sample."""

import random

import numpy as np

from delayloom.llm import toxicity
from delayloom.llm._spark import arrow_batches, held_out
from delayloom.llm.queries import importable


def test_lexicon_and_votes_cover_all_labels(spark, monkeypatch):
    importable(spark)
    random.seed(9)
    rows = []
    for i in range(1200):
        words = [f"word{random.randrange(300)}" for _ in range(30)]
        if i % 8 == 0:
            words[3] = "rarevile" if i % 96 == 0 else "vilest"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i, _ in rows], "doc_id long, toxic int")
    seen, whole = [], toxicity.LabelModel

    def watched(patterns, counts, toxic):
        seen.append((counts.sum(), toxic.sum()))
        return whole(patterns, counts, toxic)

    monkeypatch.setattr(toxicity, "LabelModel", watched)
    with arrow_batches(spark):
        model = toxicity.fit(docs, labels, fit_rows=100)
    data = np.frombuffer(b"rarevile", dtype=np.uint8)
    word = toxicity.form_hashes(data, np.array([0, len(data)]))[0][0]
    assert len(model.lexicon.shares(word)[0]) == 1
    learnt = labels.filter(~held_out(labels["doc_id"]))
    assert seen == [(learnt.count(), learnt.filter("toxic = 1").count())]


def test_only_labelled_texts_are_moved(spark, monkeypatch):
    """The join with the labels has one plan at every size: no broadcast of labels, no move of texts without one."""
    importable(spark)
    docs = spark.range(400).selectExpr("id as doc_id", "concat('some words ', id) as text")
    labels = spark.range(0, 400, 10).selectExpr("id as doc_id", "cast(id % 20 = 0 as int) as toxic")
    plans, whole = {}, toxicity.stored

    def watched(df, name, *rest):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return whole(df, name, *rest)

    monkeypatch.setattr(toxicity, "stored", watched)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.optimizer.runtime.bloomFilter.numBits")
    before = [spark.conf.get(key) for key in keys]
    with arrow_batches(spark):
        toxicity.fit(docs, labels)
    assert "BroadcastHashJoin" not in plans["labelled"] and "ShuffledHashJoin" in plans["labelled"]
    assert "might_contain" in plans["labelled"]
    assert [spark.conf.get(key) for key in keys] == before
