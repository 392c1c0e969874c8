"""Repeated rows, rows without doc_id and several texts under one doc_id in near-dedup."""

from collections import Counter

import corpus_pipeline

from delayloom.llm import chosen_path
from delayloom.llm.queries import importable


def test_every_class_keeps_exactly_one_row(spark):
    importable(spark)
    text = lambda name, *changed: " ".join("changed" if k in changed else f"{name}{k}" for k in range(120))
    rows = [(1, text("a")), (1, text("a")), (1, text("a")),  # a row three times
            (None, text("b")), (None, text("b")),  # without doc_id only
            (None, text("c", 30)), (7, text("c")), (8, text("c", 30, 70)),  # linked through a row without doc_id
            (9, text("d")), (9, text("e")), (10, text("e", 50)),  # two texts under one doc_id
            (11, ""), (12, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_deduplication(spark, docs, "").collect())
    assert kept == Counter([(1, text("a")), (None, text("b")), (7, text("c")), (9, text("d")), (9, text("e")), (11, ""), (12, None)])
    got = chosen_path.near_duplicates(docs).select("doc_id", "component_id", "kept").collect()
    assert len(got) == len(rows)
    assert Counter(tuple(r) for r in got) == Counter({
        (1, 1, True): 3, (None, None, False): 2, (None, 7, False): 1, (7, 7, True): 1, (8, 7, False): 1, (9, 9, True): 2,
        (10, 9, False): 1, (11, 11, True): 1, (12, 12, True): 1})
