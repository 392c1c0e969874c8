"""Benchmark items that are short, have no id or are repeated."""

from delayloom.llm import decontaminate
from delayloom.llm.queries import importable


def test_short_and_nameless_items_are_found(spark):
    importable(spark)
    long = "a question of more than forty-eight bytes that has no id but must not be trained on"
    items = [(1, "What is 7 x 8?"), (2, "Paris"), (2, "Paris"), (3, "the capital of France is a city"), (None, long),
             (None, "Nameless Item"), (5, "  "), (6, None), (7, "(é)")]
    texts = ["He asked:  what is\n7 X 8?  Nobody knew", "comparison and parish", "in PARIS", "the capital of France is a cityscape",
             "so the capital  of france is a city.", f"x {long.upper()} y", "a nameless item", None, "", "x(É)y", "paris paris"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = sorted(((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, benchmark).collect()), key=str)
    expected = [(0, 1), (2, 2), (2, 2), (4, 3), (5, None), (6, None), (9, 7), (10, 2), (10, 2)]
    assert found == sorted(expected, key=str)
    first = decontaminate.contaminated(docs, benchmark).filter("item_id = 1").first()
    assert texts[0].encode()[first.start : first.end].decode() == "what is\n7 X 8?"
    kept = {r.doc_id for r in decontaminate.drop_contaminated(docs, benchmark).collect()}
    assert kept == {1, 3, 7, 8}
