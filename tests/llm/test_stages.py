"""All stages of the pipeline on awkward rows: nulls, repeats, shared ids, long texts, clashing and map columns, nothing."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from delayloom.llm import decontaminate, packing
from delayloom.llm.queries import importable

#: Names that operators add or use inside, and a type that cannot be ordered.
EXTRA = ("kept", "n_words", "n_lines", "n_removed", "_mark", "mark", "row", "class", "other_columns", "posterior", "id", "m", "a.b")
LEAK = "a question of more than forty-eight bytes that must not be trained on by anyone"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    importable(spark)
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(1, LEAK), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def frame(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({name: F.lit(f"own {name}") for name in EXTRA if "." not in name})
    return docs.withColumn("a.b", F.lit("own a.b")).withColumn("tags", F.create_map(F.lit("k"), F.col("doc_id")))


def prose(name, lines=8):
    return "\n".join(" ".join(f"{name}{line}word{k}" for k in range(20)) + "." for line in range(lines))


def rows_of(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


ROWS = [(1, prose("a")), (1, prose("a")), (2, prose("a")), (None, prose("b")), (3, prose("c")), (3, f"{prose('d')}\n{LEAK}"),
        (None, f"{prose('e')}\n{LEAK}"), (4, None), (5, ""), (6, " \n "), (7, " ".join(f"long{k}" for k in range(20000)))]


def test_every_stage_returns_the_columns_as_they_were(spark, folder):
    docs = frame(spark, ROWS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.schema.names == docs.schema.names and out.dtypes == docs.dtypes, name
        for row in out.collect():
            assert all(row[extra] == f"own {extra}" for extra in EXTRA), name
            assert row["tags"] == {"k": row["doc_id"]}, name
        empty = stage(spark, docs.limit(0), folder)
        assert empty.count() == 0 and empty.dtypes == docs.dtypes, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), folder).count() == 0


def test_quality_keeps_good_rows_and_repeats(spark, folder):
    kept = rows_of(corpus_pipeline.quality_rules(spark, frame(spark, ROWS), folder))
    gone = {None, "", " \n "}
    assert kept == Counter({row: n for row, n in Counter(ROWS).items() if row[1] not in gone})


def test_line_stage_cuts_later_runs(spark, folder):
    rows = [(1, prose("a")), (2, "head\n" + prose("a") + "\ntail"), (3, prose("a")), (3, prose("a")), (4, None), (5, "")]
    out = corpus_pipeline.line_deduplication(spark, frame(spark, rows), folder)
    assert rows_of(out) == Counter({(1, prose("a")): 1, (2, "head\ntail"): 1, (4, None): 1, (5, ""): 1})
    assert {r["doc_id"]: r["n_chars"] for r in out.collect()}[2] == len("head\ntail")


def test_near_stage_keeps_one_row_of_each_class(spark, folder):
    kept = rows_of(corpus_pipeline.near_deduplication(spark, frame(spark, ROWS), folder))
    assert kept[1, prose("a")] == 1 and (2, prose("a")) not in kept
    assert all(kept[row] == 1 for row in ROWS if row != (2, prose("a")))


def test_rows_are_decontaminated_by_their_own_text(spark, folder):
    kept = rows_of(corpus_pipeline.benchmark_decontamination(spark, frame(spark, ROWS), folder))
    assert kept == Counter(row for row in ROWS if LEAK not in (row[1] or ""))
    found = decontaminate.contaminated(frame(spark, ROWS), spark.read.parquet(f"{folder}/benchmark.parquet")).collect()
    assert sorted((str(r["doc_id"]), r["item_id"]) for r in found) == [("3", 1), ("None", 1)]


def test_whole_pipeline_on_awkward_rows(spark, folder):
    frame(spark, ROWS).write.parquet(f"{folder}/documents.parquet")
    packed = corpus_pipeline.run(spark, folder).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter([1, None, 3, 7])


def test_packing_deals_rows_without_ids_evenly(spark):
    importable(spark)
    rows = [(None if i < 4000 else i, 0, 0, 1 + i * 37 % 2047, 0) for i in range(12000)]
    pieces = spark.createDataFrame(rows, packing.PIECE_SCHEMA)
    got = packing.pack(pieces, group_pieces=500).collect()
    assert sorted(r.length for r in got) == sorted(r[3] for r in rows)
    groups = Counter(r.sequence_id >> 28 for r in got)
    assert max(groups.values()) <= 2 * 500
