"""Training-corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

Every stage takes (spark, docs, sf_dir); ``run`` writes what a stage returns to the shared checkpoint folder and
reads it back as the next stage's documents.  All but the last return the columns of their input, in its order: an extra
column of any name or type comes back as it was, also where an operator has a column of that name.  An empty table stays
empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayloom.llm import chosen_path, decontaminate, line_dedup, packing, quality
from delayloom.llm._spark import REST, packed, read_table, stored, unpacked
from delayloom.llm.queries import importable


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep; null, empty and blank texts go, equal rows get equal verdicts."""
    return unpacked(quality.judged(packed(docs)).filter("kept"), docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later runs of lines; one that had lines and loses all of them goes.  n_chars follows the text.

    Null and empty texts stay as they are.  Rows with equal doc_id and text are one place: all keep their lines or lose the same.
    """
    cut = line_dedup.delete_repeated_runs(packed(docs))
    cut = cut.filter(~((F.col("n_lines") > 0) & (F.col("n_removed") == F.col("n_lines"))))
    if "n_chars" not in docs.columns:
        return unpacked(cut, docs)
    before = F.col(REST).getField("n_chars")
    return unpacked(cut, docs, n_chars=F.when(F.col("n_removed") > 0, F.length("text")).otherwise(before))


#: The stage links from 0.8 on; so many trees miss a pair at 0.8 in deep nodes with a chance of about 3e-6.
NEAR_PERCENT, NEAR_TREES = 80, 32


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one row of each near-duplicate class, repeated rows and null doc_ids included: that of the least doc_id."""
    importable(spark)
    return chosen_path.one_of_each_class(docs, min_percent=NEAR_PERCENT, trees=NEAR_TREES)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose own text contains no benchmark item, whatever their doc_id; null and empty texts stay."""
    importable(spark)
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents with their sequences and offsets; null and empty texts are a separator."""
    importable(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("near-dedup", near_deduplication),
    ("decontamination", benchmark_decontamination),
    ("packing", sequence_packing),
]

#: Models and token ids are beyond SQL; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
