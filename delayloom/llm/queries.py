"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayloom.llm import (
    chosen_path,
    conversations,
    decontaminate,
    fuzzy_simhash,
    langid,
    line_dedup,
    packing,
    pii,
    quality,
    suffix_dedup,
    token_alignment,
    toxicity,
    url_filter,
)
from delayloom.llm._spark import read_table

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from a checkout that is not installed."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if _ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (_ROOT, known) if p)


OP1_LINE_DEDUP = """
WITH parts AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
    FROM documents
), bodies AS (
    SELECT doc_id, line, place, trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) AS body FROM parts
), worded AS (
    SELECT doc_id, place, body, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS n FROM bodies WHERE body <> ''
), runs AS (
    SELECT doc_id, n, body, lead(body, 1) OVER own AS second, lead(body, 2) OVER own AS third, words, lead(words, 1) OVER own AS more
    FROM (SELECT *, len(regexp_split_to_array(body, '[\\x20\\x09-\\x0D]+')) AS words FROM worded)
    WINDOW own AS (PARTITION BY doc_id ORDER BY n)
), windows AS (
    SELECT doc_id, n, 3 AS size, concat(body, chr(10), second, chr(10), third) AS content FROM runs WHERE third IS NOT NULL
    UNION ALL
    SELECT doc_id, n, 2 AS size, concat(body, chr(10), second) AS content FROM runs WHERE words + more >= 50
    UNION ALL
    SELECT doc_id, n, 1 AS size, body AS content FROM runs WHERE words >= 50
), later AS (
    SELECT doc_id, n, size FROM (
        SELECT *, row_number() OVER (PARTITION BY size, content ORDER BY doc_id, n) AS turn FROM windows
    ) WHERE turn > 1
), lost AS (
    SELECT DISTINCT w.doc_id, w.n, w.place FROM worded w JOIN later l
    ON w.doc_id = l.doc_id AND w.n >= l.n AND w.n < l.n + l.size
), counts AS (
    SELECT doc_id, count(*) AS n_removed, count(*) FILTER (before IS NULL OR before <> n - 1) AS n_runs
    FROM (SELECT doc_id, n, lag(n) OVER (PARTITION BY doc_id ORDER BY n) AS before FROM lost) GROUP BY doc_id
), lines AS (
    SELECT doc_id, count(*) AS n_lines FROM worded GROUP BY doc_id
), rest AS (
    SELECT b.doc_id, string_agg(b.line, chr(10) ORDER BY b.place) AS text
    FROM bodies b LEFT JOIN lost l ON b.doc_id = l.doc_id AND b.place = l.place WHERE l.n IS NULL GROUP BY b.doc_id
)
SELECT d.doc_id, coalesce(lines.n_lines, 0) AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_runs, 0)::BIGINT AS n_runs, sha256(coalesce(rest.text, '')) AS kept_sha256
FROM documents d LEFT JOIN lines USING (doc_id) LEFT JOIN counts USING (doc_id) LEFT JOIN rest USING (doc_id)
"""


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of lines, deleted lines and deleted runs, and the hash of each remaining text."""
    cut = line_dedup.delete_repeated_runs(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(read_table(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(read_table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(read_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(read_table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired_after_damage(read_table(spark, sf_dir, "conversations"))


def op13_fuzzy_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


_QUERIES = (
    op1_line_dedup,
    op2_toxicity,
    op3_url_filter,
    op4_decontamination,
    op5_pii,
    op6_language,
    op7_quality_rules,
    op8_near_duplicates,
    op9_packing,
    op10_suffix_dedup,
    op11_token_alignment,
    op12_conversation_repair,
    op13_fuzzy_simhash,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def ready(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return query(spark, sf_dir)

        return run

    return {query.__name__: ready(query) for query in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": OP1_LINE_DEDUP}
