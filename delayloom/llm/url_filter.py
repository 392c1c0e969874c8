"""URL filtering: allow and block rules, and boosted trees on lexical features where no rule fits.

Rules are (verdict, host, path): a rule fits its host and all subdomains if the URL's path starts with the
rule's; the longest one wins.  URLs that a rule decides are the labelled ones; boosted trees learn from them
by length, depth, digit ratio, entropy, parameter counts and statistics of the host's suffixes, and judge the rest.
All of it is built-in expressions and Spark's own learner.

Suffix statistics count all labelled rows.  The trees are fitted on a bounded sample (``FIT_ROWS`` rows,
chosen by a hash of the URL).  A suffix that a third of all URLs have is one row after a grouping with
map-side combine; the statistics are joined back by suffix, where AQE splits a hot side.

A null URL, or one without ``://``, has an empty host and path; no rule fits it and the trees judge its text
(null: as empty).  Repeated rows get equal verdicts.  Extra columns are ignored.  An empty table gives no
rows; where the labelled rows have one verdict only, it is everyone's, and without any all are allowed.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayloom.llm._spark import stored

#: The rules of the registered query.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
FIT_ROWS = 20_000
TREES, DEPTH = 12, 4
#: Trees extrapolate to suffixes without labelled rows; block only on clear evidence.
THRESHOLD = 0.8

FEATURES = (
    "n_chars", "host_chars", "path_chars", "depth", "host_labels", "n_digits", "digit_ratio", "host_digits", "n_hyphens",
    "n_parameters", "query_chars", "n_fragments", "is_secure", "has_extension", "entropy", "suffix_rows", "suffix_blocked",
    "top_rows", "top_blocked",
)


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def parsed(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL column."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for given, own_host, own_path in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = ((host == own_host) | host.endswith(f".{own_host}")) & path.startswith(own_path)
        text = F.when(fits, own_host + own_path).otherwise(text)
        verdict = F.when(fits, given).otherwise(verdict)
    return text, verdict


def _lexical(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Parts, rule and lexical features of every URL."""
    host, path = parsed(F.col("url"))
    step = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    rule, decided = longest_rule(F.col("host"), F.col("path"), rules)
    query = F.regexp_extract("url", "\\?([^#]*)", 1)
    step = step.select(
        "page_id", "url", "host", "path", rule.alias("rule"), decided.alias("decided"), query.alias("query"),
        F.substring_index("host", ".", -2).alias("suffix"), F.substring_index("host", ".", -1).alias("top"),
        F.filter(F.array_distinct(F.split("url", "")), lambda c: c != "").alias("letters"),
    )
    size = F.greatest(F.length("url"), F.lit(1))
    entropy = F.aggregate(
        "letters", F.lit(0.0),
        lambda total, c: total - (F.length("url") - F.length(F.replace("url", c, F.lit("")))) / size * F.log2(
            (F.length("url") - F.length(F.replace("url", c, F.lit("")))) / size),
    )
    digits = string.digits
    lexical = {
        "n_chars": F.length("url"),
        "host_chars": F.length("host"),
        "path_chars": F.length("path"),
        "depth": _count(F.col("path"), "/"),
        "host_labels": _count(F.col("host"), ".") + 1,
        "n_digits": _count(F.col("url"), digits),
        "digit_ratio": _count(F.col("url"), digits) / size,
        "host_digits": _count(F.col("host"), digits),
        "n_hyphens": _count(F.col("host"), "-"),
        "n_parameters": _count(F.col("query"), "="),
        "query_chars": F.length("query"),
        "n_fragments": _count(F.col("url"), "#"),
        "is_secure": F.col("url").startswith("https:"),
        "has_extension": F.col("path").rlike("\\.[A-Za-z0-9]{1,5}$"),
        "entropy": entropy,
    }
    return step.select(
        "page_id", "host", "path", "rule", "decided", "suffix", "top", F.xxhash64("url").alias("mark"),
        *[F.coalesce(value.cast("double"), F.lit(0.0)).alias(name) for name, value in lexical.items()])


def _with_statistics(lexical: DataFrame, labelled: DataFrame, key: str) -> DataFrame:
    """Log count and smoothed share of blocked rows among the labelled rows of the same suffix."""
    blocked = (F.col("decided") == "block").cast("double")
    counts = labelled.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"), F.sum(blocked).alias("b"))
    return lexical.join(counts, lexical[key] == counts["k"], "left").withColumns({
        f"{key}_rows": F.log1p(F.coalesce("n", F.lit(0)).cast("double")),
        f"{key}_blocked": (F.coalesce("b", F.lit(0.0)) + 1) / (F.coalesce("n", F.lit(0)) + 2),
    }).drop("k", "n", "b")


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, fit_rows: int = FIT_ROWS) -> DataFrame:
    """page_id, host, path, rule (null where none fits), verdict and score (chance of block by the trees)."""
    lexical = stored(_lexical(pages.select("page_id", "url"), rules), "urls")
    labelled = lexical.filter(F.col("decided").isNotNull())
    counts = {r["decided"]: r["n"] for r in labelled.groupBy("decided").agg(F.count("*").alias("n")).collect()}  # 2 rows
    shown = ["page_id", "host", "path", "rule"]
    if len(counts) < 2:
        only = next(iter(counts), "allow")
        return lexical.select(*shown, F.coalesce("decided", F.lit(only)).alias("verdict"), F.lit(float(only == "block")).alias("score"))
    rows = lexical
    for key in ("suffix", "top"):
        rows = _with_statistics(rows, labelled, key)
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    draw = F.pmod(F.xxhash64("mark", F.lit(4)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.filter(F.col("decided").isNotNull() & (draw < min(1.0, fit_rows / sum(counts.values()))))
    sample = stored(sample.select(*FEATURES, (F.col("decided") == "block").cast("double").alias("label")), "url-sample")
    kinds = sample.agg(F.min("label"), F.max("label")).first()
    if kinds[0] == kinds[1]:
        only = "block" if kinds[0] else "allow"
        return lexical.select(*shown, F.coalesce("decided", F.lit(only)).alias("verdict"), F.lit(kinds[0] or 0.0).alias("score"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=7, stepSize=0.3)
    model = trees.fit(assembled.transform(sample.coalesce(4)).select("features", "label"))
    scored = model.transform(assembled.transform(rows)).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    verdict = F.coalesce("decided", F.when(F.col("score") >= THRESHOLD, "block").otherwise("allow"))
    return scored.select(*shown, verdict.alias("verdict"), "score")
