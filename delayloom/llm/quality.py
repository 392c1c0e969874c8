"""Quality rules as weak supervision, in built-in expressions only.

Each rule votes good, bad or abstains.  Expectation-maximisation over the counts of vote patterns (at most
3 ** number of rules, whatever the corpus) estimates how often each rule votes either way on good and on bad
documents and how common bad ones are; a document is kept by its posterior probability, not by passing every
rule.  A base check (too few words, or too many words in repeated 5-word windows) rejects on its own.

Null, empty and blank texts have no words and fail the base check.  Repeated rows get equal verdicts.  Extra
columns are kept by ``judged``; names that clash with a result column are replaced by it.  An empty table
gives no rows (and leaves the rules at their starting accuracies).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayloom.llm._spark import stored

_BLANKS = " \t\n\x0b\x0c\r"
WINDOW_WORDS = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
KEEP_POSTERIOR = 0.5
ROUNDS = 30
#: Bits that hold a place in a text when window hashes are sorted with their places.
_PLACE_BITS = 20

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measures(docs: DataFrame) -> DataFrame:
    """Counts of each text next to its row (column ``row``).

    The steps stay apart because every intermediate array is used more than once by the next.
    """
    text = F.coalesce("text", F.lit(""))
    step = docs.select(F.struct(*docs.columns).alias("row"), text.alias("text"), F.btrim(text, F.lit(_BLANKS)).alias("body"))
    step = step.select(
        "row",
        "text",
        F.when(F.col("body") == "", F.array().cast("array<string>"))
        .otherwise(F.split("body", "[\\x20\\x09-\\x0D]+", -1)).alias("words"),
        F.filter(F.split("text", "\n", -1), lambda line: F.btrim(line, F.lit(_BLANKS)) != "").alias("lines"),
        F.translate("text", _BLANKS, "").alias("solid"),
    )
    step = step.select(
        "row",
        F.size("words").alias("n_words"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.length("solid").alias("word_chars"),
        (F.length("solid") - F.length(F.translate("solid", "#*$%&|<>", ""))).alias("n_symbols"),
        (F.length("solid") - F.length(F.translate("solid", "!?", ""))).alias("n_shouts"),
        (F.length("solid") - F.length(F.regexp_replace("solid", "[A-Z]+", ""))).alias("n_capitals"),
        (F.length("solid") - F.length(F.regexp_replace("solid", "[^\\p{L}\\p{N}]+", ""))).alias("n_marks"),
        (F.length("solid") - F.length(F.regexp_replace("solid", "[#*$%&|<>!?=_~-]{2,}", ""))).alias("n_strings"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    windows = F.when(
        F.size("hashes") >= WINDOW_WORDS,
        F.transform(
            F.sequence(F.lit(0), F.size("hashes") - WINDOW_WORDS),
            lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW_WORDS)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    step = step.withColumn("windows", windows).drop("hashes")
    # only texts with a repeated window go on; their windows are sorted as (leading bits, place)
    size = F.size("windows")
    again = F.size(F.array_distinct("windows")) < size
    mask = (1 << _PLACE_BITS) - 1
    packed = F.when(
        again & (size <= mask),
        F.sort_array(F.transform("windows", lambda w, i: w.bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long")))),
    )
    step = step.withColumn("packed", packed)
    step = step.withColumn(
        "order",
        F.when(F.col("packed").isNotNull(), F.transform("packed", lambda p: p.bitwiseAND(F.lit(mask)).cast("int")))
        .when(F.size("windows") > mask, F.transform(
            F.array_sort(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))), lambda x: x["i"])),
    ).drop("packed")
    same = lambda a, b: F.get("windows", F.get("order", a)) == F.get("windows", F.get("order", b))
    places = F.sort_array(F.filter(
        "order", lambda place, k: F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False))))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-WINDOW_WORDS).alias("last"), F.lit(0).alias("words")),
        lambda done, place: F.struct(
            place.alias("last"), (done["words"] + F.least(place - done["last"], F.lit(WINDOW_WORDS))).alias("words")),
        lambda done: done["words"],
    )
    return step.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0))).drop("windows", "order")


def _between(value: Column, good: Column, bad: Column) -> Column:
    """1 good, 0 bad, null abstain."""
    return F.when(bad, 0).when(good, 1).otherwise(F.lit(None).cast("int"))


def votes() -> dict[str, Column]:
    """The rules: a vote of 1 (good), 0 (bad) or null (abstain) over the measures."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    letters = F.greatest(F.col("word_chars"), F.lit(1))
    ratio = {
        "length": F.col("n_words"),
        "symbols": F.col("n_symbols") / words,
        "word_length": F.col("word_chars") / words,
        "line_copies": F.col("n_dup_lines") / lines,
        "repeats": F.col("n_repeat_words") / words,
        "capitals": F.col("n_capitals") / letters,
        "shouts": F.col("n_shouts") / words,
        "purity": F.col("n_marks") / letters,
        "strings": F.col("n_strings") / words,
        "variety": F.when(F.col("n_words") >= 40, F.col("n_distinct") / words),
    }
    limits = {  # good from / up to, bad beyond
        "length": (">=", 20, "<", 10),
        "symbols": ("<=", 0.02, ">", 0.1),
        "word_length": ("<=", 10, ">", 15),
        "line_copies": ("<=", 0.1, ">", 0.3),
        "repeats": ("<=", 0.05, ">", 0.15),
        "capitals": ("<=", 0.1, ">", 0.3),
        "shouts": ("<=", 0.05, ">", 0.25),
        "purity": ("<=", 0.08, ">", 0.12),
        "strings": ("<=", 0.02, ">", 0.1),
        "variety": (">=", 0.3, "<", 0.15),
    }

    def compared(value: Column, sign: str, limit: float) -> Column:
        return {"<": value < limit, "<=": value <= limit, ">": value > limit, ">=": value >= limit}[sign]

    return {
        name: _between(ratio[name], compared(ratio[name], g, good), compared(ratio[name], b, bad))
        for name, (g, good, b, bad) in limits.items()
    }


def estimate(patterns: list[tuple[tuple[int | None, ...], int]], rules: int, rounds: int = ROUNDS) -> tuple[float, list, list]:
    """Expectation-maximisation over counted vote patterns.

    Returns the share of good documents and, by rule, the chance of a bad vote on a good and on a bad document
    (given a vote).  Starts from rules that are rarely wrong on good documents and catch a third of bad ones;
    two pseudo-counts keep every chance inside (0, 1).
    """
    share, on_good, on_bad = 0.9, [0.02] * rules, [0.35] * rules
    total = sum(n for _, n in patterns)
    if not total:
        return share, on_good, on_bad
    for _ in range(rounds):
        good_mass, seen = 0.0, [[[0.0, 0.0], [0.0, 0.0]] for _ in range(rules)]
        for pattern, n in patterns:
            p = _posterior(pattern, share, on_good, on_bad)
            good_mass += n * p
            for r, vote in enumerate(pattern):
                if vote is not None:
                    seen[r][0][vote] += n * p
                    seen[r][1][vote] += n * (1 - p)
        share = min(max((good_mass + 9) / (total + 10), 0.5), 0.999)
        on_good = [min((s[0][0] + 0.1) / (sum(s[0]) + 5), 0.2) for s in seen]
        on_bad = [max((s[1][0] + 1.75) / (sum(s[1]) + 5), 0.02) for s in seen]
        on_bad = [max(b, 1.5 * g) for b, g in zip(on_bad, on_good)]  # a bad vote is never evidence of quality
    return share, on_good, on_bad


def _posterior(pattern: tuple[int | None, ...], share: float, on_good: list, on_bad: list) -> float:
    odds = math.log(share / (1 - share))
    for vote, g, b in zip(pattern, on_good, on_bad):
        if vote is not None:
            odds += math.log(g / b) if vote == 0 else math.log((1 - g) / (1 - b))
    return 1 / (1 + math.exp(-odds))


def judged(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with the measures, ``base_failed``, ``posterior`` and ``kept``."""
    names = [f"vote_{name}" for name in votes()]
    measured = stored(_measures(docs).withColumns(dict(zip(names, votes().values()))), "measures")
    counted = measured.groupBy(*names).agg(F.count("*").alias("n")).collect()  # at most 3 ** rules rows
    patterns = sorted(((tuple(r[:-1]), r["n"]) for r in counted), key=str)
    share, on_good, on_bad = estimate(patterns, len(names))
    odds = F.lit(math.log(share / (1 - share)))
    for name, g, b in zip(names, on_good, on_bad):
        odds = odds + F.when(F.col(name) == 0, math.log(g / b)).when(F.col(name) == 1, math.log((1 - g) / (1 - b))).otherwise(0.0)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    posterior = 1 / (1 + F.exp(-odds))
    results = {name: F.col(name).cast("long") for name in MEASURES}
    results |= {"base_failed": failed, "posterior": posterior, "kept": ~failed & (posterior >= KEEP_POSTERIOR)}
    own = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in results]
    return measured.select(*own, *[value.alias(name) for name, value in results.items()])
