"""Personal data: exact base patterns, and further candidates chosen by boosted trees.

Base spans are the leftmost non-overlapping matches of one pattern per kind (email, ip, card, phone) that
pass the kind's check.  High-recall generators propose more, overlapping spans: matches that fail their check,
telephone numbers without a leading plus, addresses with a spelt-out at or dot.  Boosted trees learn what base
spans look like by format and context against failed matches, and a threshold of its own for each kind,
calibrated so that all but ``MISSED`` of all base spans pass, selects further redactions.

Places are code points, ends exclusive.  Patterns are written so that every text is read in linear time.
The trees and the thresholds are fitted on all base spans and failed matches: matches of one format and context
are one row with their number as its weight, and both classes weigh the same in all.  All of it is built-in
expressions and Spark's own learner; texts are never shuffled.

Null texts count as empty.  Rows are told apart by doc_id and text; repeated rows get equal results.  Extra
columns are ignored.  An empty table gives no rows; without failed or without base spans the base ones are all.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delayloom.llm._spark import stored

KINDS = ("email", "ip", "card", "phone")
TREES, DEPTH = 8, 3
#: Share of the base spans that a kind's threshold may leave out, and the least threshold.
MISSED = 0.01
LEAST_THRESHOLD = 0.9

_LOCAL = "A-Za-z0-9._%+-"
#: The base patterns.  Possessive steps and starts at the beginning of a run (or where the last match ended)
#: find the same spans without reading a run again from each of its characters.
PATTERNS = {
    "email": f"(?:\\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?:\\G|(?<![0-9]))[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
#: Whether a text can have a match at all; cheaper than the pattern.
_HINTS = {
    "email": lambda text: text.contains("@"),
    "ip": lambda text: text.rlike("[0-9]\\.[0-9]"),
    "card": lambda text: text.rlike("[0-9][\\x20-]?[0-9]"),
    "phone": lambda text: text.contains("+"),
}
#: Further generators: (kind, pattern).
GENERATORS = (
    ("phone", "(?<![0-9+(])\\(?[0-9]{3}\\)?[\\x20.-][0-9]{3}[\\x20.-][0-9]{4}(?![0-9])"),
    ("email", "(?<![A-Za-z0-9])[A-Za-z0-9]{1,64}(?:\\x20?[\\[(]at[\\])]\\x20?)[A-Za-z0-9-]{1,64}(?:\\x20?[\\[(]dot[\\])]\\x20?|\\.)[A-Za-z]{2,}"),
)
_GENERATOR_HINTS = ("[0-9]{3}\\)?[\\x20.-][0-9]{3}[\\x20.-][0-9]{4}", "[\\[(]at[\\])]")
_CONTEXT = 24

FEATURES = (
    "n_chars", "n_digits", "n_marks", "n_groups", "largest_part", "luhn", "has_plus", "has_at", "after_letter",
    "before_letter", "context_word", "kind_number",
)
#: Features that count, and the places where trees may split them.
COUNTED, STEPS = FEATURES[:5], (*range(1, 25), 28, 32, 40, 48, 64)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The Luhn check of a string of digits."""
    total = F.aggregate(
        F.transform(
            F.sequence(F.lit(1), F.length(digits)),
            lambda i: F.struct(F.substring(digits, i, F.lit(1)).cast("int").alias("d"), ((F.length(digits) - i) % 2).alias("odd")),
        ),
        F.lit(0),
        lambda total, x: total + F.when(x["odd"] == 0, x["d"]).when(x["d"] > 4, 2 * x["d"] - 9).otherwise(2 * x["d"]),
    )
    return total % 10 == 0


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _passes(kind: str, match: Column) -> Column:
    digits = _digits(match)
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(f"^{_PART}\\.{_PART}\\.{_PART}\\.{_PART}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(9, 15)


def _spans(text: Column, pattern: str, hint: Column) -> Column:
    """(start, end, match, before, after) of every match, with some characters around it."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("match"))
    empty = F.array().cast("array<struct<start:int,end:int,match:string,before:string>>")
    found = F.aggregate(
        F.filter(pairs, lambda x: x["match"].isNotNull()),
        F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda done, x: F.struct(
            (done["at"] + F.length(x["gap"]) + F.length(x["match"])).alias("at"),
            F.concat(done["spans"], F.array(F.struct(
                (done["at"] + F.length(x["gap"])).alias("start"),
                (done["at"] + F.length(x["gap"]) + F.length(x["match"])).alias("end"),
                x["match"].alias("match"),
                F.right(x["gap"], F.lit(_CONTEXT)).alias("before"),
            ))).alias("spans"),
        ),
        lambda done: done["spans"],
    )
    return F.when(hint, found).otherwise(empty)


def _candidates(docs: DataFrame) -> DataFrame:
    """doc_id, mark, base and other spans of every row; base spans are sorted by kind as listed, then start."""
    step = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.coalesce("text", F.lit("")).alias("text"))
    columns = {f"m_{kind}": _spans(F.col("text"), PATTERNS[kind], _HINTS[kind](F.col("text"))) for kind in KINDS}
    columns |= {
        f"g_{i}": _spans(F.col("text"), pattern, F.col("text").rlike(hint))
        for i, ((_, pattern), hint) in enumerate(zip(GENERATORS, _GENERATOR_HINTS))
    }
    step = step.select("doc_id", "mark", *[value.alias(name) for name, value in columns.items()])

    def marked(column: str, kind: str, base: Column | None) -> Column:
        return F.transform(column, lambda s: F.struct(
            F.lit(KINDS.index(kind)).alias("number"), s["start"].alias("start"), s["end"].alias("end"),
            s["match"].alias("match"), s["before"].alias("before"),
            (_passes(kind, s["match"]) if base is None else base).alias("base"), F.lit(base is not None).alias("generated")))

    every = F.concat(*[marked(f"m_{kind}", kind, None) for kind in KINDS],
                     *[marked(f"g_{i}", kind, F.lit(False)) for i, (kind, _) in enumerate(GENERATORS)])
    return step.select("doc_id", "mark", every.alias("spans"))


def _label(span: Column) -> Column:
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), span["number"] + 1)
    return F.concat_ws(":", kind, span["start"].cast("string"), span["end"].cast("string"))


def _features(rows: DataFrame) -> DataFrame:
    """Format and context of one candidate a row."""
    match, before = F.col("s.match"), F.col("s.before")
    digits = _digits(match)
    parts = F.split(match, "[^0-9]+")
    values = {
        "n_chars": F.length(match),
        "n_digits": F.length(digits),
        "n_marks": F.length(match) - F.length(F.regexp_replace(match, "[^A-Za-z0-9]", "")),
        "n_groups": F.size(parts),
        "largest_part": F.array_max(F.transform(parts, lambda p: F.length(p))),
        "luhn": F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False),
        "has_plus": match.startswith("+"),
        "has_at": match.contains("@"),
        "after_letter": before.rlike("\\p{L}$"),
        "before_letter": F.length(before) == 0,
        "context_word": before.rlike("(?i)(tel|phone|call|mail|contact|card|ip|address)"),
        "kind_number": F.col("s.number"),
    }
    return rows.select("*", *[F.coalesce(v.cast("double"), F.lit(0.0)).alias(n) for n, v in values.items()])


def _encoded(rows: DataFrame) -> DataFrame:
    """``features`` of yes and no alone: Spark chooses where to split numbers from a sample of rows, and splits these as they are."""
    values = {f"{name}_{step}": F.col(name) >= step for name in COUNTED for step in STEPS}
    values |= {f"is_{name}": F.col(name) > 0 for name in FEATURES[len(COUNTED):-1]}
    values |= {f"is_{kind}": F.col("kind_number") == number for number, kind in enumerate(KINDS)}
    binary = {"ml_attr": {"type": "binary"}}
    rows = rows.select("*", *[value.cast("double").alias(name, metadata=binary) for name, value in values.items()])
    return VectorAssembler(inputCols=list(values), outputCol="features").transform(rows).drop(*values)


def _limits(base: DataFrame) -> dict[int, float]:
    """Threshold of each kind: at most MISSED of its base spans (kind_number, chance; n of them a row) have a lower chance."""
    own = Window.partitionBy("kind_number")
    steps = base.groupBy("kind_number", "chance").agg(F.sum("n").alias("n"))  # trees have few distinct chances
    below = F.sum("n").over(own.orderBy("chance")) - F.col("n")
    steps = steps.withColumn("missed", below / F.sum("n").over(own)).filter(F.col("missed") <= MISSED)
    rows = steps.groupBy("kind_number").agg(F.max("chance").alias("limit")).collect()  # a row for each kind
    return {int(r["kind_number"]): max(LEAST_THRESHOLD, r["limit"]) for r in rows}


def found(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, base_sha256 and all spans (``kind:start:end``, joined by commas)."""
    rows = stored(_candidates(docs.select("doc_id", "text")), "candidates")
    added = _selected(rows)
    base = F.filter("spans", lambda s: s["base"])
    count = lambda number: F.size(F.filter(base, lambda s: s["number"] == number)).cast("long")
    if added is not None:
        rows = rows.join(added, rows["doc_id"].eqNullSafe(added["id"]) & (rows["mark"] == added["m"]), "left")
        more = F.coalesce("more", F.array().cast("array<struct<number:int,start:int,end:int>>"))
    else:
        more = F.array().cast("array<struct<number:int,start:int,end:int>>")
    short = F.transform(base, lambda s: F.struct(s["number"].alias("number"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.select(
        "doc_id",
        *[count(number).alias(f"n_{kind}") for number, kind in enumerate(KINDS)],
        F.sha2(F.array_join(F.transform(base, _label), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(F.array_sort(F.concat(short, more)), _label), ",").alias("spans"),
    )


def _selected(rows: DataFrame) -> DataFrame | None:
    """(id, m, more): candidates beyond the base spans that the trees select, by row."""
    each = _features(rows.select("doc_id", "mark", F.filter("spans", lambda s: s["base"]).alias("base"), F.explode("spans").alias("s")))
    each = stored(each.select("doc_id", "mark", "s", *FEATURES, F.exists("base", lambda b: (
        (b["number"] == F.col("s.number")) & (b["start"] < F.col("s.end")) & (F.col("s.start") < b["end"]))).alias("covered")), "spans")
    formats = stored(each.filter("not s.generated").groupBy(*FEATURES, F.col("s.base").cast("double").alias("label")).agg(
        F.count("*").alias("n")), "pii-formats")
    counts = {r["label"]: r["n"] for r in formats.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    if len(counts) < 2:
        return None
    weight = F.col("n") / F.when(F.col("label") == 1, counts[1.0]).otherwise(counts[0.0]) * (sum(counts.values()) / 2)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=5, stepSize=0.3, weightCol="weight")
    model = trees.fit(_encoded(formats.withColumn("weight", weight)).select("features", "label", "weight"))
    chance = lambda df: model.transform(_encoded(df)).withColumn("chance", F.get(vector_to_array("probability"), F.lit(1)))
    limits = _limits(chance(formats.filter("label = 1")))
    limit = F.coalesce(*[F.when(F.col("s.number") == k, v) for k, v in limits.items()], F.lit(2.0))
    rest = chance(each.filter("not s.base and not covered")).filter(F.col("chance") >= limit)
    return rest.groupBy(F.col("doc_id").alias("id"), F.col("mark").alias("m")).agg(
        F.collect_set(F.struct(F.col("s.number").alias("number"), F.col("s.start").alias("start"), F.col("s.end").alias("end"))).alias("more"))
