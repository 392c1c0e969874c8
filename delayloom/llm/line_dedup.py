"""Line deduplication by winnowing over line hashes, in built-in expressions only.

A document is the sequence of its lines that hold a word (blanks at both ends do not count).  A run is a stretch of such
lines that has ``RUN_LINES`` lines or more, or ``LONG_LINE_WORDS`` words or more together.  A line that lies in a run
which occurs at an earlier place (smaller doc_id, or earlier in the same document) is deleted.

*Winnowing.*  The shortest runs are windows: RUN_LINES lines, or fewer that reach the words.  In every window the place
of the least line hash is selected, once for all windows that share it.  Two equal runs select the same places in every
window they consist of, so they are guaranteed a common fingerprint.  Selected places are counted by hash; only those
whose hash stands at two places go on.

*Extension.*  Each such place carries the windows that selected it, which reach to both sides of it.  A window that is
equal to one at an earlier place is marked, and overlapping marks make up the whole run, however far it goes both ways.

Nothing pairs two occurrences: each is held against the first occurrence of its window, which is found by a grouping with
map-side combine.  A line or window that a third of all documents share is one group of one row there, and the rows
that have it are dealt over ``SALTS`` tasks.

Rows are told apart by doc_id and text; identical rows count as one place, so neither deletes the other.  A
null doc_id comes after all others.  Null texts stay null, empty ones empty, lines without a word stay.
Extra columns are kept by ``delete_repeated_runs``; those named like one of its counts are replaced (``packed`` keeps
them).  An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayloom.llm._spark import stored

RUN_LINES = 3
LONG_LINE_WORDS = 50
#: Tasks that the rows of one line or window are dealt over.
SALTS = 16
_BLANKS = " \t\n\x0b\x0c\r"


def _selecting(place: Column, offset: int, size: int, needed_words: int) -> Column:
    """The window of ``size`` lines from ``offset`` lines before a place on, if it selects that place; else null."""
    start = place - offset
    hashes = [F.get("hashes", start + k) for k in range(size)]
    inside = (start >= 0) & (start + size <= F.size("hashes"))
    for k, other in enumerate(hashes):  # of equal hashes the first is selected
        if k != offset:
            inside = inside & (other > hashes[offset] if k < offset else other >= hashes[offset])
    if needed_words:
        inside = inside & (reduce(Column.__add__, [F.get("words", start + k) for k in range(size)]) >= needed_words)
    return F.when(inside, F.struct(start.alias("start"), F.lit(size).alias("size"), F.xxhash64(*hashes).alias("window")))


def _places(lines: DataFrame, run_lines: int, long_words: int) -> DataFrame:
    """(doc_id, mark, fingerprint, place, windows): every selected place of a document with the windows that selected it.

    Places count the lines with a word from 0.
    """
    def selected(line_hash: Column, place: Column) -> Column:
        windows = [_selecting(place, offset, size, long_words if size < run_lines else 0)
                   for size in range(1, run_lines + 1) for offset in range(size)]
        return F.struct(line_hash.alias("fingerprint"), place.alias("place"),
                        F.filter(F.array(*windows), lambda w: w.isNotNull()).alias("windows"))

    places = F.filter(F.transform("hashes", selected), lambda p: F.size(p["windows"]) > 0)
    return lines.select("doc_id", "mark", F.explode(places).alias("p")).select("doc_id", "mark", "p.*")


def _sequences(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, places, hashes, words): lines with a word, their places in the text, hashes and numbers of words."""
    bodies = docs.select(
        F.col("doc_id"),
        F.xxhash64("text").alias("mark"),
        F.filter(
            F.transform(
                F.split(F.coalesce("text", F.lit("")), "\n", -1),
                lambda line, i: F.struct(i.alias("place"), F.btrim(line, F.lit(_BLANKS)).alias("body")),
            ),
            lambda x: x["body"] != "",
        ).alias("lines"),
    )
    return bodies.select(
        "doc_id",
        "mark",
        F.transform("lines", lambda x: x["place"]).alias("places"),
        F.transform("lines", lambda x: F.xxhash64(x["body"])).alias("hashes"),
        F.transform("lines", lambda x: F.size(F.split(x["body"], "[\\x20\\x09-\\x0D]+"))).alias("words"),
    )


def _salted(lookup: DataFrame) -> DataFrame:
    """A lookup once for each salt: rows of a hot key are joined in as many tasks."""
    return lookup.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def repeated_lines(docs: DataFrame, run_lines: int = RUN_LINES, long_words: int = LONG_LINE_WORDS) -> DataFrame:
    """(doc_id, mark, removed, n_runs): places of the deleted lines of each document that loses any, ascending."""
    docs = docs.select("doc_id", "text")
    sequences = stored(_sequences(docs), "lines")
    salt = F.pmod(F.xxhash64("doc_id", "mark"), SALTS).cast("int")
    places = _places(sequences.select("doc_id", "mark", "hashes", "words"), run_lines, long_words)
    here = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark", "place")
    fingerprints = places.groupBy("fingerprint").agg(F.min(here).alias("a"), F.max(here).alias("b"))
    shared = _salted(fingerprints.filter(F.col("a") != F.col("b")).select("fingerprint"))
    found = places.withColumn("salt", salt).join(shared, ["fingerprint", "salt"], "left_semi")
    candidates = stored(found.select("doc_id", "mark", F.inline("windows")), "windows")
    start = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark", "start")
    first = candidates.groupBy("size", "window").agg(F.min(start).alias("first"), F.max(start).alias("final"))
    repeated = _salted(first.filter(F.col("first") != F.col("final")).select("size", "window", "first"))
    later = candidates.withColumn("salt", salt).join(repeated, ["size", "window", "salt"]).filter(start != F.col("first"))
    marked = later.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("start", "size")).alias("marked"))
    lost = sequences.select("doc_id", "mark", "places").dropDuplicates(["doc_id", "mark"]).join(
        marked, sequences["doc_id"].eqNullSafe(marked["doc_id"]) & (sequences["mark"] == marked["mark"])
    ).select(sequences["doc_id"], sequences["mark"], "places", "marked")
    numbers = F.array_sort(F.array_distinct(F.flatten(F.transform(
        "marked", lambda w: F.sequence(w["start"], w["start"] + w["size"] - 1)))))
    lost = lost.withColumn("numbers", numbers)
    starts = F.size(F.filter("numbers", lambda n, i: (i == 0) | (F.get("numbers", i - 1) != n - 1)))
    return lost.select("doc_id", "mark", F.transform("numbers", lambda n: F.get("places", n)).alias("removed"),
                       starts.alias("n_runs"))


def delete_repeated_runs(
    docs: DataFrame, run_lines: int = RUN_LINES, long_words: int = LONG_LINE_WORDS
) -> DataFrame:
    """All rows and columns of ``docs`` with later runs cut from ``text``, then n_lines, n_removed and n_runs.

    The three are counts of lines with a word, of those deleted, and of deleted runs.
    """
    added = ("n_lines", "n_removed", "n_runs")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("mark"))
    lost = repeated_lines(docs, run_lines, long_words)
    joined = rows.join(
        lost, rows["row.doc_id"].eqNullSafe(lost["doc_id"]) & (rows["mark"] == lost["mark"]), "left"
    ).select("row", "removed", "n_runs")
    joined = joined.withColumn("lines", F.split("row.text", "\n", -1))
    joined = joined.withColumn(
        "edges", F.concat(F.array(F.lit(-1)), F.col("removed"), F.array(F.size("lines"))))
    stretches = F.transform(
        F.sequence(F.lit(1), F.size("edges") - 1),
        lambda k: F.slice("lines", F.get("edges", k - 1) + 2, F.get("edges", k) - F.get("edges", k - 1) - 1),
    )
    text = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(F.array_join(F.flatten(stretches), "\n"))
    kept = [F.col("row").getField(c).alias(c) if c != "text" else text.alias("text") for c in docs.columns if c not in added]
    words = F.size(F.filter("lines", lambda line: F.btrim(line, F.lit(_BLANKS)) != ""))
    return joined.select(
        *kept,
        F.when(F.col("row.text").isNull(), 0).otherwise(words).cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_runs", F.lit(0)).cast("long").alias("n_runs"),
    )
