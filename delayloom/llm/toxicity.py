"""Toxicity by weak supervision.

Many voters look at a text: lexicons of words and of word beginnings of several lengths mined from labelled
rows, a small fixed lexicon, and patterns (shouting, marks, repeated words).  Each votes toxic, clean or
abstains.  A generative label model estimates the voters' accuracies by expectation-maximisation over counted
vote patterns and the correlations between voters, so that voters who repeat each other weigh less.  Its
posterior labels train a linear classifier on measures of the same evidence, which scores whole texts.

Lexicon counts and the label model cover all labelled rows that are not held out; only the classifier is
trained on a bounded sample of them (``FIT_ROWS``, chosen by a hash of doc_id).  The rows are halved: a text's
evidence in training comes from counts over the other half, so a word that one document alone has does not
vouch for itself.

Null and empty texts have no evidence and get the score of a clean empty text.  Repeated rows get equal scores.
A null doc_id is scored and never held out.  Several labels of one doc_id count as toxic if any is.  Extra
columns are ignored.  An empty table gives no rows; without labelled rows every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayloom.llm import _bytes as tb
from delayloom.llm._spark import HELD_OUT_REMAINDER, arrow_batches, held_out, runtime_filters, stored

FIT_ROWS = 16_000
THRESHOLD = 0.3
#: Beginnings of words, in bytes; 0 is the whole word.
FORMS = (0, 4, 5, 6, 7)
#: A form is weak evidence from the first share of toxic documents on, strong from the second.
WEAK, STRONG = 0.3, 0.75
MIN_DOCUMENTS = 3
EM_ROUNDS = 40
#: A small general lexicon.
INSULTS = ("idiot", "stupid", "moron", "trash", "scum", "loser", "pathetic", "worthless", "disgusting", "clown")

RESULT_SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
_FILTER_BITS = 22


def _lower(data: np.ndarray) -> np.ndarray:
    lowered = data.copy()
    upper = (data >= 65) & (data <= 90)
    upper[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    lowered[upper] += 32
    return lowered


def _is_letter() -> np.ndarray:
    letter = np.zeros(256, dtype=bool)
    letter[48:58] = letter[65:91] = letter[97:123] = letter[128:] = True
    return letter


LETTER = _is_letter()


def form_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of every word's forms (0 where the word is too short for a beginning) and the words of each text."""
    letter = LETTER[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = letter
    before[offsets] = False
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = letter
    after[offsets] = False
    starts = np.flatnonzero(letter & ~before[:-1])
    ends = np.flatnonzero(letter & ~after[1:]) + 1
    sums = tb.prefix_sums(_lower(data), tb.BYTE_VALUES)
    out = []
    for kind, size in enumerate(FORMS):
        hashes = tb.stretch_hashes(sums, starts, ends if not size else np.minimum(starts + size, ends))
        hashes = tb.mix(hashes + np.uint64(kind))
        if size:
            hashes[ends - starts < size] = 0
        out.append(hashes)
    return out, np.diff(np.searchsorted(starts, offsets))


def _counted_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and toxic documents with each form, by half, summed over what the task has read."""
    for batch in batches:
        data, offsets = tb.text_bytes(batch.column("text"))
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        half = batch.column("half").to_numpy(zero_copy_only=False)
        for low, high in tb.steps(offsets, 2 * tb.STEP_BYTES):
            forms, counts = form_hashes(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            doc = np.repeat(np.arange(low, high), counts)
            for kind, hashes in enumerate(forms):
                order = np.lexsort((doc, hashes))
                h, d = hashes[order], doc[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
                h, d = h[new], d[new]
                h, d = h[h != 0], d[h != 0]
                keys, first = np.unique(h, return_index=True)
                if not len(keys):
                    continue
                columns = [
                    np.add.reduceat(((half[d] == part) & (toxic[d] >= least)).astype(np.int64), first)
                    for part in (0, 1) for least in (0, 1)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), kind, dtype=np.int32)), *map(pa.array, columns)],
                    names=["form", "kind", "all_0", "toxic_0", "all_1", "toxic_1"])


class Lexicon:
    """Forms with the share of toxic documents among those that have them."""

    def __init__(self, forms: np.ndarray, share: np.ndarray):
        order = np.argsort(forms)
        self.forms, self.share = forms[order], share[order]
        self.filter = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.filter[self.forms >> np.uint64(64 - _FILTER_BITS)] = True

    def shares(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the known forms, and their shares."""
        maybe = np.flatnonzero(self.filter[hashes >> np.uint64(64 - _FILTER_BITS)])
        if not len(self.forms) or not len(maybe):
            return maybe[:0], np.zeros(0)
        at = np.minimum(np.searchsorted(self.forms, hashes[maybe]), len(self.forms) - 1)
        known = self.forms[at] == hashes[maybe]
        return maybe[known], self.share[at[known]]


def _insult_forms() -> np.ndarray:
    data = np.frombuffer(" ".join(INSULTS).encode(), dtype=np.uint8)
    return np.sort(form_hashes(data, np.array([0, len(data)]))[0][0])


N_MEASURES = 3 * len(FORMS) + 5


def measures(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon, insults: np.ndarray) -> np.ndarray:
    """(texts, N_MEASURES): per form kind the best share, strong hits (log) and strong density; then patterns."""
    n = len(offsets) - 1
    forms, counts = form_hashes(data, offsets)
    doc = np.repeat(np.arange(n), counts)
    size = np.maximum(counts, 1)
    out = np.zeros((n, N_MEASURES))
    for kind, hashes in enumerate(forms):
        at, share = lexicon.shares(hashes)
        np.maximum.at(out[:, 3 * kind], doc[at], share)
        strong = np.bincount(doc[at[share >= STRONG]], minlength=n)
        out[:, 3 * kind + 1] = np.log1p(strong)
        out[:, 3 * kind + 2] = np.minimum(100.0 * strong / size, 5.0)
    base = 3 * len(FORMS)
    out[:, base] = np.log1p(np.bincount(doc[np.isin(forms[0], insults)], minlength=n))
    row = np.repeat(np.arange(n), np.diff(offsets))
    count = lambda mask: np.bincount(row[mask], minlength=n)
    length = np.maximum(np.diff(offsets), 1)
    out[:, base + 1] = count((data >= 65) & (data <= 90)) / length
    out[:, base + 2] = np.minimum(count(data == 33) / size, 1.0)
    out[:, base + 3] = np.minimum(count((data == 42) | (data == 35) | (data == 36)) / size, 1.0)
    out[:, base + 4] = np.log1p(counts)
    return out


def voter_votes(x: np.ndarray) -> np.ndarray:
    """Votes of all voters: 1 toxic, 0 clean, -1 abstain."""
    votes = []
    base = 3 * len(FORMS)
    for kind in range(len(FORMS)):
        best = x[:, 3 * kind]
        votes.append(np.where(best >= STRONG, 1, np.where(best < WEAK, 0, -1)))
        votes.append(np.where(x[:, 3 * kind + 1] >= np.log1p(2), 1, -1))
    votes.append(np.where(x[:, base] > 0, 1, -1))
    votes.append(np.where(x[:, base + 1] > 0.4, 1, -1))
    votes.append(np.where(x[:, base + 2] > 0.3, 1, -1))
    votes.append(np.where(x[:, base + 3] > 0.3, 1, -1))
    return np.stack(votes, axis=1).astype(np.int8)


class LabelModel:
    """Accuracies and correlations of voters over counted vote patterns."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, toxic: np.ndarray, rounds: int = EM_ROUNDS):
        """``toxic``: labelled toxic documents of each pattern, for the first guess of the accuracies only."""
        self.weight = np.ones(patterns.shape[1])
        self.share = min(max(toxic.sum() / max(counts.sum(), 1), 0.001), 0.5)
        p = (toxic + self.share) / (counts + 1)
        for _ in range(rounds):
            self._estimate(patterns, counts, p)
            p = self.posterior(patterns)
        self._estimate(patterns, counts, p)

    def _estimate(self, patterns: np.ndarray, counts: np.ndarray, p: np.ndarray) -> None:
        given = {1: counts * p, 0: counts * (1 - p)}
        self.share = float(min(max(given[1].sum() / max(counts.sum(), 1), 0.0005), 0.5))
        self.chance = np.zeros((2, 3, patterns.shape[1]))
        for label, mass in given.items():
            for vote in (-1, 0, 1):
                self.chance[label, vote + 1] = (mass @ (patterns == vote) + 0.5) / (mass.sum() + 1.5)
        # correlation of two voters beyond what the label explains, averaged over the labels
        centred = [(patterns == 1) - self.chance[label, 2] for label in (0, 1)]
        spread = [np.sqrt(np.maximum(self.chance[label, 2] * (1 - self.chance[label, 2]), 1e-9)) for label in (0, 1)]
        total = np.zeros((patterns.shape[1], patterns.shape[1]))
        for label, mass in given.items():
            both = (centred[label] * mass[:, None]).T @ centred[label] / max(mass.sum(), 1e-9)
            total += both / np.outer(spread[label], spread[label]) / 2
        np.fill_diagonal(total, 0)
        self.correlation = np.clip(total, 0, 1)
        self.weight = 1 / (1 + self.correlation.sum(axis=1))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        odds = np.full(len(votes), np.log(self.share / (1 - self.share)))
        for vote in (-1, 0, 1):
            ratio = np.log(self.chance[1, vote + 1] / self.chance[0, vote + 1])
            odds += (votes == vote) @ (self.weight * ratio)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> np.ndarray:
    """Weights (last: intercept) of a ridge logistic regression on soft labels, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray, mean: np.ndarray, spread: np.ndarray):
        self.lexicon, self.weights, self.mean, self.spread = lexicon, weights, mean, spread
        self.insults = _insult_forms()

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        x = (measures(data, offsets, self.lexicon, self.insults) - self.mean) / self.spread
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def _share(toxic: np.ndarray, every: np.ndarray, prior: float) -> np.ndarray:
    return (toxic + 2 * prior) / (every + 2)


def _training_rows(lexicons: tuple[Lexicon, Lexicon]):
    """Votes on each training text under the lexicon of the other half, and its measures if it is drawn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        insults = _insult_forms()
        for batch in batches:
            data, offsets = tb.text_bytes(batch.column("text"))
            half = batch.column("half").to_numpy(zero_copy_only=False)
            drawn = batch.column("drawn").to_pylist()
            for low, high in tb.steps(offsets):
                x = np.zeros((high - low, N_MEASURES))
                for part in (0, 1):
                    own = measures(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], lexicons[1 - part], insults)
                    x[half[low:high] == part] = own[half[low:high] == part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v.tobytes() for v in voter_votes(x)], pa.binary()),
                     pa.array([r.tobytes() if d else None for r, d in zip(x, drawn[low:high])], pa.binary()),
                     batch.column("toxic").slice(low, high - low)],
                    names=["votes", "x", "toxic"])

    return run


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model | None:
    """Mine lexicons, fit the label model and train the classifier on its posterior labels."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    learnt = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != HELD_OUT_REMAINDER
    known = stored(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "known").filter(learnt)
    size = known.count()
    if not size:
        return None
    draw = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1 << 30)) / float(1 << 30)
    known = known.withColumns({"drawn": draw < min(1.0, fit_rows / size),
                               "half": F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)).cast("int")})
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(learnt)
    # labels grow with the documents: never broadcast, but only texts that have one are moved, and none is sorted
    with runtime_filters(docs.sparkSession, size):
        labelled = stored(texts.join(known.hint("shuffle_hash"), "doc_id").select("text", "toxic", "half", "drawn"), "labelled")
    totals = {r["half"]: (r["n"], r["t"]) for r in labelled.groupBy("half").agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).collect()}
    every, toxic = sum(n for n, _ in totals.values()), sum(t for _, t in totals.values())
    if not every:
        return None
    prior = max(toxic / every, 1e-4)
    counts = ("all_0", "toxic_0", "all_1", "toxic_1")
    found = labelled.select("text", "toxic", "half").mapInArrow(_counted_forms, "form long, kind int, " + ", ".join(f"{c} long" for c in counts))
    found = found.groupBy("form", "kind").agg(*[F.sum(c).alias(c) for c in counts])
    # forms that are toxic often enough: a small part of the vocabulary
    found = found.filter((F.col("toxic_0") + F.col("toxic_1") >= MIN_DOCUMENTS - 1) & (
        F.col("toxic_0") + F.col("toxic_1") >= F.lit(WEAK * 0.5) * (F.col("all_0") + F.col("all_1"))))
    table = found.toArrow()
    forms = table.column("form").to_numpy().view(np.uint64)
    a0, t0, a1, t1 = (table.column(c).to_numpy() for c in counts)
    both = (t0 + t1) >= MIN_DOCUMENTS
    lexicon = Lexicon(forms[both], _share(t0 + t1, a0 + a1, prior)[both])
    halves = tuple(Lexicon(forms[t >= MIN_DOCUMENTS - 1], _share(t, a, prior)[t >= MIN_DOCUMENTS - 1]) for a, t in ((a0, t0), (a1, t1)))
    rows = stored(labelled.mapInArrow(_training_rows(halves), "votes binary, x binary, toxic int"), "votes")
    counted = sorted((bytes(r["votes"]), r["n"], r["t"]) for r in rows.groupBy("votes").agg(
        F.count("*").alias("n"), F.sum((F.col("toxic") != 0).cast("int")).alias("t")).collect())  # a row for each pattern
    patterns = np.stack([np.frombuffer(v, dtype=np.int8) for v, _, _ in counted])
    label_model = LabelModel(
        patterns, np.array([n for _, n, _ in counted], dtype=float), np.array([t for _, _, t in counted], dtype=float))
    blobs = rows.filter("x is not null").select("x").toArrow().column("x").to_pylist()  # about fit_rows
    if not blobs:
        return None
    x = np.frombuffer(b"".join(blobs)).reshape(-1, N_MEASURES)
    x = x[np.lexsort(x.T)]
    votes = voter_votes(x)
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    weights = _logistic((x - mean) / spread, label_model.posterior(votes))
    return Model(lexicon, weights, mean, spread)


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tb.text_bytes(batch.column("text"))
            for low, high in tb.steps(offsets):
                score = model.scores(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), batch.column("held_out").slice(low, high - low),
                     pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"])

    return run


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    return stored(rows.mapInArrow(_scored(model), RESULT_SCHEMA), "toxicity")


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from THRESHOLD on) of every row."""
    with arrow_batches(docs.sparkSession):
        return score(docs, fit(docs, labels))
