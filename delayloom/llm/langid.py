"""Language identification with string kernels.

Two texts are as alike as their sets of 1-, 2- and 3-grams (blended spectrum, presence only): for each length
the number of common grams over the geometric mean of the two numbers.  Landmark texts give a Nyström map of
this kernel, and one-versus-rest ridge regression on the map tells the languages apart.  Texts are scored in
batches: a presence matrix times the landmarks' presence matrix, then times the regression weights.

Grams are bytes of the lower-cased text, hashed into ``BUCKETS`` places for each length.

The classifier is fitted on a bounded sample (``FIT_ROWS`` rows and ``LANDMARKS`` landmarks for each
language, chosen by a hash of doc_id) of rows whose language is known and that are not held out.  Scoring
covers whole texts of all rows; only the landmark matrix and the weights, of fixed size, go to the tasks.

A null text, or one without a letter, is ``und`` with score 0.  Repeated rows get equal results.  Rows with
a null doc_id are scored and never held out.  Extra columns are ignored.  An empty table gives no rows;
without a row to learn from every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayloom.llm import _bytes as tb
from delayloom.llm._spark import arrow_batches, held_out, stored

LENGTHS = (1, 2, 3)
BUCKET_BITS = 12
BUCKETS = 1 << BUCKET_BITS
FIT_ROWS = 1500
LANDMARKS = 24
RIDGE = 1e-3
SHARPNESS = 6.0
UNDETERMINED = "und"

RESULT_SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def presence(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each gram length, a (texts, BUCKETS) matrix that has 1 where the text has a gram of the bucket."""
    lowered = data.copy()
    upper = (data >= 65) & (data <= 90)
    upper[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    lowered[upper] += 32
    sums = tb.prefix_sums(lowered, tb.BYTE_VALUES)
    out = []
    for length in LENGTHS:
        matrix = np.zeros((len(offsets) - 1, BUCKETS), dtype=np.float32)
        counts = np.maximum(np.diff(offsets) - length + 1, 0)
        codes = tb.gram_hashes(sums, length) >> np.uint64(64 - BUCKET_BITS)
        if length == 1:
            inside, row = codes, np.repeat(np.arange(len(counts)), counts)
        else:
            inside, row = codes[tb.expand(offsets[:-1], counts)], np.repeat(np.arange(len(counts)), counts)
        matrix.ravel()[row * BUCKETS + inside.astype(np.int64)] = 1
        out.append(matrix)
    return out


def kernel(texts: list[np.ndarray], landmarks: list[np.ndarray]) -> np.ndarray:
    """(texts, landmarks): mean over the gram lengths of the normalised numbers of common grams."""
    total = np.zeros((len(texts[0]), len(landmarks[0])), dtype=np.float64)
    for x, y in zip(texts, landmarks):
        norm = np.sqrt(np.maximum(x.sum(axis=1), 1))[:, None] * np.sqrt(np.maximum(y.sum(axis=1), 1))[None, :]
        total += (x @ y.T) / norm
    return total / len(LENGTHS)


def _in_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        data, offsets = tb.text_bytes(batch.column("text"))
        for low, high in tb.steps(offsets, tb.STEP_BYTES // 2):
            for a in range(low, high, 512):  # short texts: bound the matrix too
                b = min(high, a + 512)
                yield batch.slice(a, b - a), presence(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def _landmark_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, matrices in _in_steps(batches):
        bits = np.packbits(np.stack(matrices, axis=1).reshape(batch.num_rows, -1).astype(bool), axis=1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), pa.array([b.tobytes() for b in bits], pa.binary())], names=["lang", "bits"])


def _fit_sums(landmarks: list[np.ndarray], to_map: np.ndarray, languages: list[str]):
    """Sums of the normal equations over a partition's rows: one row of fixed size."""
    place = {lang: i for i, lang in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = to_map.shape[1] + 1
        square, cross, seen = np.zeros((size, size)), np.zeros((size, len(languages))), False
        for batch, matrices in _in_steps(batches):
            features = np.hstack([kernel(matrices, landmarks) @ to_map, np.ones((batch.num_rows, 1))])
            which = np.array([place[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)
            weight = batch.column("weight").to_numpy(zero_copy_only=False)
            target = np.full((len(which), len(languages)), -1.0)
            target[np.arange(len(which)), which] = 1.0
            square += (features * weight[:, None]).T @ features
            cross += (features * weight[:, None]).T @ target
            seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([square.tobytes()]), pa.array([cross.tobytes()])], names=["square", "cross"])

    return run


class Model:
    def __init__(self, languages: list[str], landmarks: list[np.ndarray], weights: np.ndarray):
        self.languages, self.landmarks, self.weights = languages, landmarks, weights

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        known = kernel(texts, self.landmarks)
        return np.hstack([known, np.ones((len(known), 1))]) @ self.weights


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS, landmark_rows: int = LANDMARKS) -> Model | None:
    """Learn from ``text`` and non-null ``lang`` of rows that are not held out."""
    usable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}") & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1 << 30)) / float(1 << 30)
    rate = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, fit_rows / counts[lang]))])
    first = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, landmark_rows / counts[lang]))])
    sample = stored(
        usable.filter(draw < rate[F.col("lang")]).select(
            "text", "lang", (draw < first[F.col("lang")]).alias("landmark")), "language-sample")
    sizes = {r["lang"]: r["n"] for r in sample.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    marks = sample.filter("landmark")
    if marks.isEmpty():
        marks = sample.limit(landmark_rows)
    rows = marks.select("text", "lang").mapInArrow(_landmark_bits, "lang string, bits binary").collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["bits"])))
    bits = np.stack([np.unpackbits(np.frombuffer(r["bits"], dtype=np.uint8)) for r in rows])
    landmarks = [m.astype(np.float32) for m in np.split(bits, len(LENGTHS), axis=1)]
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks))
    good = values > 1e-6 * values.max()
    to_map = vectors[:, good] / np.sqrt(values[good])
    weight = F.create_map(*[F.lit(x) for lang in sizes for x in (lang, 1.0 / sizes[lang])])[F.col("lang")]
    sums = sample.select("text", "lang", weight.alias("weight")).coalesce(16).mapInArrow(
        _fit_sums(landmarks, to_map, languages), "square binary, cross binary").collect()
    size = to_map.shape[1] + 1
    square = sum(np.frombuffer(r["square"]) for r in sums).reshape(size, size)
    cross = sum(np.frombuffer(r["cross"]) for r in sums).reshape(size, len(languages))
    solved = np.linalg.solve(square + RIDGE * np.eye(size), cross)
    weights = np.vstack([to_map @ solved[:-1], solved[-1:]])
    return Model(languages, landmarks, weights)


def _predicted(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNDETERMINED], dtype=object)
        for batch, matrices in _in_steps(batches):
            raw = model.scores(matrices)
            best = raw.argmax(axis=1)
            odds = np.exp(SHARPNESS * (raw - raw.max(axis=1, keepdims=True)))
            score = 1 / odds.sum(axis=1)
            letters = batch.column("letters").to_numpy(zero_copy_only=False).astype(bool)
            best[~letters], score[~letters] = len(model.languages), 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names[best], pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text",
        F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)).alias("letters"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    return stored(rows.mapInArrow(_predicted(model), RESULT_SCHEMA), "languages")


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score (0 to 1) of every row."""
    with arrow_batches(docs.sparkSession):
        return predict(docs, fit(docs))
