"""Exact removal of repeated 50-byte strings by blockwise suffix sorting with a cover sample.

A suffix array of everything would hold one entry per byte.  Instead a cover sample stands for the suffixes:
a set of positions such that any two equal 50-byte strings have a sample position at the same distance from
their starts.  Suffixes are put into buckets by the hash of the sample's gram, and one bucket at a time is
sorted in a task of bounded memory.  Suffixes that tie over the whole stretch that a string with this sample
position can reach share a rank, found once; only the least document of each rank goes on, and within a gram
that has more than one rank the 50-byte strings themselves are sorted.

The cover is chosen by content (positions of least gram hash in some window of a 50-byte string) instead of
by residues of a period: both have the covering property, and this one keeps about 7 % of the positions
instead of 24 % and gives equal passages equal samples, so copies fold into one rank before any shuffle.

Texts are cut into chunks once and stored by chunk; each round sends packed arrays from chunks to buckets
and answers back, so Spark moves few, dense rows.  A passage that a third of all documents share is sent
once per chunk.

Null and empty texts have no bytes.  Matches never cross documents.  Rows of equal doc_id do not remove from
each other; a null doc_id counts as greater than any other.  Extra columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayloom.llm import _bytes as tb
from delayloom.llm._spark import arrow_batches, bucketed, grouped, parts_for, stored

MATCH_BYTES = 50
GRAM_BYTES = 24
REACH = MATCH_BYTES - GRAM_BYTES  # a string with a sample position begins at most so far before it
CHUNK_BYTES = 1 << 19
#: Bytes of text whose samples meet in one bucket.
BUCKET_TEXT_BYTES = 6e6
_NULL_ID = np.iinfo(np.int64).max

RESULT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_CHUNK_SCHEMA = "chunk long, doc_ids array<long>, sizes array<long>, body binary"
_SENT_SCHEMA = "bucket int, chunk long, body binary"


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        data, offsets = tb.text_bytes(batch.column("text"))
        for low, high in tb.steps(offsets, CHUNK_BYTES):
            body = pa.compress(data[offsets[low] : offsets[high]].tobytes(), codec="zstd", asbytes=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()),
                 pa.array([batch.column("doc_id").slice(low, high - low).to_pylist()], pa.list_(pa.int64())),
                 pa.array([np.diff(offsets[low : high + 1])], pa.list_(pa.int64())), pa.array([body], pa.binary())],
                names=["chunk", "doc_ids", "sizes", "body"],
            )
            number += 1


class _Chunk:
    """Texts of a chunk with their sample positions; the same in every round."""

    def __init__(self, row: dict, buckets: int):
        sizes = np.array(row["sizes"], dtype=np.int64)
        self.doc_ids = row["doc_ids"]
        self.ids = np.array([_NULL_ID if i is None else i for i in self.doc_ids], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        raw = pa.decompress(row["body"], decompressed_size=int(self.offsets[-1]), codec="zstd", asbytes=True)
        self.data = np.frombuffer(raw, dtype=np.uint8)
        self.sums = tb.prefix_sums(self.data, tb.BYTE_VALUES)
        self.at, self.grams = self._samples()
        doc = np.searchsorted(self.offsets, self.at, side="right") - 1
        self.doc = doc
        self.left = np.minimum(self.at - self.offsets[doc], REACH)
        self.right = np.minimum(self.offsets[doc + 1] - self.at - GRAM_BYTES, REACH)
        self.buckets = buckets

    def _samples(self) -> tuple[np.ndarray, np.ndarray]:
        strings = len(self.data) - MATCH_BYTES + 1
        if strings <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        grams = tb.gram_hashes(self.sums, GRAM_BYTES) | np.uint64(1)
        least = tb.sliding_min(grams, REACH + 1)
        inside = np.zeros(strings, dtype=bool)  # strings within one document
        ends = self.offsets[1:] - MATCH_BYTES + 1
        change = np.zeros(strings + 1, dtype=np.int32)
        own = ends > self.offsets[:-1]
        np.add.at(change, self.offsets[:-1][own], 1)
        np.add.at(change, ends[own], -1)
        inside = np.cumsum(change[:-1]) > 0
        padded = np.zeros(strings + 2 * REACH, dtype=np.uint64)
        padded[REACH : REACH + strings] = np.where(inside, least, np.uint64(0))
        at = np.flatnonzero(tb.sliding_max(padded, REACH + 1) == grams)
        return at, grams[at]

    def bucket_of(self, grams: np.ndarray) -> np.ndarray:
        return ((grams >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)

    def gram_classes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct grams, the class of each sample, and whether a gram is in two documents of the chunk."""
        grams, which = np.unique(self.grams, return_inverse=True)
        low, high = np.full(len(grams), _NULL_ID), np.full(len(grams), -1)
        np.minimum.at(low, which, self.doc)
        np.maximum.at(high, which, self.doc)
        return grams, which, low != high

    def repeated(self, row: dict) -> np.ndarray:
        """Samples whose gram occurs in another document (of this chunk, or by the answers of the first round)."""
        grams, which, twice = self.gram_classes()
        counts = np.bincount(self.bucket_of(grams).astype(np.int64), minlength=self.buckets)
        known = np.zeros(len(grams), dtype=bool)
        starts = tb.run_starts(counts)
        for answer in row["first"] or ():
            b = answer["bucket"]
            bits = np.unpackbits(np.frombuffer(answer["body"], dtype=np.uint8), count=int(counts[b]))
            known[starts[b] : starts[b] + counts[b]] = bits.astype(bool)
        return np.flatnonzero((known | twice)[which])

    def ranked(self, chosen: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct (gram, stretch) among the chosen samples: gram, stretch hash, least doc_id, and the class of each."""
        at, left, right = self.at[chosen], self.left[chosen], self.right[chosen]
        stretch = tb.stretch_hashes(self.sums, at - left, at + GRAM_BYTES + right)
        stretch = tb.mix(stretch ^ (left * 64 + right).astype(np.uint64))
        order = np.lexsort((self.ids[self.doc[chosen]], stretch, self.grams[chosen]))
        g, s = self.grams[chosen][order], stretch[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (g[1:] != g[:-1]) | (s[1:] != s[:-1])
        which = np.zeros(len(order), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        first = order[new]
        return g[new], s[new], self.ids[self.doc[chosen]][first], which, first

    def answers(self, answers: list | None, grams: np.ndarray, dtype: type) -> np.ndarray:
        """Values that came back for the sorted grams, bucket by bucket."""
        out = np.zeros(len(grams), dtype=dtype)
        bucket = self.bucket_of(grams).astype(np.int64)
        for answer in answers or ():
            low, high = np.searchsorted(bucket, [answer["bucket"], answer["bucket"] + 1])
            out[low:high] = np.frombuffer(answer["body"], dtype=dtype)
        return out

    def sent(self, chunk: int, grams: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Packed columns for every bucket; ``grams`` are sorted."""
        bucket = self.bucket_of(grams).astype(np.int64)
        used = np.unique(bucket)
        lows, highs = np.searchsorted(bucket, used), np.searchsorted(bucket, used, side="right")
        bodies = [
            b"".join(c[low:high].tobytes() for c in (grams, *columns)) for low, high in zip(lows.tolist(), highs.tolist())
        ]
        if bodies:
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array([chunk] * len(bodies), pa.int64()), pa.array(bodies, pa.binary())],
                names=["bucket", "chunk", "body"],
            )


def _over_chunks(buckets: int, work: Callable[[_Chunk, dict], Iterator[pa.RecordBatch]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield from work(_Chunk(row, buckets), row)

    return run


def _send_grams(chunk: _Chunk, row: dict) -> Iterator[pa.RecordBatch]:
    yield from chunk.sent(row["chunk"], np.unique(chunk.grams))


def _send_ranks(chunk: _Chunk, row: dict) -> Iterator[pa.RecordBatch]:
    grams, stretches, least, _, _ = chunk.ranked(chunk.repeated(row))
    yield from chunk.sent(row["chunk"], grams, stretches, least)


_COVERED, _SORT_STRINGS = 1, 2
_STRETCH = GRAM_BYTES + 2 * REACH


def _send_stretches(chunk: _Chunk, row: dict) -> Iterator[pa.RecordBatch]:
    chosen = chunk.repeated(row)
    grams, _, least, _, first = chunk.ranked(chosen)
    sort = chunk.answers(row["second"], grams, np.uint8) == _SORT_STRINGS
    first = chosen[first[sort]]
    left, right = chunk.left[first], chunk.right[first]
    around = np.zeros((len(first), _STRETCH), dtype=np.uint8)
    places = chunk.at[first][:, None] - REACH + np.arange(_STRETCH)
    within = (places >= (chunk.at[first] - left)[:, None]) & (places < (chunk.at[first] + GRAM_BYTES + right)[:, None])
    around[within] = chunk.data[places[within]]
    yield from chunk.sent(
        row["chunk"], grams[sort], least[sort], left.astype(np.uint8), right.astype(np.uint8), around
    )


def _answer(table: pa.Table, bodies: list[bytes]) -> Iterator[pa.RecordBatch]:
    yield pa.RecordBatch.from_arrays(
        [table.column("bucket").combine_chunks(), table.column("chunk").combine_chunks(), pa.array(bodies, pa.binary())],
        names=["bucket", "chunk", "body"],
    )


def _find_repeated(_: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
    parts = [np.frombuffer(b, dtype=np.uint64) for b in table.column("body").to_pylist()]
    every = np.sort(np.concatenate(parts))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    bodies = []
    for part in parts:
        place = np.searchsorted(twice, part)
        found = np.zeros(len(part), dtype=bool)
        near = place < len(twice)
        found[near] = twice[place[near]] == part[near]
        bodies.append(np.packbits(found).tobytes())
    yield from _answer(table, bodies)


def _columns(body: bytes, *kinds: tuple[type, int]) -> list[np.ndarray]:
    """Columns packed one after the other in a body; each kind is (type, width)."""
    rows = len(body) // sum(np.dtype(t).itemsize * width for t, width in kinds)
    out, place = [], 0
    for kind, width in kinds:
        values = np.frombuffer(body, dtype=kind, count=rows * width, offset=place)
        out.append(values.reshape(rows, width) if width > 1 else values)
        place += values.nbytes
    return out


def _rank_stretches(_: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Sort the bucket's stretches; the rows of one rank but its least document are covered."""
    parts = [_columns(b, (np.uint64, 1), (np.uint64, 1), (np.int64, 1)) for b in table.column("body").to_pylist()]
    gram, stretch, doc = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((doc, stretch, gram))
    g, s, d = gram[order], stretch[order], doc[order]
    new_gram = np.ones(len(g), dtype=bool)
    new_gram[1:] = g[1:] != g[:-1]
    new = new_gram.copy()
    new[1:] |= s[1:] != s[:-1]
    least = d[np.flatnonzero(new)][np.cumsum(new) - 1]
    ranks = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_gram))[np.cumsum(new_gram) - 1]
    code = np.where(d > least, _COVERED, np.where(ranks > 1, _SORT_STRINGS, 0)).astype(np.uint8)
    out = np.zeros(len(code), dtype=np.uint8)
    out[order] = code
    cuts = np.cumsum([len(p[0]) for p in parts])[:-1]
    yield from _answer(table, [x.tobytes() for x in np.split(out, cuts)])


def _sort_strings(_: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
    """For each stretch, the bits of the strings in it that also start in a lesser document.

    Equal strings have their sample positions at equal distances, so strings are sorted one distance at a time.
    """
    kinds = ((np.uint64, 1), (np.int64, 1), (np.uint8, 1), (np.uint8, 1), (np.uint8, _STRETCH))
    parts = [_columns(b, *kinds) for b in table.column("body").to_pylist()]
    gram, doc, left, right, around = (np.concatenate(c) for c in zip(*parts))
    up, down = tb.powers("up", MATCH_BYTES), tb.powers("down", REACH + 1)
    string = np.zeros(len(gram), dtype=np.uint64)  # of the current start, without spreading
    for place in range(MATCH_BYTES):
        string += tb.BYTE_VALUES[around[:, place]] * up[place]
    masks = np.zeros(len(gram), dtype=np.uint32)
    step = tb.powers("up", MATCH_BYTES + 1)[MATCH_BYTES]
    for start in range(REACH + 1):
        inside = np.flatnonzero((start >= REACH - left.astype(np.int64)) & (start <= right))
        key = tb.mix(string[inside]) ^ gram[inside]
        order = np.argsort(key, kind="stable")
        k, owner = key[order], doc[inside][order]
        new = np.ones(len(k), dtype=bool)
        new[1:] = k[1:] != k[:-1]
        if len(k):
            least = np.minimum.reduceat(owner, np.flatnonzero(new))[np.cumsum(new) - 1]
            masks[inside[order[owner > least]]] |= np.uint32(1 << start)
        if start < REACH:
            out, new_byte = tb.BYTE_VALUES[around[:, start]], tb.BYTE_VALUES[around[:, start + MATCH_BYTES]]
            string = (string - out + new_byte * step) * down[1]
    cuts = np.cumsum([len(p[0]) for p in parts])[:-1]
    yield from _answer(table, [x.tobytes() for x in np.split(masks, cuts)])


def _removed(chunk: _Chunk, row: dict) -> np.ndarray:
    """Which bytes of the chunk go."""
    chosen = chunk.repeated(row)
    grams, _, least, which, _ = chunk.ranked(chosen)
    codes = chunk.answers(row["second"], grams, np.uint8)
    sort = codes == _SORT_STRINGS
    masks = np.zeros(len(grams), dtype=np.uint32)
    masks[sort] = chunk.answers(row["third"], grams[sort], np.uint32)
    whole = (codes[which] == _COVERED) | (chunk.ids[chunk.doc[chosen]] > least[which])
    change = np.zeros(len(chunk.data) + 1, dtype=np.int32)
    at = chosen[whole]
    np.add.at(change, chunk.at[at] - chunk.left[at], 1)
    np.add.at(change, chunk.at[at] + GRAM_BYTES + chunk.right[at], -1)
    partly = np.flatnonzero(~whole & (masks[which] > 0))
    sample, start = np.nonzero((masks[which[partly]][:, None] >> np.arange(REACH + 1, dtype=np.uint32)) & np.uint32(1))
    begin = chunk.at[chosen[partly[sample]]] - REACH + start
    np.add.at(change, begin, 1)
    np.add.at(change, begin + MATCH_BYTES, -1)
    return np.cumsum(change[:-1]) > 0


def _results(with_kept: bool):
    def work(chunk: _Chunk, row: dict) -> Iterator[pa.RecordBatch]:
        gone = _removed(chunk, row)
        first = gone.copy()
        first[1:] &= ~gone[:-1]
        starts = chunk.offsets[:-1][np.diff(chunk.offsets) > 0]
        first[starts] = gone[starts]
        counts, spans = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, first))
        kept_data = chunk.data[~gone]
        edges = (chunk.offsets - counts[chunk.offsets]).tolist()
        kept = [kept_data[a:b].tobytes() for a, b in zip(edges, edges[1:])]
        columns = [
            pa.array(chunk.doc_ids, pa.int64()),
            pa.array(np.diff(chunk.offsets)),
            pa.array(np.diff(counts[chunk.offsets])),
            pa.array(np.diff(spans[chunk.offsets])),
            pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
        ]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if with_kept:
            columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "kept"]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    return work


def remove_repeats(docs: DataFrame, with_kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row; ``with_kept`` adds the remaining bytes."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = parts_for(total, BUCKET_TEXT_BYTES)
    parts = parts_for(total, 24e6, spark.sparkContext.defaultParallelism)
    schema = RESULT_SCHEMA + (", kept binary" if with_kept else "")
    with arrow_batches(spark), bucketed(docs.mapInArrow(_chunk_rows, _CHUNK_SCHEMA), "chunk", parts) as chunks, \
            arrow_batches(spark, 8):

        def asked(source: DataFrame, send: Callable, answer: Callable, name: str) -> DataFrame:
            sent = source.mapInArrow(_over_chunks(buckets, send), _SENT_SCHEMA)
            answers = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket", "chunk").mapInArrow(
                grouped("bucket", answer), _SENT_SCHEMA)
            return stored(answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "body")).alias(name)), name)

        source = chunks
        for send, answer, name in (
            (_send_grams, _find_repeated, "first"),
            (_send_ranks, _rank_stretches, "second"),
            (_send_stretches, _sort_strings, "third"),
        ):
            source = source.join(asked(source, send, answer, name), "chunk", "left")
        return stored(source.mapInArrow(_over_chunks(buckets, _results(with_kept)), schema), "kept")
