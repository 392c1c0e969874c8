"""Benchmark decontamination by q-gram lemma filtering.

Benchmark texts are cut into probes: the whole text if it is short, else overlapping stretches of
``PROBE_CHARS``.  A document contains a probe when some stretch of it is within ``e`` edits of the probe, e
being ``EDIT_PERCENT`` of its length.  By the q-gram lemma such a stretch shares at least
``n - q + 1 - q * e`` q-grams with the probe, all in a band of e diagonals on either side.  So q-gram hits are counted in
overlapping diagonal bands; only bands that reach the bound are verified, by banded alignment.

An item under ``MIN_PROBE_CHARS`` is one probe without edits: it is found where it stands whole, between word
boundaries.  Its first ``GRAM`` bytes, or all if it is shorter, are looked up.

Both sides are compared with A-Z and the accented capitals of Western Europe in lower case and every run of
blanks as one space.

The benchmark is read in blocks of bounded size, each sent to all tasks; documents are streamed and never
shuffled, so no source, passage or item makes a hot task.

Null and empty texts contain nothing; items without text are never found.  Items with a null item_id are reported
with a null, and so are rows with a null doc_id.  Repeated documents are each reported; repeated items are each reported.
Empty tables give no rows.  Extra columns, whatever their names and types, are ignored (kept by ``drop_contaminated``).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayloom.llm import _bytes as tb
from delayloom.llm._spark import arrow_batches, packed, parts_for, stored, unpacked

GRAM = 12
EDIT_PERCENT = 6
PROBE_CHARS = 128
MIN_PROBE_CHARS = 48
#: Bytes of benchmark text sent to every task at once; more text is taken in further blocks.
BLOCK_BYTES = 8_000_000
_FILTER_BITS = 22

MATCH_SCHEMA = "doc_id long, item_id long, n_probes int, n_matched int, least_edits int, start long, end long"


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower case with single spaces: bytes, offsets, and the place of each byte in the original."""
    blank = tb.SPACE[data]
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    firsts = offsets[:-1][np.diff(offsets) > 0]
    keep[firsts] = True
    at = np.flatnonzero(keep)
    out = np.where(blank[at], np.uint8(32), data[at])
    upper = (out >= 65) & (out <= 90)
    upper[1:] |= (out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)  # accented capitals
    out = out + upper.astype(np.uint8) * np.uint8(32)
    return out, np.searchsorted(at, offsets), at


class Probes:
    """The probes of a block of benchmark items and an index of their q-grams."""

    def __init__(self, items: list[tuple[int | None, str, int]]):
        """Items with the number of their rows; ``item`` is the place in the list, as ids can be null."""
        self.item, self.text = [], []
        short: dict[int, list[tuple[int, bytes]]] = {}
        for number, (_, text, _) in enumerate(items):
            raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
            body = normalised(raw, np.array([0, len(raw)]))[0].tobytes().strip()
            if len(body) < MIN_PROBE_CHARS:
                if body:
                    short.setdefault(min(len(body), GRAM), []).append((number, body))
                continue
            last = max(0, len(body) - PROBE_CHARS)
            for start in [*range(0, last, PROBE_CHARS // 2), last]:
                self.item.append(number)
                self.text.append(body[start : start + PROBE_CHARS])
        lengths = np.array([len(t) for t in self.text], dtype=np.int64)
        self.edits = lengths * EDIT_PERCENT // 100
        self.bound = lengths - GRAM + 1 - GRAM * self.edits
        data = np.frombuffer(b"".join(self.text), dtype=np.uint8)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        grams = tb.gram_hashes(tb.prefix_sums(data, tb.BYTE_VALUES), GRAM) if len(data) else np.zeros(0, np.uint64)
        counts = np.maximum(lengths - GRAM + 1, 0)
        at = tb.expand(offsets[:-1], counts)
        order = np.argsort(grams[at], kind="stable")
        self.grams = grams[at][order]
        self.probe = np.repeat(np.arange(len(lengths)), counts)[order]
        self.place = (at - np.repeat(offsets[:-1], counts))[order]
        self.filter = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.filter[self.grams >> np.uint64(64 - _FILTER_BITS)] = True

        #: By size of the gram: sorted hashes of the short items' first grams, then their lengths, hashes and numbers.
        self.short = {}
        for size, own in short.items():
            joined = np.frombuffer(b"".join(body for _, body in own), dtype=np.uint8)
            ends = np.cumsum([len(body) for _, body in own])
            starts = ends - np.array([len(body) for _, body in own])
            sums = tb.prefix_sums(joined, tb.BYTE_VALUES)
            first = tb.stretch_hashes(sums, starts, starts + size)
            order = np.argsort(first, kind="stable")
            self.short[size] = (first[order], (ends - starts)[order], tb.stretch_hashes(sums, starts, ends)[order],
                                np.array([number for number, _ in own])[order])

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, probe, place in the probe) of every q-gram shared with a probe."""
        maybe = np.flatnonzero(self.filter[grams >> np.uint64(64 - _FILTER_BITS)])
        low = np.searchsorted(self.grams, grams[maybe])
        high = np.searchsorted(self.grams, grams[maybe], side="right")
        counts = high - low
        at = tb.expand(low, counts)
        return np.repeat(maybe, counts), self.probe[at], self.place[at]


def banded_edits(probe: bytes, text: bytes, first: int, band: int, most: int) -> tuple[int, int] | None:
    """Least edits between the probe and a stretch of the text, and where it ends.

    Only diagonals (text place minus probe place) from ``first`` to ``first + band`` are filled in; the
    stretch may begin and end anywhere.  None beyond ``most`` edits.
    """
    n = band + 1
    columns = np.arange(n)
    big = len(probe) + len(text) + 1
    body = np.frombuffer(text, dtype=np.uint8).astype(np.int16)
    start = first + columns  # text place of each diagonal before the first letter
    row = np.where((start >= 0) & (start <= len(body)), 0, big)
    for i, letter in enumerate(probe):
        place = first + i + columns
        inside = (place >= 0) & (place < len(body))
        other = body[np.clip(place, 0, max(len(body) - 1, 0))] if len(body) else np.zeros(n, np.int16)
        change = np.where(inside, row + (other != letter), big)
        drop = np.append(row[1:], big) + 1  # a probe letter with no counterpart
        best = np.where(place + 1 >= 0, np.minimum(change, drop), big)
        best = np.where(place + 1 <= len(body), best, big)
        row = np.minimum.accumulate(best - columns) + columns  # a text letter with no counterpart
        if row.min() > most:
            return None
    end = int(row.argmin())
    return (int(row[end]), first + len(probe) + end) if row[end] <= most else None


def _matches(data: np.ndarray, offsets: np.ndarray, probes: Probes) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, probe, edits, start, end) with places in the original text."""
    text, edges, origin = normalised(data, offsets)
    if len(text) < GRAM or not len(probes.text):
        return
    at, probe, place = probes.hits(tb.gram_hashes(tb.prefix_sums(text, tb.BYTE_VALUES), GRAM))
    row = np.searchsorted(edges, at, side="right") - 1
    whole = at + GRAM <= edges[row + 1]
    at, probe, place, row = at[whole], probe[whole], place[whole], row[whole]
    if not len(at):
        return
    diagonal = at - place
    half = probes.edits[probe] + 1
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    for shift in (0, 1):  # bands of twice the reach, once more moved by half of it
        band = (diagonal + shift * half) // (2 * half)
        order = np.lexsort((place, band, probe))
        p, b, d, j = probe[order], band[order], diagonal[order], place[order]
        new = np.ones(len(p), dtype=bool)
        new[1:] = (p[1:] != p[:-1]) | (b[1:] != b[:-1])
        fresh = new.copy()
        fresh[1:] |= j[1:] != j[:-1]  # a q-gram of the probe counts once
        firsts = np.flatnonzero(new)
        counts = np.add.reduceat(fresh.astype(np.int64), firsts)
        for k in np.flatnonzero(counts >= np.maximum(probes.bound[p[firsts]], 1)).tolist():
            i = firsts[k]
            low, key = int(b[i] * 2 * half[order[i]] - shift * half[order[i]]), int(p[i])
            reach = int(probes.edits[key])
            middle = int(np.bincount((d[i : i + (np.append(firsts, len(p))[k + 1] - i)] - low)).argmax()) + low
            doc = int(row[order[i]])
            known = found.get((doc, key))
            if known and known[0] == 0:
                continue
            begin, stop = int(edges[doc]), int(edges[doc + 1])
            target = probes.text[key]
            if begin <= middle and middle + len(target) <= stop and text[middle : middle + len(target)].tobytes() == target:
                found[doc, key] = (0, middle, middle + len(target))
                continue
            left = max(begin, low - reach)
            right = min(stop, low + 4 * reach + 2 + len(target))
            result = banded_edits(target, text[left:right].tobytes(), low - reach - left, 4 * reach + 2, reach)
            if result and (not known or result[0] < known[0]):
                end = left + result[1]
                found[doc, key] = (result[0], max(begin, end - len(target)), end)
    for (doc, key), (edits, start, end) in sorted(found.items()):
        base = int(offsets[doc])
        yield doc, key, edits, int(origin[start]) - base, int(origin[end - 1]) + 1 - base


def _short_matches(data: np.ndarray, offsets: np.ndarray, probes: Probes) -> Iterator[tuple[int, int, int, int]]:
    """(row, item, start, end) of the first whole stand of each short item in a text, places in the original."""
    if not probes.short or not len(data):
        return
    text, edges, origin = normalised(data, offsets)
    sums = tb.prefix_sums(text, tb.BYTE_VALUES)
    wordlike = np.zeros(len(text) + 2, dtype=bool)  # shifted by one: nothing before the first and after the last
    wordlike[1:-1] = ((text >= 48) & (text <= 57)) | ((text >= 97) & (text <= 122)) | (text >= 128)
    for size, (first, lengths, wholes, numbers) in probes.short.items():
        grams = tb.gram_hashes(sums, size)
        low = np.searchsorted(first, grams)
        counts = np.searchsorted(first, grams, side="right") - low
        probe = tb.expand(low, counts)
        at = np.repeat(np.arange(len(grams)), counts)
        row = np.searchsorted(edges, at, side="right") - 1
        end = at + lengths[probe]
        inside = end <= edges[row + 1]
        at, probe, row, end = at[inside], probe[inside], row[inside], end[inside]
        opens = (at == edges[row]) | ~(wordlike[at] & wordlike[at + 1])
        closes = (end == edges[row + 1]) | ~(wordlike[end] & wordlike[end + 1])
        same = opens & closes & (tb.stretch_hashes(sums, at, end) == wholes[probe])
        at, probe, row, end = at[same], probe[same], row[same], end[same]
        order = np.lexsort((at, probe, row))
        at, probe, row, end = at[order], probe[order], row[order], end[order]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (probe[1:] != probe[:-1]) | (row[1:] != row[:-1])
        for k in np.flatnonzero(new).tolist():
            base = int(offsets[row[k]])
            yield int(row[k]), int(numbers[probe[k]]), int(origin[at[k]]) - base, int(origin[end[k] - 1]) + 1 - base


def _found(batch: pa.RecordBatch, probes: Probes) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """(row, item, matches of the item's probes) of a batch of texts."""
    data, offsets = tb.text_bytes(batch.column("text"))
    for low, high in tb.steps(offsets):
        own: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        step = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], probes
        for doc, key, edits, start, end in _matches(*step):
            own.setdefault((low + doc, probes.item[key]), []).append((edits, start, end))
        for doc, item, start, end in _short_matches(*step):
            own[low + doc, item] = [(0, start, end)]
        for (doc, item), found in own.items():
            yield doc, item, found


def _scan(items: list[tuple[int | None, str, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes = Probes(items)
        number = {}
        for item in probes.item:
            number[item] = number.get(item, 0) + 1
        for batch in batches:
            rows = []
            for doc, item, found in _found(batch, probes):
                item_id, _, times = items[item]
                rows.extend([(doc, item_id, number.get(item, 1), len(found), min(f[0] for f in found),
                              min(f[1] for f in found), max(f[2] for f in found))] * times)
            if rows:
                doc, *columns = zip(*rows)
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(doc, pa.int64())), *map(pa.array, columns, kinds)],
                    names=["doc_id", "item_id", "n_probes", "n_matched", "least_edits", "start", "end"],
                )

    return run


def _clean(items: list[tuple[int | None, str, int]]):
    """Rows whose own text contains none of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes = Probes(items)
        for batch in batches:
            clean = np.ones(batch.num_rows, dtype=bool)
            clean[[doc for doc, _, _ in _found(batch, probes)]] = False
            yield batch.filter(pa.array(clean))

    return run


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str, int]]]:
    """Items with the number of their rows, in blocks of about BLOCK_BYTES, by a hash of the item; an item is in one block."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").groupBy("item_id", "text").count()
    parts = parts_for(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0, BLOCK_BYTES)
    for part in range(parts):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield [(r[0], r[1], r[2]) for r in block.orderBy("item_id", "text").collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item found in it.

    n_probes and n_matched: probes of the item and how many the document contains; least_edits of them; start
    and end: bytes of the document from the first to the last matched stretch.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with arrow_batches(docs.sparkSession):
        found = [stored(docs.mapInArrow(_scan(items), MATCH_SCHEMA), "matches") for items in _blocks(benchmark)]
    return reduce(DataFrame.union, found)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that contain no benchmark item, with all their columns.

    Each row is decided by its own text as it passes by: rows without doc_id, or with another text under the same doc_id,
    are rows like any other, and nothing is shuffled.  The result is stored.
    """
    rows = packed(docs)
    with arrow_batches(docs.sparkSession):
        for items in _blocks(benchmark):
            rows = rows.mapInArrow(_clean(items), rows.schema)
        return stored(unpacked(rows, docs), "clean")
