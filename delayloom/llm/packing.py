"""Best-fit packing of token sequences with certified bounds.

Documents are tokenised by a public byte-level BPE vocabulary (a file whose path is a parameter), ended by
one separator id and cut only where they exceed the capacity.  Pieces are then packed inside partitions by
best-fit decreasing.  Dual-feasible functions bound the sequences any packing of a partition needs; where
the count meets the bound the partition is certified and final.  The others release their poorly filled
sequences, which are dealt anew over fewer partitions and packed again.

Null and empty texts become the separator alone.  Repeated rows are packed as often as they occur.  An empty
table gives no rows.  Extra columns of the input are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayloom.llm import _bytes as tb
from delayloom.llm._spark import arrow_batches, grouped, parts_for, stored

CAPACITY = 2048
SEPARATOR_ID = 0
VOCABULARY = "byte_bpe_50k.json"
#: Pieces packed together in one task, and how often partitions with a gap exchange pieces.
GROUP_PIECES = 40_000
EXCHANGES = 3
#: Distinct word forms a task remembers before it starts anew.
REMEMBERED_FORMS = 1_000_000

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long, certified boolean"


def _after_wide_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """True where a white-space character outside ASCII ends just before the position."""
    one, two, three = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
    general = (two == 0x80) & (((one >= 0x80) & (one <= 0x8A)) | np.isin(one, (0xA8, 0xA9, 0xAF)))
    return (
        ((two == 0xC2) & ((one == 0xA0) | (one == 0x85)))
        | ((three == 0xE2) & (general | ((two == 0x81) & (one == 0x9F))))
        | ((three == 0xE1) & (two == 0x9A) & (one == 0x80))
        | ((three == 0xE3) & (two == 0x80) & (one == 0x80))
    )


def _merged(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Two tables as one, sorted by the first column."""
    order = np.argsort(np.concatenate([a[0], b[0]]), kind="stable")
    return tuple(np.concatenate([x, y])[order] for x, y in zip(a, b))


class _Encoder:
    """Ids of texts, by encoding each distinct stretch of blanks and a word once.

    The vocabulary's splitter never joins characters across the start of a run of blanks, so a text's ids
    are those of its stretches one after the other.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits; the vocabulary is larger")
        self.forget()

    def forget(self) -> None:
        """Two sorted tables of form hashes: many settled ones and a few new ones, merged now and then."""
        self.tables = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(2)]
        self.ids = np.zeros(1 << 16, dtype=np.uint16)
        self.used = 0

    def _known(self, forms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and numbers of ids of each form, and which forms are not known."""
        starts, sizes = np.zeros(len(forms), dtype=np.int64), np.zeros(len(forms), dtype=np.int64)
        missing = np.ones(len(forms), dtype=bool)
        for keys, own_starts, own_sizes in self.tables:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, forms), len(keys) - 1)
                hit = keys[at] == forms
                starts[hit], sizes[hit] = own_starts[at[hit]], own_sizes[at[hit]]
                missing &= ~hit
        return starts, sizes, missing

    def _learn(self, keys: np.ndarray, forms: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Encode forms and remember them; their starts and numbers of ids."""
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(forms, add_special_tokens=False)]
        sizes = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
        flat = np.fromiter(chain.from_iterable(encoded), dtype=np.uint16, count=int(sizes.sum()))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(flat)] = flat
        starts = self.used + tb.run_starts(sizes)
        self.used += len(flat)
        old, new = self.tables
        new = _merged(new, (keys, starts, sizes))
        self.tables = [_merged(old, new), tuple(x[:0] for x in new)] if len(new[0]) > 30_000 else [old, new]
        return starts, sizes

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the number of ids of each text."""
        if len(self.tables[0][0]) > REMEMBERED_FORMS:
            self.forget()
        blank = tb.SPACE[data]
        cut = blank.copy()
        cut[1:] &= ~blank[:-1]
        at = np.flatnonzero(cut)
        cut[at[_after_wide_space(data, at)]] = False
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        hashes = tb.stretch_hashes(tb.prefix_sums(data, tb.BYTE_VALUES), starts, ends)
        forms, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        form_starts, form_sizes, missing = self._known(forms)
        new = np.flatnonzero(missing)
        if len(new):
            form_starts[new], form_sizes[new] = self._learn(
                forms[new],
                [data[starts[i] : ends[i]].tobytes().decode("utf-8", "replace") for i in first[new].tolist()])
        sizes = form_sizes[which]
        ids = self.ids[tb.expand(form_starts[which], sizes)]
        edges = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(starts, offsets)]
        return ids, np.diff(edges)


#: A worker keeps its encoder, and so the forms it has met, from task to task.
_encoders: dict[str, _Encoder] = {}


def _piece_rows(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
    encoder = _encoders.get(path) or _encoders.setdefault(path, _Encoder(path))
    for batch in batches:
        data, offsets = tb.text_bytes(batch.column("text"))
        doc_ids = batch.column("doc_id")
        for low, high in tb.steps(offsets):
            ids, counts = encoder.encode(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            rows: list[tuple[int, int, int, int, int]] = []
            place = 0
            for row, count in enumerate(counts.tolist()):
                own = np.append(ids[place : place + count], np.uint32(SEPARATOR_ID)).astype("<u4")
                place += count
                start, end = 0, (len(own) - 1) % capacity + 1
                for piece in range(-(-len(own) // capacity)):
                    rows.append((low + row, piece, start, end - start, zlib.crc32(own[start:end].tobytes())))
                    start, end = end, end + capacity
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [doc_ids.take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int32())]
                + [pa.array(c, pa.int64()) for c in columns[2:]],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )


def token_pieces(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: its place among the document's ids, its length and a checksum of its ids.

    ``tokenizer_path`` names the vocabulary file as executors see it; by default the installed public one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_path
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        yield from _piece_rows(batches, path, capacity)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECE_SCHEMA)


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Least number of sequences that any packing needs, by two families of dual-feasible functions.

    The first counts lengths over ``capacity - t`` as whole and those under ``t`` as nothing; the second
    rounds ``(k + 1) * length / capacity`` down to k-ths.
    """
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    if not counts.sum():
        return 0
    sizes = np.arange(capacity + 1, dtype=np.int64)
    total = np.concatenate([[0], np.cumsum(counts * sizes)])
    number = np.concatenate([[0], np.cumsum(counts)])
    t = np.arange(0, capacity // 2 + 1)
    large = number[-1] - number[capacity - t + 1]
    bounds = [-(-(large * capacity + total[capacity - t + 1] - total[t]) // capacity)]
    for k in range(1, 101):
        scaled = (k + 1) * sizes
        exact = scaled % capacity == 0
        # lengths times k, so that all stays whole: k-ths of a sequence, or the length where it divides
        worth = np.where(exact, sizes * k, scaled // capacity * capacity)
        bounds.append(np.array([-(-int((worth * counts).sum()) // (k * capacity))]))
    return int(max(b.max() for b in bounds))


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, and the room left in each sequence."""
    order = np.argsort(-lengths, kind="stable")
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, room_left = 0, []  # bit r of rooms: some sequence has r left
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            own = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, own = capacity, len(room_left)
            room_left.append(capacity)
        sequence[i], offset[i] = own, capacity - room
        room_left[own] = room - size
        if room > size:
            if not with_room[room - size]:
                rooms |= 1 << (room - size)
            with_room[room - size].append(own)
    return sequence, offset, np.array(room_left, dtype=np.int64)


def _pack_group(round_number: int, last: bool, capacity: int):
    def work(group: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        lengths = table.column("length").to_numpy()
        sequence, offset, room = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(lengths, capacity)
        certified = len(room) <= bound
        waste = max(0.0, (bound * capacity - int(lengths.sum())) / max(bound, 1))
        final = np.ones(len(room), dtype=bool) if certified or last else room <= waste
        base = (round_number << 56) | (group << 28)
        added = [base + sequence, offset, np.full(len(lengths), certified), ~final[sequence]]
        table = table.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        for name, values in zip(("sequence_id", "offset", "certified", "open"), added):
            table = table.append_column(name, pa.array(values))
        yield from table.combine_chunks().to_batches()

    return grouped("part", work)


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, exchanges: int = EXCHANGES
) -> DataFrame:
    """Assign every piece a sequence and a gapless offset; ``certified``: its last partition met its bound.

    Each round deals the open rows by a hash of their number over partitions of about ``group_pieces``, so neither a
    source, a doc_id nor a length that many documents share makes a large group.
    """
    done, pool, parts = None, pieces, None
    for round_number in range(exchanges + 1):
        size = pool.count()
        if not size and done is not None:
            break
        before, parts = parts, parts_for(size, group_pieces)
        last = round_number == exchanges or parts == 1 or parts == before
        # by the row's number in the stored table: rows without doc_id, or under one, are dealt like any other
        part = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(round_number)), F.lit(parts))
        packed = stored(
            pool.withColumn("part", part)
            .repartition(parts, "part")
            .sortWithinPartitions("part", "length", "doc_id", "piece")
            .mapInArrow(_pack_group(round_number, last, capacity), PACKED_SCHEMA + ", open boolean"),
            f"packed-{round_number}",
        )
        settled = packed.filter("not open").drop("open")
        done = settled if done is None else done.union(settled)
        if last:
            break
        pool = packed.filter("open").select("doc_id", "piece", "start", "length", "ids_crc32")
    return done


def pack_documents(
    docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """Tokenise and pack: doc_id, piece, start, length, ids_crc32, sequence_id, offset, certified."""
    with arrow_batches(docs.sparkSession):
        pieces = stored(token_pieces(docs, tokenizer_path, capacity), "pieces")
    return pack(pieces, capacity, group_pieces)
