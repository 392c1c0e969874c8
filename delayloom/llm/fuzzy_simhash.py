"""Near duplicates by SimHash fingerprints and Golay-code fuzzy hashing.

A fingerprint has 64 bits: a bit is one if it is set in over half the XXH64 values of the text's shingles, repeats
included.  Fingerprints that differ in ``MOST_ERRORS`` bits or fewer are linked.

The 64 bits are cut into segments of 22, 21 and 21 bits.  The binary Golay code puts every 23-bit word within three
bits of exactly one codeword.  A segment's indices are the codewords of the words at most one bit away from it, six at
most; two segments that differ in two bits or fewer have a word between them and so share an index.  Of four errors
over three segments,

* some segment has none: another has two at most.  Keys: that segment itself with an index of the other;
* or every segment has one or two, and two of them exactly one: a half of either is free of errors, and the third
  segment has two at most.  Keys: the two halves with an index of the third.

That is about 95 keys of 33 bits and more for a fingerprint, and no link is missed.  What is keyed are distinct
fingerprints, so copies never meet.  Fingerprints that share a key are compared in one task, and only as many links as
join them are returned; a key with more than ``BLOCK`` fingerprints is dealt as pairs of blocks, each pair once.

Null, empty and blank texts have the fingerprint zero and are linked like any other.  Rows with a null doc_id take part;
a class takes its least non-null doc_id.  Repeated rows are returned as often as they occur.  Extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayloom.llm import _bytes as tb
from delayloom.llm._graph import components
from delayloom.llm._spark import arrow_batches, grouped, parts_for, stored

SHINGLE_WORDS = 4
MOST_ERRORS = 4
SEED = 42
#: Lowest bit and width of each segment, and of its two halves.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
HALVES = (((0, 11), (11, 11)), ((22, 11), (33, 10)), ((43, 11), (54, 10)))
#: Generator of the (23, 12) Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0xC75
#: Fingerprints of one key compared in one task at once (two blocks where a key has more).
BLOCK = 4096
#: Shingles whose hashes are held at once, parts that rows of a fingerprint are dealt over, and links that are joined at once.
STEP_SHINGLES, SALTS, HELD_LINKS = 1 << 16, 16, 1 << 16

U64 = np.uint64


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """SimHash of a text's word shingles; zero without words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z, only ASCII blanks
    if not words:
        return 0
    whole = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    width = min(size, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    ones = np.zeros(64, dtype=np.int64)
    for low in range(0, len(starts), STEP_SHINGLES):
        pairs = zip(starts[low : low + STEP_SHINGLES], ends[low : low + STEP_SHINGLES])
        hashes = np.array([xxh64_intdigest(whole[a:b], SEED) for a, b in pairs], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), size) for t in batch.column("text")], dtype=np.uint64)
            salts = pa.array(np.arange(len(found), dtype=np.int32) % SALTS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64)), salts], names=["doc_id", "bits", "salt"])

    return run


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator: zero for codewords, equal where two words differ by one."""
    words = words.astype(np.int64)
    for bit in range(22, 10, -1):
        words = np.where(words >> bit & 1, words ^ (GENERATOR << (bit - 11)), words)
    return words


def _index_offsets() -> np.ndarray:
    """For each syndrome, what leads from a word to its (up to six) indices: a codeword is the word XOR an offset."""
    errors = np.zeros(2048, dtype=np.int64)
    patterns = np.array([sum(1 << b for b in bits) for n in range(4) for bits in combinations(range(23), n)])
    errors[_syndromes(patterns)] = patterns  # a perfect code: every syndrome once
    flips = np.array([0, *(1 << b for b in range(23))])
    reached = np.sort(flips ^ errors[np.arange(2048)[:, None] ^ _syndromes(flips)], axis=1)
    offsets = np.zeros((2048, 6), dtype=np.int64)
    for syndrome, own in enumerate(reached):
        own = np.unique(own)
        offsets[syndrome] = np.resize(own, 6)
    return offsets


_OFFSETS = _index_offsets()


def indices(words: np.ndarray) -> np.ndarray:
    """Six Golay indices (12 bits) of each word of up to 23 bits, some of them repeated."""
    words = words.astype(np.int64)
    return (words[:, None] ^ _OFFSETS[_syndromes(words)]) >> 11


def _bits(fingerprints: np.ndarray, place: tuple[int, int]) -> np.ndarray:
    return (fingerprints >> U64(place[0])) & U64((1 << place[1]) - 1)


def keys(fingerprints: np.ndarray) -> np.ndarray:
    """Keys of each fingerprint, sorted; a key that a fingerprint has twice is repeated in its row."""
    found = [indices(_bits(fingerprints, s)).astype(U64) for s in SEGMENTS]
    out = []
    for i in range(3):
        for j in range(3):
            if i != j:
                kind = U64(len(out) + 1) << U64(48)
                out.append(kind | (_bits(fingerprints, SEGMENTS[i])[:, None] << U64(12)) | found[j])
    for k in range(3):
        i, j = (x for x in range(3) if x != k)
        for first in HALVES[i]:
            for second in HALVES[j]:
                kind = U64(len(out) + 1) << U64(48)
                own = (_bits(fingerprints, first) << U64(23)) | (_bits(fingerprints, second) << U64(12))
                out.append(kind | own[:, None] | found[k])
    return np.sort(np.concatenate(out, axis=1), axis=1)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = batch.column("bits").to_numpy()
        found = keys(bits.view(np.uint64))
        once = np.ones(found.shape, dtype=bool)
        once[:, 1:] = found[:, 1:] != found[:, :-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found[once].view(np.int64)), pa.array(np.repeat(bits, once.sum(axis=1)))], names=["key", "bits"])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few of the links as join the same nodes."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    chosen = np.zeros(len(a), dtype=bool)
    while True:
        ends = label[one], label[two]
        across = np.flatnonzero(ends[0] != ends[1])
        if not len(across):
            return a[chosen], b[chosen]
        high, low = np.maximum(ends[0], ends[1])[across], np.minimum(ends[0], ends[1])[across]
        # every label that has lower neighbours takes the lowest; one link stands for the step
        order = np.lexsort((low, high))
        first = order[np.concatenate([[True], high[order][1:] != high[order][:-1]])]
        chosen[across[first]] = True
        parent = np.arange(len(nodes))
        parent[high[first]] = low[first]
        while not np.array_equal(parent[parent], parent):
            parent = parent[parent]
        label = parent[label]


def linked_in_key(bits: np.ndarray, sides: np.ndarray | None, errors: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the fingerprints of one key: every pair (with ``sides``: across them) is decided."""
    own = bits.view(np.uint64)
    left, right = (own, own) if sides is None else (own[sides == 0], own[sides == 1])
    held: list[tuple[np.ndarray, np.ndarray]] = [(bits[:0], bits[:0])]
    amount = 0
    for low in range(0, len(left), 256):
        block = left[low : low + 256]
        later = right[low:] if sides is None else right
        x, y = np.nonzero(np.bitwise_count(block[:, None] ^ later[None, :]) <= errors)
        if sides is None:
            x, y = x[x < y], y[x < y]
        held.append((block[x].view(np.int64), later[y].view(np.int64)))
        amount += len(x)
        if amount > HELD_LINKS:  # keep only what joins the same fingerprints
            held = [forest(*(np.concatenate(c) for c in zip(*held)))]
            amount = len(held[0][0])
    return forest(*(np.concatenate(c) for c in zip(*held)))


def _key_links(errors: int):
    def work(_: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        side = table.column("side").to_numpy()
        if len(side) < 2:
            return
        a, b = linked_in_key(table.column("bits").to_numpy(), None if side[0] < 0 else side, errors)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return grouped("task", work)


def _placed(keyed: DataFrame) -> DataFrame:
    """(task, side, bits): the tasks of each key with more than one fingerprint.

    A key of up to BLOCK fingerprints is one task.  A larger one is dealt over blocks; each pair of blocks is a task,
    and a block with itself is one too (side -1: all pairs).
    """
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = keyed.join(shared, "key")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("bits"), blocks).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.struct(
        F.xxhash64("key", F.least(own, j), F.greatest(own, j)).alias("task"),
        F.when(j == own, -1).when(j > own, 0).otherwise(1).alias("side")))
    whole = F.array(F.struct(F.xxhash64("key", F.lit(0), F.lit(0)).alias("task"), F.lit(-1).alias("side")))
    at = F.explode(F.when(F.col("n") <= BLOCK, whole).otherwise(pairs))
    return members.select("bits", at.alias("at")).select("at.task", "at.side", "bits")


def links(fingerprints: DataFrame, errors: int = MOST_ERRORS) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints (``bits``) which differ in ``errors`` bits or fewer (four at most)."""
    if errors > MOST_ERRORS:
        raise ValueError(f"the keys find up to {MOST_ERRORS} errors")
    placed = stored(_placed(stored(fingerprints.mapInArrow(_keyed, "key long, bits long"), "keys")), "key-members")
    parts = parts_for(placed.count(), 1e6, placed.sparkSession.sparkContext.defaultParallelism)
    return stored(
        placed.repartition(parts, "task").sortWithinPartitions("task").mapInArrow(_key_links(errors), "a long, b long"),
        "fingerprint-links")


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, errors: int = MOST_ERRORS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (least doc_id reachable over links)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with arrow_batches(docs.sparkSession):
        rows = stored(rows.mapInArrow(_fingerprints(size), "doc_id long, bits long, salt int"), "fingerprints")
    same = stored(rows.groupBy("bits").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    classes = components(links(same.select("bits"), errors)).withColumnRenamed("node", "bits")
    named = same.join(classes, "bits", "left").withColumn("class", F.coalesce("component", "bits"))
    leaders = named.groupBy("class").agg(F.min("first").alias("component_id"))
    # one fingerprint can have any number of rows: they were dealt over salts as they were read
    known = named.select("bits", "class").join(leaders, "class").select(
        "bits", "component_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return rows.join(known, ["bits", "salt"]).select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
