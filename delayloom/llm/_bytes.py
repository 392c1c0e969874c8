"""Vectorised work on the bytes of many texts at once (numpy inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_MIX_A = U64(0xBF58476D1CE4E5B9)
_MIX_B = U64(0x94D049BB133111EB)

#: Bytes of text that one step works on; a longer text is a step of its own.
STEP_BYTES = 1 << 19

_generator = np.random.Generator(np.random.PCG64(20240607))
#: A fixed random value for each byte, so that hashes agree between tasks.
BYTE_VALUES = _generator.integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
#: The same with A-Z as a-z.
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[65:91] = BYTE_VALUES[97:123]
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True

_powers = {"up": np.ones(1, dtype=U64), "down": np.ones(1, dtype=U64)}


def powers(kind: str, size: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < size:
        size = max(size, STEP_BYTES + 1)
        base = np.full(size, _MULTIPLIER if kind == "up" else _INVERSE, dtype=U64)
        base[0] = 1
        have = _powers[kind] = np.multiply.accumulate(base)
    return have[:size]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each value (a fixed bijection of 64-bit integers)."""
    x = x ^ (x >> U64(30))
    x *= _MIX_A
    x ^= x >> U64(27)
    x *= _MIX_B
    x ^= x >> U64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.zeros(0, dtype=np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(offsets: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; each text is whole."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1)
        yield start, min(end, rows)
        start = end


def prefix_sums(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums that give the hash of any stretch: ``stretch_hashes``."""
    sums = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(values[data] * powers("up", len(data) + 1)[: len(data)], out=sums[1:])
    return sums


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each pair; equal stretches get equal hashes wherever they stand."""
    return mix((sums[ends] - sums[starts]) * powers("down", len(sums))[starts])


def gram_hashes(sums: np.ndarray, size: int) -> np.ndarray:
    """Hash of each stretch of ``size`` bytes, by start."""
    count = max(0, len(sums) - size)
    return mix((sums[size:] - sums[:count]) * powers("down", len(sums))[:count])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and how many words each text has."""
    blank = SPACE[data]
    before = np.ones(len(data) + 1, dtype=bool)
    before[1:] = blank
    before[offsets] = True
    after = np.ones(len(data) + 1, dtype=bool)
    after[:-1] = blank
    after[offsets] = True
    starts = np.flatnonzero(~blank & before[:-1])
    ends = np.flatnonzero(~blank & after[1:]) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by the first; shorter by ``width - 1``."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def sliding_max(x: np.ndarray, width: int) -> np.ndarray:
    return ~sliding_min(~x, width)


def run_starts(counts: np.ndarray) -> np.ndarray:
    """First index of each run of the given lengths."""
    starts = np.zeros(len(counts), dtype=np.int64)
    np.cumsum(counts[:-1], out=starts[1:])
    return starts


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each run, one after the other."""
    total = int(counts.sum())
    return np.repeat(starts - run_starts(counts), counts) + np.arange(total)
