"""Texts as byte arrays inside Arrow tasks: words, word hashes and shingles without a Python loop per word.

Everything works on slices of about a megabyte, so that the memory of a task does not depend on how many rows an Arrow
batch holds. Byte classes equal the code point classes they stand for, as UTF-8 uses bytes over 0x7F for all others.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

U = np.uint64
SLICE_BYTES = 1 << 20
BATCH_ROWS = 512
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)


#: what a Python worker keeps between tasks, by the operator that uses it
HELD: dict = {}


def map_batches(df: DataFrame, func: Callable, schema: str, keeps: str = "") -> DataFrame:
    """`mapInArrow` with batches of at most BATCH_ROWS rows, as a row holds a whole text.

    Spark keeps Python workers between tasks, so a task lets go of what other operators than `keeps` left in HELD, and
    hands its free memory back to the system at its end.
    """

    def run(batches):
        let_go(keeps)
        yield from func(batches)
        release()

    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) not in range(1, BATCH_ROWS + 1):
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def let_go(keeps: str) -> None:
    """Drop what operators other than `keeps` hold. A function of the module, so that a task sees its worker's HELD."""
    for name in [name for name in HELD if name != keeps]:
        del HELD[name]


def release() -> None:
    """Return memory that Arrow and the C allocator hold free."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    column = column.fill_null("").cast(pa.large_binary())
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes each, or of one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def byte_values(is_word: np.ndarray, fold: bool) -> np.ndarray:
    """A 64-bit value per byte: zero for separators, else scrambled; A-Z share the values of a-z when `fold`."""
    code = np.arange(256, dtype=U)
    if fold:
        code[65:91] = code[97:123]
    values = mix((code + U(1)) * U(ODD[0])) | U(1)
    values[~is_word] = 0
    return values


def class_of(*separators: range) -> np.ndarray:
    """True for bytes that belong to words."""
    word = np.ones(256, bool)
    for r in separators:
        word[r.start : r.stop] = False
    return word


SPACES = (range(0x20, 0x21), range(0x09, 0x0E))
SPACED = byte_values(class_of(*SPACES), fold=True)
POWERS = np.cumprod(np.full(4096, U(ODD[1])), dtype=U)


def _hash_block(raw: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of every word in one block."""
    v = values[raw]
    word = v != 0
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, U), starts
    v = v[starts[0] :]
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    longest = int(place.max()) + 1
    powers = POWERS if longest <= len(POWERS) else np.cumprod(np.full(longest, U(ODD[1])), dtype=U)
    return mix(np.add.reduceat(v * powers[place], starts - starts[0])), starts


def word_hashes(raw: np.ndarray, offsets: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words before each row): words never cross rows.

    Rows are joined by a separator first; a long row is hashed in blocks that end at separators.
    """
    gap = int(np.flatnonzero(values == 0)[0])
    n = len(offsets) - 1
    joined = np.full(len(raw) + n, gap, np.uint8)
    row = np.repeat(np.arange(n), np.diff(offsets))
    joined[np.arange(len(raw)) + row] = raw
    hashes, starts, at = [], [], 0
    while at < len(joined):
        end = min(len(joined), at + 2 * SLICE_BYTES)
        while end < len(joined) and values[joined[end - 1]] != 0:
            end += 1
        h, s = _hash_block(joined[at:end], values)
        hashes.append(h)
        starts.append(s + at)
        at = end
    if not hashes:
        return np.zeros(0, U), np.zeros(n + 1, np.int64)
    bounds = np.searchsorted(np.concatenate(starts), offsets + np.arange(n + 1))
    return np.concatenate(hashes), bounds


def shingles(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every run of `size` words, bounds per row); a row with fewer words has one run of all of them."""
    counts = np.diff(bounds)
    runs = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(runs)])
    first = np.repeat(bounds[:-1] - out_bounds[:-1], runs) + np.arange(out_bounds[-1])
    short = np.repeat(np.where(counts < size, counts, size), runs)
    total = np.zeros(len(first), U)
    multiplier = 1
    for k in range(size):
        multiplier = (multiplier * ODD[2] + ODD[3]) % (1 << 64) | 1
        here = k < short
        total[here] += words[first[here] + k] * U(multiplier)
    return mix(total + short.astype(U)), out_bounds
