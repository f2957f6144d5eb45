"""Document fingerprints by winnowing.

A k-gram is K bytes of UTF-8. Of every WINDOW consecutive k-grams the one with the least hash is kept, the rightmost one
of equals, with its position. Two texts that share WINDOW + K - 1 bytes in a row share a kept hash.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sorrel.llm.arrays import ODD, SLICE_BYTES, U, byte_values, class_of, map_batches, mix, slices, text_bytes
from sorrel.llm.rows import in_ranges

K, WINDOW = 16, 50
VALUES = byte_values(class_of(), fold=False)
ENTRY = np.dtype([("hash", "<u4"), ("gap", "u1")])


def rolling64(raw: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of the k bytes from every position, by doubling; the last k - 1 places hold nothing of use."""
    n, total, done = len(raw), np.zeros(len(raw), U), 0
    power, size = VALUES[raw], 1
    while size <= k:
        if k & size:
            shifted = np.zeros(n, U)
            shifted[: n - done] = power[done:]
            total = total * U(ODD[1]) + shifted
            done += size
        longer = power * U(ODD[(size.bit_length() % 3) + 2])
        longer[: max(0, n - size)] += power[size:]
        power, size = longer, 2 * size
    return mix(total)


def rolling(raw: np.ndarray, k: int = K) -> np.ndarray:
    """The upper 32 bits of that."""
    return rolling64(raw, k) >> U(32)


def least(packed: np.ndarray, window: int) -> np.ndarray:
    """The least of `window` values from every position, by doubling; the last window - 1 places hold nothing of use."""
    out, size = packed, 1
    while 2 * size <= window:
        out = np.append(np.minimum(out[:-size], out[size:]), out[-size:])
        size *= 2
    rest = window - size
    return np.append(np.minimum(out[:-rest], out[rest:]), out[-rest:]) if rest else out


def winnow(raw: np.ndarray, offsets: np.ndarray, k: int = K, window: int = WINDOW) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, positions) per row. A text with fewer than `window` k-grams keeps its least one, one shorter than k is a
    single gram at 0, an empty one has nothing. A long row is cut into blocks that overlap by a window."""
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    if n == 1 and lengths[0] > 4 * SLICE_BYTES:
        step, parts, at = 4 * SLICE_BYTES - window - k + 2, [], 0
        while at == 0 or at + window + k - 1 <= lengths[0]:
            piece = raw[at : at + 4 * SLICE_BYTES]
            h, p = winnow(piece, np.array([0, len(piece)]), k, window)[0]
            parts.append((h, p + at))
            at += step
        h, p = (np.concatenate(x) for x in zip(*parts))
        _, first = np.unique(p, return_index=True)
        return [(h[first], p[first])]
    out: list = [None] * n
    if len(raw):
        grams = rolling(raw, k)
        packed = (grams << U(32)) | (U(0xFFFFFFFF) - np.arange(len(raw), dtype=U))
        row = np.repeat(np.arange(n), lengths)
        at = np.arange(len(raw)) - offsets[row]
        if len(raw) >= window:
            low = least(packed, window)
            chosen = low[at + window + k - 1 <= lengths[row]]
            chosen = chosen[np.append(True, chosen[1:] != chosen[:-1])] if len(chosen) else chosen
        else:
            chosen = np.zeros(0, U)
        places = (U(0xFFFFFFFF) - (chosen & U(0xFFFFFFFF))).astype(np.int64)
        hashes = (chosen >> U(32)).astype(np.uint32)
        bounds = np.searchsorted(places, offsets)
    for r in range(n):
        size = int(lengths[r])
        if size == 0:
            out[r] = (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        elif size < k:
            h = int.from_bytes(hashlib.md5(raw[offsets[r] : offsets[r + 1]].tobytes()).digest()[:4], "little")
            out[r] = (np.array([h], np.uint32), np.zeros(1, np.int64))
        elif size < window + k - 1:
            best = int(packed[offsets[r] : offsets[r + 1] - k + 1].min())
            out[r] = (np.array([best >> 32], np.uint32), np.array([0xFFFFFFFF - (best & 0xFFFFFFFF) - int(offsets[r])]))
        else:
            s = slice(bounds[r], bounds[r + 1])
            out[r] = (hashes[s], places[s] - offsets[r])
    return out


def pack(hashes: np.ndarray, places: np.ndarray) -> str:
    """Base64 of 5 bytes an entry: the hash, and the step from the last position, which is at most WINDOW."""
    entries = np.empty(len(hashes), ENTRY)
    entries["hash"], entries["gap"] = hashes, np.diff(places, prepend=0)
    return base64.b64encode(entries.tobytes()).decode()


def unpack(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    entries = np.frombuffer(base64.b64decode(fingerprint), ENTRY)
    return entries["hash"], np.cumsum(entries["gap"].astype(np.int64))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets of hashes; two empty ones are alike."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `fingerprint` (see `pack`), of the whole text; null reads as empty and has the empty fingerprint.

    Equal texts have equal fingerprints; rows stay as they are. A column `fingerprint` of `docs` is replaced.
    """
    docs = docs.drop("fingerprint")

    def run(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
            found = []
            for i, j in slices(offsets):
                found += [pack(*x) for x in winnow(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, "fingerprint"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_batches(docs, run, f"{schema}, fingerprint string")


def edited(text: str, following: str) -> str:
    """`text` with its last third replaced by as much of the start of `following`."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


EDIT_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(rows: list[tuple]) -> pa.RecordBatch:
    """Result rows for all of `rows` but the last, which is only the one that follows."""
    texts = [t for _, t in rows]
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    raw, offsets = text_bytes(pa.array(texts + changed, pa.large_string()))
    marks = winnow(raw, offsets) if len(texts) + len(changed) > 1 and len(raw) <= 4 * SLICE_BYTES else []
    if not marks:
        for i in range(len(offsets) - 1):
            marks += winnow(raw[offsets[i] : offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]]))
    sets = [np.unique(h) for h, _ in marks]
    n = len(texts)
    made = [
        (rows[i][0], len(texts[i]), hashlib.sha256(changed[i].encode()).hexdigest(), pack(*marks[i]), pack(*marks[n + i]), likeness(sets[i], sets[n + i]), likeness(sets[i], sets[i + 1]))
        for i in range(n - 1)
    ]
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    return pa.RecordBatch.from_pydict({x.split()[0]: pa.array([m[k] for m in made], kinds[x.split()[1]]) for k, x in enumerate(EDIT_SCHEMA.split(", "))})


def edit_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form (see `edited`), and how alike they and the next text's are.

    The next document is the one with the next smaller key, after the last the first; null keys are smallest, equal keys
    are ordered by a hash of their text. Documents are dealt to key ranges in one shuffle; the largest one of each range
    goes along to the range above as well (one row per range), so each task meets the follower of its last row.
    A single document follows itself; an empty table gives an empty result; null text reads as empty.
    """
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    ranged, n = in_ranges(source, "doc_id")
    ranged = ranged.withColumn("h", F.xxhash64("text"))
    tops = ranged.groupBy("range_no").agg(F.max(F.struct("doc_id", "h")).alias("top")).orderBy("range_no").collect()
    above = [(r["range_no"], tops[(k + 1) % len(tops)]["range_no"], r["top"]["doc_id"], r["top"]["h"]) for k, r in enumerate(tops)]
    marks = docs.sparkSession.createDataFrame(above, "of int, target int, top_id long, top_h long")
    fits = (F.col("range_no") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("top_id")) & (F.col("h") == F.col("top_h"))
    extra = ranged.join(F.broadcast(marks), fits).select("doc_id", "text", F.col("target").alias("range_no"), "h", F.lit(1).alias("extra"))
    dealt = ranged.withColumn("extra", F.lit(0)).unionByName(extra).repartitionById(n, F.col("range_no"))
    dealt = dealt.sortWithinPartitions("extra", F.col("doc_id").desc_nulls_last(), F.col("h").desc())

    def run(batches):
        held, size, over = [], 0, False
        for batch in batches:
            for doc, t, is_extra in zip(*(c.to_pylist() for c in batch.columns)):
                if over:
                    continue
                held.append((doc, t))
                size += len(t)
                over = bool(is_extra)
                if size > SLICE_BYTES // 2 and len(held) > 1:
                    yield _compare(held)
                    held = held[-1:]
                    size = len(held[0][1])
        if len(held) > 1:
            yield _compare(held)

    return map_batches(dealt.select("doc_id", "text", "extra"), run, EDIT_SCHEMA)
