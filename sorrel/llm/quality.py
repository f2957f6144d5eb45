"""Quality classifier: hashed word and character n-gram vectors, averaged per document, softmax, numpy SGD.

Words, pairs of neighbouring words (a word and itself again is one pair, whatever the word) and runs of 2 to 5 bytes are
hashed into BUCKETS vectors. As the output layer is
linear, the logit of an average of vectors is the average of their logits: the fitted model is one number per bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sorrel.llm.arrays import SLICE_BYTES, SPACES, U, byte_values, class_of, map_batches, slices, text_bytes, word_hashes

BUCKETS, DIMENSIONS, EPOCHS, RATE = 1 << 17, 8, 5, 2.0
#: At most this many labelled rows are learnt from, drawn by a hash of their id.
MAX_ROWS = 4000
THRESHOLD = 0.3
GRAMS = (2, 3, 4, 5)
CASED = byte_values(class_of(*SPACES), fold=False)
SCALE = 1 << 24
SHIFT = U(64 - BUCKETS.bit_length() + 1)


def _fold(h: np.ndarray) -> np.ndarray:
    return (h >> SHIFT).astype(np.int64)


def _byte_grams(raw: np.ndarray):
    """(n, bucket of the n bytes from every position) for each n of GRAMS."""
    code = raw.astype(np.uint32) + np.uint32(1)
    h, done = code, 1
    for n in GRAMS:
        while done < n:
            h = h[:-1] * np.uint32(0x01000193) + code[done:]
            done += 1
        if not len(h):
            return
        mixed = (h ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        mixed ^= mixed >> np.uint32(15)
        yield n, ((mixed * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _word_grams(raw: np.ndarray, offsets: np.ndarray):
    """(buckets of words, bounds per row, buckets of word pairs, bounds per row)."""
    h, bounds = word_hashes(raw, offsets, CASED)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    inside = row[1:] == row[:-1] if len(row) else np.zeros(0, bool)
    pairs = (h[:-1] * U(0x9E3779B97F4A7C15) + h[1:]) * U(0xD6E8FEB86659FD93)
    pairs = np.where(h[:-1] == h[1:], U(0xC2B2AE3D27D4EB4F), pairs)[inside]
    return _fold(h), bounds, _fold(pairs), np.concatenate([[0], np.cumsum(np.maximum(np.diff(bounds) - 1, 0))])


def counted(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, count of each) of one document, in narrow types: the training task holds those of all its rows."""
    raw = np.frombuffer(text, np.uint8)
    words, _, pairs, _ = _word_grams(raw, np.array([0, len(raw)]))
    ids = np.concatenate([words, pairs, *(g for _, g in _byte_grams(raw))])
    found, counts = np.unique(ids, return_counts=True)
    return found.astype(np.int32), counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def shares(counts: np.ndarray) -> np.ndarray:
    return (counts / max(1, counts.sum(dtype=np.int64))).astype(np.float32)


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, share of each) of one document."""
    found, counts = counted(text)
    return found, shares(counts)


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 2) -> tuple[np.ndarray, float]:
    """(logit of label 1 over label 0 per bucket, the same for the bias) from `counted` texts."""
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    total, done = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for k in draw.permutation(len(bags)):
            ids, share = bags[k][0], shares(bags[k][1])
            rate = RATE * (1 - done / total)
            done += 1
            rows = vectors[ids]
            mean = share @ rows
            logits = mean @ output + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[labels[k]] -= 1
            back = output @ error
            output -= rate * np.outer(mean, error)
            bias -= rate * 0.1 * error
            # an average over many n-grams leaves each of them a tiny step; this makes up for part of it
            vectors[ids] = rows - rate * share[:, None] * back * min(len(ids), 1000) ** 0.5
    table = vectors @ output
    return (table[:, 1] - table[:, 0]).astype(np.float32), float(bias[1] - bias[0])


def totals(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sum over the n-grams of `table`, number of n-grams) per row, in whole numbers so that equal texts sum alike."""
    words, w_bounds, pairs, p_bounds = _word_grams(raw, offsets)
    sums, counts = np.zeros(len(offsets) - 1, np.int64), np.diff(w_bounds) + np.diff(p_bounds)
    for ids, bounds in ((words, w_bounds), (pairs, p_bounds)):
        run = np.concatenate([[0], np.cumsum(table[ids])])
        sums += run[bounds[1:]] - run[bounds[:-1]]
    lengths, longest = np.diff(offsets), max(GRAMS)
    for at in range(0, len(raw), 2 * SLICE_BYTES):
        for n, ids in _byte_grams(raw[at : at + 2 * SLICE_BYTES + longest - 1]):
            ids = ids[: 2 * SLICE_BYTES]
            run = np.concatenate([[0], np.cumsum(table[ids])])
            first = np.clip(offsets[:-1] - at, 0, len(ids))
            last = np.clip(np.maximum(offsets[1:] - n + 1, offsets[:-1]) - at, 0, len(ids))
            sums += run[last] - run[first]
    for n in GRAMS:
        counts = counts + np.maximum(lengths - n + 1, 0)
    return sums, counts


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = MAX_ROWS) -> tuple[np.ndarray, float]:
    """Fit on whole texts of at most `max_rows` rows of `labels` (key, label), drawn by a hash of the key.

    The sample bounds what the one training task reads and what is broadcast to find its texts. Labels other than 0 and
    1, null keys and documents without a label are not learnt from; of a repeated key every labelled text counts. With
    no rows the model says 0.5 for every text.
    """
    drawn = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
    drawn = drawn.orderBy(F.md5(F.col("_key").cast("string")), "_key", "_label").limit(max_rows)
    rows = docs.select(F.col(key).alias("doc_key"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(F.broadcast(drawn), F.col("doc_key") == F.col("_key"))
    rows = rows.select(F.md5(F.col("_key").cast("string")).alias("o"), "_label", "t")

    def run(batches):
        bags, marks = [], []
        for batch in batches:
            marks += batch.column(1).to_pylist()
            bags += [counted(t.as_py().encode("utf-8", "surrogatepass")) for t in batch.column(2)]
        if bags:
            table, bias = train(bags, np.array(marks))
            yield pa.RecordBatch.from_pydict({"model": [np.append(table, np.float32(bias)).tobytes()]})

    model = map_batches(rows.repartition(1).sortWithinPartitions("o", "_label", "t"), run, "model binary").collect()
    if not model:
        return np.zeros(BUCKETS, np.float32), 0.0
    numbers = np.frombuffer(model[0]["model"], np.float32)
    return numbers[:-1], float(numbers[-1])


def score(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", name: str = "score") -> DataFrame:
    """`docs` with the probability of label 1 of every whole text; null and empty texts get the bias alone.

    Rows stay as they are and equal texts score alike; a column `name` of `docs` is replaced. The model sent to the
    tasks has BUCKETS numbers, whatever the data.
    """
    docs = docs.drop(name)
    table, bias = np.rint(model[0].astype(np.float64) * SCALE).astype(np.int64), model[1]
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        numbers = shared.value
        for batch in batches:
            raw, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
            sums, counts = np.zeros(len(offsets) - 1, np.int64), np.zeros(len(offsets) - 1, np.int64)
            for i, j in slices(offsets):
                sums[i:j], counts[i:j] = totals(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], numbers)
            logit = sums / SCALE / np.maximum(counts, 1) + bias
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(logit, -500, 500))))], [*batch.schema.names, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_batches(docs, run, f"{schema}, {name} double")


def held_out(key: str):
    """True for rows that no model may learn from: crc32 of the key as text, modulo 5, is 0; a null key counts as 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(True))
