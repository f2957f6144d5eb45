"""Token ids as one concatenated array per shard, with Elias-Fano coded document boundaries.

The files are Parquet tables of blocks, so any file system that Spark writes will do and a lost task is simply repeated.
A block holds whole documents: `ids` (little-endian, 2 or 4 bytes each), and the ends and the document ids as two
Elias-Fano sequences of about 2 + log2(universe / n) bits an entry, with samples for select.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from sorrel.llm.arrays import map_batches
from sorrel.llm.rows import in_ranges
from sorrel.llm.token_counts import TokenCounter, compiled

BLOCK_IDS = 1 << 16
SAMPLE = 64
BLOCK_SCHEMA = "shard int, block int, first long, n_docs long, n_null long, n_ids long, width int, lowest long, places binary, doc_ids binary, ends binary, ids binary"


class EliasFano:
    """A sorted sequence of integers from 0: low bits packed, high bits in unary, every SAMPLE-th one's place kept."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        if not n:
            return cls(0, 0, b"", b"", np.zeros(0, np.uint32))
        width = max(0, (int(v[-1]) // n).bit_length() - 1)
        shifts = np.arange(width, dtype=np.uint64)
        low = np.packbits(((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        places = (v >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1, np.uint8)
        bits[places] = 1
        return cls(n, width, low.tobytes(), np.packbits(bits, bitorder="little").tobytes(), places[::SAMPLE].astype(np.uint32))

    def _low(self, i: int, j: int) -> np.ndarray:
        """Low bits of entries i to j."""
        w = self.low_bits
        if not w:
            return np.zeros(j - i, np.uint64)
        first = i * w // 8
        raw = np.frombuffer(self.low, np.uint8)[first : (j * w + 7) // 8]
        bits = np.unpackbits(raw, bitorder="little")[i * w - 8 * first :][: (j - i) * w].reshape(j - i, w)
        return (bits.astype(np.uint64) << np.arange(w, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """The i-th value, from 0: a look at one sample and the bits up to the next."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self.samples[i // SAMPLE])
        left, byte = i % SAMPLE, at // 8
        skip = at - 8 * byte
        end = len(self.high) if i // SAMPLE + 1 >= len(self.samples) else int(self.samples[i // SAMPLE + 1]) // 8 + 1
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8)[byte:end], bitorder="little")[skip:]
        place = at + int(np.flatnonzero(bits)[left])
        return ((place - i) << self.low_bits) | int(self._low(i, i + 1)[0])

    def values(self) -> np.ndarray:
        if not self.n:
            return np.zeros(0, np.uint64)
        places = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[: self.n]
        return ((places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(0, self.n)

    def dump(self) -> bytes:
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high)], "<u8").tobytes()
        return head + self.low + self.high + self.samples.astype("<u4").tobytes()

    @classmethod
    def load(cls, data: bytes) -> EliasFano:
        n, width, low, high = (int(x) for x in np.frombuffer(data, "<u8", 4))
        return cls(n, width, data[32 : 32 + low], data[32 + low : 32 + low + high], np.frombuffer(data, "<u4", offset=32 + low + high))


def tokenize(ranged: DataFrame, tokenizer: str, end_id: int, text: str, key: str, width: int, order: str | None = None) -> DataFrame:
    """(doc_id, range_no, ids, place): the ids of every whole text as bytes, with the end id; null text has the end id only.

    The ids are read off the transducers that are compiled from the tokenizer file (`token_counts`).
    """
    dtype = f"<u{width}"
    tail = np.array([end_id], dtype).tobytes()
    sent = ranged.sparkSession.sparkContext.broadcast(compiled(tokenizer))

    def run(batches):
        counter = TokenCounter.get(sent)
        for batch in batches:
            parts = [[] for _ in range(batch.num_rows)]
            for rows, sections, after in counter.batches(batch.column(2)):
                ids, counts = counter.encode(sections)
                raw, ends = ids.astype(dtype).tobytes(), np.cumsum(counts) * width
                for r, i, j, special in zip(rows, ends - counts * width, ends, after):
                    parts[r].append(raw[i:j])
                    if special >= 0:
                        parts[r].append(np.array([special], dtype).tobytes())
            ids = pa.array([b"".join(p) + tail for p in parts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ids, batch.column(3)], ["doc_id", "range_no", "ids", "place"])

    place = F.col(order or key).cast("double" if order else "long").alias("place")
    source = ranged.select(F.col(key).cast("long").alias("doc_id"), "range_no", F.col(text).cast("string").alias("t"), place)
    return map_batches(source, run, f"doc_id long, range_no int, ids binary, place {source.schema['place'].dataType.simpleString()}", keeps="tokens")


def block_of(shard: int, number: int, first: int, docs: list, width: int) -> dict:
    """A block of documents in their order. Its document ids are kept sorted, with the place of each where they are not."""
    known = [k for k, (d, _) in enumerate(docs) if d is not None]
    known.sort(key=lambda k: docs[k][0])
    ids = [docs[k][0] for k in known]
    ends = np.cumsum([len(b) // width for _, b in docs])
    lowest = ids[0] if ids else 0
    nulls_first = [k for k, (d, _) in enumerate(docs) if d is None] + known
    places = b"" if nulls_first == list(range(len(docs))) else np.array(nulls_first, "<u4").tobytes()
    return {
        "shard": shard, "block": number, "first": first, "n_docs": len(docs), "n_null": len(docs) - len(ids),
        "n_ids": int(ends[-1]), "width": width, "lowest": lowest, "places": places,
        "doc_ids": EliasFano.of([d - lowest for d in ids]).dump(), "ends": EliasFano.of(ends).dump(), "ids": b"".join(b for _, b in docs),
    }


def write(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, text: str = "text", key: str = "doc_id", width: int = 2, block_ids: int = BLOCK_IDS, order: str | None = None
) -> None:
    """Write the ids of all documents under `path`, in ascending order of `key`, one shard per key range.

    With `order`, a number column, documents lie in ascending order of that instead, and of `key` where it is equal.
    Nulls come first, equal rows follow each other in the order of their ids' bytes. `width` is bytes an id: 2 needs
    a vocabulary of at most 65,536. The texts become ids before they are shuffled, which moves fewer bytes.
    """
    ranged, n = in_ranges(docs.select(*dict.fromkeys([key, text, order or key])), order or key)
    coded = tokenize(ranged, tokenizer, end_id, text, key, width, order)
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in BLOCK_SCHEMA.split(", "))])

    def run(batches):
        shard, number, first, held, size = 0, 0, 0, [], 0
        for batch in batches:
            for doc, at, ids in zip(*(c.to_pylist() for c in batch.columns[:3])):
                shard = at
                held.append((doc, ids))
                size += len(ids) // width
                if size >= block_ids:
                    yield pa.RecordBatch.from_pylist([block_of(shard, number, first, held, width)], schema)
                    number, first, held, size = number + 1, first + size, [], 0
        if held:
            yield pa.RecordBatch.from_pylist([block_of(shard, number, first, held, width)], schema)

    ordered = coded.repartitionById(n, F.col("range_no")).sortWithinPartitions(F.col("place").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), "ids")
    map_batches(ordered, run, BLOCK_SCHEMA).write.option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files; start counts the ids of all before it.

    A shard's first id follows from the totals of the shards before it: a sum over one row per shard, of which there is
    at most one per write task, and which is sent to the tasks.
    """
    blocks = spark.read.parquet(path)
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    base = totals.select(F.col("shard").alias("of"), F.coalesce(before, F.lit(0)).alias("base"))
    placed = blocks.join(F.broadcast(base), F.col("shard") == F.col("of"))

    def run(batches):
        for batch in batches:
            for b in batch.to_pylist():
                ends = EliasFano.load(b["ends"]).values().astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                ids = np.frombuffer(b["ids"], f"<u{b['width']}").astype("<u4")
                docs = [None] * b["n_null"] + [int(d) + b["lowest"] for d in EliasFano.load(b["doc_ids"]).values()]
                if b["places"]:
                    docs = [docs[k] for k in np.argsort(np.frombuffer(b["places"], "<u4"))]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(docs, pa.int64()),
                        "start": starts + b["base"] + b["first"],
                        "n_tokens": ends - starts,
                        "ids_crc32": pa.array([zlib.crc32(ids[i:j].tobytes()) for i, j in zip(starts, ends)], pa.int64()),
                    }
                )

    cols = ["first", "n_null", "width", "lowest", "places", "doc_ids", "ends", "ids", "base"]
    return map_batches(placed.select(*cols), run, "doc_id long, start long, n_tokens long, ids_crc32 long")
