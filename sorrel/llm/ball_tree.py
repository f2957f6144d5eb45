"""Exact ranked lexical search: documents as sparse vectors in ball trees, pruned by centroid and radius.

A document's coordinate for a term is weight x saturated frequency (integers), a query's is how often it has the term,
and the score is their inner product. For a ball with centroid c and radius r no document scores above q.c + |q| r, so
subtrees are visited best bound first and left when the bound falls below the k-th score found. Bounds are rounded up by
more than their error; scores are exact 64-bit integers, computed at the leaves only.

Queries go in blocks of bounded size, which are sent to the tasks. A document is projected on the terms of the block,
which leaves every inner product as it is; the texts are read once per block. A task builds one tree after another, each
over a bounded number of documents, and keeps k documents per query from tree to tree.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sorrel.llm.arrays import byte_values, class_of, map_batches, slices, text_bytes, word_hashes
from sorrel.llm.rows import with_row_number, written

#: a term is a run of bytes other than these; only A-Z are lower-cased
TERM = byte_values(class_of(range(0x00, 0x30), range(0x3A, 0x41), range(0x5B, 0x61), range(0x7B, 0x80)), fold=True)
ITEM_BYTES = 1 << 17
TREE_ROWS, TREE_ENTRIES, LEAF_ROWS = 4096, 1 << 20, 32
SALTS = 64
TOP = 10


class Queries:
    """A block of queries over their own vocabulary: sorted term hashes, and (column, multiplicity) lists per query."""

    def __init__(self, texts: list[str | None]):
        raw, offsets = text_bytes(pa.array(texts, pa.string()))
        words, bounds = word_hashes(raw, offsets, TERM)
        self.terms = np.unique(words)
        at = np.searchsorted(self.terms, words)
        parts = [np.unique(at[i:j], return_counts=True) for i, j in zip(bounds, bounds[1:])]
        self.columns = [p[0] for p in parts]
        self.times = [p[1].astype(np.int64) for p in parts]
        self.norms = np.array([math.sqrt(float((t * t).sum())) for t in self.times])
        self.starts = np.cumsum([0, *(len(c) for c in self.columns)])
        self.all_columns = np.concatenate([*self.columns, np.zeros(0, np.int64)]).astype(np.int64)
        self.all_times = np.concatenate([*self.times, np.zeros(0, np.int64)]).astype(np.float64)

    def products(self, dense: np.ndarray) -> np.ndarray:
        """Inner product of one vector over the vocabulary with every query."""
        sums = np.concatenate([[0.0], np.cumsum(dense[self.all_columns] * self.all_times)])
        return sums[self.starts[1:]] - sums[self.starts[:-1]]


def project(docs: DataFrame, terms: np.ndarray, text: str, key: str) -> DataFrame:
    """(key, n, columns, counts) per document: its number of terms, and those of the vocabulary with their counts."""

    def run(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            for i, j in slices(offsets):
                words, bounds = word_hashes(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], TERM)
                at = np.searchsorted(terms, words)
                known = at < len(terms)
                known[known] = terms[at[known]] == words[known]
                row = np.repeat(np.arange(j - i), np.diff(bounds))[known]
                cells, counts = np.unique(row * (len(terms) + 1) + at[known], return_counts=True)
                cuts = np.searchsorted(cells, np.arange(j - i + 1) * (len(terms) + 1))
                columns, counts = (cells % (len(terms) + 1)).astype("<i4"), counts.astype("<i4")
                pieces = [[a[x:y].tobytes() for x, y in zip(cuts, cuts[1:])] for a in (columns, counts)]
                arrays = [batch.column(0).slice(i, j - i), pa.array(np.diff(bounds), pa.int64()), *(pa.array(p, pa.binary()) for p in pieces)]
                yield pa.RecordBatch.from_arrays(arrays, ["k", "n", "cols", "counts"])

    source = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    kind = source.schema["k"].dataType.simpleString()
    return map_batches(source, run, f"k {kind}, n long, cols binary, counts binary")


def document_frequencies(projected: DataFrame, width: int) -> np.ndarray:
    """Documents per term of the vocabulary: one count array per task, summed by a shuffle of `width` rows a task."""

    def run(batches):
        seen = np.zeros(width, np.int64)
        for batch in batches:
            for cols in batch.column(0):
                seen[np.frombuffer(cols.as_buffer(), "<i4")] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(seen[at])], ["col", "df"])

    out = np.zeros(width, np.int64)
    for r in map_batches(projected.select("cols"), run, "col long, df long").groupBy("col").agg(F.sum("df").alias("df")).toLocalIterator():
        out[r["col"]] = r["df"]
    return out


class Rows:
    """Sparse integer vectors of some documents, one after another; `norms` are squared lengths."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, cols: np.ndarray, values: np.ndarray, norms: np.ndarray | None = None):
        self.ids, self.starts, self.cols, self.values = ids, starts, cols, values
        self.norms = self.sums(values.astype(np.float64) ** 2) if norms is None else norms

    def sums(self, entries: np.ndarray) -> np.ndarray:
        """Sums of an array over the entries, by document. Documents without entries have none in `reduceat`."""
        out = np.zeros(len(self.ids), entries.dtype)
        full = self.starts[1:] > self.starts[:-1]
        if full.any():
            out[full] = np.add.reduceat(entries, self.starts[:-1][full])
        return out

    def times(self, dense: np.ndarray) -> np.ndarray:
        return self.sums(dense[self.cols] * self.values)

    def dense(self, i: int, width: int) -> np.ndarray:
        out = np.zeros(width)
        out[self.cols[self.starts[i] : self.starts[i + 1]]] = self.values[self.starts[i] : self.starts[i + 1]]
        return out

    def take(self, rows: np.ndarray) -> Rows:
        lengths = (self.starts[1:] - self.starts[:-1])[rows]
        starts = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(self.starts[:-1][rows] - starts[:-1], lengths) + np.arange(starts[-1])
        return Rows(self.ids[rows], starts, self.cols[at], self.values[at], self.norms[rows])


class BallTree:
    """Nodes as lists: bounds of every query, children, and the rows of leaves.

    A node is cut at the median of the line through the document farthest from the centroid and the one farthest from
    that, so a tree is balanced also where all documents are equal.
    """

    def __init__(self, rows: Rows, width: int, queries: Queries):
        self.bounds, self.children, self.leaves = [], [], []
        self.width, self.queries = width, queries
        self._add(rows)

    def _add(self, rows: Rows) -> int:
        me, n = len(self.bounds), len(rows.ids)
        centre = np.bincount(rows.cols, rows.values.astype(np.float64), self.width) / n
        length = float(centre @ centre)
        apart = rows.norms - 2.0 * rows.times(centre) + length
        # the three terms cancel: their rounding, below 1e-10 of their sizes, goes on top of the radius
        radius = math.sqrt(max(float(apart.max()), 0.0) + 1e-10 * (float(rows.norms.max()) + length))
        bound = self.queries.products(centre) + self.queries.norms * radius
        # the sums behind `products` run over all queries, so their error is one of the whole sum
        self.bounds.append(bound * (1 + 1e-9) + 1e-10 * length**0.5 * float(self.queries.norms.sum()) + 1.0)
        self.children.append(None)
        self.leaves.append(rows if n <= LEAF_ROWS else None)
        if n > LEAF_ROWS:
            one = rows.dense(int(apart.argmax()), self.width)
            far = rows.norms - 2.0 * rows.times(one) + float(one @ one)
            other = rows.dense(int(far.argmax()), self.width)
            order = np.argsort(rows.times(one - other), kind="stable")
            # set after the calls: both add nodes
            self.children[me] = (self._add(rows.take(order[: n // 2])), self._add(rows.take(order[n // 2 :])))
        return me

    def search(self, q: int, k: int, best: list, keys: list) -> int:
        """Merge documents for query `q` into `best`, k sorted entries (-score, key order, key); count the scored ones."""
        dense = np.zeros(self.width, np.int64)
        dense[self.queries.columns[q]] = self.queries.times[q]
        open_nodes, scored = [(-float(self.bounds[0][q]), 0)], 0
        while open_nodes:
            bound, node = heapq.heappop(open_nodes)
            if len(best) == k and bound > best[-1][0]:
                break
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(open_nodes, (max(bound, -float(self.bounds[child][q])), child))
                continue
            rows = self.leaves[node]
            scores = rows.times(dense)
            scored += len(scores)
            least = -best[-1][0] if len(best) == k else 1
            for i in np.flatnonzero(scores >= max(least, 1)):
                key = keys[rows.ids[i]]
                best.append((-int(scores[i]), key is not None, key))
            best.sort(key=lambda e: e if e[1] else (e[0], False))
            del best[k:]
        return scored


def saturated(counts: np.ndarray, n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 8 m) with m = 25 + (75 n N) div L, for counts tf in documents of n terms."""
    m = 25 + (75 * n * n_docs) // max(total, 1)
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


def _search_tasks(projected: DataFrame, queries: Queries, weights: np.ndarray, n_docs: int, total: int, k: int, kind: str) -> DataFrame:
    """(query, score, key): the k best documents of every task, by trees."""
    sent = projected.sparkSession.sparkContext.broadcast((queries, weights))

    def trees(held):
        """Rows of Spark's batches as vectors with their keys."""
        keys = [x for b in held for x in b.column(0).to_pylist()]
        n = np.concatenate([b.column(1).to_numpy() for b in held])
        cols, counts = ([np.frombuffer(x.as_buffer(), "<i4") for b in held for x in b.column(c)] for c in (2, 3))
        lengths = np.array([len(c) for c in cols])
        cols, counts = (np.concatenate(x).astype(np.int64) for x in (cols, counts))
        values = sent.value[1][cols] * saturated(counts, np.repeat(n, lengths), n_docs, total)
        return keys, Rows(np.arange(len(keys)), np.concatenate([[0], np.cumsum(lengths)]), cols, values)

    def run(batches):
        queries, weights = sent.value
        best = [[] for _ in queries.columns]
        held, size, entries = [], 0, 0

        def flush():
            keys, rows = trees(held)
            tree = BallTree(rows, len(weights), queries)
            for q in range(len(best)):
                tree.search(q, k, best[q], keys)

        for batch in batches:
            # documents without a term of the block cannot score; the others are all indexed
            batch = batch.filter(pc.greater(pc.binary_length(batch.column(2)), 0))
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
                entries += pc.sum(pc.binary_length(batch.column(2))).as_py() // 4
            if size >= TREE_ROWS or entries >= TREE_ENTRIES:
                flush()
                held, size, entries = [], 0, 0
        if held:
            flush()
        out = [(q, -e[0], e[2]) for q, found in enumerate(best) for e in found]
        columns = [pa.array([o[c] for o in out], t) for c, t in ((0, pa.int64()), (1, pa.int64()), (2, schema_key))]
        yield pa.RecordBatch.from_arrays(columns, ["q", "score", "k"])

    from pyspark.sql.pandas.types import to_arrow_type

    schema_key = to_arrow_type(projected.schema["k"].dataType)
    return map_batches(projected, run, f"q long, score long, k {kind}")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best rows per query with their rank; first among a fixed number of salts, as each task brings k."""
    order = [F.col("score").desc(), F.col("k").asc_nulls_first()]
    salted = found.withColumn("salt", F.spark_partition_id() % SALTS)
    few = salted.withColumn("rank", F.row_number().over(W.partitionBy("q", "salt").orderBy(*order))).where(F.col("rank") <= k).drop("rank", "salt")
    return few.withColumn("rank", F.row_number().over(W.partitionBy("q").orderBy(*order))).where(F.col("rank") <= k)


def _blocks(items: DataFrame, text: str, limit: int) -> DataFrame:
    """`items` with a block number so that blocks have about `limit` bytes; an item is never cut."""
    total = items.agg(F.sum(F.octet_length(F.coalesce(F.col(text).cast("string"), F.lit(""))) + 1)).first()[0] or 0
    return items.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(max(1, -(-2 * total // limit) if total > limit else 1))))


def search(
    docs: DataFrame, items: DataFrame, k: int = TOP, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id", item_bytes: int = ITEM_BYTES
) -> DataFrame:
    """(item_id, rank, doc_id, score), named by the key columns: the k best documents of every item with a score above 0.

    Terms, weights and scores are those of `saturated` and `weights_of`. Equal scores rank by ascending key, a null key
    first. Rows of `items` are searched one by one, also where they are equal; equal documents each count and rank. Null
    and empty texts have no terms: such items find nothing, such documents are not found. Other columns are not looked at.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    numbered = _blocks(with_row_number(items.select(F.col(item_key).alias("item"), F.col(item_text).cast("string").alias("t")), "items"), "t", item_bytes)
    found = None
    for (block,) in sorted(tuple(r) for r in numbered.select("block").distinct().collect()):
        part = numbered.where(F.col("block") == block).select("uid", "t").orderBy("uid").collect()
        queries = Queries([r["t"] for r in part])
        if not len(queries.terms):
            continue
        projected = written(project(docs, queries.terms, text, key), "projected")
        n_docs, total = projected.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = weights_of(document_frequencies(projected, len(queries.terms)), n_docs)
        best = _best(_search_tasks(projected, queries, weights, n_docs, total, k, kind), k)
        uids = spark.createDataFrame([(q, r["uid"]) for q, r in enumerate(part)], StructType([StructField("q", LongType()), StructField("uid", LongType())]))
        best = written(best.join(uids, "q").select("uid", "rank", "k", "score"), "found")
        found = best if found is None else found.unionByName(best)
    named = [F.col("item").alias(item_key), "rank", F.col("k").alias(key), "score"]
    if found is None:
        empty = f"uid long, rank int, k {kind}, score long"
        found = spark.createDataFrame([], empty)
    return numbered.join(found, "uid").select(*named)


def weights_of(df: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) per term."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)

