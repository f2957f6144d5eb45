"""N-gram Jaccard self-join by vertical partitioning.

All n-grams have one global order: rare ones first, by a table of counts with a fixed number of cells, then by hash. In
that order two sets that are alike enough share one of their first few n-grams. Nodes that share one meet there, in
groups cut into blocks of bounded size; a parity bitmap bounds how much two sets can differ, and nodes that may be linked
become one cluster. Each sends its set to its cluster, again in blocks, where the sets are cut along the global order into
fragments of FRAGMENT n-grams; the overlaps of pairs are counted fragment by fragment and summed.
Documents with equal sets are one node throughout, and pairs stay inside their block: what comes out is one row per node
and block, with the number of linked documents and one node of those it is linked with.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from sorrel.llm.arrays import SPACED, U, map_batches, shingles, slices, text_bytes, word_hashes
from sorrel.llm.graph import components
from sorrel.llm.rows import plain_names, written

CELLS_BITS, BLOCKS, FRAGMENT = 23, 64, 1024
#: A set's bitmap has a place per n-gram at least, between these: a narrow one is full and tells large sets apart no more.
NARROW, WIDE = 512, 4096
TOP, HELD = (1 << 16) - 1, 1 << 20
#: Nodes, and n-grams of all their sets, that one block of a group may hold; a pair of blocks meets in one task.
BLOCK_NODES, BLOCK_GRAMS = 1024, 2_000_000
#: Earlier shared n-grams a node shows where it meets others, and bits of the filter for the texts that are read again.
EARLIER, FILTER_BITS = 4, 1 << 24
#: Contexts without a rule of their own take five words and 80 %.
SIZE, PERCENT = 5, 80


def _sets(batch: pa.RecordBatch, column: int, size: int):
    """The distinct shingle hashes, sorted, of every row."""
    raw, offsets = text_bytes(batch.column(column))
    for i, j in slices(offsets):
        words, bounds = word_hashes(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], SPACED)
        grams, ends = shingles(words, bounds, size)
        for r in range(j - i):
            yield np.unique(grams[ends[r] : ends[r + 1]])


def gram_counts(docs: DataFrame, text: str, size: int) -> np.ndarray:
    """How often n-grams of each of 2^CELLS_BITS hash cells occur, over all documents.

    Any order of n-grams gives right results, so cells may hold several and stop at TOP; the table has the same size for
    any corpus. Tasks send BLOCKS partial sums each, which are added up block by block; there are two tasks a core at
    most, as each has a table.
    """
    cells, width = 1 << CELLS_BITS, (1 << CELLS_BITS) // BLOCKS

    def count(batches):
        total, held = np.zeros(cells, np.uint32), []
        for batch in batches:
            raw, offsets = text_bytes(batch.column(0))
            for i, j in slices(offsets):
                words, bounds = word_hashes(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], SPACED)
                held.append((shingles(words, bounds, size)[0] >> U(64 - CELLS_BITS)).astype(np.int32))
                if sum(map(len, held)) > HELD:
                    found, times = np.unique(np.concatenate(held), return_counts=True)
                    total[found] += times.astype(np.uint32)
                    held = []
        if held:
            found, times = np.unique(np.concatenate(held), return_counts=True)
            total[found] += times.astype(np.uint32)
        if total.any():
            parts = np.minimum(total, TOP).astype("<u2").reshape(BLOCKS, width)
            yield pa.RecordBatch.from_pydict({"block": pa.array(range(BLOCKS), pa.int32()), "sums": [p.tobytes() for p in parts]})

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(*(c.to_pylist() for c in batch.columns)):
                sums[block] = np.minimum(sums.get(block, 0) + np.frombuffer(part, "<u2").astype(np.uint32), TOP)
        if sums:
            parts = [s.astype("<u2").tobytes() for s in sums.values()]
            yield pa.RecordBatch.from_pydict({"block": pa.array(list(sums), pa.int32()), "sums": parts})

    few = docs.select(text).coalesce(2 * docs.sparkSession.sparkContext.defaultParallelism)
    parts = map_batches(few, count, "block int, sums binary")
    out = np.zeros((BLOCKS, width), np.uint16)
    for row in map_batches(parts.repartitionById(BLOCKS, F.col("block")), add, "block int, sums binary").collect():
        out[row["block"]] = np.frombuffer(row["sums"], "<u2")
    return out.ravel()


def least_overlap(n: np.ndarray | int, percent: int):
    """The fewest shared n-grams that a set of n needs with any set it is linked to."""
    return -(-n * percent // 100)


def set_hash(grams: np.ndarray) -> list[int]:
    """Two 64-bit hashes of a set."""
    return np.frombuffer(hashlib.blake2b(grams.tobytes(), digest_size=16).digest(), np.int64).tolist()


def bitmap(grams: np.ndarray) -> bytes:
    """Parity of the n-grams in each place. Half as wide a one is the exclusive or of its halves."""
    width = NARROW
    while width < min(len(grams), WIDE):
        width *= 2
    odd = np.bincount((grams & U(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(bits: bytes, width: int) -> bytes:
    """The bitmap at half its width, if it is not that narrow already."""
    if 8 * len(bits) == width:
        return bits
    both = np.frombuffer(bits, np.uint64)
    return (both[: len(both) // 2] ^ both[len(both) // 2 :]).tobytes()


def rank(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return counts[(grams >> U(64 - CELLS_BITS)).astype(np.int64)]


def described(docs: DataFrame, text: str, size: int, percent: int, counts: np.ndarray, keep: list[str]) -> DataFrame:
    """`keep` columns with n, two hashes of the set, its parity bitmap and its first n-grams in the global order.

    Sets of n and m >= n share o >= percent * m / 100 n-grams when linked, so the first n - o + 1 of each must meet.
    """
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def run(batches):
        table = shared.value
        for batch in batches:
            rows = []
            for grams in _sets(batch, len(keep), size):
                n = len(grams)
                length = n - int(least_overlap(n, percent)) + 1 if n else 0
                near, ranks = np.arange(n), rank(grams, table)
                if length < n:
                    near = np.flatnonzero(ranks <= np.partition(ranks, length - 1)[length - 1])
                near = near[np.lexsort((grams[near], ranks[near]))[:length]]
                rows.append((n, *set_hash(grams), bitmap(grams), grams[near].view(np.int64)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
            cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *cols], [*batch.schema.names[: len(keep)], "n", "h1", "h2", "bits", "first"])

    return map_batches(docs.select(*keep, text), run, f"{schema}, n long, h1 long, h2 long, bits binary, first array<bigint>")


def by_cell(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """(cell, rows) of rows that are sorted by their first `width` columns."""
    cell, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:width] != cell:
                if rows:
                    yield cell, rows
                cell, rows = row[:width], []
            rows.append(row[width:])
    if rows:
        yield cell, rows


def meetings(nodes: DataFrame) -> DataFrame:
    """(gram, low, high, block, node, earlier, n, bits): nodes that share one of their first n-grams, by cell.

    N-grams of a single node go first. A group beyond a block is dealt to blocks by hash, and block i and block j meet in
    the cell (i, j), so a group of any size is spread. `earlier` are the shared n-grams just before this one.
    """
    grams = nodes.select("node", "n", F.posexplode("first").alias("place", "gram"))
    group = W.partitionBy("gram")
    shared = grams.withColumns({"many": F.count(F.lit(1)).over(group), "weight": F.sum("n").over(group)}).where("many > 1")
    blocks = F.expr(f"cast(greatest(ceil(many / {BLOCK_NODES}), ceil(weight / {BLOCK_GRAMS})) as int)")
    shared = shared.withColumn("blocks", F.least(blocks, F.col("many").cast("int")))
    earlier = F.collect_list("gram").over(W.partitionBy("node").orderBy("place").rowsBetween(-EARLIER, -1))
    shared = shared.select("node", "gram", earlier.alias("earlier"), "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    full = shared.join(nodes.select("node", "n", "bits"), "node")
    full = full.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return full.select("gram", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "earlier", "n", "bits")


def may_link(meeting: DataFrame, percent: int) -> DataFrame:
    """(node, least) of the nodes that have a possible partner in a cell: the least node reached over such partners there.

    Two nodes may be linked if their sizes allow it and their bitmaps, which differ in no more places than their sets do.
    Where they share one of the n-grams before as well, they have met there.
    """

    def run(batches):
        made: list[tuple] = []
        for cell, rows in by_cell(batches, 3):
            m = len(rows)
            n = np.array([r[3] for r in rows], np.int64)
            # places without an n-gram before get a number of their own each, so nothing equals them
            seen: dict = {}
            before = np.array([[seen.setdefault(r[2][e] if e < len(r[2]) else (k, e), len(seen)) for e in range(EARLIER)] for k, r in enumerate(rows)])
            block = np.array([r[0] for r in rows])
            nodes, label = np.array([r[1] for r in rows], np.int64), np.arange(m)
            widths = np.array([8 * len(r[4]) for r in rows])
            # sets that may be linked are of a like size, so their widths are equal or neighbours
            for width in sorted(set(widths.tolist())):
                among = np.flatnonzero((widths == width) | (widths == 2 * width))
                table = np.frombuffer(b"".join(folded(rows[k][4], width) for k in among), np.uint64).reshape(len(among), -1)
                own = np.flatnonzero(widths[among] == width)
                step = max(1, (1 << 21) // table.size)
                for at in range(0, len(own), step):
                    part = own[at : at + step]
                    one, two = among[part][:, None], among[None, :]
                    apart = np.bitwise_count(table[part, None, :] ^ table[None, :, :]).sum(axis=2, dtype=np.int64)
                    small, large = np.minimum(n[one], n[two]), np.maximum(n[one], n[two])
                    fits = (100 * small >= percent * large) & ((100 + percent) * apart <= (100 - percent) * (small + large))
                    for e in range(EARLIER * EARLIER):
                        fits &= before[one, e // EARLIER] != before[two, e % EARLIER]
                    fits &= one != two
                    if cell[1] != cell[2]:
                        fits &= block[one] != block[two]
                    for k in np.flatnonzero(fits.any(axis=1)):
                        joined = np.append(label[among[np.flatnonzero(fits[k])]], label[one[k, 0]])
                        label[np.isin(label, joined)] = joined.min()
            # a label is the least place of its component; its node stands for it
            sizes = np.bincount(label, minlength=m)
            made += [(int(nodes[k]), int(nodes[label[k]])) for k in np.flatnonzero(sizes[label] > 1)]
            if len(made) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made)], ["node", "least"])
                made = []
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made)], ["node", "least"])

    dealt = meeting.repartition("gram", "low", "high").sortWithinPartitions("gram", "low", "high")
    return map_batches(dealt, run, "node long, least long")


def in_cells(clusters: DataFrame) -> DataFrame:
    """(cluster, low, high, block, node, ...): clusters cut into blocks as groups are in `meetings`."""
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("many"), F.sum("n").alias("weight"))
    blocks = F.expr(f"cast(least(many, greatest(ceil(many / {BLOCK_NODES}), ceil(weight / {BLOCK_GRAMS}))) as int)")
    placed = clusters.join(sizes.select("cluster", blocks.alias("blocks")), "cluster")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return placed.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("blocks", "other", "n")


CELL = ["cluster", "low", "high"]


def overlaps(sets: list[np.ndarray], counts: np.ndarray) -> np.ndarray:
    """How many n-grams every two sets share, counted fragment by fragment of the global order."""
    m = len(sets)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(m), [len(s) for s in sets])
    values, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    several = np.flatnonzero(times > 1)
    several = several[np.lexsort((values[several], rank(values[several], counts)))]
    place = np.full(len(values), -1)
    place[several] = np.arange(len(several))
    kept = place[column] >= 0
    owner, place = owner[kept], place[column][kept]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    total = np.zeros((m, m), np.float32)
    for first in range(0, len(several), FRAGMENT):
        last = min(first + FRAGMENT, len(several))
        i, j = np.searchsorted(place, (first, last))
        fragment = np.zeros((m, last - first), np.float32)
        fragment[owner[i:j], place[i:j] - first] = 1
        total += fragment @ fragment.T
    return total


def linked(members: DataFrame, percent: int, counts: np.ndarray) -> DataFrame:
    """(node, least, near) per node with links in a cell: the least node it can reach there, and how many documents the
    nodes have to which it is linked there. Every two nodes of a cluster meet in one cell."""
    shared = members.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        table = shared.value
        made: list[tuple] = []
        for cell, rows in by_cell(batches, 3):
            # a node comes twice if its row stands twice in the input
            rows = sorted({r[1]: r for r in rows}.values(), key=lambda r: r[1])
            m = len(rows)
            if m > 1:
                sets = [np.frombuffer(r[3], U) for r in rows]
                n = np.array([len(s) for s in sets], np.float64)
                total = overlaps(sets, table)
                link = (100 + percent) * total.astype(np.float64) >= percent * (n[:, None] + n[None, :])
                np.fill_diagonal(link, False)
                if cell[1] != cell[2]:
                    block = np.array([r[0] for r in rows])
                    link &= block[:, None] != block[None, :]
                label = np.arange(m)
                while True:
                    low = np.minimum(label, np.where(link, label[None, :], m).min(axis=1))
                    low = low[low]
                    if (low == label).all():
                        break
                    label = low
                near = link @ np.array([r[2] for r in rows], np.int64)
                made += [(rows[k][1], rows[label[k]][1], int(near[k])) for k in np.flatnonzero(near)]
            if len(made) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made)], ["node", "least", "near"])
                made = []
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made)], ["node", "least", "near"])

    dealt = members.select(*CELL, "block", "node", "copies", "grams").repartition(*CELL).sortWithinPartitions(*CELL)
    return map_batches(dealt, run, "node long, least long, near long")


def sized(docs: DataFrame, text: str, size: int) -> DataFrame:
    """(key, n, h1, h2) of every row: the size of its set and the set's hash."""

    def run(batches):
        for batch in batches:
            rows = [(len(g), *set_hash(g)) for g in _sets(batch, 1, size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3))], ["key", "n", "h1", "h2"])

    kind = docs.select("key").schema[0].dataType.simpleString()
    return map_batches(docs.select("key", text), run, f"key {kind}, n long, h1 long, h2 long")


def sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(key, h1, h2, grams) of the rows of `docs` (key, text) whose key is in `wanted` (least), and of a few more.

    The keys are told apart by a filter of FILTER_BITS bits, whatever their number, so that texts nobody asks for are not
    shuffled; the join on the key and the set's hash that follows is exact.
    """
    place = F.pmod(F.xxhash64("least"), F.lit(FILTER_BITS))
    words = wanted.groupBy((place / 64).cast("int").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(least), {FILTER_BITS}) % 64 as int))")).alias("bits"))
    table = np.zeros(FILTER_BITS // 64, np.int64)
    for row in words.collect():
        table[row["word"]] = row["bits"]
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        bits = shared.value.view(U)
        for batch in batches:
            at = batch.column(2).to_numpy()
            batch = batch.filter(pa.array((bits[at >> 6] >> (at & 63).astype(U)) & U(1) == 1))
            rows = [(*set_hash(g), g.tobytes()) for g in _sets(batch, 1, size)]
            cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["key", "h1", "h2", "grams"])

    kind = docs.select("key").schema[0].dataType.simpleString()
    source = docs.select("key", "text", F.pmod(F.xxhash64("key"), F.lit(FILTER_BITS)).alias("at"))
    return map_batches(source, run, f"key {kind}, h1 long, h2 long, grams binary")


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, nodes, ends): which documents have which shingle set, and with what the sets are linked.

    documents: one row per row of `docs` with its key, `n_shingles`, h1, h2 (the set's hash). nodes: one row per distinct
    set that is not empty: node, h1, h2, n, `least` (its least key, null only if all are null), `copies`. ends: node,
    least, near (see `linked`) by the rule 100 * intersection >= percent * union; their edges (node, least) join exactly
    the nodes that links join, and the sum of near is the number of linked documents with another set.
    Null and empty texts have an empty set, which is linked to nothing. Rows with a repeated or null key are rows like any.
    """
    counts = gram_counts(docs, text, size)
    keyed = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    sets = described(keyed, "text", size, percent, counts, ["key"])
    grouped = sets.where("n > 0").groupBy("h1", "h2").agg(
        F.first("n").alias("n"), F.min("key").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("bits").alias("bits"), F.first("first").alias("first")
    )
    nodes = written(grouped.withColumn("node", F.monotonically_increasing_id()), "nodes")
    near = written(may_link(meetings(nodes), percent), "near")
    clusters = components(near.where("node <> least"), "node", "least").withColumnRenamed("component", "cluster")
    members = written(clusters.join(nodes.select("node", "n", "least", "copies", "h1", "h2"), "node"), "members")
    found = sets_of(keyed, members, size).withColumnsRenamed({"h1": "g1", "h2": "g2"})
    asked = in_cells(members)
    same = F.col("key").eqNullSafe(F.col("least")) & (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))
    full = asked.join(found, same)
    ends = written(linked(full, percent, counts), "ends")
    documents = sized(keyed, "text", size).withColumnRenamed("n", "n_shingles")
    return documents, nodes.select("node", "h1", "h2", "n", "least", "copies"), ends


def groups(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """`nodes` with `component`, the least node that links reach."""
    found = components(ends.select("node", F.col("least").alias("to")).distinct(), "node", "to")
    return nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def clusters(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """One row per row of `docs`: key, n_shingles, component_id (the least key reachable), n_links.

    `n_links` counts linked documents, those with an equal set among them. A document with an empty set is alone. If all
    keys of a component are null, so is its id.
    """
    documents, nodes, ends = jaccard_join(docs, key, text, size, percent)
    degree = ends.groupBy("node").agg(F.sum("near").alias("near"))
    named = groups(nodes, ends).join(degree, "node", "left")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    per_set = named.join(least, "component").select(F.col("h1").alias("s1"), F.col("h2").alias("s2"), "component_id", (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = documents.join(per_set, (F.col("h1") == F.col("s1")) & (F.col("h2") == F.col("s2")) & (F.col("n_shingles") > 0), "left")
    alone = F.col("n_shingles") == 0
    return out.select("key", "n_shingles", F.when(alone, F.col("key")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """`docs` with one row of each component of linked documents, the one with the least key (nulls last), and all rows
    without words. Columns stay as they were, whatever their names; the texts are shuffled once to meet the decision."""
    given = docs.columns
    docs, called = plain_names(docs)
    names, key, text = docs.columns, called[key], called[text]
    row_id = [F.xxhash64(*names).alias("r1"), F.hash(*names).alias("r2")]
    marked = docs.select("*", *row_id)
    rows = marked.select(F.struct(F.col(key).isNull().alias("no_key"), F.col(key).alias("key"), "r1", "r2").alias("row_key"), F.col(text).alias("text"))
    documents, nodes, ends = jaccard_join(rows, "row_key", "text", size, percent)
    chosen = groups(nodes, ends).groupBy("component").agg(F.min("least").alias("best")).select("best.r1", "best.r2", F.lit(True).alias("single"))
    wordless = documents.where("n_shingles = 0").select("key.r1", "key.r2", F.lit(False).alias("single")).distinct()
    stay = chosen.unionByName(wordless).select(F.col("r1").alias("k1"), F.col("r2").alias("k2"), "single")
    met = marked.join(stay, (F.col("r1") == F.col("k1")) & (F.col("r2") == F.col("k2")))
    # rows that are equal in every column stand in one group, and one of them stays
    again = F.row_number().over(W.partitionBy("r1", "r2").orderBy("r1"))
    return met.withColumn("again", again).where("again = 1 OR NOT single").select(*names).toDF(*given)
