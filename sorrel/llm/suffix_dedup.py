"""Repeated passages by prefix-free parsing.

A trigger is a place where the rolling hash of K bytes is the least of WINDOW in a row; triggers cut every text into
phrases, and each string of LENGTH = WINDOW + K - 1 bytes holds one, found from its own bytes alone. A string is thus the
end of a phrase before its trigger (a dictionary suffix) and what follows the trigger (a parse suffix). Triggers whose K
bytes occur once cannot lie in a repeated string. The rest are grouped by those bytes; in a group the dictionary suffixes
and the parse suffixes are sorted, with the lengths that neighbours have in common, and the two orders are combined: two
places hold the same string if, for some a, they agree in a bytes before the trigger and LENGTH - a from it on.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from sorrel.llm.arrays import SLICE_BYTES, U, map_batches, slices, text_bytes
from sorrel.llm.rows import written
from sorrel.llm.winnowing import least, rolling64

LENGTH, K = 200, 32
WINDOW = LENGTH - K + 1
BEFORE = WINDOW - 1
#: Contexts sorted together; larger groups are compared string by string, spread over all tasks.
GROUP_LIMIT = 20_000


def triggers(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in `raw`, hashes of their K bytes) of the triggers of all rows, in order."""
    if len(offsets) == 2 and len(raw) > 4 * SLICE_BYTES:
        step, parts = 4 * SLICE_BYTES - LENGTH + 1, []
        for at in range(0, len(raw) - LENGTH + 1, step):
            piece = raw[at : at + 4 * SLICE_BYTES]
            p, h = triggers(piece, np.array([0, len(piece)]))
            parts.append((p + at, h))
        places, hashes = (np.concatenate(x) for x in zip(*parts))
        _, first = np.unique(places, return_index=True)
        return places[first], hashes[first]
    if len(raw) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = rolling64(raw, K)
    packed = (grams & U(0xFFFFFFFF00000000)) | (U(0xFFFFFFFF) - np.arange(len(raw), dtype=U))
    ends = np.repeat(offsets[1:], np.diff(offsets))
    low = least(packed, WINDOW)[np.arange(len(raw)) + LENGTH <= ends]
    low = low[np.append(True, low[1:] != low[:-1])] if len(low) else low
    places = (U(0xFFFFFFFF) - (low & U(0xFFFFFFFF))).astype(np.int64)
    return places, grams[places].view(np.int64)


def _hashes_only(batches):
    for batch in batches:
        raw, offsets = text_bytes(batch.column(0))
        for i, j in slices(offsets):
            _, h = triggers(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            yield pa.RecordBatch.from_pydict({"gram": h})


def _with_contexts(batches):
    """(doc, mark, place, gram, context): `context` is a hash of all bytes that some string through the trigger has."""
    for batch in batches:
        raw, offsets = text_bytes(batch.column(2))
        for i, j in slices(offsets):
            part, local = raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            places, h = triggers(part, local)
            row = np.searchsorted(local, places, "right") - 1
            first = np.maximum(places - BEFORE, local[row])
            last = np.minimum(places + LENGTH, local[row + 1])
            view, digest = memoryview(part), xxhash.xxh3_64_intdigest
            found = [digest(view[a:b], p - a) for a, b, p in zip(first.tolist(), last.tolist(), places.tolist())]
            at = pa.array(row + i)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(places - local[row]), pa.array(h), pa.array(np.array(found, np.uint64).view(np.int64))],
                ["doc", "mark", "place", "gram", "context"],
            )


def merged(runs: np.ndarray) -> np.ndarray:
    """Half-open runs, sorted, those that touch made one."""
    if not len(runs):
        return np.zeros((0, 2), np.int64)
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(runs[:, 1])
    new = np.append(True, runs[1:, 0] > reach[:-1])
    return np.stack([runs[new, 0], reach[np.append(np.flatnonzero(new)[1:] - 1, len(runs) - 1)]], axis=1)


def outcome(text: bytes, runs: np.ndarray) -> tuple[bytes, int, int]:
    """(what stays, bytes removed, runs)."""
    runs, kept, at = merged(runs), [], 0
    for a, b in runs.tolist():
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    rest = b"".join(kept)
    return rest, len(text) - len(rest), len(runs)


PARTS = "kind string, doc long, mark int, text binary, n_bytes long, sha256 string, runs array<int>, gram long, large boolean, place int, before binary, after binary"


def _parts(batches, whole: bool):
    """Per document: its text and the runs that are settled, and the contexts of its triggers that are not.

    Of a document without repeated triggers the text goes along only if `whole`.
    """
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "boolean": pa.bool_()}
    schema = pa.schema([(n, kinds[t]) for n, t in (x.split() for x in PARTS.split(", "))])
    for batch in batches:
        rows = []
        for doc, mark, text, asked in zip(*(c.to_pylist() for c in batch.columns)):
            runs = []
            for x in asked or ():
                p = x["place"]
                if x["settled"]:
                    # every string through this trigger occurs elsewhere too
                    first, last = max(0, p - BEFORE), min(len(text), p + LENGTH)
                    if last - first >= LENGTH:
                        runs += [first, last]
                if x["shown"]:
                    rows.append({"kind": "context", "doc": doc, "mark": mark, "gram": x["gram"], "large": x["large"], "place": p, "before": text[max(0, p - BEFORE) : p], "after": text[p : p + LENGTH]})
            runs = merged(np.array(runs, np.int64).reshape(-1, 2)).ravel().tolist()
            if asked:
                rows.append({"kind": "text", "doc": doc, "mark": mark, "text": text, "runs": runs})
            else:
                rows.append({"kind": "alone", "doc": doc, "n_bytes": len(text), "sha256": hashlib.sha256(text).hexdigest(), "text": text if whole else None})
            if len(rows) >= 256:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


def _order(strings: list[bytes], width: int, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows sorted by group and string, length in common with the row before; -1 at the start of a group)."""
    table = np.zeros((len(strings), width), np.uint8)
    for k, s in enumerate(strings):
        table[k, : len(s)] = np.frombuffer(s, np.uint8)
    by = np.argsort(np.ascontiguousarray(table).view(f"S{width}").ravel(), kind="stable")
    by = by[np.argsort(group[by], kind="stable")]
    differ = table[by[1:]] != table[by[:-1]]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common[group[by[1:]] != group[by[:-1]]] = -1
    return by, np.append(-1, common)


def extents(group: np.ndarray, before: list[bytes], after: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(most, fewest) bytes before the trigger of a string that another row of the group has too; -1 where there is none.

    `before` and `after` are the bytes around the triggers. For each a, rows fall in classes by their last a bytes before
    the trigger and by their first LENGTH - a from it on; a pair of classes with several rows is a repeated string.
    """
    n = len(group)
    left, left_common = _order([b[::-1] for b in before], BEFORE, group)
    right, right_common = _order(after, LENGTH, group)
    have_left, have_right = (np.array([len(x) for x in s]) for s in (before, after))
    most, fewest = np.full(n, -1), np.full(n, -1)
    left_class, right_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for a in range(BEFORE + 1):
        fits = np.flatnonzero((have_left >= a) & (have_right >= LENGTH - a))
        if len(fits) < 2:
            continue
        left_class[left] = np.cumsum(left_common < a)
        right_class[right] = np.cumsum(right_common < LENGTH - a)
        _, at, counts = np.unique(left_class[fits] * (n + 1) + right_class[fits], return_inverse=True, return_counts=True)
        hit = fits[counts[at] > 1]
        most[hit] = a
        fewest[hit[fewest[hit] < 0]] = a
    return most, fewest


def _resolve(batches):
    """Runs of the unsettled triggers of groups that are small enough, several groups at a time."""
    held: list[list] = [[] for _ in range(6)]

    def results(size: int):
        doc, mark, place, gram, before, after = (h[:size] for h in held)
        most, fewest = extents(np.unique(np.array(gram), return_inverse=True)[1], before, after)
        hit = np.flatnonzero(most >= 0)
        start = np.array(place)[hit]
        for h in held:
            del h[:size]
        return pa.RecordBatch.from_arrays(
            [pa.array([doc[k] for k in hit], pa.int64()), pa.array([mark[k] for k in hit], pa.int32()), pa.array(start - most[hit], pa.int32()), pa.array(start - fewest[hit] + LENGTH, pa.int32())],
            ["doc", "mark", "first", "last"],
        )

    for batch in batches:
        for h, c in zip(held, batch.columns):
            h += c.to_pylist()
        if len(held[0]) >= GROUP_LIMIT:
            gram = np.array(held[3])
            whole = int(np.searchsorted(gram, gram[-1]))
            if whole:
                yield results(whole)
    if held[0]:
        yield results(len(held[0]))


def _strings(batches):
    """Every string through a trigger of a large group, as two hashes, with the number of bytes before the trigger."""
    for batch in batches:
        doc, mark, place, gram, before, after = (c.to_pylist() for c in batch.columns)
        for k in range(len(doc)):
            rows = []
            for a in range(max(0, LENGTH - len(after[k])), len(before[k]) + 1):
                both = before[k][len(before[k]) - a :] + after[k][: LENGTH - a]
                rows.append((a, *np.frombuffer(xxhash.xxh3_128_digest(both), np.int64).tolist()))
            if rows:
                n = len(rows)
                cols = [pa.array([doc[k]] * n, pa.int64()), pa.array([mark[k]] * n, pa.int32()), pa.array([place[k]] * n, pa.int32()), pa.array([gram[k]] * n, pa.int64()), *(pa.array([r[c] for r in rows], pa.int64()) for c in range(3))]
                yield pa.RecordBatch.from_arrays(cols, ["doc", "mark", "place", "gram", "a", "s1", "s2"])


def _runs(contexts: DataFrame, large: bool) -> DataFrame:
    """(doc, mark, first, last) of contexts in small or in large groups."""
    rows = contexts.where(F.col("large") == large).select("doc", "mark", "place", "gram", "before", "after")
    if not large:
        return map_batches(rows.repartition("gram").sortWithinPartitions("gram"), _resolve, "doc long, mark int, first int, last int")
    strings = map_batches(rows, _strings, "doc long, mark int, place int, gram long, a long, s1 long, s2 long")
    # a string with two triggers comes from both; through one trigger it comes once from each of its places
    same = ["gram", "a", "s1", "s2"]
    several = strings.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    hit = strings.join(several, same).groupBy("doc", "mark", "place").agg(F.max("a").alias("most"), F.min("a").alias("fewest"))
    return hit.select("doc", "mark", F.expr("cast(place - most as int)").alias("first"), F.expr(f"cast(place - fewest + {LENGTH} as int)").alias("last"))


KEPT = "doc long, kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _outcomes(batches, whole: bool):
    """Rows of KEPT from (doc, text, runs)."""
    for batch in batches:
        made = []
        for t, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            rest, gone, spans = outcome(t, np.array(runs, np.int64).reshape(-1, 2))
            made.append((rest if whole else None, len(t), gone, spans, hashlib.sha256(rest).hexdigest()))
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        cols = [pa.array([m[k] for m in made], t) for k, t in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["doc", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", whole: bool = True, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(doc, kept, n_bytes, n_removed, n_spans, kept_sha256) per row of `docs`, `doc` being its key.

    Removed is each byte of a string of LENGTH bytes that also starts anywhere else in the table; `kept` is the rest, in
    bytes, or null unless `whole` (digests alone move less). Matches lie within a text; null reads as empty; shorter texts
    lose nothing. Rows are told apart by key and text, so equal rows, being copies of each other, fare alike; a null key
    is a key. No group of copies is gathered: only distinct contexts around a trigger are compared.
    """
    source = docs.select(F.col(key).cast("long").alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    source = source.select("doc", F.hash("text").alias("mark"), F.col("text").cast("binary").alias("text"))
    grams = map_batches(source.select("text"), _hashes_only, "gram long").groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    grams = written(grams, "grams")
    found = map_batches(source, _with_contexts, "doc long, mark int, place long, gram long, context long")
    rest = written(found.join(grams, "gram"), "triggers")
    contexts = rest.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "mark", "place")).alias("at"))
    contexts = written(contexts, "contexts")
    # where every context of a trigger occurs twice, or it has one context only, nothing is left to compare
    open_ = contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("fewest")).where("kinds > 1 AND fewest = 1")
    shown = contexts.join(open_, "gram").select("at.*", "gram", (F.col("n") > 1).alias("settled"), F.lit(True).alias("shown"), (F.col("kinds") > group_limit).alias("large"))
    settled = rest.join(contexts.where("n > 1").select("gram", "context"), ["gram", "context"])
    settled = settled.select("doc", "mark", "place", "gram", F.lit(True).alias("settled"), F.lit(False).alias("shown"), F.lit(False).alias("large"))
    asked = shown.unionByName(settled).groupBy(F.col("doc").alias("d"), F.col("mark").alias("m"))
    asked = asked.agg(F.collect_list(F.struct(F.col("place").cast("int").alias("place"), "gram", "settled", "shown", "large")).alias("asked"))
    same = F.col("doc").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m"))
    joined = source.join(asked, same, "left").select("doc", "mark", "text", "asked")
    parts = written(map_batches(joined, lambda batches: _parts(batches, whole), PARTS), "parts")
    around = parts.where("kind = 'context'")
    runs = _runs(around, False).unionByName(_runs(around, True))
    more = runs.groupBy(F.col("doc").alias("d"), F.col("mark").alias("m")).agg(F.flatten(F.collect_set(F.array("first", "last"))).alias("more"))
    texts = parts.where("kind = 'text'").select("doc", "mark", "text", "runs").join(more, same, "left")
    texts = texts.select("doc", "text", F.concat("runs", F.coalesce("more", F.array().cast("array<int>"))).alias("runs"))
    alone = parts.where("kind = 'alone'").select("doc", F.col("text").alias("kept"), "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("sha256").alias("kept_sha256"))
    return map_batches(texts, lambda batches: _outcomes(batches, whole), KEPT).unionByName(alone)
