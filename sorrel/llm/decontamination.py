"""Benchmark decontamination: training tokens are streamed through a generalised suffix automaton of the test items."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sorrel.llm.arrays import map_batches
from sorrel.llm.rows import plain_names

WINDOW = 10
MAX_COVERAGE = 0.5
BLOCK_WORDS = 1_000_000
PIECE_WORDS = 20_000
#: A-Z to a-z; what is neither a digit, a letter a-z nor beyond ASCII to a space.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z, as bytes; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(FOLDED).split() if text else []


class SuffixAutomaton:
    """All runs of words that occur within some item; states know which items hold their run of `window` words.

    `cut[v]` is the state of the last `window` words of v's runs, `items[u]` the items that hold them, `short[u]` the
    items of fewer words that end there as a whole, `above[v]` the nearest state with such items.
    """

    def __init__(self, items: Iterable[tuple[str, Sequence[bytes], bool]], window: int):
        self.window, self.step, self.link, self.length = window, [{}], [0], [0]
        self.vocabulary: dict[bytes, int] = {}
        known, items = self.vocabulary, [(i, w, whole) for i, w, whole in items if w]
        coded = [(i, [known.setdefault(w, len(known)) for w in words], whole) for i, words, whole in items]
        for _, words, _ in coded:
            last = 0
            for w in words:
                last = self._extend(last, w)
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        self.cut = [0] * len(self.link)
        for v in order:
            if self.length[v] >= window:
                up = self.link[v]
                self.cut[v] = v if self.length[up] < window else self.cut[up]
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        for item, words, whole in coded:
            v = 0
            for place, w in enumerate(words, 1):
                v = self.step[v][w]
                if place >= window:
                    self.items.setdefault(self.cut[v], set()).add(item)
            if whole and len(words) < window:
                self.short.setdefault(v, []).append((len(words), item))
        self.above = [0] * len(self.link)
        for v in order:
            self.above[v] = v if v in self.short else self.above[self.link[v]]

    def _extend(self, last: int, w: int) -> int:
        step, link, length = self.step, self.link, self.length
        if w in step[last]:
            q = step[last][w]
            return q if length[q] == length[last] + 1 else self._split(last, w, q)
        cur = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p: int = last
        while w not in step[p]:
            step[p][w] = cur
            if p == 0:
                return cur
            p = link[p]
        q = step[p][w]
        link[cur] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return cur

    def _split(self, p: int, w: int, q: int) -> int:
        step, link, length = self.step, self.link, self.length
        clone = len(step)
        step.append(dict(step[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = clone
        while step[p].get(w) == q:
            step[p][w] = clone
            if p == 0:
                break
            p = link[p]
        return clone

    def scan(self, words: Sequence[bytes]) -> tuple[list[tuple[int, int]], set[str], int]:
        """(runs of hit words as half-open ranges, items whose windows occur, longest match in words)."""
        step, link, length, cut, above, window = self.step, self.link, self.length, self.cut, self.above, self.window
        runs: list[list[int]] = []
        states, found, longest = set(), set(), 0
        v = size = 0
        has_short = bool(self.short)
        for end, w in enumerate(map(self.vocabulary.get, words), 1):
            if w is None:
                v = size = 0
                continue
            to = step[v].get(w)
            if to is None:
                while v and to is None:
                    v = link[v]
                    to = step[v].get(w)
                size = length[v]
                if to is None:
                    size = 0
                    continue
            v = to
            size += 1
            if size > longest:
                longest = size
            start = end
            if size >= window:
                states.add(cut[v])
                start = end - window
            if has_short:
                u = above[v]
                while u:
                    for n, item in self.short[u]:
                        if n <= size:
                            found.add(item)
                            start = min(start, end - n)
                    u = above[link[u]]
            if start < end:
                while runs and start <= runs[-1][1]:
                    start = min(start, runs.pop()[0])
                runs.append([start, end])
        for u in states:
            found |= self.items[u]
        return [(a, b) for a, b in runs], found, longest


def join_runs(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    if not a or not b:
        return a or b
    out: list[list[int]] = []
    for s, e in sorted(a + b):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def item_pieces(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(item, words, whole): items of more than PIECE_WORDS words are cut, each piece repeating window - 1 words."""

    def run(batches):
        for batch in batches:
            rows = []
            for item, t in zip(*(c.to_pylist() for c in batch.columns)):
                w = words_of(t)
                for at in range(0, max(1, len(w) - window + 1), PIECE_WORDS):
                    piece = w[at : at + PIECE_WORDS + window - 1]
                    rows.append((item or "", b" ".join(piece), len(piece) == len(w), len(piece)))
            cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.binary(), pa.bool_(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, ["item", "words", "whole", "n"])

    source = items.select(F.col(item_id).cast("string").alias("i"), F.col(text).cast("string").alias("t"))
    return map_batches(source, run, "item string, words binary, whole boolean, n long").where("n > 0")


def automata(items: DataFrame, item_id: str, text: str, window: int, block_words: int) -> Iterator[SuffixAutomaton]:
    """One automaton per block of about `block_words` words, built on the driver one at a time.

    The words are counted first; the number of blocks grows with the benchmark, the size of a block does not.
    """
    pieces = item_pieces(items, item_id, text, window)
    total = pieces.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // block_words)
    for b in range(blocks):
        mine = pieces.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == b) if blocks > 1 else pieces
        yield SuffixAutomaton(((r["item"], bytes(r["words"]).split(), r["whole"]) for r in mine.collect()), window)


def scan(docs: DataFrame, items: DataFrame, text: str, item_text: str = "text", item_id: str = "item_id", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """`docs` with n_words, hit_runs (word ranges, flat), hit_items (ids as strings, sorted), longest_match.

    A window is `window` consecutive item words, or a shorter item as a whole. A block of items is sent to all tasks, and
    each pass over the documents adds what its block finds to the row, so that no document is shuffled. Null text has no
    words; items without words match nothing; a null item id reads as empty; equal ids count as one item; repeated rows
    stay. Columns of `docs` with the new names are replaced.
    """
    added = ("n_words long", "hit_runs array<int>", "hit_items array<string>", "longest_match int")
    names = [x.split()[0] for x in added]
    kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.int32()]
    out = docs.drop(*names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    blank = {"n_words": F.lit(None).cast("long"), "hit_runs": F.lit(None).cast("array<int>"), "hit_items": F.lit(None).cast("array<string>"), "longest_match": F.lit(0)}
    out = out.withColumns(blank)

    def one_pass(df: DataFrame, automaton: SuffixAutomaton) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(automaton)

        def run(batches):
            machine = shared.value
            for batch in batches:
                k = batch.schema.get_field_index(text)
                runs_before, items_before, longest_before = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names[1:])
                made = []
                for t, r, i, m in zip(batch.column(k), runs_before, items_before, longest_before):
                    words = words_of(t.as_py())
                    runs, found, longest = machine.scan(words)
                    runs = join_runs(runs, [(a, b) for a, b in zip((r or [])[::2], (r or [])[1::2])])
                    made.append((len(words), [x for p in runs for x in p], sorted(found.union(i or ())), max(longest, m)))
                kept = [c for c, n in zip(batch.columns, batch.schema.names) if n not in names]
                cols = [pa.array([m[j] for m in made], kinds[j]) for j in range(4)]
                yield pa.RecordBatch.from_arrays([*kept, *cols], [*(n for n in batch.schema.names if n not in names), *names])

        return map_batches(df, run, ", ".join([schema, *added]))

    machines = automata(items, item_id, item_text, window, block_words)
    empty = True
    for machine in machines:
        out, empty = one_pass(out, machine), False
    return one_pass(out, SuffixAutomaton([], window)) if empty else out


def without_runs(text: str, runs: Sequence[int]) -> str:
    """`text` without the words of `runs` and what stands between them; one space stays in place of each run."""
    data = text.encode("utf-8", "surrogatepass")
    spans = [m.span() for m in WORD.finditer(data)]
    out, at = [], 0
    for a, b in zip(runs[::2], runs[1::2]):
        out.append(data[at : spans[a][0]])
        at = spans[b - 1][1]
    out.append(data[at:])
    joined = out[0]
    for piece in out[1:]:
        between = b"" if not joined or joined[-1:].isspace() or piece[:1].isspace() or not piece else b" "
        joined += between + piece
    return joined.decode("utf-8", "surrogatepass")


def decontaminate(
    docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW, max_coverage: float = MAX_COVERAGE, item_text: str = "text", **how
) -> DataFrame:
    """`docs` without benchmark passages, with the same columns.

    Runs of words that match `window` or more words of an item (or a whole shorter item) are cut out of the text. A
    document with more than `max_coverage` of its words in such runs is dropped. Others stay as they are, null texts too,
    and so do all other columns, whatever their names.
    """
    given = docs.columns
    docs, called = plain_names(docs)
    names, text = docs.columns, called[text]
    seen = scan(docs, items, text, item_text, window=window, **how)

    def run(batches):
        for batch in batches:
            at = {n: batch.schema.get_field_index(n) for n in (text, "hit_runs", "n_words")}
            texts, runs, totals = (batch.column(at[n]).to_pylist() for n in (text, "hit_runs", "n_words"))
            hit = [sum(r[1::2]) - sum(r[::2]) for r in runs]
            kept = np.array([not h or h <= max_coverage * n for h, n in zip(hit, totals)], bool)
            clean = [without_runs(t, r) if h else t for t, r, h in zip(texts, runs, hit)]
            cols = [pa.array(clean, batch.schema.field(text).type) if n == text else batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays(cols, names).filter(pa.array(kept))

    return map_batches(seen, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)).toDF(*given)
