"""Token counts by finite-state transducers compiled from a byte-level BPE tokenizer file.

Two transducers run one after the other. The first cuts lower-cased text into words as the tokenizer's pattern does. It has
few states, so a chunk of text has a whole map from entry to exit states; maps compose by a parallel prefix scan, after
which every chunk runs from its true entry state. The second reads the bytes of a word, and each transition carries the
number of tokens that it adds to the count (a merge takes tokens away). Words start in a known state and run side by side;
a long word is cut into pieces whose maps are worked out for the entry states that turn up, until exits and entries agree.

States of the second transducer follow from the merges: the last token of a BPE encoding is the one token, among the
suffixes of the text, that stays apart from the last token before it. So a state is the longest suffix that begins a token,
and for each suffix that does so, the last token before it and the tokens since. States and transitions are made when a
text first asks for them, many at a time, and thrown away together when there are too many.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from sorrel.llm.arrays import HELD, map_batches

# Fixed values of the tokenizer file's kind, checked against the file.
SUFFIX = "</w>"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]

SLICE_CHARS = 1 << 18
CHUNK = 256
PIECE, WARM = 64, 48
MOST_STATES, MOST_TRANSITIONS = 1 << 17, 1 << 19
#: text without these code points is in composed form as it is
COMBINING = re.compile("[\u0300-\U0010ffff]")
ODD = np.uint64(0x9E3779B97F4A7C15)
LIMIT = 2048
#: tables of the file that was compiled last
COMPILED: dict = {}

SPACE, LETTER, NUMBER, OTHER, QUOTE, SHORT, R_OR_V, L, E, UNKNOWN = range(10)
START, START_BEFORE = 1, 2


def _cutter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and output by 16 * state + class. Output bits: a word starts here, a word started one place before.

    States: between words, in letters, in marks, after a quote that starts a word, then after r or v, or after l.
    """
    between, letters, marks, quote, quote_rv, quote_l = range(6)
    to, out = np.zeros(96, np.uint8), np.zeros(96, np.uint8)
    plain = {SPACE: between, NUMBER: between, OTHER: marks, QUOTE: quote, **dict.fromkeys((LETTER, SHORT, R_OR_V, L, E), letters)}
    for state in range(6):
        for c, goes in plain.items():
            to[16 * state + c], out[16 * state + c] = goes, 0 if c == SPACE else START
    inside = {letters: (LETTER, SHORT, R_OR_V, L, E), marks: (OTHER, QUOTE), quote: (OTHER, QUOTE)}
    for state, classes in inside.items():
        for c in classes:
            to[16 * state + c], out[16 * state + c] = (letters if state == letters else marks), 0
    for c, goes in ((SHORT, between), (R_OR_V, quote_rv), (L, quote_l)):
        to[16 * quote + c], out[16 * quote + c] = goes, 0
    for state, closing in ((quote_rv, E), (quote_l, L)):
        # no contraction after all: the letter read before was the start of a word
        for c in plain:
            to[16 * state + c] = to[16 * letters + c]
            out[16 * state + c] = out[16 * letters + c] | START_BEFORE
        to[16 * state + closing], out[16 * state + closing] = between, 0
    return to, out


NEXT, OUTPUT = _cutter()
STATES = 6


def chunk_maps(classes: np.ndarray) -> np.ndarray:
    """Exit state by chunk and entry state, for text as a table of CHUNK classes a row."""
    state = np.broadcast_to(np.arange(STATES, dtype=np.uint8)[:, None], (STATES, len(classes))).copy()
    for column in classes.T:
        state = NEXT[state * 16 + column]
    return state.T


def scan(maps: np.ndarray) -> np.ndarray:
    """Entry state of every chunk from state 0 on: maps composed in log-many rounds, each joining twice as many."""
    whole, reach = maps.copy(), 1
    while reach < len(whole):
        whole[reach:] = np.take_along_axis(whole[reach:], whole[:-reach].astype(np.intp), axis=1)
        reach *= 2
    return np.concatenate([[0], whole[:-1, 0]]).astype(np.uint8)


def word_starts(classes: np.ndarray) -> np.ndarray:
    """True where a word starts. The text has to end in a space."""
    n = len(classes)
    table = np.zeros(-(-n // CHUNK) * CHUNK, np.uint8)
    table[:n] = classes
    table = table.reshape(-1, CHUNK)
    state = scan(chunk_maps(table))
    out = np.empty(table.shape[::-1], np.uint8)
    for k, column in enumerate(table.T):
        at = state * 16 + column
        out[k], state = OUTPUT[at], NEXT[at]
    out = out.T.ravel()
    starts = (out & START) > 0
    starts[:-1] |= (out[1:] & START_BEFORE) > 0
    return starts[:n]


class Merges:
    """Which two tokens stay apart, and the trie of all tokens with suffix links."""

    def __init__(self, model: dict, specials: set[str]):
        first = {}
        for c in (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)):
            first[chr(c)] = c
        for c in range(256):
            if chr(c) not in first:
                first[chr(0x100 + len([k for k in first if ord(k) >= 0x100]))] = c
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # token numbers by order of making: 256 inner bytes, 256 last bytes, then the merges
        names = [c for c, _ in sorted(first.items(), key=lambda x: x[1])]
        names += [c + SUFFIX for c in names]
        names += [a + b for a, b in pairs]
        ids = {name: k for k, name in enumerate(names)}
        if len(ids) != len(names) or set(ids) != set(model["vocab"]) - specials:
            raise ValueError("tokens and merges of the tokenizer file do not belong together")
        left = np.full(len(names), -1, np.int64)
        right = left.copy()
        left[512:] = [ids[a] for a, _ in pairs]
        right[512:] = [ids[b] for _, b in pairs]
        self.n = len(names)
        self.ids = np.array([model["vocab"][name] for name in names], np.int64)
        self.size = np.array([len(x) - len(SUFFIX) if x.endswith(SUFFIX) else len(x) for x in names], np.int64)
        key = left[512:] * self.n + right[512:]
        order = np.argsort(key)
        self.pair_keys, self.pair_made = key[order], order + 512
        self.mark = xxhash.xxh3_128_hexdigest(key.tobytes() + self.ids.tobytes())
        self.right_spine, self.left_spine = self._spines(right), self._spines(left)

        made = np.arange(512, self.n)
        sound = np.ones(self.n, bool)
        sound[512:] = ~self._merges(left[512:], right[512:], made)
        for t in range(512, self.n):
            sound[t] &= sound[left[t]] and sound[right[t]]
        self._trie([bytes(first[c] for c in (x[: -len(SUFFIX)] if x.endswith(SUFFIX) else x)) for x in names], [x.endswith(SUFFIX) for x in names], sound)

    def _spines(self, child: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens along one edge of a token's merges, smallest first, one after another, with the starts of each."""
        lists: list = [[t] for t in range(512)]
        for t in range(512, self.n):
            lists.append([*lists[child[t]], t])
        starts = np.cumsum([0, *map(len, lists)])
        return np.concatenate(lists).astype(np.int64), starts

    def _merges(self, a: np.ndarray, b: np.ndarray, below: np.ndarray | int) -> np.ndarray:
        """Whether a merge made before `below` joins the end of a to the beginning of b, where a and b stand side by side.

        Merges come in the order of their numbers. The tokens at the border grow along the edges of a and b; at every
        step the pair at the border merges if its number comes before the next ones on both sides (of equal merges the
        left one comes first).
        """
        items_a, starts_a = self.right_spine
        items_b, starts_b = self.left_spine
        i, j = starts_a[a], starts_b[b]
        end_i, end_j = starts_a[a + 1], starts_b[b + 1]
        below = np.broadcast_to(np.asarray(below, np.int64), a.shape)
        joined = np.zeros(len(a), bool)
        todo = np.arange(len(a))
        while len(todo):
            ii, jj = i[todo], j[todo]
            key = items_a[ii] * self.n + items_b[jj]
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            made = np.where(self.pair_keys[at] == key, self.pair_made[at], self.n)
            more_i, more_j = ii + 1 < end_i[todo], jj + 1 < end_j[todo]
            next_i = np.where(more_i, items_a[np.where(more_i, ii + 1, 0)], below[todo])
            next_j = np.where(more_j, items_b[np.where(more_j, jj + 1, 0)], below[todo])
            hit = (made < next_i) & (made <= next_j) & (made < below[todo])
            joined[todo[hit]] = True
            step_i = more_i & (~more_j | (next_i <= next_j))
            step_j = more_j & ~step_i
            i[todo] += step_i
            j[todo] += step_j
            todo = todo[~hit & (step_i | step_j)]
        return joined

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether a followed by b is encoded as those two tokens; a below 0 stands for the beginning of a word."""
        out = a < 0
        real = np.flatnonzero(~out)
        out[real] = ~self._merges(a[real], b[real], self.n)
        return out

    def _trie(self, spelled: list[bytes], last: list[bool], sound: np.ndarray) -> None:
        """Nodes in order of depth. `ends` holds the inner token that ends in a node (row 0), and the last one (row 1);
        `token_at` the nearest node with such a token on the chain of suffixes from a node on, itself included."""
        edges: dict = {}
        depth, ends = [0], [[-1], [-1]]
        found = sorted((t for t in range(self.n) if sound[t]), key=lambda t: len(spelled[t]))
        prefixes = sorted({s[:k] for s in (spelled[t] for t in found) for k in range(1, len(s) + 1)}, key=len)
        node = {b"": 0}
        for p in prefixes:
            node[p] = len(depth)
            edges[node[p[:-1]] << 8 | p[-1]] = node[p]
            depth.append(len(p))
            ends[0].append(-1)
            ends[1].append(-1)
        for t in found:
            ends[int(last[t])][node[spelled[t]]] = t
        self.depth, self.ends = np.array(depth), np.array(ends)
        self.edge_keys = np.array(sorted(edges), np.int64)
        self.edge_to = np.array([edges[k] for k in sorted(edges)], np.int64)
        fail = np.zeros(len(depth), np.int64)
        token_at = np.zeros((2, len(depth)), np.int64)
        for p in prefixes:
            x = node[p]
            k = 1
            while p[k:] not in node:
                k += 1
            fail[x] = node[p[k:]]
            for kind in (0, 1):
                token_at[kind, x] = x if ends[kind][x] >= 0 else token_at[kind, fail[x]]
        self.fail, self.token_at = fail, token_at
        self.deepest = int(self.depth.max())
        live = np.zeros((len(depth), self.deepest + 1), bool)
        for x in range(len(depth)):
            live[x] = live[fail[x]]
            live[x, depth[x]] = True
        self.live = live

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The longest suffix that begins a token after one more byte."""
        out = np.zeros(len(node), np.int64)
        at, todo = node.copy(), np.arange(len(node))
        while len(todo):
            key = at[todo] << 8 | byte[todo]
            k = np.minimum(np.searchsorted(self.edge_keys, key), len(self.edge_keys) - 1)
            there = self.edge_keys[k] == key
            out[todo[there]] = self.edge_to[k[there]]
            todo = todo[~there & (at[todo] > 0)]
            at[todo] = self.fail[at[todo]]
        return out


class WordTransducer:
    """Counts and names tokens of words. A transition's key is 512 * state + byte, plus 256 for the last byte of a word."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.reset()

    def reset(self) -> None:
        """The state before a word only: no token so far."""
        width = self.merges.deepest + 1
        self.n_states, room = 1, 1 << 10
        self.node = np.zeros(room, np.int64)
        self.tokens = np.full((room, width), -1, np.int32)
        self.since = np.zeros((room, width), np.int8)
        self.known = {self._name(self.node[:1], self.tokens[:1], self.since[:1])[0]: 0}
        self.made = 0
        self._rehash(1 << 12)

    @staticmethod
    def _name(node, tokens, since) -> list[bytes]:
        """A 128-bit hash of each state, which stands for it in the table of known ones."""
        rows = np.concatenate([node.astype("<i4").view(np.uint8).reshape(len(node), -1), tokens.view(np.uint8), since.view(np.uint8)], axis=1)
        return [xxhash.xxh3_128_digest(r) for r in np.ascontiguousarray(rows)]

    def _rehash(self, size: int) -> None:
        old = (self.keys[self.keys >= 0], self.values[self.keys >= 0]) if self.made else None
        self.shift = np.uint64(64 - (size.bit_length() - 1))
        self.keys, self.values = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        if old:
            self._insert(*old)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * ODD) >> self.shift).astype(np.int64)

    def _insert(self, key: np.ndarray, value: np.ndarray) -> None:
        slot, mask = self._slot(key), len(self.keys) - 1
        todo = np.arange(len(key))
        while len(todo):
            at = slot[todo]
            free = self.keys[at] < 0
            self.keys[at[free]] = key[todo[free]]
            mine = self.keys[at] == key[todo]
            self.values[at[mine]] = value[todo[mine]]
            todo = todo[~mine]
            slot[todo] = (slot[todo] + 1) & mask

    def lookup(self, key: np.ndarray) -> np.ndarray:
        """256 * next state (after a last byte: 256 * last token) + 128 + change of the count."""
        slot, mask = self._slot(key), len(self.keys) - 1
        value, at = self.values[slot], self.keys[slot]
        wrong = np.flatnonzero(at != key)
        absent = []
        while len(wrong):
            empty = self.keys[slot[wrong]] < 0
            absent.append(wrong[empty])
            wrong = wrong[~empty]
            slot[wrong] = (slot[wrong] + 1) & mask
            there = self.keys[slot[wrong]] == key[wrong]
            value[wrong[there]] = self.values[slot[wrong[there]]]
            wrong = wrong[~there]
        absent = np.concatenate(absent) if absent else wrong
        if len(absent):
            new, which = np.unique(key[absent], return_inverse=True)
            made = self._make(new)
            self.made += len(new)
            size = len(self.keys)
            while size < 2 * self.made:
                size *= 2
            if size > len(self.keys):
                self.made -= len(new)
                self._rehash(size)
                self.made += len(new)
            self._insert(new, made)
            value[absent] = made[which]
        return value

    def _make(self, key: np.ndarray) -> np.ndarray:
        """Work out transitions, and the states they lead to."""
        m = self.merges
        state, byte, last = key >> 9, key & 255, (key >> 8) & 1
        node = m.step(self.node[state], byte)
        at = m.token_at[last, node]
        todo = np.arange(len(key))
        while len(todo):
            before = self.tokens[state[todo], m.depth[at[todo]] - 1].astype(np.int64)
            todo = todo[~m.apart(before, m.ends[last[todo], at[todo]])]
            at[todo] = m.token_at[last[todo], m.fail[at[todo]]]
        change = 1 - self.since[state, m.depth[at] - 1].astype(np.int64)
        goes = m.ends[last, at]
        inner = np.flatnonzero(last == 0)
        if len(inner):
            live = m.live[node[inner]]
            tokens, since = (np.empty((len(inner), live.shape[1]), t) for t in (np.int32, np.int8))
            tokens[:, 0], since[:, 0] = m.ends[0, at[inner]], 0
            tokens[:, 1:] = self.tokens[state[inner], :-1]
            since[:, 1:] = self.since[state[inner], :-1] + change[inner, None].astype(np.int8)
            tokens[~live], since[~live] = -1, 0
            names = self._name(node[inner], tokens, since)
            fresh = []
            for k, name in enumerate(names):
                number = self.known.setdefault(name, len(self.known))
                if number == self.n_states + len(fresh):
                    fresh.append(k)
                goes[inner[k]] = number
            self._grow(node[inner[fresh]], tokens[fresh], since[fresh])
        return goes << 8 | (change + 128)

    def _grow(self, node, tokens, since) -> None:
        end = self.n_states + len(node)
        while end > len(self.node):
            self.node, self.tokens, self.since = (np.concatenate([x, np.zeros_like(x)]) for x in (self.node, self.tokens, self.since))
        for held, new in ((self.node, node), (self.tokens, tokens), (self.since, since)):
            held[self.n_states : end] = new
        self.n_states = end

    def run(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, ends: np.ndarray, state: np.ndarray, token: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(exit state, count) of byte runs side by side from given entry states; `ends` marks runs that end a word.

        `token`, if given, receives at every byte the token that ends there if the word is cut off there.
        """
        order = np.argsort(-lengths, kind="stable")
        at, ends, state = starts[order], ends[order], state[order]
        active = np.cumsum(np.bincount(lengths)[::-1])[::-1]
        counts = np.zeros(len(order), np.int64)
        for k in range(len(active) - 1):
            n, still = int(active[k + 1]), int(active[k + 2]) if k + 2 < len(active) else 0
            symbol = data[at[:n] + k].astype(np.int64)
            symbol[still:] += 256 * ends[still:n]
            value = self.lookup(state[:n] * 512 + symbol)
            state[:n] = value >> 8
            counts[:n] += (value & 255) - 128
            if token is not None:
                token[at[still:n] + k] = np.where(ends[still:n] > 0, state[still:n], self.tokens[np.where(ends[still:n] > 0, 0, state[still:n]), 0])
                token[at[:still] + k] = self.tokens[state[:still], 0]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return state[back], counts[back]

    def count(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, token: np.ndarray | None = None) -> np.ndarray:
        """Tokens of every word."""
        if self.n_states > MOST_STATES or self.made > MOST_TRANSITIONS:
            self.reset()
        pieces = -(-lengths // PIECE)
        word = np.repeat(np.arange(len(starts)), pieces)
        number = np.arange(len(word)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = starts[word] + number * PIECE
        size = np.minimum(lengths[word] - number * PIECE, PIECE)
        ends = (number + 1 == pieces[word]).astype(np.int64)
        entry = np.zeros(len(word), np.int64)
        later = np.flatnonzero(number > 0)
        if len(later):
            # entry states of later pieces, guessed from the bytes before
            entry[later] = self.run(data, at[later] - WARM, np.full(len(later), WARM), np.zeros(len(later), np.int64), np.zeros(len(later), np.int64))[0]
        leaves, counts = self.run(data, at, size, ends, entry, token)
        while len(later):
            wrong = later[entry[later] != leaves[later - 1]]
            if not len(wrong):
                break
            entry[wrong] = leaves[wrong - 1]
            leaves[wrong], counts[wrong] = self.run(data, at[wrong], size[wrong], ends[wrong], entry[wrong], token)
        return np.bincount(word, counts, len(starts)).astype(np.int64)

    def encode(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vocabulary ids of all words one after another, tokens of every word): read off from the last token backwards."""
        token = np.zeros(len(data), np.int32)
        counts = self.count(data, starts, lengths, token)
        out = np.zeros(int(counts.sum()), np.int64)
        place, at, words = np.cumsum(counts) - 1, starts + lengths - 1, np.arange(len(starts))
        while len(words):
            here = token[at[words]]
            out[place[words]] = self.merges.ids[here]
            place[words] -= 1
            at[words] -= self.merges.size[here]
            words = words[at[words] >= starts[words]]
        return out, counts


def compiled(path: str) -> tuple[Merges, dict[str, int]]:
    """(merges, special strings with their ids) of a tokenizer file: some megabytes, by the size of its vocabulary."""
    if path not in COMPILED:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec["added_tokens"]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", ())]
        cut = [c.get("pattern", {}).get("Regex") for c in spec["pre_tokenizer"].get("pretokenizers", ())][:1]
        plain = not any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized"))
        if (kinds, cut, model.get("end_of_word_suffix"), model["type"], plain) != (NORMALIZERS, [PATTERN], SUFFIX, "BPE", True):
            raise ValueError(f"{path} is not of the kind these transducers are compiled for")
        COMPILED.clear()
        COMPILED[path] = Merges(model, {t["content"] for t in added}), {t["content"]: t["id"] for t in added}
    return COMPILED[path]


class TokenCounter:
    """Both transducers for one tokenizer file, from what `compiled` gives."""

    def __init__(self, merges: Merges, specials: dict[str, int]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, normalizers, pre_tokenizers

        self.special_ids = specials
        self.specials = re.compile("|".join(map(re.escape, specials)))
        self.words = WordTransducer(merges)
        self.nfc, self.lower = normalizers.NFC(), normalizers.Lowercase()
        self.split = pre_tokenizers.Split(Regex(PATTERN), "removed", invert=True)
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        self.lowered = np.arange(0x110000, dtype="<u4")
        self.longer: dict = {}

    @classmethod
    def get(cls, sent) -> TokenCounter:
        """One per Python worker, from a broadcast of `compiled`; a task of another operator lets go of it."""
        mark = sent.value[0].mark
        if "tokens" not in HELD or HELD["tokens"][0] != mark:
            HELD["tokens"] = mark, cls(*sent.value)
        return HELD["tokens"][1]

    def _learn(self, code: int) -> None:
        """Lower case and class of a code point, asked of the library once."""
        low = self.lower.normalize_str(chr(code))
        if len(low) != 1:
            self.longer[chr(code)] = low
            self.classes[code] = OTHER
            return
        pieces = len(self.split.pre_tokenize_str(low * 2))
        kind = SPACE if pieces == 0 else NUMBER if pieces == 2 else LETTER if len(self.split.pre_tokenize_str("a" + low)) == 1 else OTHER
        special = {"'": QUOTE, **dict.fromkeys("stmd", SHORT), "r": R_OR_V, "v": R_OR_V, "l": L, "e": E}
        self.classes[code], self.lowered[code] = special.get(low, kind), ord(low)

    def _codes(self, sections: list[str]) -> np.ndarray:
        codes = np.frombuffer("".join(s + " " for s in sections).encode("utf-32-le"), "<u4")
        for code in np.unique(codes[self.classes[codes] == UNKNOWN]):
            self._learn(int(code))
        return codes

    def _words(self, sections: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, starts, lengths of words, section of words) of sections of text that hold no special token."""
        sections = [self.nfc.normalize_str(s) if COMBINING.search(s) else s for s in sections]
        codes = self._codes(sections)
        if any(ord(c) in codes for c in self.longer):
            table = str.maketrans(self.longer)
            sections = [s.translate(table) for s in sections]
            codes = self._codes(sections)
        classes = self.classes[codes]
        starts, kept = word_starts(classes), classes != SPACE
        low = self.lowered[codes]
        section = np.repeat(np.arange(len(sections)), [len(s) + 1 for s in sections])[starts]
        data = np.frombuffer(low[kept].tobytes().decode("utf-32-le").encode(), np.uint8)
        width = np.where(kept, 1 + (low >= 0x80).astype(np.int64) + (low >= 0x800) + (low >= 0x10000), 0)
        begins = (np.cumsum(width) - width)[starts]
        return data, begins, np.diff(np.append(begins, len(data))), section

    def count(self, sections: list[str]) -> np.ndarray:
        """Tokens of each section."""
        data, starts, lengths, section = self._words(sections)
        return np.bincount(section, self.words.count(data, starts, lengths), len(sections)).astype(np.int64)

    def encode(self, sections: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all sections one after another, tokens of each section)."""
        data, starts, lengths, section = self._words(sections)
        ids, counts = self.words.encode(data, starts, lengths)
        return ids, np.bincount(section, counts, len(sections)).astype(np.int64)

    def sections(self, text: str) -> tuple[list[str], list[int]]:
        """Parts of at most about SLICE_CHARS code points, and after each the id of a special token, or -1.

        Cuts are at spaces and around special tokens only.
        """
        parts = self.specials.split(text) if "<" in text else [text]
        ids = [self.special_ids[s] for s in self.specials.findall(text)] if len(parts) > 1 else []
        out, after = [], []
        for p, special in zip(parts, [*ids, -1]):
            at = 0
            while len(p) - at > SLICE_CHARS:
                cut = p.rfind(" ", at, at + SLICE_CHARS)
                cut = cut if cut > at else p.find(" ", at + SLICE_CHARS)
                if cut < 0:
                    break
                out.append(p[at:cut])
                after.append(-1)
                at = cut
            out.append(p[at:])
            after.append(special)
        return out, after

    def batches(self, texts: pa.Array) -> Iterator[tuple[list[int], list[str], list[int]]]:
        """(row, section, special id after it) of texts, in lists of about SLICE_CHARS code points; null reads as empty."""
        rows, held, after, size = [], [], [], 0
        for r in range(len(texts)):
            sections, specials = self.sections(texts[r].as_py() or "")
            for s, special in zip(sections, specials):
                rows.append(r)
                held.append(s)
                after.append(special)
                size += len(s) + 1
                if size >= SLICE_CHARS:
                    yield rows, held, after
                    rows, held, after, size = [], [], [], 0
        if held:
            yield rows, held, after


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """`docs` without the text, with n_bytes, n_tokens and over_limit (more than `limit` tokens), which replace columns of
    these names.

    Counts equal the library's on whole texts: special strings count one token, nothing is added, cut off or padded. Null
    and empty texts have 0 bytes and 0 tokens. Rows are independent: no shuffle, ties and repeats are counted alike.
    """
    made = ("n_bytes", "n_tokens", "over_limit")
    rest = [c for c in docs.columns if c != text and c not in made]
    packed = docs.select(F.struct(*rest).alias("row") if rest else F.lit(0).alias("row"), F.col(text).cast("string").alias("t"))
    kind = packed.schema["row"].dataType.simpleString()

    sent = docs.sparkSession.sparkContext.broadcast(compiled(tokenizer))

    def run(batches):
        counter = TokenCounter.get(sent)
        for batch in batches:
            texts = batch.column(1)
            totals = np.zeros(len(texts), np.int64)
            for rows, sections, after in counter.batches(texts):
                np.add.at(totals, rows, counter.count(sections) + (np.array(after) >= 0))
            n_bytes = pc.binary_length(texts.fill_null("")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, pa.array(totals)], ["row", "n_bytes", "n_tokens"])

    counted = map_batches(packed, run, f"row {kind}, n_bytes long, n_tokens long", keeps="tokens")
    return counted.select(*(F.col("row").getField(c).alias(c) for c in rest), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
