"""Token counts against the tokenizers library on whole texts."""

import os
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from sorrel.llm import token_counts
from sorrel.llm.queries import QUERIES, TOKENIZER

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def counter():
    return token_counts.TokenCounter(*token_counts.compiled(TOKENIZER))


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def encoded(counter, text):
    """Ids of a text; its counts have to agree."""
    sections, after = counter.sections(text)
    ids, counts = counter.encode(sections)
    assert (counts == counter.count(sections)).all()
    ends = np.cumsum(counts)
    return [x for a, b, special in zip(ends - counts, ends, after) for x in [*ids[a:b].tolist(), *([special] if special >= 0 else [])]]


PARTS = [
    "'", "s", "t", "re", "ve", "ll", "'ll", "'re", "m", "d", "a", "e", "l", "r", "v", "1", "2", "!", "é", "İ", "Σ", "ς", " ", "  ", "\n", " ", "́", "é", "漢", "字",
    "😂😂", "<|endoftext|>", "<|startoftext|>", "<|", "ﬁ", "क़", "क़", "ab", "the", "ing", "’", "٣", "½", "_", "-", "​", "　", "ǅ", "ẞ", "K", "한", "\x00", "\U0010ffff",
]


def test_counts_of_random_mixtures(counter, library):
    draw = random.Random(1)
    texts = ["".join(draw.choices(PARTS, k=draw.randint(1, 40))) for _ in range(4000)]
    assert [encoded(counter, t) for t in texts] == [library(t) for t in texts]


def test_long_words_are_cut_without_a_trace(counter, library):
    draw = random.Random(2)
    texts = ["a" * 5000, "aaab" * 999, "😂" * 3000, "=" * 4001, "internationalwomensday" * 300, *("".join(draw.choices(letters, k=9000)) for letters in ("ab", "aeiotnsr", "thequickbrownfoxé"))]
    assert [encoded(counter, t) for t in texts] == [library(t) for t in texts]


def test_states_may_be_thrown_away(counter, library, monkeypatch):
    monkeypatch.setattr(token_counts, "MOST_STATES", 20)
    monkeypatch.setattr(token_counts, "SLICE_CHARS", 64)
    texts = ["some words of several kinds, it's they'll we've 12 " * 20, "x" * 700 + " y", "İstanbul " * 30]
    assert [encoded(counter, t) for t in texts] == [library(t) for t in texts]


def test_scan_equals_reading_from_the_start():
    rng = np.random.default_rng(3)
    for n in (1, 255, 256, 257, 5000):
        classes = rng.integers(0, 9, n).astype(np.uint8)
        classes[-1] = token_counts.SPACE
        state, want = 0, np.zeros(n, bool)
        for k, c in enumerate(classes):
            out = token_counts.OUTPUT[16 * state + c]
            want[k] |= bool(out & token_counts.START)
            if out & token_counts.START_BEFORE:
                want[k - 1] = True
            state = token_counts.NEXT[16 * state + c]
        assert (token_counts.word_starts(classes) == want).all()


def test_other_kinds_of_file_are_refused(tmp_path):
    import public_tokenizers

    with pytest.raises(ValueError):
        token_counts.compiled(public_tokenizers.path("byte_bpe_50k.json"))


def test_counts_of_awkward_rows(spark, library):
    rows = [(None, None), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "it's <|endoftext|>'S end"), (6, "word " * 60_000), (7, "x" * 30_000), (-8, "é漢字 😀 İ")]
    docs = spark.createDataFrame([(i, t, 5, "n", "r") for i, t in rows], "doc_id long, text string, n_tokens int, row string, t string").repartition(3)
    got = token_counts.count_tokens(docs, TOKENIZER)
    assert got.columns == ["doc_id", "row", "t", "n_bytes", "n_tokens", "over_limit"]
    found = sorted((tuple(r) for r in got.collect()), key=repr)
    want = [(i, "n", "r", len((t or "").encode()), len(library(t)), len(library(t)) > 2048) for i, t in rows]
    assert found == sorted(want, key=repr)
    assert token_counts.count_tokens(docs.limit(0), TOKENIZER).count() == 0
    assert token_counts.count_tokens(docs.select("text"), TOKENIZER).columns == ["n_bytes", "n_tokens", "over_limit"]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are not here")
def test_query_equals_the_library(spark, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op13_token_counts"](spark, FOLDER).collect())
    assert got == sorted((i, len((t or "").encode()), len(library(t)), len(library(t)) > 2048) for i, t in rows)
