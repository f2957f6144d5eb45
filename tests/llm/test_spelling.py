"""Spelling variants against a plain version over all pairs of words."""

import os
import random
import re
import zlib
from collections import Counter

import pytest

from sorrel.llm import spelling

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, word string, n string, r int, p int, key string, root string, h string"


def docs_of(spark, rows):
    """Documents with extra columns whose names the operator uses inside."""
    return spark.createDataFrame([(i, t, "w", "n", 1, 2, "k", "r", "h") for i, t in rows], DOCS).repartition(3)


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(rows):
    count = Counter()
    for i, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            count[word] += len(word) >= 6
    known = {w: n for w, n in count.items() if n >= 5}
    near = {w: {x for x in known if abs(len(x) - len(w)) < 2 and one_apart(x, w)} for w in known}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-known[x], x), default=None)
        if best and known[best] >= 5 * known[w]:
            form[w] = best
    out = []
    for w in known:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, known[w], len(near[w]), known.get(form.get(w))))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_variants_equal_all_pairs(spark):
    draw = random.Random(3)
    words = ["".join(draw.choice("abé") for _ in range(draw.randint(5, 8))) for _ in range(300)]
    rows = [(i, " ".join(draw.choices(words, weights=[k * k + 1 for k in range(300)], k=120))) for i in range(60)]
    rows.append((60, "lantern " * 200 + "lanterm " * 30 + "lantarm " * 6))
    want = plain(rows)
    assert found(spelling.variants(docs_of(spark, rows))) == want
    # a chain of more than one step has been followed
    assert any(form and form != root for _, form, root, *_ in want)


def test_variants_of_awkward_rows(spark):
    long = "ab" * 400
    rows = [(None, "Nullid nullid NULLID nullid nullid"), (1, None), (2, ""), (2, ""), (3, "...\n\t 12345 漢字漢字漢字"), (4, "letter " * 25), (4, "letter " * 25), (5, "lettér " * 7 + "lexter " * 6 + "leter letterr " * 6),
            (6, "aaaaaaa " * 40 + "aaaaaa " * 8 + "aaaaaaaa " * 6), (7, f"{long} {long}a " * 6), (-8, "×÷×÷×÷ " * 9 + "×÷×÷×a " * 60)]
    assert found(spelling.variants(docs_of(spark, rows))) == plain(rows)
    assert spelling.variants(docs_of(spark, [(1, None)]).limit(0)).count() == 0


def test_each_pair_comes_once(spark):
    rows = [("aabbccdd", 5), ("abbccdd", 5), ("aabbccd", 7), ("aabbccde", 9), ("xaabbccdd", 5), ("qqqqqq", 5)]
    got = sorted((r.a, r.b) for r in spelling.near_pairs(spark.createDataFrame(rows, "word string, n long")).collect())
    assert got == sorted((a, b) for a, _ in rows for b, _ in rows if a < b and one_apart(a, b))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are not here")
def test_query_equals_the_plain_version(spark):
    from sorrel.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert found(QUERIES["op12_spelling_variants"](spark, FOLDER)) == plain(rows)
