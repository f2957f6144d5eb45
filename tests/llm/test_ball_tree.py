"""Ranked search against plain scoring of all documents."""

import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest

from sorrel.llm import ball_tree

FOLDER = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, score int, rank string, k int, q string, uid long, n string, item_id int"


def frame(spark, rows):
    """Documents with extra columns whose names the operator uses inside."""
    return spark.createDataFrame([(i, t, 1, "r", 2, "q", 3, "n", 4) for i, t in rows], DOCS).repartition(3)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 5, 6, "b") for i, t in rows], "item_id string, text string, uid int, t int, block string").repartition(2)


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(rows, items, k=10):
    docs = [(i, Counter(terms(t)), len(terms(t))) for i, t in rows]
    n_docs, total = sum(n > 0 for *_, n in docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in items:
        scored = []
        for i, c, n in docs:
            m = 100 - 75 + ((75 * n * n_docs) // max(total, 1))
            score = sum(weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_search_equals_scoring_all(spark, monkeypatch):
    monkeypatch.setattr(ball_tree, "TREE_ROWS", 40)
    monkeypatch.setattr(ball_tree, "LEAF_ROWS", 3)
    draw = random.Random(5)
    words = [f"w{k}" for k in range(80)]
    weights = [1 / (k + 1) for k in range(80)]
    rows = [(i, " ".join(draw.choices(words, weights, k=draw.randint(1, 60)))) for i in range(300)]
    items = [(f"i{j}", " ".join(draw.choices(words, k=draw.randint(1, 12)))) for j in range(20)]
    want = plain(rows, items)
    assert found(ball_tree.search(frame(spark, rows), items_of(spark, items))) == want
    # many small blocks of queries give the same
    assert found(ball_tree.search(frame(spark, rows), items_of(spark, items), item_bytes=60)) == want


def test_search_of_awkward_rows(spark):
    rows = [(None, "alpha beta"), (None, "alpha beta"), (1, None), (2, ""), (3, " .,;\n"), (4, "Alpha BETA alpha"), (5, "alpha beta"), (5, "alpha beta"), (6, "é漢字 😀 Éa alpha"), (7, "gamma " * 50_000),
            (-8, "alpha beta"), *((k, "copy of one text") for k in range(100, 130))]
    items = [(None, "alpha"), ("a", None), ("b", ""), ("c", "alpha ALPHA beta beta"), ("c", "alpha ALPHA beta beta"), ("d", "nowhere"), ("e", "copy text"), ("f", "é漢字 éa gamma 😀")]
    docs, asked = frame(spark, rows), items_of(spark, items)
    assert found(ball_tree.search(docs, asked)) == plain(rows, items)
    assert found(ball_tree.search(docs, asked, k=3)) == plain(rows, items, 3)
    assert found(ball_tree.search(docs.limit(0), asked)) == [] == found(ball_tree.search(docs, asked.limit(0)))


def test_keys_may_be_strings(spark):
    rows = [("b", "one two"), ("a", "one two"), (None, "one"), ("c", "three")]
    got = ball_tree.search(spark.createDataFrame(rows, "doc_id string, text string"), items_of(spark, [("x", "one")]))
    assert [r.doc_id for r in got.orderBy("rank").collect()] == [None, "a", "b"]


def test_bounds_hold_and_subtrees_are_left_out():
    """Documents about one topic each: no bound is below a score of its subtree, and far topics are not scored."""
    rng = np.random.default_rng(1)
    texts = [" ".join(f"t{topic}x{w}" for w in rng.integers(0, 12, 30)) for topic in range(20) for _ in range(64)]
    queries = ball_tree.Queries([" ".join(f"t{topic}x{w}" for w in range(12)) for topic in range(20)])
    vocabulary = {h: c for c, h in enumerate(queries.terms.tolist())}
    cols = [np.array(sorted(vocabulary[h] for h in ball_tree.Queries([t]).terms.tolist())) for t in texts]
    lengths = np.array([len(c) for c in cols])
    values = rng.integers(1, 10**10, lengths.sum())
    rows = ball_tree.Rows(np.arange(len(texts)), np.concatenate([[0], np.cumsum(lengths)]), np.concatenate(cols), values)
    tree = ball_tree.BallTree(rows, len(queries.terms), queries)
    dense = np.zeros((20, len(queries.terms)), np.int64)
    for q in range(20):
        dense[q, queries.columns[q]] = queries.times[q]

    def best_below(node):
        if tree.children[node]:
            scores = np.maximum(*(best_below(c) for c in tree.children[node]))
        else:
            scores = np.array([tree.leaves[node].times(dense[q]).max() for q in range(20)])
        assert (tree.bounds[node] >= scores).all()
        return scores

    best_below(0)
    scored = sum(tree.search(q, 10, [], list(range(len(texts)))) for q in range(20))
    assert scored < 20 * len(texts) / 2


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are not here")
def test_query_equals_scoring_all(spark):
    from sorrel.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    assert found(QUERIES["op11_ball_tree_search"](spark, FOLDER)) == plain(rows, items)
