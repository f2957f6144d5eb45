"""The whole pipeline against plain versions of its five stages, one after another, over all documents."""

import hashlib
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from sorrel.llm import curriculum, decontamination as de
from sorrel.llm.queries import QUERIES, TOKENIZER

from .test_plain import plain_clusters, plain_targets

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are not here")


def plain_cuts(texts, items):
    """Texts without benchmark windows; without those that are covered for the most part."""
    windows = {}
    for t in items:
        w = de.words_of(t)
        n = min(len(w), de.WINDOW)
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(n, set()).add(tuple(w[k : k + n]))
    out = {}
    for i, t in texts.items():
        w = de.words_of(t)
        hit = {p for n, known in windows.items() for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in known for p in range(k, k + n)}
        if len(hit) <= de.MAX_COVERAGE * len(w):
            # runs of hit words, each from its first word to behind its last
            edges = [p for p in sorted(hit) if p - 1 not in hit], [p + 1 for p in sorted(hit) if p + 1 not in hit]
            out[i] = de.without_runs(t, [x for pair in zip(*edges) for x in pair]) if hit else t
    return out


def plain_copies(texts, sources):
    """How often the mix takes each document: passes over a source in a seeded order, up to its target."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in texts.items()}
    totals = Counter()
    for i in texts:
        totals[sources[i]] += size[i]
    targets = plain_targets(dict(totals), curriculum.WEIGHTS, curriculum.MOST_REPEATS)
    out = Counter()
    for s, target in targets.items():
        drawn = sorted((hashlib.md5(f"{curriculum.SEED}|{i}".encode()).hexdigest(), i) for i in texts if sources[i] == s)
        before = 0
        for _, i in drawn:
            out[i] = sum(2 * (e * totals[s] + before) + size[i] <= 2 * target and (size[i] > 0 or e == 0) for e in range(curriculum.MOST_REPEATS))
            before += size[i]
    return out


def test_pipeline_equals_plain_stages_one_after_another(spark):
    import corpus_pipeline

    got = [tuple(r) for r in corpus_pipeline.run(spark, FOLDER).orderBy("start").collect()]
    table = {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    good = {r["doc_id"] for r in QUERIES["op2_quality"](spark, FOLDER).collect() if r["predicted"]}
    alone = {g[2] for g in plain_clusters(sorted((i, table[i]["text"]) for i in good), 5, 80)}
    clean = plain_cuts({i: table[i]["text"] for i in alone}, items)
    assert len(clean) <= len(alone) < len(good) < len(table) and any(clean[i] != table[i]["text"] for i in clean)
    copies = plain_copies(clean, {i: table[i]["source"] for i in clean})
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for i, n in copies.items():
        ids = np.array([*tokenizer.encode(clean[i] or "", add_special_tokens=False).ids, 1], "<u4")
        want[i, len(ids), zlib.crc32(ids.tobytes())] += n
    assert Counter((i, n, crc) for i, _, n, crc in got) == +want
    # the files hold the rows without a gap, in the order of the curriculum and not of the ids
    starts = np.cumsum([0, *(n for _, _, n, _ in got)])
    assert [r[1] for r in got] == starts[:-1].tolist()
    assert [r[0] for r in got] != sorted(r[0] for r in got)
