"""Operators against plain Python versions, on the smallest tables and on awkward rows."""

import base64
import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from sorrel.llm import curriculum, decontamination, graph, interleave, jaccard, quality, suffix_dedup, token_files, url_vocabulary, warc, winnowing
from sorrel.llm.queries import QUERIES, TOKENIZER

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are not here")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, gram string, size int, h1 string"


def frame(spark, rows, parts=3):
    """Documents with extra columns whose names operators use inside."""
    made = [(i, t, "en", s, None, "x", 7, "y") for i, t, s in rows]
    return spark.createDataFrame(made, DOCS).repartition(parts)


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(30_000))
AWKWARD = [
    (None, None, None), (None, "a b c d e f", "s"), (1, None, "s"), (2, "", "s"), (2, "", "s"), (3, "  \n\t ", None), (4, "one", "t"), (5, LONG, "s"), (6, LONG + " end", "t"),
    (7, "same text of six words here", "s"), (7, "same text of six words here", "s"), (8, "same text of six words here", "t"), (9, "é ü ß 漢字 😀 word word word", "s"),
    (10, "na " * 500, "s"), (11, "na " * 500, "u"), (12, "x" * 3000, "u"), (-5, "Same TEXT of six words here", "s"),
]


def test_array_words_equal_a_plain_split(spark):
    from sorrel.llm import arrays as A

    texts = [t or "" for _, t, _ in AWKWARD]
    raw, offsets = A.text_bytes(__import__("pyarrow").array(texts))
    words, bounds = A.word_hashes(raw, offsets, A.SPACED)
    seen = {}
    for r, t in enumerate(texts):
        plain = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        assert len(plain) == bounds[r + 1] - bounds[r]
        for w, h in zip(plain, words[bounds[r] : bounds[r + 1]]):
            assert seen.setdefault(w, h) == h
    assert len(set(map(int, seen.values()))) == len(seen)


# 1 decontamination


def plain_hits(text, items, window=10):
    words = decontamination.words_of(text)
    hit, found = set(), set()
    for item, t in items:
        w = decontamination.words_of(t)
        runs = [w[k : k + window] for k in range(len(w) - window + 1)] if len(w) >= window else [w] * bool(w)
        for run in runs:
            for k in range(len(words) - len(run) + 1):
                if words[k : k + len(run)] == run:
                    hit.update(range(k, k + len(run)))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


ITEMS = [(1, "a b a b a b a b a b a b a"), (2, "b a b a"), (3, "x y z"), (3, "Q"), (10, " ".join(f"w{i}" for i in range(40))), (4, ""), (5, None), (None, "null item words")]


@pytest.mark.parametrize("block", [1_000_000, 9])
def test_automaton_equals_search(spark, block):
    texts = ["a b a b a b a b a b", "b a b a x y z q", "x y, Z! w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 end", "A b a b a b a b a b a b a b a b", "the null item words", "", None, "w1 w2 w3 w4 w5 w6 w7 w8 w9", " ".join(f"w{i}" for i in range(12)) + " w12 w13 " * 2]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontamination.scan(frame(spark, [(i, t, "s") for i, t in enumerate(texts)]), items, "text", block_words=block).collect()
    for r in got:
        n, hit, found = plain_hits(texts[r["doc_id"]], [("" if i is None else i, t) for i, t in ITEMS])
        runs = r["hit_runs"]
        assert (r["n_words"], sum(runs[1::2]) - sum(runs[::2]), r["hit_items"]) == (n, hit, found)
        assert runs == sorted(runs) and r["gram"] == "x"


def test_random_automata(spark):
    draw = np.random.default_rng(3)
    for _ in range(60):
        items = [(str(k), " ".join(draw.choice(list("abc"), draw.integers(1, 9)))) for k in range(4)]
        machine = decontamination.SuffixAutomaton([(i, decontamination.words_of(t), True) for i, t in items], 4)
        for _ in range(5):
            text = " ".join(draw.choice(list("abcd"), 30))
            runs, found, _ = machine.scan(decontamination.words_of(text))
            assert (30, sum(b - a for a, b in runs), sorted(found)) == plain_hits(text, items, 4)


def test_decontaminate_cuts_and_drops(spark):
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(20)))], "item_id long, text string")
    passage = ", ".join(f"W{i}" for i in range(3, 15))
    rows = [(1, f"before it. {passage} after it and many more words than the passage has, so that it stays here", "s"), (2, passage + " end", "s"), (3, None, "s"), (4, "clean  text", "s")]
    got = {r["doc_id"]: r for r in decontamination.decontaminate(frame(spark, rows), items).collect()}
    assert set(got) == {1, 3, 4} and got[3]["text"] is None and got[4]["text"] == "clean  text"
    assert got[1]["text"].startswith("before it. ") and "W3" not in got[1]["text"] and "after it" in got[1]["text"]
    empty = items.where("false")
    assert decontamination.decontaminate(frame(spark, rows), empty).count() == 4
    assert decontamination.decontaminate(frame(spark, rows).where("false"), items).count() == 0


# 2 quality


def test_scores_follow_the_vectors_and_learn(spark):
    draw = np.random.default_rng(1)
    good = [" ".join(draw.choice(["river", "stone", "quiet", "morning", "water"], 40)) for _ in range(60)]
    bad = [" ".join(draw.choice(["BUY!!", "NOW$$", "CLICK##", "FREE%%"], 40)) for _ in range(60)]
    rows = [(i, t, "s") for i, t in enumerate(good + bad)] + [(None, "x", "s"), (900, None, "s"), (901, "", "s"), (902, good[0], "s")]
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)] + [(None, 1), (5000, 1), (3, None)], "doc_id long, quality int")
    held = labels.where(~quality.held_out("doc_id"))
    model = quality.fit(frame(spark, rows), held)
    got = {r["doc_id"]: r["score"] for r in quality.score(frame(spark, rows), model).collect()}
    out = [i for i in range(120) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert out and all((got[i] >= 0.5) == (i < 60) for i in out)
    assert got[900] == got[901] and got[902] == got[0] and all(0 <= s <= 1 for s in got.values())
    again = {r["doc_id"]: r["score"] for r in quality.score(frame(spark, rows, 1), model).collect()}
    assert again == got
    assert set(r["score"] for r in quality.score(frame(spark, rows), quality.fit(frame(spark, rows), labels.where("false"))).collect()) == {0.5}


def test_totals_equal_a_count_of_the_bag():
    table = np.arange(quality.BUCKETS)
    texts = [(t or "").encode() for _, t, _ in AWKWARD[:9]] + [LONG.encode() * 20]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    sums, counts = quality.totals(raw, offsets, table)
    for t, s, c in zip(texts, sums, counts):
        ids, share = quality.bag(t)
        assert round(float((table[ids] * np.rint(share.astype(np.float64) * c)).sum())) == s


@needs_tables
def test_quality_of_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op2_quality"](spark, folder).where("held_out").collect()
    right = [(r["predicted"] == labels[r["doc_id"]], labels[r["doc_id"]]) for r in rows if r["doc_id"] in labels]
    assert np.mean([x for x, y in right if y == 1]) > 0.95 and np.mean([x for x, _ in right]) > 0.88


# 3 winnowing


def plain_winnow(data, k, window):
    if not data:
        return []
    raw = np.frombuffer(data, np.uint8)
    if len(data) < k:
        return [(int.from_bytes(hashlib.md5(data).digest()[:4], "little"), 0)]
    h = [int(x) for x in winnowing.rolling(raw, k)[: len(data) - k + 1]]
    kept = {}
    for s in range(max(1, len(h) - window + 1)):
        part = h[s : s + window]
        low = min(part)
        at = s + max(i for i, x in enumerate(part) if x == low)
        kept[at] = h[at]
    return sorted(((v, p) for p, v in kept.items()), key=lambda x: x[1])


def test_winnowing_equals_the_plain_rule(docs):
    texts = [(t or "").encode() for _, t, _ in AWKWARD if len(t or "") < 4000] + [t.encode() for t in list(docs.values())[:40]]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    for t, (h, p) in zip(texts, winnowing.winnow(raw, offsets)):
        assert list(zip(h.tolist(), p.tolist())) == plain_winnow(t, winnowing.K, winnowing.WINDOW)
        back = winnowing.unpack(winnowing.pack(h, p))
        assert back[0].tolist() == h.tolist() and back[1].tolist() == p.tolist()


def test_rolling_hash_depends_on_the_bytes_alone():
    raw = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz" * 4, np.uint8)
    h = winnowing.rolling64(raw, 16)
    assert len(set(map(int, h[:26]))) == 26 and (h[:26] == h[26:52]).all()


def test_long_rows_are_cut_without_a_trace(monkeypatch, docs):
    data = np.frombuffer("".join(docs.values()).encode()[:60_000], np.uint8)
    whole = winnowing.winnow(data, np.array([0, len(data)]))[0]
    triggers = suffix_dedup.triggers(data, np.array([0, len(data)]))
    monkeypatch.setattr(winnowing, "SLICE_BYTES", 1000)
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 1000)
    cut = winnowing.winnow(data, np.array([0, len(data)]))[0]
    assert all((a == b).all() for a, b in zip(whole, cut))
    assert all((a == b).all() for a, b in zip(triggers, suffix_dedup.triggers(data, np.array([0, len(data)]))))


def plain_edits(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for (i, t), (_, u) in zip(ordered, ordered[1:] + ordered[:1]):
        third = len(t) // 3
        out.append((i, len(t), hashlib.sha256((t[: len(t) - third] + u[:third]).encode()).hexdigest()))
    return out


@needs_tables
def test_edits_follow_descending_ids(spark, docs):
    got = QUERIES["op3_winnowing"](spark, FOLDER).collect()
    assert sorted((r[0], r[1], r[2]) for r in got) == sorted(plain_edits(list(docs.items())))
    near = [r["near_edited"] for r in got if r["n_chars"] > 600]
    assert 0.3 < np.mean(near) < 0.7 and np.mean([r["near_next"] for r in got]) < 0.2


def test_edits_of_awkward_rows(spark):
    rows = [(i, t) for i, t, _ in AWKWARD if i not in (7, 2) and i is not None] + [(None, None)]
    got = winnowing.edit_likeness(frame(spark, [(i, t, "s") for i, t in rows])).collect()
    want = plain_edits([(i, t or "") for i, t in rows])
    order = lambda x: (x[0] is None, x[0] or 0)
    assert sorted(((r[0], r[1], r[2]) for r in got), key=order) == sorted(want, key=order)
    whole = winnowing.edit_likeness(frame(spark, AWKWARD)).collect()
    assert len(whole) == len(AWKWARD)
    alone = winnowing.edit_likeness(frame(spark, [(4, "abcdef", "s")])).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0
    assert winnowing.edit_likeness(frame(spark, AWKWARD).where("false")).count() == 0
    prints = winnowing.fingerprints(frame(spark, AWKWARD)).collect()
    assert len({r["fingerprint"] for r in prints if r["text"] == "same text of six words here"}) == 1


# 4 WARC


@needs_tables
def test_derivatives_refer_to_their_response(spark, tmp_path):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    want = {r["page_id"]: r for r in pages.collect()}
    got = warc.derivatives(pages)
    rows = got.collect()
    assert Counter(r["warc_type"] for r in rows) == {"metadata": len(want), "conversion": len(want)}
    for r in rows:
        page = want[r["page_id"]]
        source = warc.response(page["page_id"], page["url"], page["html"], None)
        sha = "sha1:" + base64.b32encode(hashlib.sha1(page["html"].encode()).digest()).decode()
        assert r["refers_to"] == source["headers"]["WARC-Record-ID"] and r["source_digest"] == sha and f"WARC-Payload-Digest: {sha}\r\n" in r["source_headers"]
        assert r["block_digest"] == warc.digest(r["payload"].encode()) and r["content_length"] == len(r["payload"].encode())
        if r["warc_type"] == "conversion":
            assert "<" not in r["payload"] and "track(" not in r["payload"]
    assert len({r["record_id"] for r in rows}) == len(rows)
    warc.write_files(got, str(tmp_path / "w"))
    back = warc.read_files(spark, str(tmp_path / "w")).collect()
    assert sorted((b["headers"]["WARC-Record-ID"], b["headers"]["WARC-Refers-To"], b["payload"]) for b in back) == sorted((r["record_id"], r["refers_to"], r["payload"]) for r in rows)


def test_plain_text_of_awkward_pages(spark):
    assert warc.plain_text("<p>a &amp; b<br>c</p><script>x<y</script><!-- <p>n</p> --><style>p{}</style> d < e") == "a & b\nc\nd < e"
    assert warc.plain_text("<div>open <script>never closed") == "open"
    rows = [(None, None, None), (1, "http://x\r\nEvil: 1", "<title> T&eacute; </title><a href='/a'>l</a><a href=\"/a\">m</a>"), (1, "u", ""), (1, "u", "")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, payload string")
    got = warc.derivatives(pages).collect()
    assert len(got) == 8 and not any("\r\nEvil" in r["source_headers"] for r in got)
    meta = next(r["payload"] for r in got if r["warc_type"] == "metadata" and "Té" in r["payload"])
    assert '"links": ["/a"]' in meta
    assert warc.derivatives(pages.where("false")).count() == 0


# 5 URLs


def test_terms_need_boundaries(spark):
    urls = ["https://a.net/porn", "https://a.net/popcorn-pornx", "http://b.net/?ref=1&ref=2", "http://b.net/?ref=1&feed", "http://ADS-TRACK.net/", "no scheme ref feed", None, "", "http://x.com/fr/casino", "http://sub.example.org/es/", "http://example.org/en/15?x", "http://notexample.org/es/1", "http://h.org?a=/es/", "http://:8080/", "ftp://A.Com#/de/"]
    got = {r["url"]: r for r in url_vocabulary.judge(spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)], "page_id int, url string, rule string")).collect()}
    verdicts = [got[u]["verdict"] for u in urls]
    assert verdicts == ["block", "allow", "allow", "block", "block", "block", "allow", "allow", "allow", "block", "block", "allow", "allow", "allow", "allow"]
    assert [got[u]["rule"] for u in urls[8:13]] == ["com/fr/", "example.org/es/", "example.org/en/1", "org/", None]
    assert (got["http://h.org?a=/es/"]["host"], got["http://h.org?a=/es/"]["path"], got[None]["host"]) == ("h.org", "", "")
    assert (got["ftp://A.Com#/de/"]["host"], got["ftp://A.Com#/de/"]["path"]) == ("a.com", "")
    empty = spark.createDataFrame([], "page_id int, url string")
    assert url_vocabulary.judge(empty).count() == 0
    assert url_vocabulary.judge(spark.createDataFrame([(1, "http://a/porn")], "page_id int, url string"), strict=(), soft=()).first()["verdict"] == "allow"


# 6 token files


@pytest.mark.parametrize("values", [[], [0], [5, 5, 5], list(range(300)), sorted(int(x) for x in np.random.default_rng(2).integers(0, 1 << 40, 1000)), [0] * 100 + [1 << 50]])
def test_elias_fano_round_trip_and_select(values):
    coded = token_files.EliasFano.load(token_files.EliasFano.of(values).dump())
    assert coded.values().tolist() == values and [coded.select(i) for i in range(len(values))] == values
    if len(values) == 1000:
        assert len(coded.dump()) * 8 < len(values) * (np.log2((1 << 40) / len(values)) + 4)
    with pytest.raises(IndexError):
        coded.select(len(values))


def plain_ids(rows, in_order=False):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    start, out = 0, []
    coded = [(i, [*t.encode(x or "", add_special_tokens=False).ids, 1]) for i, x in rows]
    for i, ids in coded if in_order else sorted(coded, key=lambda r: (r[0] is not None, r[0] or 0)):
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@needs_tables
def test_token_files_hold_whole_texts(spark, docs):
    got = sorted(tuple(r) for r in QUERIES["op6_token_files"](spark, FOLDER).collect())
    assert got == plain_ids(docs.items())


def test_token_files_of_awkward_rows(spark, tmp_path):
    rows = [(i, t) for i, t, _ in AWKWARD if i not in (2, 7)]
    rows += [(100 + k, t) for k, t in enumerate(["á é ́x", "İSTANBUL ΣΑΣ's it's 'LL", "tab\tvt\x0bnbsp nel\x85fs\x1c!\x1d! z", "!!\n??\r\n\r!?", "<|endoftext|> a<|startoftext|>b", "x  " * 9])]
    rows.remove((None, "a b c d e f"))
    token_files.write(frame(spark, [(i, t, "s") for i, t in rows]), str(tmp_path / "t"), TOKENIZER, block_ids=1000)
    got = sorted((tuple(r) for r in token_files.read(spark, str(tmp_path / "t")).collect()), key=lambda r: r[1])
    assert got == plain_ids(rows)
    token_files.write(frame(spark, AWKWARD), str(tmp_path / "u"), TOKENIZER, width=4)
    assert token_files.read(spark, str(tmp_path / "u")).count() == len(AWKWARD)
    token_files.write(frame(spark, AWKWARD).where("false"), str(tmp_path / "e"), TOKENIZER)
    assert token_files.read(spark, str(tmp_path / "e")).count() == 0


def test_marks_after_letters_that_decompose(spark, tmp_path):
    words = ["TALİ.", "xİ,", "ka\u0958.", "ka\u0958,", "a\ufb2a.", "a\ufb2a,", "ΣΑΣ.", "é,", "e\u0301.", "漢字,", "Word.", "word,"]
    rows = [(k, f"a {w} b") for k, w in enumerate(words)] + [(100, " ".join(words))]
    token_files.write(frame(spark, [(i, t, "s") for i, t in rows]), str(tmp_path / "t"), TOKENIZER)
    got = sorted((tuple(r) for r in token_files.read(spark, str(tmp_path / "t")).collect()), key=lambda r: r[1])
    assert got == plain_ids(rows)


# 7 shards


def check_shards(rows, shards):
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@needs_tables
def test_shards_match_the_mixture(spark, docs):
    rows = QUERIES["op7_interleaved_shards"](spark, FOLDER).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in docs.items()}
    check_shards(rows, 8)
    total, per = Counter(r["source"] for r in rows), Counter((r["source"], r["shard"]) for r in rows)
    assert all(abs(per[s, k] - n / 8) <= 2 for s, n in total.items() for k in range(8))
    plain = []
    for s in total:
        mine = sorted((hashlib.md5(f"{interleave.SEED}|{r['doc_id']}".encode()).hexdigest(), r["doc_id"]) for r in rows if r["source"] == s)
        plain += [((k + 0.5) / len(mine), s, *m) for k, m in enumerate(mine)]
    plain.sort()
    assert {r["doc_id"]: r["shard"] for r in rows} == {p[3]: k * 8 // len(plain) for k, p in enumerate(plain)}


def test_shards_of_awkward_rows(spark):
    rows = frame(spark, AWKWARD).select("doc_id", "source", interleave.text_size("text").alias("size"))
    got = interleave.interleave(rows, "source", "doc_id", 4).collect()
    assert len(got) == len(AWKWARD)
    check_shards(got, 4)
    assert interleave.interleave(rows.where("false"), "source", "doc_id", 4).count() == 0
    check_shards(interleave.interleave(rows.limit(2), "source", "doc_id", 5).collect(), 5)


# 8 Jaccard join


def plain_clusters(rows, size, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    near = [[j for j in range(len(rows)) if j != i and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = set(near[todo.pop()]) - seen
            seen |= new
            todo += new
        keys = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(sets[i]), min(keys) if keys and sets[i] else rows[i][0], len(near[i])))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, *r[1:2]))


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80), (2, 50), (1, 100)])
def test_join_equals_all_pairs(spark, size, percent):
    draw = np.random.default_rng(size)
    rows = [(i, t) for i, t, _ in AWKWARD if len(t or "") < 4000]
    base = [f"v{k}" for k in draw.integers(0, 400, 120)]
    for k in range(60):
        words = list(base)
        for _ in range(int(draw.integers(0, 9))):
            words[int(draw.integers(0, len(words)))] = f"n{int(draw.integers(0, 1000))}"
        rows.append((100 + k, " ".join(words[: int(draw.integers(90, 121))])))
    got = jaccard.clusters(frame(spark, [(i, t, "s") for i, t in rows]), size=size, percent=percent).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: (r[0] is None, r[0] or 0, r[1])) == plain_clusters(rows, size, percent)


def test_large_groups_meet_in_blocks(spark, monkeypatch):
    draw = np.random.default_rng(4)
    monkeypatch.setattr(jaccard, "BLOCK_NODES", 7)
    base = [f"v{k}" for k in range(60)]
    rows = []
    for k in range(50):
        words = list(base)
        for _ in range(int(draw.integers(0, 4))):
            words[int(draw.integers(0, 60))] = f"n{int(draw.integers(0, 100))}"
        rows.append((k, " ".join(words)))
    got = jaccard.clusters(frame(spark, [(i, t, "s") for i, t in rows]), size=2, percent=85).collect()
    assert sorted(tuple(r) for r in got) == plain_clusters(rows, 2, 85)


def test_one_row_of_each_group_stays(spark):
    rows = frame(spark, AWKWARD)
    got = jaccard.one_per_group(rows)
    assert got.columns == rows.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)
    texts = [t for _, t in kept]
    assert [i for i, t in kept if t and t.lower().startswith("same")] == [-5]
    assert texts.count(LONG) + texts.count(LONG + " end") == 1 and texts.count("na " * 500) == 1 and "one" in texts
    assert sum(not (t or "").strip() for t in texts) == 5
    assert jaccard.one_per_group(rows.where("false")).count() == 0
    assert jaccard.clusters(rows.where("false")).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 200)]
    got = dict(tuple(r) for r in graph.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect())
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {300: 200, 200: 200}


# 9 mixture


def plain_targets(sizes, weights, most):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: Fraction(weights[k % len(weights)]) for k, s in enumerate(order)}
    total, capped = Fraction(sum(sizes.values())), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = sum(w[s] for s in order if s not in capped)
        over = {s for s in order if s not in capped and left * w[s] / free > most * sizes[s]}
        if not over:
            return {s: Fraction(most * sizes[s]) if s in capped else left * w[s] / free for s in order}
        capped |= over


def test_targets_stop_and_reshare(spark):
    draw = np.random.default_rng(9)
    for n in (1, 2, 5, 12):
        sizes = {**{f"s{k}": int(draw.integers(0, 2000) ** 2 // 400) for k in range(n)}, None: 50}
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in curriculum.source_targets(rows).collect()}
        want = plain_targets(sizes, [5, 2, 1], 3)
        assert all(abs(got[s] - want[s]) < 1e-6 for s in sizes) and abs(sum(got.values()) - sum(sizes.values())) < 1e-6
    assert all(r["target"] == 0 for r in curriculum.source_targets(spark.createDataFrame([("a", 0), (None, 0)], "source string, source_size long")).collect())


def test_moments_invert_the_integral(spark):
    for curve in curriculum.CURVES + (((0.0, 0.0), (0.3, 2.0), (1.0, 0.0)),):
        rows = spark.range(101).select((F.col("id") / 100).alias("s")).withColumn("t", curriculum.moment(F.col("s"), curve)).collect()
        xs = np.linspace(0, 1, 200_001)
        ws = np.interp(xs, *zip(*curve))
        area = np.concatenate([[0], np.cumsum((ws[1:] + ws[:-1]) / 2)])
        area /= area[-1]
        assert all(abs(np.interp(r["t"], xs, area) - r["s"]) < 1e-6 for r in rows)
        assert [r["t"] for r in rows] == sorted(r["t"] for r in rows)
    with pytest.raises(ValueError):
        curriculum.segments(((0.0, 0.0), (1.0, 0.0)))


def test_mix_takes_near_the_targets_in_order(spark):
    rows = [(i, "word " * (i % 17 + 1), f"s{i % 3 if i % 10 else 3}") for i in range(400)] + AWKWARD
    docs = frame(spark, rows)
    narrow = docs.select("doc_id", "source", curriculum.word_count("text").alias("words"))
    plan = curriculum.plan(narrow, "source", "doc_id", "words").collect()
    assert len(plan) == len(rows)
    taken, target, biggest = Counter(), {}, Counter()
    for r in plan:
        taken[r["source"]] += r["copies"] * r["words"]
        target[r["source"]] = r["target"]
        biggest[r["source"]] = max(biggest[r["source"]], r["words"])
        assert r["copies"] <= 3 and len(r["moments"]) == r["copies"] and r["moments"] == sorted(r["moments"])
    assert all(abs(taken[s] - target[s]) <= biggest[s] for s in target)
    mixed = curriculum.mix(docs)
    assert mixed.columns == docs.columns
    out = Counter((r["doc_id"], r["text"], r["source"]) for r in mixed.collect())
    want = Counter()
    texts = defaultdict(list)
    for i, t, s in rows:
        texts[i, s, len((t or "").split())].append(t)
    for r in plan:
        want[r["doc_id"], r["source"], r["words"]] += r["copies"]
    got = Counter()
    for (i, t, s), n in out.items():
        got[i, s, len((t or "").split())] += n
    assert got == +want
    assert curriculum.mix(docs.where("false")).count() == 0


# 10 prefix-free parsing


def plain_runs(texts, length):
    at = defaultdict(list)
    for k, t in enumerate(texts):
        for s in range(len(t) - length + 1):
            at[t[s : s + length]].append((k, s))
    hit = [bytearray(len(t)) for t in texts]
    for places in at.values():
        if len(places) > 1:
            for k, s in places:
                hit[k][s : s + length] = b"\1" * length
    out = []
    for t, h in zip(texts, hit):
        rest = bytes(b for b, x in zip(t, h) if not x)
        out.append((len(t), sum(h), len(re.findall(rb"\x01+", bytes(h))), hashlib.sha256(rest).hexdigest()))
    return out


@needs_tables
def test_repeats_equal_all_strings(spark, docs):
    ids = sorted(docs)
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op10_prefix_free_parsing"](spark, FOLDER).collect()}
    assert [got[i] for i in ids] == plain_runs([docs[i].encode() for i in ids], 200)


@pytest.mark.parametrize("limit", [20_000, 1])
def test_repeats_of_mosaics(spark, limit):
    draw = np.random.default_rng(limit)
    pool = bytes(draw.integers(97, 123, 4000).astype(np.uint8)).decode()
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(int(draw.integers(1, 7))):
            s, n = int(draw.integers(0, 3600)), int(draw.integers(20, 420))
            parts += [pool[s : s + n], bytes(draw.integers(65, 91, int(draw.integers(0, 40))).astype(np.uint8)).decode()]
        texts.append("".join(parts))
    texts += ["z" * 199, "z" * 200, "y" * 201, "na" * 300, "", "é" * 150, "\0" * 250]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, None, "s"), (None, texts[0], "s"), (3, texts[3], "s")]
    got = suffix_dedup.deduplicate(frame(spark, rows, 5), group_limit=limit).drop("kept").collect()
    want = plain_runs([(t or "").encode() for _, t, _ in rows], 200)
    key = lambda r: (str(r[0]), r[1:])
    assert sorted((tuple(r) for r in got), key=key) == sorted(((i, *w) for (i, _, _), w in zip(rows, want)), key=key)


def test_repeats_of_awkward_rows(spark):
    rows = [r for r in AWKWARD if r[1] is None or len(r[1]) < 4000] + [(50, LONG[:9000], "s"), (51, "q" + LONG[2000:9000], "s")]
    got = suffix_dedup.deduplicate(frame(spark, rows)).collect()
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got)
    got = [(r["doc"], *r[2:]) for r in got]
    want = plain_runs([(t or "").encode() for _, t, _ in rows], 200)
    key = lambda r: (str(r[0]), r[1:])
    assert sorted((tuple(r) for r in got), key=key) == sorted(((i, *w) for (i, _, _), w in zip(rows, want)), key=key)
    assert suffix_dedup.deduplicate(frame(spark, rows).where("false")).count() == 0


# the pipeline


@needs_tables
def test_pipeline_stages_equal_plain_ones(spark, docs):
    import corpus_pipeline

    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    good = steps["quality"](spark, table, FOLDER)
    assert good.columns == table.columns
    scores = {r["doc_id"]: r["predicted"] for r in QUERIES["op2_quality"](spark, FOLDER).collect()}
    good_ids = {r["doc_id"] for r in good.collect()}
    assert good_ids == {i for i, p in scores.items() if p}
    alone = steps["near copies"](spark, table, FOLDER)
    groups = plain_clusters(sorted(docs.items()), 5, 80)
    assert alone.columns == table.columns and {r["doc_id"] for r in alone.collect()} == {g[2] for g in groups}
    clean = steps["decontamination"](spark, table, FOLDER)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    after = {r["doc_id"]: r for r in clean.collect()}
    assert clean.columns == table.columns and all(r["n_chars"] == len(r["text"]) for r in after.values())
    for i in sorted(docs)[:60]:
        n, hit, _ = plain_hits(docs[i], items)
        assert (i in after) == (hit <= decontamination.MAX_COVERAGE * n)
        assert hit or after[i]["text"] == docs[i]
    ids = sorted((tuple(r) for r in steps["token files"](spark, clean, FOLDER).collect()), key=lambda r: r[1])
    order = [r["doc_id"] for r in curriculum.schedule(clean).orderBy("moment", "doc_id").collect()]
    assert [r[0] for r in ids] == order != sorted(order)
    assert ids == plain_ids([(i, after[i]["text"]) for i in order], in_order=True)


def test_schedules_follow_the_curves(spark):
    rows = [(i % 40, f"{'word ' * (i % 40 % 7 + 1)}{i % 40}", f"s{i % 40 % 2}") for i in range(120)]
    early, late = ((0.0, 2.0), (1.0, 0.0)), ((0.0, 0.0), (1.0, 2.0))
    for curves, first in (((early, late), "s0"), ((late, early), "s1")):
        got = curriculum.schedule(frame(spark, rows), curves=curves).orderBy("moment").collect()
        assert len(got) == 120 and all(0 <= r["moment"] <= 1 for r in got)
        half = [r for r in got if r["moment"] < 0.5]
        # the early source has asked for three quarters of its tokens by the middle, the late one for one quarter
        assert sum(r["source"] == first for r in half) > 2 * sum(r["source"] != first for r in half)
        # copies lie in passes: the first of every document before the second of any, within a source
        for s in ("s0", "s1"):
            ids = [r["doc_id"] for r in got if r["source"] == s]
            assert sorted(ids[:20]) == sorted(set(ids)) == sorted(ids[20:40])
    awkward = curriculum.schedule(frame(spark, AWKWARD))
    assert awkward.count() == len(AWKWARD) and awkward.where("moment IS NULL").isEmpty()
    assert curriculum.schedule(frame(spark, AWKWARD).limit(0)).count() == 0


def test_equal_rows_take_their_moments_one_each(spark, tmp_path):
    rows = [(1, "a b", "s")] * 3 + [(1, "c d", "s")] * 2 + [(None, "a b", "s")] * 2 + [(None, None, None)] * 2 + [(1, "a b", None), (2, "", "s"), (2, None, "s")]
    docs = frame(spark, rows)
    docs.write.parquet(str(tmp_path / "d"))
    for got in (curriculum.schedule(docs), curriculum.schedule(spark.read.parquet(str(tmp_path / "d")), stored=True)):
        got = got.collect()
        assert sorted(map(str, ((r["doc_id"], r["text"], r["source"]) for r in got))) == sorted(map(str, rows))
        # rows with words lie at moments of their own within a source
        moments = [r["moment"] for r in got if r["source"] == "s" and r["text"]]
        assert len(set(moments)) == len(moments) == 7


def test_token_stage_stores_no_text_again(spark, tmp_path):
    import corpus_pipeline
    from sorrel.session import shared_dir

    rng = np.random.default_rng(3)
    texts = [" ".join(rng.bytes(6).hex() for _ in range(200)) for _ in range(300)]
    frame(spark, [(i, t, f"s{i % 3}") for i, t in enumerate(texts)]).write.parquet(str(tmp_path / "d"))
    before = set(os.listdir(shared_dir(spark)))
    corpus_pipeline.write_tokens(spark, spark.read.parquet(str(tmp_path / "d")), FOLDER)
    made = [n for n in os.listdir(shared_dir(spark)) if n not in before and not n.startswith("tokens-")]
    held = sum(os.path.getsize(os.path.join(at, f)) for n in made for at, _, files in os.walk(os.path.join(shared_dir(spark), n)) for f in files)
    assert made and held < sum(map(len, texts)) / 4


def test_token_files_in_another_order(spark, tmp_path):
    rows = [(k, float(p), "ab " * int(p)) for k, p in [(5, 1), (3, 2), (9, 0), (None, 1.5), (5, 4), (4, 3), (8, 3)]] + [(7, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, at double, text string").repartition(3)
    token_files.write(docs, str(tmp_path / "a"), TOKENIZER, block_ids=5, order="at")
    got = sorted((tuple(r) for r in token_files.read(spark, str(tmp_path / "a")).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [7, 9, 5, None, 3, 4, 8, 5]
    assert got == plain_ids([(i, t) for i, _, t in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0] or 0))], in_order=True)


NAMES = ["n_words", "hit_runs", "hit_items", "longest_match", "rank", "place", "weight", "_h", "r1", "k1", "single", "again", "_label", "uid", "drawn", "stratum", "fraction", "in_0", "in_1", "o", "t", "_key"]


def test_columns_of_any_name_pass_through(spark):
    """One table whose extra columns have the names that operators use inside; their values come out unchanged."""
    docs = spark.createDataFrame([(i, t, s) for i, t, s in AWKWARD], "doc_id long, text string, source string").repartition(3)
    docs = docs.select("doc_id", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in NAMES], "text", "source")
    items = spark.createDataFrame([("a", LONG[:400]), ("b", "same text of six words here")], "item_id string, text string")
    labels = spark.createDataFrame([(4, 1), (5, 0), (9, 1)], "doc_id long, quality int")
    assert quality.fit(docs, labels)[0].any()
    for got in (decontamination.decontaminate(docs, items), jaccard.one_per_group(docs), interleave.interleave(docs, "source", "doc_id", 3).drop("shard", "slot")):
        assert got.columns == docs.columns
        rows = got.collect()
        assert rows and all(r[c] == (None if r["doc_id"] is None else f"{c}{r['doc_id']}") for r in rows for c in NAMES)


CLASHES = ["uid", "row", "weight", "turn", "drawn", "_h", "moments", "copies", "target", "size", "at", "place", "key"]


def test_mix_keeps_columns_of_any_name(spark):
    docs = frame(spark, AWKWARD).select("doc_id", "text", "source", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in CLASHES], F.create_map(F.lit("a"), "doc_id").alias("m"))
    plain = {r["doc_id"]: r for r in docs.collect()}
    for got in (curriculum.mix(docs), curriculum.schedule(docs).drop("moment")):
        assert got.columns == docs.columns
        assert all(r[c] == (None if r["doc_id"] is None else f"{c}{r['doc_id']}") for r in got.collect() for c in CLASHES) and plain


@needs_tables
def test_pipeline_runs(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert rows and sum(r["n_tokens"] for r in rows) == max(r["start"] + r["n_tokens"] for r in rows)
