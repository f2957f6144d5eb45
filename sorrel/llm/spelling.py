"""Spelling variants: words of a corpus that differ by one letter, found in a reduced alphabet and grouped under a root.

Letters are hashed to a few symbols. Two words one edit apart have reduced words at most one edit apart, so the one-edit
neighbourhood of every reduced word, joined with the reduced vocabulary, misses no pair; the words themselves decide. A
pair of reduced words is needed from one side only: deletions of the longer one, replacements by a larger symbol, and the
word unchanged (the edit may lie inside a symbol). As the place of the edit is known, the half of the word without it must
agree letter by letter, and is part of the join key. That keeps a frequent reduced word from being one group.

All steps are DataFrame functions. A neighbourhood costs the square of a word's length; words here are runs of letters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sorrel.llm.rows import written

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))
SYMBOLS = "0123"
SLIP = 199
LEAST_LENGTH, LEAST_COUNT = 6, 5
RATIO = 5


def reduced(word: Column) -> Column:
    """The word in the reduced alphabet: a symbol per letter, by a multiplicative hash of the letter."""
    return F.translate(word, LETTERS, "".join(SYMBOLS[(ord(c) * 0x9E3779B1 >> 16) % len(SYMBOLS)] for c in LETTERS))


def _without(s: Column, at: Column) -> Column:
    """`s` without the code point at place `at`, from 0."""
    return F.concat(F.substr(s, F.lit(1), at), F.substr(s, at + 2))


def vocabulary(docs: DataFrame, text: str = "text", key: str = "doc_id", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of at least `least_length` code points that occur at least `least_count` times.

    A word is a lower-cased run (A-Z only). Where SLIP divides the CRC-32 h of "<key>:<run>", the code point at h modulo
    the run's length is left out first: known misspellings, the same in every run. A null text has no words, a null key
    reads as empty, equal rows count each. Other columns are not looked at.
    """
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.explode(F.regexp_extract_all(F.col(text).cast("string"), F.lit(RUN), F.lit(0))).alias("run"))
    lowered = runs.where(F.char_length("run") >= least_length).select("k", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = lowered.withColumn("h", F.crc32(F.concat("k", F.lit(":"), "run").cast("binary")))
    slipped = _without(F.col("run"), (F.col("h") % F.char_length("run")).cast("int"))
    words = hashed.select(F.when(F.col("h") % SLIP == 0, slipped).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _key(side: str, form: Column, half: Column) -> Column:
    return F.xxhash64(F.lit(side), form, half)


def _halves(word: Column, form: Column) -> list[Column]:
    """Keys of a word as it stands: its reduced form with its first half, and with its second."""
    cut = F.floor(F.char_length(word) / 2).cast("int")
    return [_key("first", form, F.substr(word, F.lit(1), cut)), _key("second", form, F.substr(word, cut + 1))]


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): each unordered pair of different words one insertion, deletion or replacement apart, once."""
    w, r, p, c = F.col("word"), F.col("r"), F.col("p"), F.col("c")
    base = words.select("word", "n", reduced(w).alias("r"))
    whole = base.select("word", "n", F.explode(F.array(*_halves(w, r))).alias("key"))

    places = base.withColumn("length", F.char_length("word")).select("*", F.explode(F.sequence(F.lit(0), F.col("length") - 1)).alias("p"))
    drawn = places.select("*", F.explode(F.array(F.lit(""), *(F.lit(s) for s in SYMBOLS[1:]))).alias("c"))
    drawn = drawn.where((c == "") | (c > F.substr(r, p + 1, F.lit(1))))
    # the halves are those of the word that is sought: one shorter after a deletion
    cut = F.floor((F.col("length") - (c == "").cast("int")) / 2).cast("int")
    form = F.concat(F.substr(r, F.lit(1), p), c, F.substr(r, p + 2))
    kept_second = F.substr(w, cut + 1 + (c == "").cast("int"))
    key = F.when(p < cut, _key("second", form, kept_second)).otherwise(_key("first", form, F.substr(w, F.lit(1), cut)))
    edited = drawn.select("word", "n", key.alias("key"))

    left = edited.unionByName(whole).select("key", F.col("word").alias("x"), F.col("n").alias("x_n"))
    right = whole.select("key", F.col("word").alias("y"), F.col("n").alias("y_n"))
    found = left.join(right, "key").where(F.levenshtein("x", "y", 1) == 1)
    first = F.col("x") < F.col("y")
    ends = [F.when(first, F.col(i)).otherwise(F.col(j)).alias(name) for i, j, name in (("x", "y", "a"), ("x_n", "y_n", "a_n"), ("y", "x", "b"), ("y_n", "x_n", "b_n"))]
    return found.select(*ends).dropDuplicates(["a", "b"])


def follow(links: DataFrame) -> DataFrame:
    """(word, root): the last word of every chain word -> form; chains have no loops, as n rises along them.

    Every round doubles the steps taken and is written; the count along a chain grows by RATIO a step, so the rounds
    grow with the logarithm of the logarithm of the largest count.
    """
    to = written(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = to.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = to.join(ahead, "root", "left")
        if step.where("further IS NOT NULL").limit(1).count() == 0:
            return to
        to = written(step.select("word", F.coalesce("further", "root").alias("root")), "roots")


def variants(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word of the vocabulary.

    `form` is the near word of largest count (ties: smallest in code point order) if that count is at least RATIO times
    the word's own, else null; `root` is where forms lead, the word itself without one. No documents, no rows.
    """
    words = written(vocabulary(docs, text, key), "words")
    pairs = near_pairs(words)
    sides = F.array(F.struct(F.col("a").alias("word"), F.col("a_n").alias("own"), (-F.col("b_n")).alias("m"), F.col("b").alias("other")),
                    F.struct(F.col("b").alias("word"), F.col("b_n").alias("own"), (-F.col("a_n")).alias("m"), F.col("a").alias("other")))
    best = pairs.select(F.inline(sides)).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct("m", "other")).alias("best"), F.first("own").alias("own"))
    fits = -F.col("best.m") >= RATIO * F.col("own")
    near = written(best.select("word", "n_near", F.when(fits, F.col("best.other")).alias("form"), F.when(fits, -F.col("best.m")).alias("form_n")), "near")
    roots = follow(near.where("form IS NOT NULL"))
    out = words.join(near, "word", "left").join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form_n")
