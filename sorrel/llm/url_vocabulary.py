"""URL filter: rules for hosts first, then a weighted vocabulary searched by one Aho-Corasick automaton."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sorrel.llm.arrays import map_batches

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Terms that reject a URL by themselves, and terms of which several different ones do.
STRICT = ("ads-track", "adserver", "clickbait", "casino", "gambling", "porn", "xxx", "warez", "phishing", "malware")
SOFT = ("utm_source", "ref", "feed", "affiliate", "sponsored", "promo", "track", "ads", "click", "banner", "popup", "free")
SOFT_LIMIT = 2
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def host_of(url: str) -> Column:
    found = F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: str, path: str, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for said, at, below in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col(host) == at) | F.col(host).endswith(f".{at}")) & F.col(path).startswith(below)
        rule, verdict = F.when(fits, at + below).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def build(vocabulary: Mapping[str, bool]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for term, strict in vocabulary.items():
        automaton.add_word(term, (term, strict))
    automaton.make_automaton()
    return automaton


def edge(c: str) -> bool:
    return not ("a" <= c <= "z" or "0" <= c <= "9")


def hits(automaton: ahocorasick.Automaton, text: str) -> tuple[int, int]:
    """Distinct (strict, soft) terms that stand between characters other than a-z and 0-9."""
    found = set()
    for end, (term, strict) in automaton.iter(text):
        start = end - len(term)
        if (start < 0 or edge(text[start])) and (end + 1 == len(text) or edge(text[end + 1])):
            found.add((term, strict))
    strict = sum(s for _, s in found)
    return strict, len(found) - strict


def count_terms(df: DataFrame, url: str, strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT) -> DataFrame:
    """`df` with `strict_hits` and `soft_hits`: how many different terms of each kind the URL holds.

    A-Z are lower-cased first; a term in both lists is strict; a null or empty URL has none. Columns of `df` with these
    two names are replaced.
    """
    vocabulary = dict.fromkeys(soft, False) | dict.fromkeys(strict, True)
    vocabulary.pop("", None)
    table, df = str.maketrans(UPPER, LOWER), df.drop("strict_hits", "soft_hits")
    if not vocabulary:
        return df.withColumns({"strict_hits": F.lit(0), "soft_hits": F.lit(0)})

    def run(batches):
        automaton = build(vocabulary)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(url))
            counts = [hits(automaton, x.translate(table)) if x else (0, 0) for x in column.to_pylist()]
            both = [pa.array([c[k] for c in counts], pa.int32()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *both], [*batch.schema.names, "strict_hits", "soft_hits"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", strict_hits int, soft_hits int"
    return map_batches(df, run, schema)


def judge(
    df: DataFrame,
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """`df` with host, path, rule, strict_hits, soft_hits and verdict (allow or block).

    The longest rule that fits decides; without one, a strict term or `soft_limit` different soft terms block. A null
    URL, or one without `://`, has an empty host and path, which no rule fits; its terms count all the same (null has
    none, so it is allowed). Rows stay as they are, repeated ones too; columns of `df` with the new names are replaced.
    """
    df = df.drop(*({"host", "path", "rule", "verdict"} - {url}))
    out = count_terms(df, url, strict, soft).withColumns({"host": host_of(url), "path": path_of(url)})
    rule, said = rule_for("host", "path", rules)
    bad = (F.col("strict_hits") > 0) | (F.col("soft_hits") >= soft_limit)
    return out.withColumns({"rule": rule, "verdict": F.coalesce(said, F.when(bad, "block").otherwise("allow"))})
