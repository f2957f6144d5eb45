"""One query per operator over the whole sample tables, and SQL where SQL can say the same."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sorrel.llm import ball_tree, curriculum, decontamination, interleave, jaccard, quality, spelling, suffix_dedup, token_counts, token_files, url_vocabulary, warc, winnowing
from sorrel.llm.rows import table
from sorrel.session import new_folder

TOKENIZER = os.environ.get("SORREL_TOKENIZER") or public_tokenizers.path("word_bpe_49k.json")
SHARDS = 8


def decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    seen = decontamination.scan(docs, table(spark, folder, "benchmark"), "text").drop("text")
    ends = F.filter("hit_runs", lambda x, i: i % 2 == 1)
    starts = F.filter("hit_runs", lambda x, i: i % 2 == 0)
    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + x)
    n_hit = total(ends) - total(starts)
    ids = F.sha2(F.array_join("hit_items", ","), 256)
    return seen.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("bigint").alias("n_items"), ids.alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (table(spark, folder, t) for t in ("documents", "labels"))
    model = quality.fit(docs.select("doc_id", "text"), labels.select("doc_id", "quality").where(~quality.held_out("doc_id")))
    scored = quality.score(docs.select("doc_id", "text"), model).drop("text")
    predicted = F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0)
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", predicted.alias("predicted"))


def fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.edit_likeness(table(spark, folder, "documents"))


def derivatives(spark: SparkSession, folder: str) -> DataFrame:
    return warc.derivatives(table(spark, folder, "pages"))


def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_vocabulary.judge(table(spark, folder, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits")


def token_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    token_files.write(table(spark, folder, "documents"), path, TOKENIZER)
    return token_files.read(spark, path)


def shards(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = table(spark, folder, "documents").select("doc_id", "source", interleave.text_size("text").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    out = interleave.interleave(narrow, "source", "doc_id", SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


def near_copies(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard.clusters(table(spark, folder, "documents"), size=3, percent=90)
    return found.withColumnRenamed("key", "doc_id")


def mixture(spark: SparkSession, folder: str) -> DataFrame:
    narrow = table(spark, folder, "documents").select("doc_id", "source", curriculum.word_count("text").alias("size"))
    placed = curriculum.plan(narrow, "source", "doc_id", "size")
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return placed.select("doc_id", "size", "source_size", "target", taken, F.round(F.get("moments", F.lit(0)), 6).alias("first_moment"))


def passages(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.deduplicate(table(spark, folder, "documents"), whole=False)
    return found.select(F.col("doc").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ball_tree.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents").select("doc_id", "text"))


def token_totals(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents").select("doc_id", "text"), TOKENIZER)


QUERIES = {
    "op1_decontaminate": decontaminate,
    "op2_quality": quality_scores,
    "op3_winnowing": fingerprints,
    "op4_warc_derivatives": derivatives,
    "op5_url_vocabulary": url_verdicts,
    "op6_token_files": token_ids,
    "op7_interleaved_shards": shards,
    "op8_jaccard_join": near_copies,
    "op9_curriculum_mix": mixture,
    "op10_prefix_free_parsing": passages,
    "op11_ball_tree_search": ranked_search,
    "op12_spelling_variants": spelling_variants,
    "op13_token_counts": token_totals,
}
