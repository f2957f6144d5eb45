"""From documents to training token files: quality, near copies, benchmark passages, mixture, ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sorrel.llm import curriculum, decontamination, jaccard, quality, token_files
from sorrel.llm.queries import TOKENIZER
from sorrel.llm.rows import table
from sorrel.session import new_folder


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least the threshold."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(~quality.held_out("doc_id"))
    model = quality.fit(docs.select("doc_id", "text"), labels)
    return quality.score(docs, model, name="_score").where(F.col("_score") >= quality.THRESHOLD).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 or more."""
    return jaccard.one_per_group(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents that consist of them for the most part dropped."""
    clean = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return clean.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for, in training order."""
    return curriculum.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all rows in the order of training; doc_id, start, n_tokens and ids_crc32 as read back from them.

    A row's place follows from its source's curve (`curriculum.schedule`): ids of rows asked for earlier come first.
    """
    path = new_folder(spark, "tokens")
    token_files.write(curriculum.schedule(docs, stored=True), path, TOKENIZER, order="moment")
    return token_files.read(spark, path)


STAGES = [
    ("quality", keep_quality),
    ("near copies", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("mixture", mix_sources),
    ("token files", write_tokens),
]
#: A trained model decides what stays, which SQL cannot express; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
