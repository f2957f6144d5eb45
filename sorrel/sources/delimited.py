"""Delimited raw files: typed scans, prepared tables, line statistics and line validation."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from sorrel.functions import columns as C, fixed

MOVIES = T.StructType(
    [T.StructField("MovieID", T.IntegerType()), T.StructField("Title", T.StringType()), T.StructField("Genres", T.StringType())]
)
USERS = T.StructType(
    [
        T.StructField("UserID", T.IntegerType()),
        T.StructField("Gender", T.StringType()),
        T.StructField("Age", T.IntegerType()),
        T.StructField("Occupation", T.IntegerType()),
        T.StructField("Zip", T.StringType()),
    ]
)
RATINGS = T.StructType(
    [
        T.StructField("UserID", T.IntegerType()),
        T.StructField("MovieID", T.IntegerType()),
        T.StructField("Rating", T.IntegerType()),
        T.StructField("Timestamp", T.LongType()),
    ]
)


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = "::", encoding: str = "ISO-8859-1"
) -> DataFrame:
    """Headerless text with a declared schema; unreadable fields become NULL (`read_checked` keeps such lines apart)."""
    return spark.read.csv(path, schema=schema, sep=sep, encoding=encoding, header=False, mode="PERMISSIVE")


def load_items(
    df: DataFrame, vocab: Sequence[str], text_col: str = "Title", tags_col: str = "Genres", sep: str = "|"
) -> DataFrame:
    """Items with `Year` and one 0/1 column per tag of `vocab`, whose names become columns."""
    return df.select("*", C.extract_year(text_col).alias("Year"), *C.one_hot(tags_col, vocab, sep))


def load_users(df: DataFrame, gender_col: str = "Gender", positive: str = "M") -> DataFrame:
    return df.withColumn("Gender_enc", C.encode_binary(gender_col, positive))


def load_interactions(df: DataFrame, rating_col: str = "Rating", threshold: float | None = None) -> DataFrame:
    """Ratings with `Liked`; the limit comes from the argument, else RATING_THRESHOLD, else 4."""
    if threshold is None:
        threshold = float(os.getenv("RATING_THRESHOLD", fixed.LIKE_AT))
    return df.withColumn("Liked", C.label_threshold(rating_col, threshold))


def read_lines(spark: SparkSession, path: str | Sequence[str], charset: str = "ISO-8859-1") -> DataFrame:
    """Every line, blank ones too, with its file, split start and position in the task.

    The text scan keeps the raw bytes, so the charset is applied here.
    """
    return spark.read.text(path).select(
        F.decode(F.col("value").cast("binary"), charset).alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    )


def raw_file_stats(spark: SparkSession, paths: str | Sequence[str], n_fields: int, sep: str = "::") -> DataFrame:
    """Per file: number of lines, and how many do not have `n_fields` fields."""
    fields = F.size(F.split(F.trim("line"), sep))
    return (
        read_lines(spark, paths)
        .groupBy("file")
        .agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(fields != n_fields).alias("n_bad_fields"))
    )


CORRUPT = "_corrupt_record"


def read_checked(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, sep: str = "::", encoding: str = "ISO-8859-1"
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected lines): every line of the files is on exactly one side.

    Lines go through the CSV parser with a column for corrupt records: a line is rejected where a field does not parse or
    the number of fields is another one, and where it is blank. Rows are as `read_delimited` gives them; rejected lines
    carry their file, 1-based line number and the reason.
    """
    lines = read_lines(spark, path, encoding)
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # as a generated column a line is parsed once, and not anew for every field that is read
    parsed = lines.withColumn("fields", F.explode(F.array(F.from_csv("line", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields), options))))
    blank = F.trim("line") == ""
    bad = blank | F.col("fields").isNull() | F.col("fields")[CORRUPT].isNotNull()
    n_fields = F.size(F.split("line", sep))
    reason = F.when(blank, F.lit("blank")).when(n_fields != len(schema), F.format_string(f"%d fields instead of {len(schema)}", n_fields))
    for i, f in enumerate(schema.fields):
        if not isinstance(f.dataType, T.StringType):
            reason = reason.when(F.get(F.split("line", sep), F.lit(i)).try_cast(f.dataType).isNull(), F.lit(f"{f.name} does not parse"))
    rejected = number_lines(lines, parsed.where(bad).withColumn("reason", reason.otherwise("not a record")))
    return parsed.where(~bad).select("fields.*").drop(CORRUPT), rejected.select("file", "line_no", "line", "reason")


def read_and_reject(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, rejects: str, sep: str = "::", encoding: str = "ISO-8859-1") -> DataFrame:
    """The rows of `read_checked`; rejected lines are written as JSON under `rejects`, which is there after each read."""
    rows, rejected = read_checked(spark, path, schema, sep, encoding)
    rejected.write.mode("overwrite").json(rejects)
    return rows


# A rule is (message, expression that is true for a bad row); the first that holds is reported.
Rules = Callable[[Mapping[str, Column]], list[tuple[str, Column]]]


def first_error(rules: Sequence[tuple[str, Column]]) -> Column:
    """Message of the first rule that is broken, NULL for a good row; NULL tests count as broken."""
    out = F.lit(None).cast("string")
    for message, bad in reversed(list(rules)):
        out = F.when(F.coalesce(bad, F.lit(True)), F.lit(message)).otherwise(out)
    return out


def number_lines(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """Add the 1-based line number within its file to the `wanted` lines.

    Lines are counted per file split; the splits of a file, not its lines, are then summed in order.
    """
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"))
    before = F.sum("n").over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    starts = blocks.select("file", "block", "first_pos", F.coalesce(before, F.lit(0)).alias("skipped"))
    return wanted.join(starts, ["file", "block"]).withColumn(
        "line_no", F.col("skipped") + F.col("pos") - F.col("first_pos") + 1
    )


def checked_lines(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, rules: Rules, sep: str = "::"
) -> DataFrame:
    """Every line with `error`: too few fields, a number that does not parse, or a broken rule."""
    lines = read_lines(spark, path).withColumn("parts", F.split(F.trim("line"), sep))
    typed: dict[str, Column] = {}
    broken = [("too few fields", F.size("parts") < len(schema))]
    for i, field in enumerate(schema.fields):
        typed[field.name] = F.get("parts", F.lit(i)).try_cast(field.dataType)
        if not isinstance(field.dataType, T.StringType):
            broken.append((f"{field.name} is not a number", typed[field.name].isNull()))
    return lines.withColumn("error", first_error(broken + rules(typed))).drop("parts")


def validate_file(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    rules: Rules,
    sep: str = "::",
    keep: int = 5,
) -> tuple[DataFrame, DataFrame]:
    """One row (valid, invalid), and the first `keep` bad lines with their line numbers."""
    lines = checked_lines(spark, path, schema, rules, sep)
    counts = lines.agg(
        F.count_if(F.col("error").isNull()).alias("valid"), F.count_if(F.col("error").isNotNull()).alias("invalid")
    )
    bad = lines.where(F.col("error").isNotNull()).orderBy("file", "block", "pos").limit(keep)
    first = number_lines(lines, bad).select("file", "line_no", "error", "line").orderBy("file", "line_no")
    return counts, first
