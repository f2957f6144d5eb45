"""Row rules of the raw tables and data-quality checks of a feature matrix."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sorrel.functions import columns as C, fixed
from sorrel.sources.delimited import first_error


def item_rules(
    item_id: Column, title: Column, tags: Column, vocab: Sequence[str] = fixed.GENRES, sep: str = "|"
) -> list[tuple[str, Column]]:
    known = F.array(*[F.lit(t) for t in vocab])
    return [
        ("id", item_id <= 0),
        ("title", F.length(title) == 0),
        ("tags", F.size(F.array_except(C.tokens(tags, sep), known)) > 0),
    ]


def user_rules(
    user_id: Column,
    gender: Column,
    age: Column,
    occupation: Column,
    genders: Sequence = fixed.GENDERS,
    ages: Sequence = fixed.AGES,
    occupations: Sequence = fixed.OCCUPATIONS,
) -> list[tuple[str, Column]]:
    return [
        ("id", user_id <= 0),
        ("gender", ~gender.isin(list(genders))),
        ("age", ~age.isin(list(ages))),
        ("occupation", ~occupation.isin(list(occupations))),
    ]


def interaction_rules(
    user_id: Column, item_id: Column, rating: Column, epoch: Column, ratings: Sequence = fixed.RATINGS
) -> list[tuple[str, Column]]:
    return [
        ("user", user_id <= 0),
        ("item", item_id <= 0),
        ("rating", ~rating.isin(list(ratings))),
        ("timestamp", epoch <= 0),
    ]


def movie_file_rules(c: Mapping[str, Column]) -> list[tuple[str, Column]]:
    return item_rules(c["MovieID"], c["Title"], c["Genres"])


def user_file_rules(c: Mapping[str, Column]) -> list[tuple[str, Column]]:
    return user_rules(c["UserID"], c["Gender"], c["Age"], c["Occupation"])


def rating_file_rules(c: Mapping[str, Column]) -> list[tuple[str, Column]]:
    return interaction_rules(c["UserID"], c["MovieID"], c["Rating"], c["Timestamp"])


def all_errors(rules: Sequence[tuple[str, Column]]) -> Column:
    """Messages of every broken rule, an empty array for a good row."""
    return F.array_compact(
        F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(m)) for m, bad in rules])
    )


def validate(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows with `error` (first broken rule or NULL) and `errors` (all of them)."""
    return df.withColumns({"error": first_error(rules), "errors": all_errors(rules)})


def null_rates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column with its share of missing values, from one pass."""
    rates = [F.avg(C.missing_in(df, c).cast("double")).alias(c) for c in cols]
    return df.agg(*rates).unpivot([], list(cols), "column", "null_rate")


def check_nulls(df: DataFrame, cols: Sequence[str], threshold: float = fixed.MAX_NULL_RATE) -> DataFrame:
    """Columns with more missing values than allowed."""
    return null_rates(df, cols).where(F.col("null_rate") > threshold)


def check_null_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns without a single value."""
    return null_rates(df, cols).where(F.col("null_rate") == 1.0).select("column")


def duplicate_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: how many rows repeat an earlier one."""
    return df.groupBy(*cols).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n_duplicates"))


CHECK = "check string, passed boolean, severity string, value double, detail string"


def check_min_rows(n: Column, limit: int = fixed.MIN_ROWS) -> Column:
    return n >= limit


def check_class_balance(rate: Column, low: float = fixed.POSITIVE_RANGE[0], high: float = fixed.POSITIVE_RANGE[1]) -> Column:
    return F.coalesce(rate.between(low, high), F.lit(False))


def check_duplicates(n_duplicates: Column, n: Column, share: float = fixed.MAX_DUPLICATE_SHARE) -> Column:
    return n_duplicates < n * share


def run_quality_checks(
    df: DataFrame,
    cols: Sequence[str],
    label: str,
    min_rows: int = fixed.MIN_ROWS,
    threshold: float = fixed.MAX_NULL_RATE,
    balance: tuple[float, float] = fixed.POSITIVE_RANGE,
    share: float = fixed.MAX_DUPLICATE_SHARE,
) -> DataFrame:
    """One row per check, and `all_passed` over those of severity `error`.

    Null rates, balance and size come from one aggregate; duplicates need the one shuffle.
    """
    names = F.array(*[F.lit(c) for c in cols])
    wide = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(label).alias("rate"),
        F.array(*[F.avg(C.missing_in(df, c).cast("double")) for c in cols]).alias("nulls"),
    )
    dup = duplicate_count(df, list(cols)).scalar()

    def named(test) -> Column:
        hit = F.filter(F.arrays_zip(names.alias("name"), F.col("nulls").alias("rate")), test)
        return F.array_join(F.transform(hit, lambda x: x["name"]), ",")

    bad = named(lambda x: x["rate"] > threshold)
    empty = named(lambda x: x["rate"] == 1.0)
    stats = wide.select("n", "rate", bad.alias("bad"), empty.alias("empty"), dup.alias("dup"))

    def row(name, passed, severity, value, detail):
        return F.struct(
            F.lit(name).alias("check"),
            passed.alias("passed"),
            F.lit(severity).alias("severity"),
            value.cast("double").alias("value"),
            detail.cast("string").alias("detail"),
        )

    none = F.lit("")
    checks = F.array(
        row("min_rows", check_min_rows(F.col("n"), min_rows), "error", F.col("n"), none),
        row("no_nulls", F.col("bad") == "", "error", F.size(F.array_compact(F.split("bad", ","))) - (F.col("bad") == "").cast("int"), F.col("bad")),
        row("no_null_columns", F.col("empty") == "", "error", F.size(F.split("empty", ",")) - (F.col("empty") == "").cast("int"), F.col("empty")),
        row("class_balance", check_class_balance(F.col("rate"), *balance), "error", F.col("rate"), none),
        row("no_duplicates", check_duplicates(F.col("dup"), F.col("n"), share), "warn", F.col("dup"), none),
    )
    ok = F.forall("checks", lambda c: c["passed"] | (c["severity"] != "error"))
    return (
        stats.select(checks.alias("checks"))
        .select(ok.alias("all_passed"), F.inline("checks"))
        .select("check", "passed", "severity", "value", "detail", "all_passed")
    )
