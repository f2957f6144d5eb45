"""Column expressions: everything here stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sorrel.functions import fixed

NUMERIC = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DecimalType)


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_year(title: Column | str) -> Column:
    """First four digits in parentheses as a double, NULL where there are none."""
    found = F.regexp_extract(as_col(title), r"\((\d{4})\)", 1)
    return F.nullif(found, F.lit("")).cast("double")


def tokens(c: Column | str, sep: str = "|") -> Column:
    """The parts of a multi-valued string."""
    return F.split(as_col(c), f"[{sep}]" if sep in "|." else sep)


def one_hot(c: Column | str, vocab: Sequence[str], sep: str = "|", prefix: str = "") -> list[Column]:
    """One 0/1 column per token in sorted order, from a narrow projection without a shuffle."""
    parts = tokens(c, sep)
    return [
        F.coalesce(F.array_contains(parts, t).cast("int"), F.lit(0)).alias(prefix + t) for t in sorted(vocab)
    ]


def vocabulary(df: DataFrame, c: str, sep: str = "|") -> DataFrame:
    """All tokens that occur; a first pass for data whose vocabulary is not known."""
    return df.select(F.explode(tokens(c, sep)).alias("token")).where(F.col("token") != "").distinct()


def explode_tokens(df: DataFrame, c: str, sep: str = "|", name: str = "token") -> DataFrame:
    return df.withColumn(name, F.explode(tokens(c, sep)))


def encode_binary(c: Column | str, positive: str = "M") -> Column:
    return F.coalesce(as_col(c) == positive, F.lit(False)).cast("int")


def label_threshold(c: Column | str, at: float = fixed.LIKE_AT) -> Column:
    """1 at or above the limit; a missing rating is 0."""
    return F.coalesce(as_col(c) >= at, F.lit(False)).cast("int")


def or_zero(c: Column | str) -> Column:
    """NULL and NaN both count as missing and become 0."""
    return F.coalesce(F.nanvl(as_col(c).cast("double"), F.lit(None).cast("double")), F.lit(0.0))


def present(c: Column | str) -> Column:
    """True where a number is neither NULL nor NaN."""
    col = as_col(c)
    return col.isNotNull() & ~F.isnan(col)


def missing_in(df: DataFrame, name: str) -> Column:
    """True where the column has no value: NULL, and NaN in floating-point columns."""
    floating = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return ~present(name) if floating else F.col(name).isNull()


def fill_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """0 for missing numbers; strings are left alone."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]
    return df.na.fill(0, [c for c in numeric if cols is None or c in cols])


def feature_columns(
    df: DataFrame, not_features: Sequence[str], last: Sequence[str] = ()
) -> list[str]:
    """Feature order: all columns but ids and targets, statistics at the end."""
    base = [c for c in df.columns if c not in not_features and c not in last]
    return base + [c for c in last if c in df.columns]


def select_features(df: DataFrame, keep: Sequence[str], features: Sequence[str]) -> DataFrame:
    return df.select(*keep, *features)


def normalise_names(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Lower-case names without apostrophes, `-` as `_`, then explicit renames."""
    clean = [c.lower().replace("'", "").replace("-", "_") for c in df.columns]
    return df.toDF(*[(renames or {}).get(c, c) for c in clean])


def epoch_to_ts(c: Column | str) -> Column:
    return F.timestamp_seconds(as_col(c))


def align_columns(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly `cols` in that order: absent ones are 0.0, missing values 0.0, extras gone."""
    have = set(df.columns)
    return df.select(*keep, *[(or_zero(c) if c in have else F.lit(0.0)).alias(c) for c in cols])


def profile_defaults(
    df: DataFrame, defaults: Mapping[str, float] = fixed.PROFILE_DEFAULTS, zero_is_missing: bool = True
) -> DataFrame:
    """Put defaults where a profile statistic is missing, or zero if so asked."""
    out = {}
    for name, value in defaults.items():
        if name not in df.columns:
            out[name] = F.lit(float(value))
            continue
        c = F.col(name).cast("double")
        ok = present(c) & (c != 0) if zero_is_missing else present(c)
        out[name] = F.when(ok, c).otherwise(F.lit(float(value)))
    return df.withColumns(out)


def map_labels(c: Column | str, labels: Mapping) -> Column:
    """Label of a code; an unknown code passes through as text."""
    col = as_col(c)
    pairs = [x for code, label in labels.items() for x in (F.lit(code), F.lit(label))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), col.cast("string"))


def scaled(c: Column | str, lo: float, hi: float) -> Column:
    """Position in [lo, hi]; values outside are not clipped, a zero range divides by 1."""
    width = hi - lo
    return (as_col(c).cast("double") - F.lit(lo)) / F.lit(width if width != 0 else 1.0)


def minmax_scale(df: DataFrame, params: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: scaled(c, lo, hi) for c, (lo, hi) in params.items()})
