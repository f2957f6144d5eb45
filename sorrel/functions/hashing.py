"""Row hashes that decide splits and folds, equal on every run and partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

FAST_RANGE = 1 << 31
PRIME = (1 << 31) - 1
MULTIPLIER = 48271


def fast_hash(cols: Sequence[str], seed: int = 42) -> Column:
    """xxhash64 folded to [0, 2^31)."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in cols]), F.lit(FAST_RANGE))


def portable_hash(cols: Sequence[str], seed: int = 42) -> Column:
    """Multiplicative hash of integer keys to [0, 2^31 - 1), the same in any SQL engine."""
    h = F.lit(seed).cast("bigint")
    for c in cols:
        key = F.pmod(F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint")), F.lit(PRIME))
        h = F.pmod((h + key) * F.lit(MULTIPLIER), F.lit(PRIME).cast("bigint"))
    return h
