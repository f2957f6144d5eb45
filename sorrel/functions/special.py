"""Tail probabilities of the drift tests as column expressions.

They are evaluated on one row per feature, so the series are summed with `aggregate`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def kolmogorov_sf(lam: Column) -> Column:
    """P(K > lam) of the Kolmogorov distribution, 1 where the series has no meaning yet."""
    k = F.sequence(F.lit(1), F.lit(100))
    total = F.aggregate(
        k,
        F.lit(0.0),
        lambda s, i: s + F.when(i % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * i * i * lam * lam),
    )
    return F.when(lam < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * total)))


def erfc(z: Column) -> Column:
    """Complementary error function for z >= 0 from the all-positive series of erf."""
    square = z * z
    acc = F.struct(z.alias("term"), z.alias("total"))

    def step(s, i):
        term = s["term"] * 2.0 * square / (2.0 * i + 1.0)
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    series = F.aggregate(F.sequence(F.lit(1), F.lit(250)), acc, step)["total"]
    erf = 2.0 / math.sqrt(math.pi) * F.exp(-square) * series
    return F.when(z > 6.3, 0.0).otherwise(F.greatest(F.lit(0.0), 1.0 - erf))


def chi2_sf(x: Column, df: Column) -> Column:
    """P(X > x) for a chi-squared variable with a whole number of degrees of freedom.

    The tail is a sum of Poisson probabilities, with a half step and erfc for odd `df`. Those further
    than 40 standard deviations from the mean are below any double, so about 80 sqrt(x) terms are
    summed at most, whatever `df`.
    """
    half = x / 2.0
    odd = df % 2 == 1
    # terms exp(-h) h^a / gamma(a + 1), a running from 0 or 1/2 to df/2 - 1
    start = F.when(odd, 0.5).otherwise(0.0)
    n_terms = F.floor(df / 2).cast("bigint")
    reach = 40.0 * F.sqrt(half) + 100.0
    below = F.floor(half - reach).cast("bigint")
    # Stirling's series is exact to the last digits from 64 on
    low = F.when(below < 64, F.lit(0).cast("bigint")).otherwise(below)
    last = F.least(n_terms - 1, F.ceil(half + reach).cast("bigint"))
    at = start + low + 1.0
    log_gamma = (at - 0.5) * F.log(at) - at + 0.5 * math.log(2 * math.pi)
    log_gamma = log_gamma + 1 / (12 * at) - 1 / (360 * F.pow(at, F.lit(3))) + 1 / (1260 * F.pow(at, F.lit(5)))
    from_zero = F.when(odd, 0.5 * F.log(half) - math.lgamma(1.5)).otherwise(0.0) - half
    log_first = F.when(low == 0, from_zero).otherwise((start + low) * F.log(half) - half - log_gamma)

    def step(s, i):
        log_term = s["log_term"] + F.when(i == low, 0.0).otherwise(F.log(half) - F.log(start + i))
        return F.struct(log_term.alias("log_term"), (s["total"] + F.exp(log_term)).alias("total"))

    terms = F.when(last >= low, F.sequence(low, last)).otherwise(F.array().cast("array<bigint>"))
    tail = F.aggregate(terms, F.struct(log_first.alias("log_term"), F.lit(0.0).alias("total")), step)["total"]
    p = F.when(odd, erfc(F.sqrt(half))).otherwise(0.0) + tail
    return F.when((df < 1) | (x <= 0), 1.0).otherwise(F.least(F.lit(1.0), p))
