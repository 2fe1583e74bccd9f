"""Probabilities as column expressions: log gamma, the chi-square tail, lattice paths inside a band."""

from __future__ import annotations

from math import log, pi

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_gamma(a: Column) -> Column:
    """Logarithm of the gamma function for a > 0, by its asymptotic series eight steps up."""
    z = a + 8.0
    steps = F.log(a)
    for k in range(1, 8):
        steps = steps + F.log(a + float(k))
    inverse = F.lit(1.0) / z
    square = inverse * inverse
    series = inverse * (F.lit(1 / 12) - square * (F.lit(1 / 360) - square * (F.lit(1 / 1260) - square / 1680.0)))
    return (z - 0.5) * F.log(z) - z + F.lit(0.5 * log(2 * pi)) + series - steps


def upper_gamma(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma function Q(a, x) for a > 0.

    Below x = a + 1 by the series of its complement, above by the continued fraction. Both
    need some ten times the root of ``a`` terms.
    """
    scale = F.exp(a * F.log(x) - x - log_gamma(a))
    terms = F.sequence(F.lit(1), (F.sqrt(a) * 12 + 60).cast("int"))
    summed = F.aggregate(
        terms, F.struct((F.lit(1.0) / a).alias("term"), (F.lit(1.0) / a).alias("sum")),
        lambda s, k: F.struct((s["term"] * x / (a + k)).alias("term"), (s["sum"] + s["term"] * x / (a + k)).alias("sum")),
        lambda s: s["sum"])
    tiny = F.lit(1e-300)
    away = lambda v: F.when(F.abs(v) < tiny, tiny).otherwise(v)

    def step(s: Column, k: Column) -> Column:
        """Next convergent from the ratios of numerators (c) and denominators (d) so far."""
        top = k * (a - k)
        bottom = x + 2.0 * k + 1.0 - a
        c, d = away(bottom + top / s["c"]), F.lit(1.0) / away(bottom + top * s["d"])
        return F.struct(c.alias("c"), d.alias("d"), (s["value"] * c * d).alias("value"))

    first = F.lit(1.0) / away(x + 1.0 - a)
    fraction = F.aggregate(terms, F.struct((F.lit(1.0) / tiny).alias("c"), first.alias("d"), first.alias("value")),
                           lambda s, k: step(s, k.cast("double")), lambda s: s["value"])
    tail = F.when(x < a + 1.0, 1.0 - scale * summed).otherwise(scale * fraction)
    return F.when(x <= 0, 1.0).otherwise(F.least(F.greatest(tail, F.lit(0.0)), F.lit(1.0)))


def chi_square_p(statistic: Column, degrees: Column) -> Column:
    """Probability of at least this chi-square statistic; 1 without a degree of freedom."""
    half = degrees.cast("double") / 2.0
    return F.when(degrees < 1, 1.0).otherwise(upper_gamma(half, statistic / 2.0))


def band_exit_p(gap: Column, n: Column, m: Column) -> Column:
    """Probability that a random path of n steps right and m steps up leaves the band |i m - j n| < gap.

    This is the exact two-sample Kolmogorov-Smirnov p-value for gap = statistic n m. Paths are followed one
    diagonal (i + j = t) after the other: a path at (i, j) came from the left with probability i / t. Of a diagonal
    only the places about the band are followed.
    """
    def first(t: Column) -> Column:
        return F.greatest(F.lit(0).cast("long"), t - m, F.floor((t * n - gap) / (n + m)))

    def last(t: Column) -> Column:
        return F.least(n, t, F.ceil((t * n + gap) / (n + m)))

    def diagonal(before: Column, t: Column) -> Column:
        def at(i: Column) -> Column:
            j = t - i
            left, down = (F.coalesce(F.get(before, (k - first(t - 1)).cast("int")), F.lit(0.0)) for k in (i - 1, i))
            outside = (j < 0) | (j > m) | (F.abs(i * m - j * n) >= gap)
            return F.when(outside, 0.0).otherwise(i / t * left + j / t * down)

        return F.transform(F.sequence(first(t), last(t)), at)

    inside = F.aggregate(F.sequence(F.lit(1).cast("long"), n + m), F.array(F.lit(1.0)), diagonal, lambda end: F.element_at(end, -1))
    return F.when(gap <= 0, 1.0).otherwise(F.least(F.greatest(1.0 - inside, F.lit(0.0)), F.lit(1.0)))
