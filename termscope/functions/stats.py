"""Column expressions for association scores, weights and hash buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Above this many documents the product of two counts leaves BIGINT.
_BIGINT_SAFE_DOCS = 3_037_000_499
_WIDE = "decimal(19,0)"


def _excess(n: Column, nc: Column, nt: Column, ntc: Column) -> Column:
    """N*Ntc - Nc*Nt, exact for any document count, as a double.

    BIGINT while the products fit; DECIMAL(38,0) for corpora beyond three
    billion documents, where BIGINT would raise an overflow under ANSI mode.
    """
    wide = n.cast(_WIDE) * ntc.cast(_WIDE) - nc.cast(_WIDE) * nt.cast(_WIDE)
    return F.when(
        n <= F.lit(_BIGINT_SAFE_DOCS), (n * ntc - nc * nt).cast("double")
    ).otherwise(wide.cast("double"))


def chi_square(n: Column, nc: Column, nt: Column, ntc: Column) -> Column:
    """Chi-square of the 2x2 table (in category or not) x (has term or not).

    0.0 where a margin is empty. Counts are documents: all, of the category,
    with the term, of the category with the term.
    """
    excess = _excess(n, nc, nt, ntc)
    margins = nt.cast("double") * (n - nt) * nc * (n - nc)
    return F.when(margins == 0, F.lit(0.0)).otherwise(
        n.cast("double") * excess * excess / margins
    )


def chi_square_cell(n: Column, nc: Column, nt: Column, ntc: Column) -> Column:
    """What one observed (term, category) cell adds to the 2xC statistic."""
    excess = _excess(n, nc, nt, ntc)
    margins = nc.cast("double") * nt * (n - nt)
    return F.when(margins == 0, F.lit(0.0)).otherwise(excess * excess / margins)


def chi_square_empty_cells(n: Column, nt: Column, docs_in_empty: Column) -> Column:
    """What all cells without the term add together.

    A cell with Ntc = 0 adds Nc*Nt/(N-Nt), so their sum needs only the number of
    documents in those categories: no term x category grid is ever built.
    """
    return F.when(n == nt, F.lit(0.0)).otherwise(
        docs_in_empty.cast("double") * nt / (n - nt)
    )


# Steps of the continued fraction of a half degree, and of the series besides those
# that grow with the square root of the degrees; both leave an error below 1e-13.
_FRACTION_STEPS = 40
_SERIES_STEPS = 60
_SERIES_GROWTH = 9
_SHIFT = 8


def log_gamma(a: Column) -> Column:
    """Logarithm of the gamma function for a > 0: Stirling's series at a + 8."""
    z = a + _SHIFT
    series = (
        (z - 0.5) * F.log(z) - z + 0.9189385332046727
        + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    )
    product = a
    for i in range(1, _SHIFT):
        product = product * (a + i)
    return series - F.log(product)


def _falling(steps: Column) -> Column:
    return F.sequence(steps.cast("int"), F.lit(1), F.lit(-1))


def log_chi_square_tail(statistic: Column, dof: Column) -> Column:
    """Logarithm of the probability that chi-square exceeds ``statistic``.

    Unlike the probability it does not underflow, so it orders statistics of different
    degrees of freedom however large they are. With x half the statistic and a half the
    degrees, the tail is Q(a, x) = x^(a-1) e^-x h(a) / Gamma(a), where
    h(a + 1) = 1 + h(a) a / x. The recurrence starts at h(1) = 1 or, for odd degrees, at
    h(1/2), a continued fraction. Below a + 1, where it would lose digits, it is one less
    the series of the lower part. 0.0 for no degrees or a statistic of 0 or less.
    """
    x, a = statistic / 2, dof / F.lit(2.0)
    odd = dof % 2 == 1
    base = F.when(odd, F.lit(0.5)).otherwise(F.lit(1.0))
    fraction = F.aggregate(
        _falling(F.lit(_FRACTION_STEPS)),
        x + (2 * _FRACTION_STEPS + 0.5),
        lambda f, n: x + 2 * n - 1.5 - n * (n - 0.5) / f,
    )
    first = F.when(odd, x / fraction).otherwise(F.lit(1.0))
    steps = F.floor(a - base).cast("int")
    rising = F.when(steps > 0, F.sequence(F.lit(0), steps - 1)).otherwise(F.array().cast("array<int>"))
    h = F.aggregate(rising, first, lambda h, j: 1 + h * (base + j) / x)
    upper = (a - 1) * F.log(x) - x - log_gamma(a) + F.log(h)
    count = _SERIES_STEPS + F.ceil(_SERIES_GROWTH * F.sqrt(a))
    series = F.aggregate(_falling(count), F.lit(1.0), lambda s, n: 1 + s * x / (a + n))
    lower = F.exp(a * F.log(x) - x - log_gamma(a + 1)) * series
    return (
        F.when(statistic.isNull() | dof.isNull(), F.lit(None).cast("double"))
        .when((dof <= 0) | (x <= 0), F.lit(0.0))
        .when(x >= a + 1, upper)
        .otherwise(F.log1p(-lower))
    )


def log_chi_square_tail_bounds(statistic: Column, dof: Column) -> tuple[Column, Column]:
    """A lower and an upper bound of :func:`log_chi_square_tail`, without its loops.

    Where x > a, the upper incomplete gamma function is between x^(a-1) e^-x and
    x / (x + 1 - a) times that, which is more for a > 1 and less for a < 1. Elsewhere the
    bound from above is 1, the one from below holds too.
    """
    x, a = statistic / 2, dof / F.lit(2.0)
    power = (a - 1) * F.log(x) - x - log_gamma(a)
    other = power + F.log(x / (x + 1 - a))
    below = F.when(a < 1, other).otherwise(power)
    above = F.when(x <= a, F.lit(0.0)).otherwise(F.least(F.when(a < 1, power).otherwise(other), F.lit(0.0)))
    unknown, certain = statistic.isNull() | dof.isNull(), (dof <= 0) | (x <= 0)
    return tuple(
        F.when(unknown, F.lit(None).cast("double")).when(certain, F.lit(0.0)).otherwise(bound)
        for bound in (below, above)
    )


def idf(docs: Column, doc_freq: Column) -> Column:
    """Smoothed inverse document frequency, ln((m + 1) / (df + 1))."""
    return F.log((docs + 1).cast("double") / (doc_freq + 1).cast("double"))


def hash_bucket(key: Column, seed: int, buckets: int = 100) -> Column:
    """A bucket in [0, buckets) that depends on key and seed alone.

    Unlike a random split it is the same under any partitioning, retry or order.
    """
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"-{seed}")))
    return F.pmod(
        F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(buckets)
    ).cast("int")
