"""Aggregate expressions with null-safe, ANSI-safe semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def null_safe_corr(a, b) -> Column:
    """Pearson correlation over pairwise-complete rows.

    ``covar_pop(a, b) / (stddev_pop(a | b present) * stddev_pop(b | a present))``
    with a zero denominator giving null instead of a divide-by-zero error, so
    a constant column yields a null correlation.  A plain partial aggregate:
    map-side combine, one row of state per group.
    """
    a, b = _c(a).cast("double"), _c(b).cast("double")
    both = a.isNotNull() & b.isNotNull()
    a2 = F.when(both, a)
    b2 = F.when(both, b)
    den = F.stddev_pop(a2) * F.stddev_pop(b2)
    return F.try_divide(F.covar_pop(a2, b2), F.when(den != 0, den))


def sample_skewness(col) -> Column:
    """Bias-adjusted (sample) skewness G1 = g1 * sqrt(n(n-1)) / (n-2); null for
    n < 3 or a constant column."""
    c = _c(col).cast("double")
    n = F.count(c).cast("double")
    g1 = F.skewness(c)
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))
