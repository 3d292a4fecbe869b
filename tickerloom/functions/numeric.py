"""Scalar and aggregate column expressions; every one stays on the JVM side."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import RATIO_EPS, STD_EPS


def as_column(c):
    return F.col(c) if isinstance(c, str) else c


def finite(c) -> Column:
    """NaN and +/-Inf become NULL."""
    return F.when(is_finite(c), as_column(c))


def is_finite(c) -> Column:
    """NaN counts as larger than Inf; NULL stays NULL."""
    return F.abs(as_column(c)) < F.lit(float("inf"))


def safe_div(a, b) -> Column:
    return F.try_divide(as_column(a), as_column(b) + F.lit(RATIO_EPS))


def relative_change(new, old) -> Column:
    return F.try_divide(as_column(new), as_column(old)) - F.lit(1.0)


def clip(c, lower=None, upper=None) -> Column:
    """NULL stays NULL, although `greatest` and `least` skip NULLs."""
    c = as_column(c)
    bounded = c
    if lower is not None:
        bounded = F.greatest(bounded, F.lit(float(lower)))
    if upper is not None:
        bounded = F.least(bounded, F.lit(float(upper)))
    return F.when(c.isNotNull(), bounded)


def zscore_of(value, mean, std, eps=STD_EPS) -> Column:
    return (as_column(value) - as_column(mean)) / (as_column(std) + F.lit(eps))


def pearson(x, y) -> Column:
    """Sample correlation over the rows where both are present; NULL if either is constant."""
    x, y = as_column(x), as_column(y)
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def complete_pearson(x, y) -> Column:
    """As `pearson`, but NULL if any value is missing."""
    x, y = as_column(x), as_column(y)
    rows = F.count(F.lit(1))
    return F.when((F.count(x) == rows) & (F.count(y) == rows), pearson(x, y))


def sharpe(c) -> Column:
    """Mean over standard deviation, not annualised."""
    return F.avg(as_column(c)) / (F.stddev_samp(as_column(c)) + F.lit(STD_EPS))


def count_where(condition) -> Column:
    return F.coalesce(F.sum(condition.cast("bigint")), F.lit(0).cast("bigint"))
