"""Aggregate helpers: shares, rounding, correlation (all built-in aggregates)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talentlake.functions.text import round_half_up


def pct_of(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part * 100 / whole`` rounded half-up; NULL when ``whole`` is 0 or NULL."""
    return round_half_up(F.try_divide(part.cast("double") * F.lit(100.0), F.nullif(whole.cast("double"), F.lit(0.0))), digits)


def pearson(x: Column, y: Column) -> Column:
    """Pearson r over rows where both values are present; NULL when fewer
    than two pairs or when either variance is zero.

    Built from the numerically stable central-moment aggregates
    (``covar_pop``, ``stddev_pop``), which merge partial states across
    partitions; ``try_divide`` keeps ANSI mode from raising on zero variance.
    """
    both = x.isNotNull() & y.isNotNull()
    xx = F.when(both, x.cast("double"))
    yy = F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(xx, yy), F.nullif(F.stddev_pop(xx) * F.stddev_pop(yy), F.lit(0.0)))


def pearson_weighted(x: Column, y: Column, n: Column) -> Column:
    """Pearson r of rows that stand for ``n`` equal ones each (no NULLs); NULL for zero variance."""
    x, y, n = x.cast("double"), y.cast("double"), n.cast("double")
    total = F.sum(n)
    mean = lambda v: F.try_divide(F.sum(v * n), total)
    covariance = mean(x * y) - mean(x) * mean(y)
    spread = F.sqrt(F.greatest(mean(x * x) - mean(x) * mean(x), F.lit(0.0))) * F.sqrt(F.greatest(mean(y * y) - mean(y) * mean(y), F.lit(0.0)))
    return F.when(spread > F.lit(1e-9), covariance / spread)
