"""Floating-point rules shared by every statistic.

Division follows IEEE 754 (``0/0`` is NaN, ``x/0`` is infinite) whatever the
session's ANSI setting, rounding is half-to-even on the scaled value, and
clipping leaves NaN and NULL alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

NAN, INF = float("nan"), float("inf")


def _double(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """IEEE division; NULL if either side is NULL.

    The NULL branch stands first so that an unknown denominator never reaches
    the zero-denominator branches, and NaN is tested before the sign because
    Spark orders NaN above every number.
    """
    n, d = _double(numerator), _double(denominator)
    return (
        F.when(n.isNull() | d.isNull(), F.lit(None).cast("double"))
        .when(d != 0, F.try_divide(n, d))
        .when((n == 0) | F.isnan(n), F.lit(NAN))
        .when(n > 0, F.lit(INF))
        .otherwise(F.lit(-INF))
    )


def round_half_even(value: Column | str, places: int) -> Column:
    """Round the scaled double half-to-even; NaN and infinities pass through."""
    scale = F.lit(10.0 ** places)
    return F.rint(_double(value) * scale) / scale


def clip(value: Column | str, low: float, high: float) -> Column:
    """Clamp to ``[low, high]``, keeping NaN and NULL as they are."""
    x = _double(value)
    return F.when(x.isNull() | F.isnan(x), x).otherwise(
        F.least(F.lit(high), F.greatest(F.lit(low), x)))


def rounded_ratio(numerator: Column | str, denominator: Column | str, *,
                  scale: int = 1, places: int = 2) -> Column:
    """A rate as stored in the split tables: rounded, NaN replaced by 0.

    Infinity is kept: a rate over zero attempts with a non-zero numerator stays
    visible. ``finite_or_null`` clears it where a sink cannot hold it.
    """
    quotient = ratio(numerator, denominator)
    if scale != 1:
        quotient = quotient * F.lit(float(scale))
    return F.nanvl(round_half_even(quotient, places), F.lit(0.0))


def finite_or_null(df: DataFrame) -> DataFrame:
    """Replace NaN and infinities in floating-point columns by NULL."""
    floating = [f.name for f in df.schema
                if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({
        c: F.when(~F.isnan(c) & (F.abs(F.col(c)) != F.lit(INF)), F.col(c))
        for c in floating})
