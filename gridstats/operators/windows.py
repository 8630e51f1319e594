"""Rolling means and running totals over ordered rows of a group.

Both are meant for rows that are already aggregated to one per game, where a
(player, season) group is bounded by the number of games in a season. They
refuse to run without a partition, which would put every row into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridstats.functions.numeric import round_half_even
from gridstats.operators.measures import MEAN_PLACES


def _ordered(partition_by: Sequence[str], order_by: Sequence[str]) -> WindowSpec:
    if not partition_by:
        raise ValueError("a window needs partition columns")
    return Window.partitionBy(*partition_by).orderBy(*order_by)


def rolling_mean(df: DataFrame, columns: Mapping[str, str], rows: int, *,
                 partition_by: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Mean of the last ``rows`` rows including the current one, rounded.

    ``columns`` maps inputs to output names. Nulls are skipped, and NaN affects
    only the windows that contain it.
    """
    window = _ordered(partition_by, order_by).rowsBetween(1 - rows, Window.currentRow)
    return df.withColumns({
        out: round_half_even(F.avg(c).over(window), MEAN_PLACES)
        for c, out in columns.items()})


def running_total(df: DataFrame, columns: Mapping[str, str], *,
                  partition_by: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Sum up to the current row; NULL on null rows while the total carries on."""
    window = _ordered(partition_by, order_by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({
        out: F.when(F.col(c).isNotNull(), F.sum(c).over(window))
        for c, out in columns.items()})
