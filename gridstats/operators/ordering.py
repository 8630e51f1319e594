"""Presentation order. Stored tables have none, so sort when reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_columns(order: Sequence[str]) -> list[Column]:
    """``-name`` sorts downwards. Unknown values come first either way."""
    return [F.col(o[1:]).desc_nulls_first() if o.startswith("-")
            else F.col(o).asc_nulls_first() for o in order]


def in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*sort_columns(order)) if order else df
