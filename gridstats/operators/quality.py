"""Data-quality checks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns that should never be null in new plays.
CRITICAL_COLUMNS = ("game_id", "play_id", "epa")


def require_columns(df: DataFrame, expected: Iterable[str]) -> None:
    """Raise ``ValueError`` naming the expected columns that are missing."""
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise ValueError(f"missing expected columns: {missing}")


def null_counts(columns: Sequence[str] = CRITICAL_COLUMNS) -> list[Column]:
    """One aggregate per column: how many rows hold NULL there."""
    return [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns]


def null_report(df: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS) -> DataFrame:
    """One row with the number of rows and the null counts, in one pass.

    To be taken before nulls are filled, or the filled columns cannot show any.
    """
    return df.agg(F.count(F.lit(1)).alias("n_plays"), *null_counts(columns))
