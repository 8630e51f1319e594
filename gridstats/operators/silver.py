"""Silver: lenient types, analysis names and derived features."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame

from gridstats import schema as S
from gridstats.functions import football as fb
from gridstats.operators.bronze import timestamp_column


# What the integral target types can hold.
LIMITS = {"tinyint": (-128, 127), "int": (-2_147_483_648, 2_147_483_647)}
WHOLE_NUMBER = "^[+-]?[0-9]+$"


def lenient_cast(column: str, source: str, target: str) -> str:
    """SQL for a cast that yields NULL where the value does not fit.

    Fractions are cut off. The value is tested first, since a failing
    ``try_cast`` costs a Java exception, which adds up where a column is dirty.
    """
    cast = f"try_cast(`{column}` AS {target})"
    if source == target or target not in LIMITS:
        return cast
    low, high = LIMITS[target]
    if source == "string":
        return f"CASE WHEN `{column}` RLIKE '{WHOLE_NUMBER}' THEN {cast} END"
    if source in ("float", "double"):
        return f"CASE WHEN `{column}` > {low - 1}D AND `{column}` < {high + 1}D THEN {cast} END"
    if source in ("smallint", "int", "bigint"):
        return f"CASE WHEN `{column}` BETWEEN {low} AND {high} THEN {cast} END"
    return cast


def enforce_schema(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the listed columns that are present; what does not fit becomes NULL."""
    return df.selectExpr(*[
        f"{lenient_cast(c, source, types[c])} AS `{c}`" if c in types else f"`{c}`"
        for c, source in df.dtypes])


def rename_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(S.RENAMES)


def add_features(df: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    """Success, red zone and two-point result; the source's own two-point
    column is replaced by what the play text says."""
    return df.withColumns({
        "is_success": fb.is_success(),
        "is_redzone": fb.is_redzone(),
        "two_point_conv_result": fb.two_point_result(),
        "silver_loaded_at": timestamp_column(loaded_at),
    })
