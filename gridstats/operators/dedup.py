"""Deterministic deduplication and the anti-join against recorded plays."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridstats.schema import BRONZE_LOADED_AT, CONTENT_DIGEST, INGEST_SEQ


def _keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order.

    ``row_number() = 1`` is planned with a group limit on both sides of the
    shuffle, so each map task sends at most one row per key: a key with a huge
    number of copies is thinned out before it reaches a single reducer.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def _content_order(columns: Sequence[str]) -> Column:
    """A repeatable order among rows that nothing else tells apart.

    The hash passes over NULLs, so where they stand is hashed too. That two rows
    of one play differ and still share all 64 bits is accepted.
    """
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def keep_any(df: DataFrame, keys: Sequence[str], tie_break: Sequence[Column] | None = None,
             unique_arrival: bool = False, contents: Sequence[str] | None = None) -> DataFrame:
    """One row per key. Any row would do, but a rerun must choose the same one.

    ``unique_arrival`` declares that ``tie_break`` leaves no ties within a key.
    ``contents`` are the columns that break ties, all unless given.
    """
    if tie_break is None:
        tie_break = [F.col(INGEST_SEQ).asc()] if INGEST_SEQ in df.columns else []
    if not (unique_arrival and tie_break):
        tie_break = [*tie_break, _content_order(df.columns if contents is None else contents)]
    return _keep_one(df, keys, tie_break)


def keep_last(df: DataFrame, keys: Sequence[str], arrival: Sequence[str] | None = None,
              unique_arrival: bool = False) -> DataFrame:
    """The row of every key that arrived last.

    ``unique_arrival`` declares that no two rows of a key arrived at the same time:
    ties need not be broken then, and columns nobody uses are not read for it.
    """
    if arrival is None:
        arrival = [c for c in (BRONZE_LOADED_AT, INGEST_SEQ) if c in df.columns]
    order = [F.col(c).desc_nulls_last() for c in arrival]
    return _keep_one(df, keys, order if unique_arrival else [*order, _content_order(df.columns)])


def recorded_keys(bronze: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of the plays an earlier run has stored."""
    return bronze.select(*keys).distinct()


def exclude_recorded(plays: DataFrame, recorded: DataFrame,
                     keys: Sequence[str]) -> DataFrame:
    """Plays whose key is not recorded yet.

    A play with an incomplete key can be neither recognised nor stored under a
    key, so it is dropped; a bare anti-join would keep it. The join runs on the
    typed key columns, shuffles by the same keys as the deduplication before it,
    and is broadcast only if Spark finds the recorded side below its threshold.
    Recorded keys may repeat: an anti-join only asks whether there is one.
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return plays.where(complete).join(
        recorded.select(*keys).where(complete), list(keys), "left_anti")


def exclude_unchanged(plays: DataFrame, recorded: DataFrame,
                      keys: Sequence[str]) -> DataFrame:
    """Plays that are not recorded, or whose last record has other contents.

    Both sides have a ``content_digest``. Recorded plays are folded to the last digest
    of each key before the exchange, so a play corrected any number of times sends one
    row per task. Incomplete keys are dropped.
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    arrival = [c for c in (BRONZE_LOADED_AT, INGEST_SEQ) if c in recorded.columns]
    last = recorded.where(complete).groupBy(*keys).agg(
        F.max(F.struct(*arrival, CONTENT_DIGEST))[CONTENT_DIGEST].alias("_recorded"))
    return (plays.where(complete).join(last, list(keys), "left")
            .where(F.col("_recorded").isNull() | (F.col("_recorded") != F.col(CONTENT_DIGEST)))
            .drop("_recorded"))
