"""Layer tables: read, append, replace. Written tables have versions; directories of
Parquet files that something else wrote are read as they are."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from gridstats.sources import versions
from gridstats.sources.versions import Conflict, Version


def read_table(spark: SparkSession, path: str) -> DataFrame:
    version = versions.current(spark, path)
    return versions.read(spark, path, version) if version else spark.read.parquet(path)


def read_table_if_any(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None if it was never written, or not to the end; other errors
    propagate."""
    return None if versions.absent(spark, path) else read_table(spark, path)


def append_table(df: DataFrame, path: str, *, partition_by: Sequence[str] = ()) -> Version:
    """Add the rows to whatever the table holds when they are written."""
    spark = df.sparkSession
    versions.refuse_plain_files(spark, path)
    new = versions.write(df, path, partition_by)
    while True:
        base = versions.current(spark, path)
        try:
            return versions.commit(spark, path, base, new, df.schema,
                                   keep=base.directories if base else (),
                                   notes=base.notes if base else None)
        except Conflict:
            continue


def append_once(df: DataFrame, path: str, base: Version | None, *,
                partition_by: Sequence[str] = ()) -> Version | None:
    """Add the rows if the table still is at ``base``, on which they were chosen.

    Otherwise they are discarded and ``Conflict`` is raised. Without rows there is
    no new version."""
    spark = df.sparkSession
    if base is None:
        versions.refuse_plain_files(spark, path)
    new = versions.write(df, path, partition_by)
    if not new:
        return base
    try:
        return versions.commit(spark, path, base, new, df.schema,
                               keep=base.directories if base else (),
                               notes=base.notes if base else None)
    except Conflict:
        versions.discard(spark, path, new)
        raise


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """Even file-sized partitions, grouped by ``columns`` as far as sizes allow.

    Adaptive execution merges small and splits oversized partitions, so that a
    dominant season yields many files and a small one does not yield a file
    from every task.
    """
    return df.hint("rebalance", *columns)


def clustered(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of one key in the same file, in order.

    Later group-bys on the columns combine nearly everything on the map side, and
    filters on them skip row groups. Adaptive execution splits oversized partitions,
    so no key, however frequent, has to fit into one task, and nothing is sampled:
    the plan below runs once.
    """
    return rebalanced(df, *columns).sortWithinPartitions(*columns)


def replace_table(df: DataFrame, path: str, *, partition_by: Sequence[str] = (),
                  cluster_by: Sequence[str] = (), partitions: Iterable[str] | None = None,
                  base: Version | None = None,
                  notes: Mapping[str, Any] | None = None) -> Version:
    """Put the rows in place of the table, or of the ``partitions`` named of it.

    The table is what it was until the rows are written; readers who have begun keep
    the version before, older ones are deleted. Of two writers at once the later
    commit holds. With ``partitions`` (``season=1996``, ...) all rows must belong to
    those; directories of the others are taken over, unread, from the version
    ``base``, and if that is no longer the newest, ``Conflict`` is raised.
    """
    spark = df.sparkSession
    if cluster_by:
        df = clustered(df, *partition_by, *cluster_by)
    new = versions.write(df, path, partition_by)
    keep: list[str] = []
    if partitions is not None:
        gone = set(partitions)
        if extra := {versions.partition_of(d) for d in new} - gone:
            versions.discard(spark, path, new)
            raise ValueError(f"rows of other partitions than those to replace: {sorted(extra)}")
        keep = [d for d in base.directories if versions.partition_of(d) not in gone] \
            if base else []
    while True:
        newest = versions.current(spark, path)
        try:
            version = versions.commit(spark, path, base if partitions is not None else newest,
                                      new, df.schema, keep=keep, notes=notes)
            break
        except Conflict:
            if partitions is not None:
                versions.discard(spark, path, new)
                raise
    versions.expire(spark, path)
    return version
