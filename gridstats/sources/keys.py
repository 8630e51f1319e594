"""The recorded keys of bronze as a narrow table beside it, bucketed by the key.

A run that looks for new plays reads this table instead of bronze: keys only, and
already dealt out by the key, so that the recorded side of the join is not shuffled
however long the history is. It notes the directories of bronze whose keys it holds.
A run that finds it behind, because an earlier one died or wrote without it, adds
what is missing; if bronze was replaced, or the table is gone, it is built anew.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstats import schema as S
from gridstats.sources import versions
from gridstats.sources.versions import WRITE, Version

ROWS_PER_BUCKET = 4_000_000
LEAST_BUCKETS = 8
# With more writes than this, all keys are written once more, as one write with as
# many buckets as they need by then.
MOST_WRITES = 32
HOLDS, BUCKETS = "holds", "buckets"


def keys_path(bronze_path: str) -> str:
    return f"{bronze_path.rstrip('/')}_keys"


def _table_name(*parts: str) -> str:
    return "gridstats_keys_" + hashlib.md5("|".join(parts).encode()).hexdigest()


def _write(keys: DataFrame, path: str, buckets: int) -> str:
    """A directory with one file per bucket that has rows."""
    name = f"{WRITE}=w{uuid.uuid4().hex}"
    table = _table_name(path, name)
    # The exchange deals the rows out as the buckets do: a task writes one of them.
    (keys.repartition(buckets, *keys.columns).write.format("parquet")
     .bucketBy(buckets, *keys.columns).option("path", f"{path}/{name}").saveAsTable(table))
    keys.sparkSession.sql(f"DROP TABLE {table}")          # external: the files stay
    return name


def _read(spark: SparkSession, path: str, version: Version) -> DataFrame:
    """The keys of the version's writes, under the catalog's knowledge of buckets."""
    buckets, names = version.notes[BUCKETS], version.schema.names
    table = _table_name(path, *version.directories)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in version.schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, `{WRITE}` string) USING parquet "
              f"PARTITIONED BY (`{WRITE}`) CLUSTERED BY ({', '.join(f'`{c}`' for c in names)}) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    spark.catalog.recoverPartitions(table)
    writes = [d.partition("=")[2] for d in version.directories]
    return spark.table(table).where(F.col(WRITE).isin(writes)).select(*names)


def _keys_of(spark: SparkSession, bronze_path: str, bronze: Version,
             directories: Sequence[str]) -> DataFrame:
    """Complete keys in some directories of bronze; only key columns are read."""
    part = Version(bronze.number, bronze.schema, tuple(directories))
    keys = S.player_key(bronze.schema.names)
    return versions.read(spark, bronze_path, part).select(*keys).dropna()


def _buckets_for(rows: int) -> int:
    return max(LEAST_BUCKETS, 1 << max(0, rows // ROWS_PER_BUCKET).bit_length())


def _refreshed(spark: SparkSession, bronze_path: str, bronze: Version) -> Version:
    """The key table's version, after it has been brought up to this one of bronze."""
    path = keys_path(bronze_path)
    base = versions.current(spark, path)
    held = set(base.notes[HOLDS]) if base else set()
    new = [d for d in bronze.directories if d not in held]
    fits = base is not None and held <= set(bronze.directories) \
        and len(base.directories) < MOST_WRITES
    if fits and not new:
        return base
    keys = _keys_of(spark, bronze_path, bronze, new if fits else bronze.directories)
    buckets = base.notes[BUCKETS] if fits else _buckets_for(keys.count())
    written = _write(keys, path, buckets)
    version = versions.commit(
        spark, path, base, [written], keys.schema, keep=base.directories if fits else (),
        notes={HOLDS: bronze.directories, BUCKETS: buckets})
    versions.expire(spark, path)
    return version


def refresh(spark: SparkSession, bronze_path: str, bronze: Version) -> Version:
    while True:
        try:
            return _refreshed(spark, bronze_path, bronze)
        except versions.Conflict:
            continue


def recorded(spark: SparkSession, bronze_path: str, bronze: Version) -> DataFrame:
    """Keys of all plays of this version of bronze, dealt out in buckets."""
    return _read(spark, keys_path(bronze_path), refresh(spark, bronze_path, bronze))


def n_buckets(spark: SparkSession, bronze_path: str) -> int:
    return versions.current(spark, keys_path(bronze_path)).notes[BUCKETS]


def exclude_bucketed(plays: DataFrame, known: DataFrame, buckets: int) -> DataFrame:
    """Plays whose key is not among the ``known`` ones; incomplete keys are dropped.

    The plays are dealt out like the buckets, under the types the keys are stored in,
    so the known side is read in place."""
    types = dict(known.dtypes)
    stored = {c: F.col(c).cast(types[c]) for c in known.columns}
    complete = plays.where(" AND ".join(f"`{c}` IS NOT NULL" for c in known.columns))
    dealt = complete.withColumns({f"_key_{c}": v for c, v in stored.items()}).repartition(
        buckets, *[f"_key_{c}" for c in known.columns])
    same = [F.col(f"_key_{c}") == F.col(f"_known_{c}") for c in known.columns]
    renamed = known.select(*[F.col(c).alias(f"_known_{c}") for c in known.columns])
    return dealt.join(renamed, same, "left_anti").drop(*[f"_key_{c}" for c in known.columns])


def differences(spark: SparkSession, bronze_path: str) -> tuple[int, int]:
    """(keys that the table lacks, keys it has beyond bronze): (0, 0) if all is well.

    Reads the keys of all of bronze; for use on demand."""
    bronze = versions.current(spark, bronze_path)
    table = versions.current(spark, keys_path(bronze_path))
    truth = _keys_of(spark, bronze_path, bronze, bronze.directories)
    if table is None:
        return truth.distinct().count(), 0
    held = _read(spark, keys_path(bronze_path), table)
    lacks = truth.distinct().join(held, truth.columns, "left_anti").count()
    return lacks, held.distinct().join(truth, truth.columns, "left_anti").count()
