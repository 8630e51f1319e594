"""Helpers the text operators share: words, the shared folder, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstats.sources.scratch import shared_folder

# A word is a run of characters other than blank, tab, line feed, vertical tab,
# form feed and carriage return.
BLANKS = "[\\x20\\x09-\\x0D]+"

# Rows of (long, flag) a broadcast may hold: about 64 MB as a hashed relation.
BROADCAST_ROWS = 2_000_000


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def as_one(names: list[str], into: str = "_in") -> Column:
    """The columns as one struct, so that none of them meets a helper of its name."""
    return F.struct(*map(quoted, names)).alias(into)


def apart(names: list[str], packed: str = "_in") -> list[Column]:
    return [F.col(packed)[c].alias(c) for c in names]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/gridstats/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends here,
    so that a lost executor costs a read and not the work before it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(work: DataFrame, rows: int, *columns: str) -> DataFrame:
    """Rows that each stand for much work, such as files to read, over as many tasks as
    there are rows, or a few for each core. A partitioning without a number would be
    merged to one task, as the rows themselves are small."""
    cores = work.sparkSession.sparkContext.defaultParallelism
    return work.repartition(max(1, min(rows, 4 * cores)), *columns)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast only if a count proves it holds at most ``rows`` rows;
    beyond that Spark shuffles. For thin tables of fixed-width columns."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def ship_package() -> None:
    """Give the executors this package: functions that run there refer to it."""
    context = SparkSession.active().sparkContext
    if getattr(context, "_gridstats_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="gridstats-")) / "gridstats.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(str(archive))
    context._gridstats_shipped = True


class Recent:
    """A bounded table of what texts gave: two halves, the older dropped when the newer is full."""

    def __init__(self, size: int):
        self.half, self.new, self.old = size // 2, {}, {}

    def get(self, key: str):
        value = self.new.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key: str, value) -> None:
        if len(self.new) >= self.half:
            self.old, self.new = self.new, {}
        self.new[key] = value

    def holding(self, keys: set[str]) -> dict:
        """The newer half, with room for ``keys`` and with those that the older has."""
        if len(self.new) + len(keys) > self.half:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        if old:
            new.update((k, old[k]) for k in keys.difference(new) if k in old)
        return new
