"""Raw plays by season."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridstats import schema as S
from gridstats.operators.bronze import as_declared, require_kinds
from gridstats.operators.quality import require_columns


# Formats whose files say what types they hold.
TYPED_FORMATS = ("parquet", "orc")


def _read_merged(spark: SparkSession, source_format: str, path: str,
                 files: list[str]) -> DataFrame | None:
    """The files as one table with the columns of all of them, None if a column has
    different types. Footers are read and compared by a distributed job."""
    reader = spark.read.format(source_format).option("basePath", path)
    try:
        return reader.option("mergeSchema", "true").load(files)
    except Py4JJavaError as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
        return None


def _of_one_type(spark: SparkSession, source_format: str, path: str,
                 files: list[str]) -> list[list[str]]:
    """The files in groups whose types agree.

    Files that differ are halved until they agree, and halves that agree are put
    together again. Deliveries come in runs, so there are few halves."""
    if _read_merged(spark, source_format, path, files) is not None or len(files) == 1:
        return [files]
    middle = len(files) // 2
    groups: list[tuple[dict[str, str], list[str]]] = []
    for half in (files[:middle], files[middle:]):
        for group in _of_one_type(spark, source_format, path, half):
            types = dict(_read_merged(spark, source_format, path, group).dtypes)
            for known, members in groups:
                if all(known.get(c, t) == t for c, t in types.items()):
                    known.update(types)
                    members.extend(group)
                    break
            else:
                groups.append((types, list(group)))
    return [members for _, members in groups]


def _season(spark: SparkSession, path: str, season: int, source_format: str) -> list[DataFrame]:
    """The season's plays as tables that are each of one type, mostly a single one."""
    directory = f"{path.rstrip('/')}/season={season}"
    if source_format not in TYPED_FORMATS:
        return [spark.read.format(source_format).option("basePath", path).load(directory)]
    merged = _read_merged(spark, source_format, path, [directory])
    if merged is not None:
        return [merged]
    files = sorted(spark.read.format(source_format).load(directory).inputFiles())
    return [_read_merged(spark, source_format, path, group)
            for group in _of_one_type(spark, source_format, path, files)]


def _by_season(spark: SparkSession, path: str, wanted: list[int] | None,
               source_format: str) -> DataFrame | None:
    """The seasons' directories, files of equal types read together and cast to the
    declared ones; None if the data are not laid out by season. The number of
    directories is bounded by the calendar."""
    whole = spark.read.format(source_format).load(path)
    if "season" not in whole.columns or not any(
            "/season=" in file for file in whole.limit(1).inputFiles()):
        return None
    if wanted is None:
        wanted = [r["season"] for r in whole.select("season").distinct().collect()]
    parts = []
    for season in sorted(wanted):
        try:
            tables = _season(spark, path, season, source_format)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        for part in tables:
            require_kinds(part)
            parts.append(as_declared(part.where(F.col("season") == season)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) \
        if parts else as_declared(whole).limit(0)


def read_plays(spark: SparkSession, path: str, seasons: Iterable[int] | None = None, *,
               extra_columns: Iterable[str] = (), source_format: str = "parquet",
               schema: StructType | str | None = None) -> DataFrame:
    """Plays of the given seasons.

    On data partitioned by ``season`` the filter selects directories, and every
    file may store numbers in its own types; otherwise the filter is pushed into
    the scan. ``schema`` overrides what files say. Columns nobody uses are never read;
    ``extra_columns`` keeps more of them, such as player ids to select by.
    """
    wanted = None if seasons is None else sorted(set(seasons))
    plays = None if schema is not None else _by_season(spark, path, wanted, source_format)
    if plays is None:
        reader = spark.read.format(source_format)
        plays = (reader if schema is None else reader.schema(schema)).load(path)
        if wanted is not None:
            plays = plays.where(F.col("season").isin(wanted))
    require_columns(plays, [*S.RAW_TYPES, *extra_columns])
    lineage = [c for c in (S.INGEST_SEQ,) if c in plays.columns]
    return plays.select(*S.RAW_TYPES, *lineage, *extra_columns)
