"""Incremental bronze: only files that have arrived since the last run are read.

The batch run finds new plays by an anti-join with all recorded keys. Here the
recorded keys are the state of a streaming ``dropDuplicates``, partitioned over
the executors, and the file sink commits each batch once, so a run that dies is
resumed from its checkpoint without losing or repeating plays.

A play file may bring plays of any past game, so no watermark expires keys: the
state grows with the number of plays and belongs into the RocksDB state store
(``spark.sql.streaming.stateStore.providerClass``) on a large table.

The sink keeps its own commit log. Give it a directory of its own and do not
append to that by ``run_bronze`` as well.

``ingest_runs`` instead hands every lot of new files to a bronze run. It keeps no
state of plays: recorded ones are found in bronze, which may be fed by other runs, too.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridstats import schema as S
from gridstats.operators import bronze as B
from gridstats.plans.runs import BronzeReport, run_bronze

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def checkpoint_location(spark: SparkSession, name: str, given: str | None = None) -> str:
    """A directory that outlives any machine: the one given, else one under the
    cluster's shared checkpoint directory."""
    if given is not None:
        return given
    shared = spark.conf.get(CHECKPOINT_SETTING, None)
    if shared is None:
        raise ValueError(f"set {CHECKPOINT_SETTING} or pass a checkpoint location")
    return f"{shared.rstrip('/')}/{name}"


def unseen_plays(stream: DataFrame, *, player: str | None = None,
                 players: Iterable[str] | None = None, passer: str = S.PASSER,
                 rusher: str = S.RUSHER) -> DataFrame:
    """Plays whose complete key has not come by before; ``passer`` and ``rusher`` name
    the columns to select players by."""
    chosen = (B.plays_of(stream, player, passer=passer, rusher=rusher)
              if player is not None
              else B.plays_by_player(stream, players, passer=passer, rusher=rusher))
    keys = S.player_key(chosen.columns)
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return chosen.where(complete).dropDuplicates(keys)


def ingest_available(spark: SparkSession, source: str, bronze_path: str, *,
                     schema: str = S.RAW_DDL, checkpoint: str | None = None,
                     player: str | None = None, players: Iterable[str] | None = None,
                     passer: str = S.PASSER, rusher: str = S.RUSHER,
                     loaded_at: datetime | None = None) -> StreamingQuery:
    """Append what has arrived in ``source`` to bronze, then stop.

    ``schema`` tells the types of the files, whose flags may be floating-point;
    bronze has the declared types whatever they are.
    """
    stream = spark.readStream.schema(schema).parquet(source)
    B.require_kinds(stream)
    unseen = unseen_plays(stream, player=player, players=players, passer=passer,
                          rusher=rusher)
    return (B.as_declared(B.clean(unseen, loaded_at)).writeStream
            .format("parquet").outputMode("append")
            .partitionBy("season")
            .option("checkpointLocation",
                    checkpoint_location(spark, "bronze_ingest", checkpoint))
            .trigger(availableNow=True)
            .start(bronze_path))


def ingest_runs(spark: SparkSession, source: str, bronze_path: str, *,
                schema: str = S.RAW_DDL, checkpoint: str | None = None,
                files_per_run: int = 1000, reports: list[BronzeReport] | None = None,
                **options) -> StreamingQuery:
    """Run bronze over what has arrived in ``source``, ``files_per_run`` files at a
    time, then stop; ``options`` are those of ``run_bronze``.

    A lot that was cut short is delivered again whole, and the run then appends what
    is missing of it. ``reports`` collects what the runs tell.
    """
    def lot(plays: DataFrame, _: int) -> None:
        report = run_bronze(plays, bronze_path, **options)
        if reports is not None:
            reports.append(report)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_run)
    return (stream.parquet(source).writeStream.foreachBatch(lot)
            .option("checkpointLocation", checkpoint_location(spark, "bronze_runs", checkpoint))
            .trigger(availableNow=True).start())
