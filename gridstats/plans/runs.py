"""The three layers written to tables, in the order they depend on each other.

Bronze grows by appends; silver and gold are derived and replaced. A run that
is repeated, or restarted after a failure, appends only what is still missing.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridstats import schema as S
from gridstats.operators import bronze as B
from gridstats.operators.ordering import in_order
from gridstats.operators.quality import CRITICAL_COLUMNS, null_counts
from gridstats.plans.form import game_momentum, season_progression
from gridstats.plans.layers import new_plays, silver_plays
from gridstats.plans.performance import qb_performance
from gridstats.plans.splits import (
    GAME_TABLES, SPLIT_TABLES, build, family_of, partial_sums)
from gridstats.sources import keys, versions
from gridstats.sources.tables import (
    append_once, read_table, read_table_if_any, rebalanced, replace_table)
from gridstats.sources.versions import Conflict, Version

log = logging.getLogger(__name__)
T = TypeVar("T")

# How often a run that others keep overtaking starts again before it gives up.
ATTEMPTS = 10

PERFORMANCE = "qb_performance"
FORM_TABLES = {"game_momentum": game_momentum, "season_progression": season_progression}
GOLD_TABLES = (PERFORMANCE, *FORM_TABLES, *SPLIT_TABLES)
GOLD_ORDER = {name: ("week",) for name in (PERFORMANCE, *FORM_TABLES)} | {
    name: table.order for name, table in SPLIT_TABLES.items()}


@dataclass(frozen=True)
class BronzeReport:
    """What a bronze run appended, and nulls found in its critical columns."""

    n_plays: int
    nulls: dict[str, int]


def run_bronze(raw: DataFrame, bronze_path: str, *, player: str | None = None,
               players: Iterable[str] | None = None,
               passer: str = S.PASSER, rusher: str = S.RUSHER,
               recorded_seasons: Sequence[int] | None = None,
               season_in_key: bool = False, key_table: bool = False,
               corrections: bool = False,
               loaded_at: datetime | None = None) -> BronzeReport:
    """Append the plays of ``raw`` that bronze does not hold yet.

    One job reads, deduplicates, anti-joins and writes; the row and null counts
    are observed on the way, before nulls are filled, instead of by further
    passes. Nothing new means that no version is added.

    The plays are chosen against one version of bronze and committed only as the
    next one. If another run was faster, what this run wrote is discarded and chosen
    anew, so two runs at once never append the same play.

    ``recorded_seasons`` limits the recorded keys to those seasons' directories.
    Use it where a game id never occurs in two seasons; by default all recorded
    plays are compared. ``season_in_key`` declares that once: the season is then
    part of the key, and only the delivered seasons' directories are read.
    ``passer`` and ``rusher`` name the columns to select players by.

    With ``key_table`` the recorded keys come from a narrow table beside bronze that
    this run brings up to date (``sources.keys``): where games may span seasons, all
    of the history counts, and neither wide files are read nor keys shuffled.

    With ``corrections`` a recorded play that is delivered with other contents is
    appended once more, and the later arrival is the one that reaches silver; equal
    contents add nothing. Bronze then has a digest of the contents beside the key,
    from its first run on or added by ``add_digests``. ``loaded_at`` must grow.

    Columns are stored under the declared types of ``schema.BRONZE_TYPES``; a
    delivery of another kind of type is refused before anything is written.
    """
    B.require_kinds(raw)
    if key_table and (corrections or season_in_key or recorded_seasons is not None):
        raise ValueError("key_table compares the keys of all seasons and nothing else")
    spark = raw.sparkSession
    if season_in_key and recorded_seasons is None:
        recorded_seasons = [r["season"] for r in raw.select("season").distinct().collect()]

    def chosen(base: Version | None) -> DataFrame:
        recorded = known = None
        if base is not None and key_table:
            known = keys.recorded(spark, bronze_path, base)
        elif base is not None:
            recorded = versions.read(spark, bronze_path, base)
        else:
            recorded = read_table_if_any(spark, bronze_path)
        if recorded is not None and recorded_seasons is not None:
            recorded = recorded.where(F.col("season").isin(list(recorded_seasons)))
        if corrections and recorded is not None and S.CONTENT_DIGEST not in recorded.columns:
            raise ValueError(f"{bronze_path} holds plays without digests: see add_digests")
        fresh = new_plays(raw, recorded, player=player, players=players, passer=passer,
                          rusher=rusher, season_in_key=season_in_key, corrections=corrections)
        if not corrections and base is not None and S.CONTENT_DIGEST in base.schema.names:
            fresh = B.with_digest(fresh)
        return fresh if known is None else keys.exclude_bucketed(
            fresh, known, keys.n_buckets(spark, bronze_path))

    def append() -> BronzeReport:
        base = versions.current(spark, bronze_path)
        fresh = chosen(base)
        seen = Observation("new_plays")
        watched = rebalanced(fresh, "season").observe(
            seen, F.count(F.lit(1)).alias("n_plays"), *null_counts())
        version = append_once(B.as_declared(B.clean(watched, loaded_at)), bronze_path, base,
                              partition_by=["season"])
        if key_table and version is not None:
            keys.refresh(spark, bronze_path, version)
        counts = seen.get
        return BronzeReport(counts["n_plays"],
                            {c: counts[f"{c}_nulls"] for c in CRITICAL_COLUMNS})

    report = _until_committed(append)
    if report.n_plays == 0:
        log.warning("no new plays")
    elif any(report.nulls.values()):
        log.warning("nulls in critical columns: %s", report.nulls)
    return report


def add_digests(spark: SparkSession, bronze_path: str) -> None:
    """Write bronze once more with the digests that corrections are found by."""
    def step() -> None:
        base = versions.current(spark, bronze_path)
        table = read_table(spark, bronze_path)
        everything = {versions.partition_of(d) for d in base.directories} if base else None
        replace_table(B.with_digest(table), bronze_path, partition_by=["season"],
                      cluster_by=["game_id"], partitions=everything, base=base,
                      notes=base.notes if base else None)

    _until_committed(step)


def _until_committed(step: Callable[[], T]) -> T:
    """Repeat a step that another writer has overtaken."""
    for _ in range(ATTEMPTS):
        try:
            return step()
        except Conflict as overtaken:
            log.warning("overtaken by another run: %s", overtaken)
    return step()


def _read_filled(spark: SparkSession, path: str) -> DataFrame | None:
    """The table unless it is missing or empty; looks at one row only."""
    table = read_table_if_any(spark, path)
    if table is None or table.isEmpty():
        log.warning("nothing to process in %s", path)
        return None
    return table


# What a season-wise table notes of itself: the directories it was built from, the
# settings that went into it, and columns it has for its own use only.
BUILT_FROM, SETTINGS, HIDDEN = "built_from", "settings", "hidden"


def changed_partitions(source: Version, derived: Version | None,
                       settings: Sequence[str] = ()) -> set[str] | None:
    """Partitions of ``source`` with other directories than ``derived`` was built
    from; None if it was not built partition by partition with these settings, so
    that all have changed."""
    if derived is None or BUILT_FROM not in derived.notes \
            or derived.notes.get(SETTINGS) != list(settings):
        return None
    changed = set(derived.notes[BUILT_FROM]) ^ set(source.directories)
    return {versions.partition_of(d) for d in changed}


def _season_wise(spark: SparkSession, source_path: str, path: str,
                 plan: Callable[[DataFrame], DataFrame], *, settings: Sequence[str] = (),
                 cluster_by: Sequence[str] = (), hidden: Sequence[str] = ()) -> bool:
    """Bring a table up to date that has every season of its source by itself; False
    if no season has changed. Only changed seasons are read and written."""
    def step() -> bool:
        source, base = versions.current(spark, source_path), versions.current(spark, path)
        if source is None:
            raise ValueError(f"{source_path} has no versions to tell what has changed")
        changed = changed_partitions(source, base, settings)
        if changed is not None and not changed:
            log.warning("nothing new for %s", path)
            return False
        rows = plan(versions.read(spark, source_path, source, changed))
        replace_table(rows, path, partition_by=["season"], partitions=changed, base=base,
                      cluster_by=[c for c in cluster_by if c in rows.columns],
                      notes={BUILT_FROM: source.directories, SETTINGS: list(settings),
                             HIDDEN: list(hidden)})
        return True

    return _until_committed(step)


SILVER_CLUSTER = (S.PLAYER, "game_id", "play_id")


def run_silver(spark: SparkSession, bronze_path: str, silver_path: str, *,
               season_in_key: bool = False, loaded_at: datetime | None = None) -> bool:
    """Replace silver; False, with nothing written, if bronze is empty.

    Silver is read by every gold table, so it is stored clustered by player and
    game: their group-bys then combine on the map side almost completely.

    ``season_in_key`` declares, as for bronze, that plays of two seasons are never
    the same. Then only seasons that got plays since the last such run are read and
    written, one directory each, and the others are taken over with the load stamp
    they have. The rows are those of a full run with ``season_in_key``.
    """
    bronze = _read_filled(spark, bronze_path)
    if bronze is None:
        return False

    def plan(plays: DataFrame) -> DataFrame:
        return silver_plays(plays, loaded_at, season_in_key=season_in_key)

    if season_in_key:
        _season_wise(spark, bronze_path, silver_path, plan, cluster_by=SILVER_CLUSTER)
    else:
        silver = plan(bronze)
        replace_table(silver, silver_path, partition_by=["season"],
                      cluster_by=[c for c in SILVER_CLUSTER if c in silver.columns])
    return True


def run_gold(spark: SparkSession, silver_path: str, gold_path: str, *,
             team: str | Column, player: str | None = None,
             tables: Sequence[str] = GOLD_TABLES, extra_keys: Sequence[str] = (),
             by_season: bool = False, loaded_at: datetime | None = None) -> list[str]:
    """Replace the gold tables asked for and return their names.

    Tables are directories ``gold_<name>`` under ``gold_path``. The form tables
    read the stored performance table, so ask for it in the same or an earlier
    run. ``extra_keys`` splits the split tables further, for instance by season.
    Silver of a single player needs that ``player``.

    Tables of a family are folded from its partial sums, stored beside them as
    ``partial_<family>``, so all fourteen tables read silver six times.

    With ``by_season`` a run reads only seasons of silver that have changed since the
    last such run with the same settings, and costs what they hold: tables with a row
    per game keep every season in a directory of its own, the others are folded from
    partial sums that do. It declares that no game spans two seasons, and needs
    silver of all players. Rows of seasons that stay keep their load stamp.
    """
    unknown = sorted(set(tables) - set(GOLD_TABLES))
    if unknown:
        raise ValueError(f"unknown gold tables: {unknown}")
    silver = _read_filled(spark, silver_path)
    if silver is None:
        return []
    by_player = S.PLAYER in silver.columns
    if not by_player and (player is None or by_season):
        raise ValueError("silver has no player column: name the player, and take all seasons")
    asked = [t for t in GOLD_TABLES if t in tables]
    if by_season:
        return _gold_by_season(spark, silver_path, gold_path, asked, team, extra_keys, loaded_at)
    written, partials = [], {}
    for name in asked:
        if name == PERFORMANCE:
            table = qb_performance(silver, team=team, player=player, loaded_at=loaded_at)
        elif name in FORM_TABLES:
            games = _read_filled(spark, gold_table_path(gold_path, PERFORMANCE))
            if games is None:
                continue
            table = FORM_TABLES[name](games, by_player=by_player)
        elif family := family_of(name):
            if family not in partials:
                path = partial_path(gold_path, family)
                replace_table(partial_sums(family, silver, extra_keys=extra_keys), path)
                partials[family] = read_table(spark, path)
            table = build(name, partials[family], player=player, extra_keys=extra_keys,
                          loaded_at=loaded_at, folded=True)
        else:
            table = build(name, silver, team=team, player=player, extra_keys=extra_keys,
                          loaded_at=loaded_at)
        replace_table(table, gold_table_path(gold_path, name))
        written.append(name)
    return written


def _gold_by_season(spark: SparkSession, silver_path: str, gold_path: str, names: Sequence[str],
                    team: str | Column, extra_keys: Sequence[str],
                    loaded_at: datetime | None) -> list[str]:
    settings = [str(team), *extra_keys]
    with_season = list(dict.fromkeys([*extra_keys, "season"]))
    hidden = [c for c in with_season if c not in extra_keys]
    performance = gold_table_path(gold_path, PERFORMANCE)
    written, refreshed = [], set()
    for name in names:
        path = gold_table_path(gold_path, name)
        if name == PERFORMANCE:
            _season_wise(spark, silver_path, path, settings=settings, plan=lambda plays:
                         qb_performance(plays, team=team, loaded_at=loaded_at))
        elif name in FORM_TABLES:
            if versions.current(spark, performance) is None:
                log.warning("nothing to process in %s", performance)
                continue
            _season_wise(spark, performance, path, FORM_TABLES[name])
        elif name in GAME_TABLES:
            _season_wise(spark, silver_path, path, settings=settings, hidden=hidden,
                         plan=lambda plays, name=name: build(
                             name, plays, extra_keys=with_season, loaded_at=loaded_at))
        else:
            family = family_of(name, by_season=True)
            partial = partial_path(gold_path, family)
            if family not in refreshed:
                _season_wise(spark, silver_path, partial, settings=settings,
                             plan=lambda plays, family=family: partial_sums(
                                 family, plays, team=team, extra_keys=with_season))
                refreshed.add(family)
            replace_table(build(name, read_table(spark, partial), extra_keys=extra_keys,
                                loaded_at=loaded_at, folded=True), path)
        written.append(name)
    return written


def partial_path(gold_path: str, family: str) -> str:
    return f"{gold_path.rstrip('/')}/partial_{family}"


def gold_table_path(gold_path: str, name: str) -> str:
    return f"{gold_path.rstrip('/')}/gold_{name}"


def read_gold(spark: SparkSession, gold_path: str, name: str, *,
              ordered: bool = False) -> DataFrame:
    """A stored gold table, in its presentation order if asked for."""
    path = gold_table_path(gold_path, name)
    version = versions.current(spark, path)
    hidden = version.notes.get(HIDDEN, ()) if version else ()
    table = read_table(spark, path).drop(*hidden)
    return in_order(table, GOLD_ORDER[name]) if ordered else table
