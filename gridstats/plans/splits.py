"""The eleven split tables: one grouped aggregation each over silver plays.

A table is a declaration (filters, keys, measures, rates, order); ``build`` is
the only code. Tables with few groups and the same plays form a family: they are
folded from one stored table of partial sums, so silver is read once for all of
them. All aggregates have fixed-width buffers, so Spark combines them
in a hash map on the map side and ships one row per group and task: a group
that holds a large share of all plays costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.functions import football as fb
from gridstats.functions.numeric import rounded_ratio
from gridstats.operators.bronze import timestamp_column
from gridstats.operators import measures
from gridstats.operators.measures import Folded, parts
from gridstats.schema import PLAYER


@dataclass(frozen=True)
class SplitTable:
    keys: tuple[str, ...]
    measures: Callable[[Any], list[Column]]
    rates: tuple[str, ...] = ()
    where: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    player_column: bool = True


# Rate -> (numerator, denominator, scale), all taken from the table's measures.
RATES = {
    "completion_pct": ("complete_pass", "pass_attempt", 100),
    "yards_per_attempt": ("passing_yards", "pass_attempt", 1),
    "yards_per_carry": ("rushing_yards", "rush_attempt", 1),
    "air_yards_per_attempt": ("air_yards", "pass_attempt", 1),
    "air_yards_per_target": ("air_yards", "pass_attempt", 1),
    "yac_per_reception": ("yards_after_catch", "complete_pass", 1),
    "yards_per_reception": ("passing_yards", "complete_pass", 1),
}

KNOWN_DOWN = "down IS NOT NULL"
KNOWN_RECEIVER = "receiver_player_name IS NOT NULL"
PASS_PLAY = "pass_attempt = 1"
RED_ZONE = "is_redzone = 1"

RUSHING = ("rush_attempt", "rushing_yards", "rush_touchdown")


def _totals(m, *columns: str) -> list[Column]:
    return [m.total(c) for c in columns]


def _pressure(m, *, gained: bool, air: bool, week: bool = False) -> list[Column]:
    """Measures common to the pressure tables, with their optional members."""
    return [
        *([m.dependent("week")] if week else []),
        m.mean("epa"), m.mean("cpoe"),
        *([m.mean("yards_gained", "avg_yards_gained")] if gained else []),
        m.official("pass_attempt"),
        *_totals(m, "complete_pass", "pass_touchdown", "interception", "passing_yards"),
        *(_totals(m, "air_yards", "yards_after_catch") if air else []),
        *_totals(m, *RUSHING),
        m.total("qb_dropback", "total_dropbacks"),
        *_totals(m, "qb_scramble", "sack"),
        m.n_rows("n_plays"),
    ]


def _receiving(m, *sums: str, cpoe: bool = False) -> list[Column]:
    return [m.mean("epa"), *([m.mean("cpoe")] if cpoe else []),
            m.official("pass_attempt"), *_totals(m, *sums), m.n_rows("n_targets")]


CAUGHT = ("complete_pass", "pass_touchdown", "passing_yards")

SPLIT_TABLES: Mapping[str, SplitTable] = {
    "situational_splits": SplitTable(
        where=(KNOWN_DOWN,),
        keys=("down", "score_bucket", "quarter", "home_or_away"),
        measures=lambda m: [
            m.mean("epa"), m.official("pass_attempt"), m.total("complete_pass"),
            m.official("passing_yards"),
            *_totals(m, "pass_touchdown", "interception", "sack", *RUSHING),
            m.n_rows("n_plays")],
        rates=("completion_pct", "yards_per_attempt", "yards_per_carry")),
    "efficiency_profile": SplitTable(
        where=(PASS_PLAY, "pass_length IS NOT NULL"),
        keys=("game_id", "pass_length", "pass_location"),
        measures=lambda m: [
            m.official("pass_attempt"),
            *_totals(m, "complete_pass", "air_yards", "yards_after_catch",
                     "pass_touchdown", "interception"),
            m.mean("epa"), m.mean("cpoe"), m.n_rows("n_plays")],
        rates=("completion_pct", "air_yards_per_attempt", "yac_per_reception"),
        order=("game_id",), player_column=False),
    "pressure_overview": SplitTable(
        where=(KNOWN_DOWN,), keys=("pressure_type",),
        measures=lambda m: _pressure(m, gained=True, air=True),
        rates=("completion_pct", "yards_per_attempt", "air_yards_per_attempt",
               "yards_per_carry")),
    "pressure_by_down": SplitTable(
        where=(KNOWN_DOWN,), keys=("pressure_type", "down"),
        measures=lambda m: _pressure(m, gained=True, air=True),
        rates=("completion_pct", "yards_per_carry"),
        order=("down", "pressure_type")),
    "pressure_by_quarter": SplitTable(
        where=(KNOWN_DOWN,), keys=("pressure_type", "quarter"),
        measures=lambda m: _pressure(m, gained=False, air=False),
        rates=("completion_pct", "yards_per_carry"),
        order=("quarter", "pressure_type")),
    "pressure_by_opponent": SplitTable(
        where=(KNOWN_DOWN,), keys=("game_id", "pressure_type", "opponent_team"),
        measures=lambda m: _pressure(m, gained=False, air=True, week=True),
        rates=("completion_pct", "yards_per_attempt", "yards_per_carry"),
        order=("week", "opponent_team", "pressure_type")),
    "pressure_air_yards": SplitTable(
        where=(KNOWN_DOWN, PASS_PLAY), keys=("pressure_type",),
        measures=lambda m: [
            m.official("pass_attempt"), m.mean("air_yards", "avg_air_yards"),
            m.mean("yards_after_catch", "avg_yac"),
            m.total("qb_dropback", "total_dropbacks"), m.n_rows("n_plays")]),
    "receiver_overview": SplitTable(
        where=(KNOWN_RECEIVER, KNOWN_DOWN), keys=("receiver_player_name",),
        measures=lambda m: _receiving(m, *CAUGHT, "air_yards", "yards_after_catch", cpoe=True),
        rates=("completion_pct", "air_yards_per_target", "yac_per_reception",
               "yards_per_reception"),
        order=("-epa",)),
    "receiver_by_down": SplitTable(
        where=(KNOWN_RECEIVER, KNOWN_DOWN), keys=("receiver_player_name", "down"),
        measures=lambda m: _receiving(m, *CAUGHT, "air_yards"),
        rates=("completion_pct", "air_yards_per_target"),
        order=("receiver_player_name", "down")),
    "receiver_by_situation": SplitTable(
        where=(KNOWN_RECEIVER, KNOWN_DOWN), keys=("receiver_player_name", "score_bucket"),
        measures=lambda m: _receiving(m, *CAUGHT), rates=("completion_pct",),
        order=("receiver_player_name", "score_bucket")),
    "receiver_redzone": SplitTable(
        where=(KNOWN_RECEIVER, KNOWN_DOWN, RED_ZONE), keys=("receiver_player_name",),
        measures=lambda m: _receiving(m, *CAUGHT), rates=("completion_pct",),
        order=("-pass_touchdown",)),
}


@dataclass(frozen=True)
class Family:
    """Tables that are folded from partial sums over the keys of them all."""

    tables: tuple[str, ...]
    keys: tuple[str, ...]
    where: tuple[str, ...]
    sums: tuple[str, ...]
    means: tuple[str, ...]
    officials: tuple[str, ...] = ("pass_attempt",)
    by_season: bool = False       # worth storing only where seasons are kept apart


# No key of a game is among them: partial sums by game are as many as the plays.
FAMILIES: Mapping[str, Family] = {
    "pressure": Family(
        tables=("pressure_overview", "pressure_by_down", "pressure_by_quarter",
                "pressure_air_yards"),
        keys=("pressure_type", "down", "quarter", "pass_attempt"),
        where=(KNOWN_DOWN,),
        sums=("complete_pass", "pass_touchdown", "interception", "passing_yards",
              *RUSHING, "qb_dropback", "qb_scramble", "sack"),
        means=("epa", "cpoe", "yards_gained", "air_yards", "yards_after_catch")),
    "receivers": Family(
        tables=("receiver_overview", "receiver_by_down", "receiver_by_situation",
                "receiver_redzone"),
        keys=("receiver_player_name", "down", "score_bucket", "is_redzone"),
        where=(KNOWN_RECEIVER, KNOWN_DOWN),
        sums=CAUGHT, means=("epa", "cpoe", "air_yards", "yards_after_catch")),
    "situations": Family(
        tables=("situational_splits",),
        keys=("down", "score_bucket", "quarter", "home_or_away"), where=(KNOWN_DOWN,),
        sums=("complete_pass", "pass_touchdown", "interception", "sack", *RUSHING),
        means=("epa",), officials=("pass_attempt", "passing_yards"), by_season=True),
}

# Keyed by game, so that every row belongs to one season.
GAME_TABLES = tuple(name for name, t in SPLIT_TABLES.items() if "game_id" in t.keys)


def family_of(name: str, *, by_season: bool = False) -> str | None:
    return next((f for f, family in FAMILIES.items()
                 if name in family.tables and by_season >= family.by_season), None)


def _derived(plays: DataFrame, keys: Sequence[str], team: str | Column | None) -> DataFrame:
    derived = {"pressure_type": fb.pressure_type, "score_bucket": fb.score_bucket,
               "home_or_away": lambda: fb.home_or_away(
                   F.lit(team) if isinstance(team, str) else team)}
    return plays.withColumns({key: derived[key]() for key in keys if key in derived})


def partial_sums(family: str, plays: DataFrame, *, team: str | Column | None = None,
                 extra_keys: Sequence[str] = ()) -> DataFrame:
    """What all tables of the family can be folded from, see ``build``."""
    f = FAMILIES[family]
    for condition in f.where:
        plays = plays.where(condition)
    by_player = [PLAYER] if PLAYER in plays.columns else []
    return _derived(plays, f.keys, team).groupBy(*by_player, *extra_keys, *f.keys).agg(
        *parts(sums=f.sums, means=f.means, officials=f.officials))


def build(name: str, plays: DataFrame, *, team: str | Column | None = None,
          player: str | None = None, extra_keys: Sequence[str] = (),
          loaded_at: datetime | None = None, folded: bool = False) -> DataFrame:
    """The split table ``name`` over silver plays, or, with ``folded``, over the
    partial sums of its family with the same ``extra_keys`` or more.

    With a ``player_name`` column in ``plays`` the table is keyed by player
    first; without one, ``player`` is written to every row. ``extra_keys``
    splits further, for instance by season. ``team`` is needed by the table
    with home and away splits only.
    """
    table = SPLIT_TABLES[name]
    by_player = PLAYER in plays.columns
    chosen = plays
    for condition in table.where:
        chosen = chosen.where(condition)

    if not folded:
        if "home_or_away" in table.keys and team is None:
            raise ValueError(f"{name} needs the team whose home games count as such")
        chosen = _derived(chosen, table.keys, team)

    keys = [*([PLAYER] if by_player else []), *extra_keys, *table.keys]
    grouped = chosen.groupBy(*keys).agg(*table.measures(Folded if folded else measures))
    literal_player = table.player_column and not by_player
    return grouped.select(
        "*",
        *([F.lit(player).alias(PLAYER)] if literal_player else []),
        *[rounded_ratio(n, d, scale=scale).alias(rate)
          for rate in table.rates for n, d, scale in [RATES[rate]]],
        timestamp_column(loaded_at).alias("gold_loaded_at"),
    )
