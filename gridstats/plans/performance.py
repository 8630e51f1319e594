"""One row per player and game: totals, rates and passer rating."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.functions.football import home_or_away, passer_rating
from gridstats.functions.numeric import ratio, round_half_even
from gridstats.operators.bronze import timestamp_column
from gridstats.operators.measures import Folded, dependent, official, parts, total
from gridstats.schema import PLAYER

# ---------------------------------------------------------------------------
# Inputs and output columns of the table, in output order.
# ---------------------------------------------------------------------------
CONTEXT = ("season", "week", "season_type", "home_team", "away_team", "opponent_team")
OFFICIAL_SUMS = ("pass_attempt", "complete_pass", "passing_yards")
SUMS = ("rushing_yards", "rush_touchdown", "pass_touchdown", "interception", "sack",
        "fumble", "fumble_lost", "air_yards", "fumble_forced", "fumble_not_forced")
MEANS = ("epa", "cpoe")

OUTPUT = (
    "game_id", "player_name", "team",
    "season", "week", "season_type", "home_team", "away_team", "opponent_team",
    "home_or_away",
    "passing_yards", "rushing_yards", "total_yards",
    "pass_attempt", "complete_pass", "completion_pct", "air_yards",
    "pass_touchdown", "rush_touchdown", "interception",
    "sack", "fumble", "fumble_forced", "fumble_not_forced", "fumble_lost",
    "epa", "cpoe", "passer_rating", "yards_per_attempt",
    "gold_loaded_at",
)
# ---------------------------------------------------------------------------


def _game_totals(plays: DataFrame, keys: list[str], gather: Sequence[str]) -> DataFrame:
    """Totals per key in two steps.

    The game context is text, and a text buffer (``min`` of a string) makes
    Spark sort every play before aggregating. Grouping by the context first
    keeps the pass over the plays a hash aggregation with map-side combining;
    only its result, about one row per game, is folded with ``min``. Should the
    context differ within a game, the game still ends up as one row.
    """
    per_context = plays.groupBy(*keys, *CONTEXT).agg(
        *[official(c) for c in OFFICIAL_SUMS],
        *[total(c) for c in SUMS],
        *parts(sums=(), means=MEANS, officials=()),
    )
    if gather:
        per_context = per_context.repartition(*gather)
    return per_context.groupBy(*keys).agg(
        *[dependent(c) for c in CONTEXT],
        *[total(c) for c in OFFICIAL_SUMS + SUMS],
        *[Folded.mean(c) for c in MEANS],
    )


def qb_performance(plays: DataFrame, *, team: str | Column, player: str | None = None,
                   loaded_at: datetime | None = None, gather: Sequence[str] = ()) -> DataFrame:
    """Game-by-game performance.

    Plays without a ``player_name`` column belong to the one ``player`` named;
    otherwise all players are kept apart. ``team`` is the team whose home games
    count as such: a name, or a column over the game's teams.

    Games without official attempts have NaN rates; nothing replaces them here.

    ``gather`` names keys of a game, the player say, for a caller that goes on with windows
    over all their games: the games, about one row each by then, are moved once by those
    columns, and neither the fold of a game nor such a window moves them again.
    """
    by_player = PLAYER in plays.columns
    keys = [PLAYER, "game_id"] if by_player else ["game_id"]
    if not set(gather) <= set(keys):
        raise ValueError(f"rows of a game can be gathered by {keys} only, not by {list(gather)}")
    totals = _game_totals(plays, keys, gather)
    team_column = F.lit(team) if isinstance(team, str) else team
    derived = {
        "team": team_column,
        "home_or_away": home_or_away(team_column),
        "total_yards": F.col("passing_yards") + F.col("rushing_yards"),
        "completion_pct": round_half_even(
            ratio("complete_pass", "pass_attempt") * 100.0, 2),
        "yards_per_attempt": round_half_even(
            ratio("passing_yards", "pass_attempt"), 2),
        "passer_rating": passer_rating(
            "pass_attempt", "complete_pass", "passing_yards",
            "pass_touchdown", "interception"),
        "gold_loaded_at": timestamp_column(loaded_at),
    }
    if not by_player:
        derived[PLAYER] = F.lit(player)
    return totals.withColumns(derived).select(*OUTPUT)
