"""Form and season-to-date tables over the game-by-game performance table.

Every window stays within one player's season, whose rows are its games.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridstats.operators.windows import rolling_mean, running_total
from gridstats.schema import PLAYER

SEASON_OF_PLAYER = (PLAYER, "season")
GAME_ORDER = ("week", "game_id")

# ---------------------------------------------------------------------------
# Window length, window inputs and output columns, in order.
# ---------------------------------------------------------------------------
ROLLING_ROWS = 4
ROLLING = ("epa", "passer_rating", "completion_pct", "rushing_yards",
           "pass_touchdown", "rush_touchdown", "interception", "sack")
MOMENTUM_GAME = (
    "game_id", "week", "opponent_team", "home_or_away",
    "epa", "passer_rating", "completion_pct", "passing_yards", "rushing_yards",
    "pass_touchdown", "rush_touchdown", "interception", "sack")

CUMULATIVE = {
    "passing_yards": "passing_yards_cumulative",
    "rushing_yards": "rushing_yards_cumulative",
    "pass_touchdown": "pass_td_cumulative",
    "rush_touchdown": "rush_td_cumulative",
    "interception": "interceptions_cumulative",
    "complete_pass": "completions_cumulative",
    "pass_attempt": "attempts_cumulative",
}
PROGRESSION_GAME = (
    "game_id", "player_name", "week", "season_type", "opponent_team", "home_or_away",
    "epa", "cpoe", "passer_rating", "yards_per_attempt",
    "pass_attempt", "complete_pass", "completion_pct", "passing_yards",
    "pass_touchdown", "interception", "air_yards", "sack",
    "rushing_yards", "rush_touchdown",
    "gold_loaded_at")
# ---------------------------------------------------------------------------


def game_momentum(performance: DataFrame, *, by_player: bool = True) -> DataFrame:
    """Four-game rolling means. ``by_player`` adds the player and season that
    tell the rows of several players or seasons apart."""
    outputs = {c: f"{c}_rolling{ROLLING_ROWS}" for c in ROLLING}
    rolled = rolling_mean(performance, outputs, ROLLING_ROWS,
                          partition_by=SEASON_OF_PLAYER, order_by=GAME_ORDER)
    leading = SEASON_OF_PLAYER if by_player else ()
    return rolled.select(*leading, *MOMENTUM_GAME, *outputs.values(), "gold_loaded_at")


def season_progression(performance: DataFrame, *, by_player: bool = True) -> DataFrame:
    """Season-to-date totals after every game."""
    running = running_total(performance, CUMULATIVE,
                            partition_by=SEASON_OF_PLAYER, order_by=GAME_ORDER)
    leading = ("season",) if by_player else ()
    return running.select(*leading, *PROGRESSION_GAME, *CUMULATIVE.values())
