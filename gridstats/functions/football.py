"""Play classifications and the passer rating."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridstats.functions.numeric import clip, ratio, round_half_even

# ---------------------------------------------------------------------------
# Labels, thresholds, text patterns and rating coefficients.
# ---------------------------------------------------------------------------
HIT, SCRAMBLE, CLEAN = "hit", "scramble", "clean"

LOSING_BIG, LOSING, TIED, WINNING, WINNING_BIG = (
    "Losing big", "Losing", "Tied", "Winning", "Winning big")
BIG_MARGIN = 14

HOME, AWAY = "Home", "Away"

RED_ZONE_YARDS = 20
YARD_LINE_TEAM = r"([A-Za-z]+)"
YARD_LINE_YARDS = r"(\d+)"

TWO_POINT_SUCCESS_TEXT = "TWO-POINT CONVERSION SUCCEEDS"
TWO_POINT_FAILURE_TEXT = "ATTEMPT FAILS"
TWO_POINT_SUCCESS, TWO_POINT_FAILURE = "success", "failure"

RATING_LOW, RATING_HIGH = 0.0, 2.375
COMPLETION_BASE, COMPLETION_WEIGHT = 0.3, 5.0
YARDS_BASE, YARDS_WEIGHT = 3.0, 0.25
TOUCHDOWN_WEIGHT, INTERCEPTION_WEIGHT = 20.0, 25.0
RATING_PARTS, RATING_SCALE, RATING_PLACES = 6.0, 100.0, 1
# ---------------------------------------------------------------------------


# Plays that count as pass attempts in official statistics.
OFFICIAL_PASS = "sack = 0 AND fumble = 0 AND two_point_conv_result IS NULL"


def official_pass() -> Column:
    return F.expr(OFFICIAL_PASS)


def pressure_type() -> Column:
    """How the passer was pressured; a hit outranks a scramble."""
    return (F.when(F.col("qb_hit") == 1, HIT)
            .when(F.col("qb_scramble") == 1, SCRAMBLE)
            .otherwise(CLEAN))


def score_bucket(score_diff: Column | str = "score_diff") -> Column:
    """Game situation by score; an unknown score falls into the last bucket.

    The margins are asymmetric: 14 behind is already big, 14 ahead is not.
    """
    diff = F.col(score_diff) if isinstance(score_diff, str) else score_diff
    return (F.when(diff <= -BIG_MARGIN, LOSING_BIG)
            .when(diff < 0, LOSING)
            .when(diff == 0, TIED)
            .when(diff <= BIG_MARGIN, WINNING)
            .otherwise(WINNING_BIG))


def home_or_away(team: Column) -> Column:
    return F.when(F.col("home_team") == team, HOME).otherwise(AWAY)


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("tinyint")


def is_success() -> Column:
    return _flag(F.col("epa") > 0)


def _first_group(column: str, pattern: str) -> Column:
    found = F.regexp_extract(column, pattern, 1)
    return F.nullif(found, F.lit(""))


def is_redzone() -> Column:
    """1 if the yard line lies within 20 yards on the opponent's side."""
    side = _first_group("yard_line", YARD_LINE_TEAM)
    yards = _first_group("yard_line", YARD_LINE_YARDS).try_cast("int")
    return _flag((side == F.col("opponent_team")) & (yards <= RED_ZONE_YARDS))


def two_point_result() -> Column:
    """Outcome of a two-point try read from the play text, else NULL."""
    text = F.col("play_description")
    return (F.when(text.contains(TWO_POINT_SUCCESS_TEXT), TWO_POINT_SUCCESS)
            .when(text.contains(TWO_POINT_FAILURE_TEXT), TWO_POINT_FAILURE))


def passer_rating(attempts: Column | str, completions: Column | str,
                  yards: Column | str, touchdowns: Column | str,
                  interceptions: Column | str) -> Column:
    """The 0 to 158.3 passer rating; NaN without attempts."""
    parts = (
        (ratio(completions, attempts) - COMPLETION_BASE) * COMPLETION_WEIGHT,
        (ratio(yards, attempts) - YARDS_BASE) * YARDS_WEIGHT,
        ratio(touchdowns, attempts) * TOUCHDOWN_WEIGHT,
        F.lit(RATING_HIGH) - ratio(interceptions, attempts) * INTERCEPTION_WEIGHT,
    )
    a, b, c, d = (clip(part, RATING_LOW, RATING_HIGH) for part in parts)
    return round_half_even((a + b + c + d) / RATING_PARTS * RATING_SCALE,
                           RATING_PLACES)
