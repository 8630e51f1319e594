"""Column lists and types of the raw, bronze and silver layers."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Column names, types, fill groups and renames of the data model.
# ---------------------------------------------------------------------------

# The 50 play columns with the type each has after the lenient cast.
PLAY_TYPES = {
    "game_id": "string",
    "play_id": "int",
    "season": "int",
    "season_type": "string",
    "game_date": "date",
    "week": "int",
    "home_team": "string",
    "away_team": "string",
    "defteam": "string",
    "receiver_player_name": "string",
    "drive": "int",
    "qtr": "int",
    "down": "int",
    "yrdln": "string",
    "desc": "string",
    "play_type": "string",
    "yards_gained": "int",
    "yards_after_catch": "double",
    "epa": "double",
    "qb_epa": "double",
    "air_epa": "double",
    "yac_epa": "double",
    "xyac_epa": "double",
    "pass_attempt": "tinyint",
    "complete_pass": "tinyint",
    "passing_yards": "int",
    "air_yards": "int",
    "pass_touchdown": "tinyint",
    "interception": "tinyint",
    "sack": "tinyint",
    "cpoe": "double",
    "pass_location": "string",
    "td_team": "string",
    "td_player_name": "string",
    "pass_length": "string",
    "qb_hit": "tinyint",
    "qb_scramble": "tinyint",
    "qb_dropback": "tinyint",
    "rush_attempt": "tinyint",
    "rushing_yards": "int",
    "rush_touchdown": "tinyint",
    "fumble": "tinyint",
    "fumble_forced": "tinyint",
    "fumble_not_forced": "tinyint",
    "fumble_lost": "tinyint",
    "fumble_out_of_bounds": "tinyint",
    "two_point_conv_result": "string",
    "score_differential": "int",
    "posteam_score": "int",
    "defteam_score": "int",
}

# Columns the lenient cast leaves as they came.
UNCAST = ("game_date",)

# Null fills of the bronze layer: value -> columns.
FILL_WITH_ZERO_FLOAT = (
    "epa", "qb_epa", "air_epa", "yac_epa", "xyac_epa", "cpoe",
    "passing_yards", "rushing_yards", "yards_gained", "air_yards",
    "yards_after_catch",
)
FILL_WITH_ZERO_INT = (
    "pass_attempt", "complete_pass", "pass_touchdown", "rush_attempt",
    "rush_touchdown", "interception", "sack", "fumble", "fumble_lost",
    "fumble_forced", "fumble_not_forced", "fumble_out_of_bounds",
    "score_differential", "posteam_score", "defteam_score", "qb_hit",
    "qb_scramble", "qb_dropback",
)
FILL_TD_PLAYER = "No TD"

# Silver names of seven play columns.
RENAMES = {
    "defteam": "opponent_team",
    "qtr": "quarter",
    "yrdln": "yard_line",
    "desc": "play_description",
    "score_differential": "score_diff",
    "posteam_score": "own_score",
    "defteam_score": "opp_score",
}

# ---------------------------------------------------------------------------

PLAY_COLUMNS = list(PLAY_TYPES)
CAST_TYPES = {c: t for c, t in PLAY_TYPES.items() if c not in UNCAST}

PLAYER = "player_name"
PLAY_KEY = ("play_id", "game_id")

# Source columns that say who passed and who ran; used to select plays only.
PASSER, RUSHER = "passer_player_name", "rusher_player_name"

# Carried from the source to silver's deduplication when present, see
# ``operators.silver``: who the row belongs to, and the order of arrival.
INGEST_SEQ = "ingest_seq"
BRONZE_LOADED_AT = "bronze_loaded_at"

# Beside the key where bronze takes corrections: a digest of all play columns.
CONTENT_DIGEST = "content_digest"

# What bronze stores: numbers wide enough for every delivery, whether it brings
# flags as integers or as floating point. The season is the partition directory.
_WHOLE = {"play_id": "bigint", "season": "int", INGEST_SEQ: "bigint"}
_WIDE = {"int": "double", "tinyint": "double", "double": "double", "string": "string",
         "date": "date"}
BRONZE_TYPES = {**{c: _WIDE[t] for c, t in PLAY_TYPES.items()}, **_WHOLE}

RAW_TYPES = {**PLAY_TYPES, PASSER: "string", RUSHER: "string"}
RAW_DDL = ", ".join(f"`{c}` {t}" for c, t in RAW_TYPES.items())


def player_key(columns: list[str]) -> list[str]:
    """Key of a play row: a play belongs once to every player it is kept for.

    Rows are sorted by this key to deduplicate them. The number leads because
    Spark sorts by the first eight bytes of the leading column before it looks
    at whole rows, and game ids and names share long prefixes.
    """
    return [*PLAY_KEY, *([PLAYER] if PLAYER in columns else [])]
