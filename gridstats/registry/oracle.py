"""Plain SQL for every registered query, written without use of the plans.

The statements share their first steps as common table expressions: order lines
read as plays, plays per player, bronze, silver and the per-game table. NaN and
infinities are NULL in results unless a statement says otherwise; sums are cast
because DuckDB widens them to 128 bits.
"""

from __future__ import annotations

# --- shared steps ------------------------------------------------------------

LINES = """
lines AS (
  SELECT l.*, s.s_name,
         CAST(year(l_shipdate) AS INTEGER) AS season_no,
         CAST(month(l_shipdate) AS INTEGER) AS wk,
         CAST(round(l_discount * 100) AS INTEGER) AS disc,
         CAST(round(l_tax * 100) AS INTEGER) AS tax,
         CAST(l_quantity AS INTEGER) AS qty,
         l_returnflag <> 'R' AS p,
         l_returnflag = 'R' AND l_linenumber <> 7 AS r
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey),
kinds AS (
  SELECT *,
         ['BUF','MIA','NYJ','KC','DAL','PHI','SF','LAR'][(l_suppkey + wk) % 8 + 1] AS opp,
         (l_suppkey + wk) % 2 = 0 AS at_home,
         p AND tax = 8 AS sk,
         p AND tax <> 8 AND qty % 3 <> 0 AS cp,
         disc = 10 AS fumbled,
         CASE WHEN l_partkey % 13 <> 0 THEN CAST(l_partkey % 41 - 20 AS INTEGER) END AS score,
         CAST(20 + l_partkey % 15 AS INTEGER) AS own,
         CASE WHEN NOT (l_linenumber = 7 AND l_partkey % 10 = 0) THEN (disc - 5) / 4.0::DOUBLE END AS epa
  FROM lines)"""

RAW = LINES + """,
raw AS (
  SELECT
    season_no || '_' || lpad(CAST(wk AS VARCHAR), 2, '0') || '_' || l_suppkey
      || '_' || (l_orderkey * 8 + l_linenumber) // 2147483647 AS game_id,
    CAST((l_orderkey * 8 + l_linenumber) % 2147483647 AS INTEGER) AS play_id,
    season_no AS season, wk AS "week", CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS game_date,
    CASE WHEN wk <= 10 THEN 'REG' ELSE 'POST' END AS season_type,
    CASE WHEN at_home THEN 'NE' ELSE opp END AS home_team,
    CASE WHEN at_home THEN opp ELSE 'NE' END AS away_team,
    opp AS defteam,
    CASE WHEN p AND NOT sk AND l_partkey % 11 <> 0 THEN 'R' || (l_partkey % 12) END AS receiver_player_name,
    l_linenumber AS drive,
    CAST(l_partkey % 4 + 1 AS INTEGER) AS qtr,
    CASE WHEN l_linenumber <> 5 THEN (l_linenumber - 1) % 4 + 1 END AS down,
    CASE WHEN l_partkey % 50 = 0 THEN '50'
         WHEN l_partkey % 2 = 0 THEN opp || ' ' || (l_partkey % 50)
         ELSE 'NE ' || (l_partkey % 50) END AS yrdln,
    CASE WHEN l_linenumber = 5 AND l_partkey % 4 = 0 THEN 'TWO-POINT CONVERSION ATTEMPT. TWO-POINT CONVERSION SUCCEEDS.'
         WHEN l_linenumber = 5 AND l_partkey % 4 = 1 THEN 'TWO-POINT CONVERSION ATTEMPT. ATTEMPT FAILS.'
         WHEN p THEN 'pass' ELSE 'run' END AS descr,
    CASE WHEN p THEN 'pass' WHEN r THEN 'run' ELSE 'no_play' END AS play_type,
    CASE WHEN cp THEN qty - 5 WHEN r THEN qty % 20 - 2 ELSE 0 END AS yards_gained,
    CASE WHEN cp THEN qty % 12 END AS yards_after_catch,
    epa, epa AS qb_epa, epa / 2 AS air_epa, epa / 2 AS yac_epa, epa / 2 AS xyac_epa,
    CAST(p AS INTEGER) AS pass_attempt, CAST(cp AS INTEGER) AS complete_pass,
    CASE WHEN cp THEN qty - 5 END AS passing_yards,
    CASE WHEN p THEN CAST(l_partkey % 40 - 5 AS INTEGER) END AS air_yards,
    CAST(cp AND qty >= 47 AS INTEGER) AS pass_touchdown,
    CAST(p AND NOT sk AND NOT cp AND qty % 9 = 0 AS INTEGER) AS interception,
    CAST(sk AS INTEGER) AS sack,
    CASE WHEN p THEN (l_partkey % 17 - 8) / 2.0::DOUBLE END AS cpoe,
    CASE WHEN p AND NOT sk THEN ['left','middle','right'][l_partkey % 3 + 1] END AS pass_location,
    CASE WHEN (cp AND qty >= 47) OR (r AND qty >= 48) THEN 'NE' END AS td_team,
    CASE WHEN (cp AND qty >= 47) OR (r AND qty >= 48) THEN s_name END AS td_player_name,
    CASE WHEN p AND NOT sk THEN CASE WHEN l_partkey % 40 > 20 THEN 'deep' ELSE 'short' END END AS pass_length,
    CAST(p AND tax >= 6 AS INTEGER) AS qb_hit,
    CAST(r AND l_linestatus = 'F' AS INTEGER) AS qb_scramble,
    CAST(p OR (r AND l_linestatus = 'F') AS INTEGER) AS qb_dropback,
    CAST(r AS INTEGER) AS rush_attempt,
    CASE WHEN r THEN qty % 20 - 2 END AS rushing_yards,
    CAST(r AND qty >= 48 AS INTEGER) AS rush_touchdown,
    CAST(fumbled AS INTEGER) AS fumble,
    CAST(fumbled AND l_partkey % 2 = 0 AS INTEGER) AS fumble_forced,
    CAST(fumbled AND l_partkey % 2 = 1 AS INTEGER) AS fumble_not_forced,
    CAST(fumbled AND l_linestatus = 'F' AS INTEGER) AS fumble_lost,
    CAST(fumbled AND l_partkey % 5 = 0 AS INTEGER) AS fumble_out_of_bounds,
    score AS score_differential, own AS posteam_score, own - score AS defteam_score,
    CASE WHEN p THEN s_name END AS passer_player_name,
    CASE WHEN r THEN s_name END AS rusher_player_name,
    l_partkey AS ingest_seq
  FROM kinds)"""

PER_PLAYER = """
  SELECT passer_player_name AS player_name, * FROM {source}
  WHERE passer_player_name IS NOT NULL
  UNION ALL
  SELECT rusher_player_name AS player_name, * FROM {source}
  WHERE rusher_player_name IS NOT NULL
    AND rusher_player_name IS DISTINCT FROM passer_player_name"""

PLAYS = RAW + ",\nplays AS (" + PER_PLAYER.format(source="raw") + ")"

FRESH = PLAYS + """,
fresh AS (
  SELECT * FROM plays
  QUALIFY row_number() OVER (PARTITION BY player_name, game_id, play_id ORDER BY ingest_seq) = 1)"""

FLOATS = ("epa qb_epa air_epa yac_epa xyac_epa cpoe passing_yards rushing_yards "
          "yards_gained air_yards yards_after_catch").split()
INTEGERS = ("pass_attempt complete_pass pass_touchdown rush_attempt rush_touchdown "
            "interception sack fumble fumble_lost fumble_forced fumble_not_forced "
            "fumble_out_of_bounds score_differential posteam_score defteam_score "
            "qb_hit qb_scramble qb_dropback").split()

FILLS = ", ".join(
    [f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in FLOATS]
    + [f"coalesce({c}, 0) AS {c}" for c in INTEGERS]
    + ["coalesce(td_player_name, 'No TD') AS td_player_name"])

FEATURES = """
    CASE WHEN epa > 0 THEN 1 ELSE 0 END AS is_success,
    CASE WHEN nullif(regexp_extract(yard_line, '([A-Za-z]+)', 1), '') = opponent_team
          AND TRY_CAST(nullif(regexp_extract(yard_line, '([0-9]+)', 1), '') AS INTEGER) <= 20
         THEN 1 ELSE 0 END AS is_redzone,
    CASE WHEN contains(play_description, 'TWO-POINT CONVERSION SUCCEEDS') THEN 'success'
         WHEN contains(play_description, 'ATTEMPT FAILS') THEN 'failure' END AS two_point_conv_result"""

RENAMED = """
    defteam AS opponent_team, qtr AS quarter, yrdln AS yard_line,
    descr AS play_description, score_differential AS score_diff,
    posteam_score AS own_score, defteam_score AS opp_score"""

SILVER = FRESH + f""",
bronze AS (SELECT * REPLACE ({FILLS}) FROM fresh),
typed AS (
  SELECT * REPLACE (
    TRY_CAST(trunc(passing_yards) AS INTEGER) AS passing_yards,
    TRY_CAST(trunc(rushing_yards) AS INTEGER) AS rushing_yards,
    TRY_CAST(trunc(yards_gained) AS INTEGER) AS yards_gained,
    TRY_CAST(trunc(air_yards) AS INTEGER) AS air_yards),
    {RENAMED}
  FROM bronze),
latest AS (
  SELECT * FROM typed
  QUALIFY row_number() OVER (PARTITION BY player_name, game_id, play_id ORDER BY ingest_seq DESC) = 1),
silver AS (SELECT *, {FEATURES} FROM latest)"""

UNFILLED = FRESH + f""",
unfilled AS (SELECT *, {RENAMED} FROM fresh)"""

# --- expressions -------------------------------------------------------------

OFFICIAL = "sack = 0 AND fumble = 0 AND two_point_conv_result IS NULL"
BUCKET = """CASE WHEN score_diff <= -14 THEN 'Losing big' WHEN score_diff < 0 THEN 'Losing'
  WHEN score_diff = 0 THEN 'Tied' WHEN score_diff <= 14 THEN 'Winning' ELSE 'Winning big' END"""
PRESSURE = """CASE WHEN qb_hit = 1 THEN 'hit' WHEN qb_scramble = 1 THEN 'scramble' ELSE 'clean' END"""
HOME = "CASE WHEN home_team = 'NE' THEN 'Home' ELSE 'Away' END"


def r2(x: str) -> str:
    return f"round_even(({x}) * 100, 0) / 100"


def sums(*columns: str) -> str:
    return ", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in columns)


def official(column: str, alias: str | None = None) -> str:
    return (f"CAST(coalesce(sum({column}) FILTER (WHERE {OFFICIAL}), 0) AS BIGINT) "
            f"AS {alias or column}")


def mean(column: str, alias: str | None = None) -> str:
    return f"{r2(f'avg({column})')} AS {alias or column}"


def ratio(n: str, d: str) -> str:
    """IEEE division spelled out, whatever the database does by itself."""
    return (f"CASE WHEN {n} IS NULL OR {d} IS NULL THEN NULL "
            f"WHEN {d} <> 0 THEN CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) "
            f"WHEN {n} = 0 THEN 'NaN'::DOUBLE WHEN {n} > 0 THEN 'Infinity'::DOUBLE "
            f"ELSE '-Infinity'::DOUBLE END")


def rate(n: str, d: str, alias: str, scale: str = "") -> str:
    """A stored rate: 0 for 0/0, NULL in place of infinity."""
    return (f"CASE WHEN {d} <> 0 THEN {r2(f'CAST({n} AS DOUBLE) / {d}{scale}')} "
            f"WHEN {n} = 0 THEN 0.0 END AS {alias}")


def finite(x: str, alias: str | None = None) -> str:
    return f"CASE WHEN isfinite({x}) THEN {x} END AS {alias or x}"


def clipped(x: str) -> str:
    return (f"CASE WHEN ({x}) IS NULL OR isnan({x}) THEN ({x}) "
            f"WHEN ({x}) < 0 THEN 0.0 WHEN ({x}) > 2.375 THEN 2.375 ELSE ({x}) END")


def rating(att: str, cmp: str, yds: str, td: str, itc: str) -> str:
    parts = [
        f"((({ratio(cmp, att)}) - 0.3::DOUBLE) * 5)",
        f"((({ratio(yds, att)}) - 3) * 0.25::DOUBLE)",
        f"(({ratio(td, att)}) * 20)",
        f"(2.375::DOUBLE - ({ratio(itc, att)}) * 25)",
    ]
    a, b, c, d = (f"CAST({clipped(part)} AS DOUBLE)" for part in parts)
    return f"round_even(({a} + {b} + {c} + {d}) / 6 * 100 * 10, 0) / 10"


# --- the per-game table --------------------------------------------------------

_MEAN_FREE_SUMS = ("rushing_yards", "rush_touchdown", "pass_touchdown", "interception",
                   "sack", "fumble", "fumble_lost", "air_yards", "fumble_forced",
                   "fumble_not_forced")

PERFORMANCE = SILVER + f""",
games AS (
  SELECT player_name, game_id,
         min(season) AS season, min("week") AS "week", min(season_type) AS season_type,
         min(home_team) AS home_team, min(away_team) AS away_team,
         min(opponent_team) AS opponent_team,
         {official("pass_attempt")}, {official("complete_pass")}, {official("passing_yards")},
         {sums(*_MEAN_FREE_SUMS)}, {mean("epa")}, {mean("cpoe")}
  FROM silver GROUP BY player_name, game_id),
perf AS (
  SELECT *, 'NE' AS team, {HOME} AS home_or_away,
         passing_yards + rushing_yards AS total_yards,
         {r2("(" + ratio("complete_pass", "pass_attempt") + ") * 100")} AS completion_pct,
         {r2(ratio("passing_yards", "pass_attempt"))} AS yards_per_attempt,
         {rating("pass_attempt", "complete_pass", "passing_yards",
                 "pass_touchdown", "interception")} AS passer_rating
  FROM games)"""


def _rolling(columns: tuple[str, ...]) -> str:
    means = [f"round_even(avg({c}) OVER w * 100, 0) / 100" for c in columns]
    return ", ".join(finite(m, f"{c}_rolling4") for c, m in zip(columns, means))


_FOUR = ('WINDOW w AS (PARTITION BY player_name, season ORDER BY "week", game_id '
         "ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)")
_TO_DATE = ('WINDOW w AS (PARTITION BY player_name, season ORDER BY "week", game_id '
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")

_CUMULATIVE = {
    "passing_yards": "passing_yards_cumulative",
    "rushing_yards": "rushing_yards_cumulative",
    "pass_touchdown": "pass_td_cumulative",
    "rush_touchdown": "rush_td_cumulative",
    "interception": "interceptions_cumulative",
    "complete_pass": "completions_cumulative",
    "pass_attempt": "attempts_cumulative",
}


def _running() -> str:
    return ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN CAST(sum({c}) OVER w AS BIGINT) END AS {out}"
        for c, out in _CUMULATIVE.items())


# --- split tables --------------------------------------------------------------

PCT = rate("complete_pass", "pass_attempt", "completion_pct", " * 100")
YPA = rate("passing_yards", "pass_attempt", "yards_per_attempt")
YPC = rate("rushing_yards", "rush_attempt", "yards_per_carry")
YAC_REC = rate("yards_after_catch", "complete_pass", "yac_per_reception")
AIR_TARGET = rate("air_yards", "pass_attempt", "air_yards_per_target")
YAC_SUM = "CAST(coalesce(sum(yards_after_catch), 0) AS DOUBLE) AS yards_after_catch"
DROPBACKS = "CAST(coalesce(sum(qb_dropback), 0) AS BIGINT) AS total_dropbacks"
PLAYS_N = "count(*) AS n_plays"
TARGETS_N = "count(*) AS n_targets"
RUSH = sums("rush_attempt", "rushing_yards", "rush_touchdown")
PASSING = (official("pass_attempt") + ", "
           + sums("complete_pass", "pass_touchdown", "interception", "passing_yards"))
GAINED = mean("yards_gained", "avg_yards_gained")
AIR = sums("air_yards") + ", " + YAC_SUM
SCRAMBLES = sums("qb_scramble", "sack")
CAUGHT = (official("pass_attempt") + ", "
          + sums("complete_pass", "pass_touchdown", "passing_yards"))
TARGETED = "receiver_player_name IS NOT NULL AND down IS NOT NULL"


def _split(keys: str, measures: str, where: str, rates: str = "") -> str:
    """Group silver plays and add the rates; keys may be ``expression AS name``."""
    return (f"WITH {SILVER.strip()},\ngrouped AS (SELECT player_name, {keys}, {measures} "
            f"FROM silver WHERE {where} GROUP BY ALL)\n"
            f"SELECT *{', ' + rates if rates else ''} FROM grouped")


def _with(steps: str, select: str) -> str:
    return f"WITH {steps.strip()}\n{select}"


PRESSURE_KEY = f"{PRESSURE} AS pressure_type"

# --- whole rows, and rates that are not finite ---------------------------------

_TEXTS = ("player_name", "game_id", "season_type", "home_team", "away_team",
          "receiver_player_name", "play_type", "pass_location", "pass_length",
          "td_team", "td_player_name")
_FLAGS = ("pass_attempt", "complete_pass", "pass_touchdown", "interception", "sack",
          "qb_hit", "qb_scramble", "qb_dropback", "rush_attempt", "rush_touchdown",
          "fumble", "fumble_forced", "fumble_not_forced", "fumble_lost",
          "fumble_out_of_bounds")
_YARDS = ("yards_gained", "passing_yards", "air_yards", "rushing_yards")
_VALUES = ("epa", "qb_epa", "air_epa", "yac_epa", "xyac_epa", "cpoe", "yards_after_catch")


def _as(sql_type: str, *columns: str) -> str:
    return ", ".join(f'CAST("{c}" AS {sql_type}) AS "{c}"' for c in columns)


def _nonfinite(table: str, source: str, rates: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{rate}' AS rate, count(*) FILTER (WHERE isnan(x)) AS n_nan, "
        f"count(*) FILTER (WHERE x = 'Infinity'::DOUBLE) AS n_positive, "
        f"count(*) FILTER (WHERE x = '-Infinity'::DOUBLE) AS n_negative, "
        f"count(*) FILTER (WHERE x IS NULL) AS n_null, count(*) AS n_rows, "
        f"'{table}' AS table_name FROM (SELECT {x} AS x FROM {source})"
        for rate, x in rates.items())


def _filled(n: str, d: str) -> str:
    return f"CASE WHEN {n} = 0 AND {d} = 0 THEN 0.0::DOUBLE ELSE {ratio(n, d)} END"


_COMPLETED = _filled("complete_pass", "pass_attempt")
_PER_ATTEMPT = _filled("passing_yards", "pass_attempt")
_PER_CARRY = _filled("rushing_yards", "rush_attempt")
_AIR_PER_ATTEMPT = _filled("air_yards", "pass_attempt")
_YAC_PER_CATCH = _filled("yards_after_catch", "complete_pass")

_GROUPED_SUMS = (f"{official('pass_attempt')}, {official('passing_yards', 'official_yards')}, "
                 + sums("complete_pass", "passing_yards", "rushing_yards", "rush_attempt",
                        "air_yards", "yards_after_catch"))
NONFINITE = PERFORMANCE + f""",
situations AS (SELECT player_name, down, {BUCKET} AS bucket, quarter, {HOME} AS place,
  {_GROUPED_SUMS} FROM silver WHERE down IS NOT NULL GROUP BY ALL),
profiles AS (SELECT player_name, game_id, pass_length, pass_location, {_GROUPED_SUMS}
  FROM silver WHERE pass_attempt = 1 AND pass_length IS NOT NULL GROUP BY ALL),
pressures AS (SELECT player_name, {PRESSURE_KEY}, {_GROUPED_SUMS}
  FROM silver WHERE down IS NOT NULL GROUP BY ALL),
targets AS (SELECT player_name, receiver_player_name, {_GROUPED_SUMS}
  FROM silver WHERE {TARGETED} GROUP BY ALL)"""

ORACLE: dict[str, str] = {
    "src_season_scan": _with(RAW, """
SELECT game_id, play_id, season, "week", play_type, epa, passer_player_name, rusher_player_name
FROM raw WHERE season IN (1996, 1997)"""),

    "bronze_recorded_keys": _with(FRESH, """
SELECT DISTINCT player_name, game_id, play_id FROM fresh"""),

    "bronze_player_plays": _with(FRESH, """
SELECT player_name, game_id, play_id, "week", down, play_type, epa, ingest_seq FROM fresh"""),

    "bronze_player_filter": _with(RAW + """,
decided AS (
  SELECT season, passer_player_name = 'Supplier#000000001'
                 OR rusher_player_name = 'Supplier#000000001' AS decision
  FROM raw)""", """
SELECT season, count(*) FILTER (WHERE decision) AS n_kept,
       count(*) FILTER (WHERE NOT decision) AS n_other_player,
       count(*) FILTER (WHERE decision IS NULL) AS n_unknown
FROM decided GROUP BY season"""),

    "bronze_multi_player_explode": _with(PLAYS, """
SELECT player_name, count(*) AS n_plays FROM plays GROUP BY player_name"""),

    "bronze_new_plays": _with(RAW + """,
delivered AS (
  SELECT * REPLACE (CASE WHEN drive <> 5 THEN game_id END AS game_id) FROM raw),
plays AS (""" + PER_PLAYER.format(source="delivered") + """),
earlier AS (SELECT * FROM raw WHERE season <= 1998),
recorded AS (""" + PER_PLAYER.format(source="earlier") + """),
fresh AS (
  SELECT * FROM plays
  QUALIFY row_number() OVER (PARTITION BY player_name, game_id, play_id ORDER BY ingest_seq) = 1)""", """
SELECT player_name, game_id, play_id, season, "week", ingest_seq FROM fresh f
WHERE game_id IS NOT NULL AND play_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM recorded k WHERE k.player_name = f.player_name
                  AND k.game_id = f.game_id AND k.play_id = f.play_id)"""),

    "bronze_clean": _with(PLAYS, f"""
SELECT player_name, game_id, play_id, {FILLS}, down FROM plays"""),

    "bronze_null_report": _with(FRESH, """
SELECT count(*) AS n_plays, count(*) FILTER (WHERE game_id IS NULL) AS game_id_nulls,
       count(*) FILTER (WHERE play_id IS NULL) AS play_id_nulls,
       count(*) FILTER (WHERE epa IS NULL) AS epa_nulls
FROM fresh"""),

    "bronze_plays": _with(FRESH + f""",
filled AS (SELECT * REPLACE ({FILLS}) FROM fresh)""", f"""
SELECT {_as("VARCHAR", *_TEXTS)}, defteam, yrdln, descr AS "desc", game_date,
       CAST(NULL AS VARCHAR) AS two_point_conv_result, {_as("BIGINT", "play_id", "ingest_seq")},
       {_as("INTEGER", "season")}, {_as("DOUBLE", "week", "drive", "qtr", "down",
       "score_differential", "posteam_score", "defteam_score", *_FLAGS, *_YARDS, *_VALUES)}
FROM filled"""),

    "silver_plays": _with(SILVER, f"""
SELECT {_as("VARCHAR", *_TEXTS)}, opponent_team, yard_line, play_description, game_date,
       two_point_conv_result, {_as("INTEGER", "play_id", "season", "week", "drive", "quarter",
       "down", "score_diff", "own_score", "opp_score", *_YARDS)},
       {_as("DOUBLE", *_VALUES)}, {_as("TINYINT", "is_success", "is_redzone", *_FLAGS)}
FROM silver"""),

    "gold_nonfinite_counts": _with(NONFINITE, "\nUNION ALL\n".join([
        _nonfinite("qb_performance", "perf", {
            "completion_pct": "completion_pct", "yards_per_attempt": "yards_per_attempt",
            "passer_rating": "passer_rating"}),
        _nonfinite("situational_splits", "situations", {
            "completion_pct": _COMPLETED, "yards_per_carry": _PER_CARRY,
            "yards_per_attempt": _filled("official_yards", "pass_attempt")}),
        _nonfinite("efficiency_profile", "profiles", {
            "completion_pct": _COMPLETED, "air_yards_per_attempt": _AIR_PER_ATTEMPT,
            "yac_per_reception": _YAC_PER_CATCH}),
        _nonfinite("pressure_overview", "pressures", {
            "completion_pct": _COMPLETED, "yards_per_attempt": _PER_ATTEMPT,
            "air_yards_per_attempt": _AIR_PER_ATTEMPT, "yards_per_carry": _PER_CARRY}),
        _nonfinite("receiver_overview", "targets", {
            "completion_pct": _COMPLETED, "air_yards_per_target": _AIR_PER_ATTEMPT,
            "yac_per_reception": _YAC_PER_CATCH,
            "yards_per_reception": _filled("passing_yards", "complete_pass")})])),

    "silver_cast": _with(RAW, """
SELECT ingest_seq, game_id, TRY_CAST(play_id AS TINYINT) AS play_id,
       TRY_CAST(trunc(epa) AS INTEGER) AS epa, TRY_CAST(yrdln AS INTEGER) AS yrdln,
       TRY_CAST(trunc(cpoe) AS TINYINT) AS cpoe, CAST(air_yards AS VARCHAR) AS air_yards
FROM raw"""),

    "silver_dedup_last": _with(PLAYS + """,
loaded AS (
  SELECT player_name, game_id, play_id, coalesce(epa, 0.0) AS epa, ingest_seq, 1 AS load_day
  FROM plays
  UNION ALL
  SELECT player_name, game_id, play_id, coalesce(epa + 1, 0.0), ingest_seq, 2
  FROM plays WHERE drive = 1)""", """
SELECT player_name, game_id, play_id, epa, ingest_seq, load_day FROM loaded
QUALIFY row_number() OVER (PARTITION BY player_name, game_id, play_id
                           ORDER BY load_day DESC, ingest_seq DESC) = 1"""),

    "silver_features": _with(SILVER, """
SELECT player_name, game_id, play_id, opponent_team, quarter, yard_line, play_description,
       score_diff, own_score, opp_score, CAST(is_success AS TINYINT) AS is_success,
       CAST(is_redzone AS TINYINT) AS is_redzone, two_point_conv_result
FROM silver"""),

    "official_pass_totals": _with(SILVER, f"""
SELECT player_name, {official("pass_attempt", "official_attempts")},
       {official("complete_pass", "official_completions")},
       {official("passing_yards", "official_passing_yards")},
       CAST(sum(pass_attempt) AS BIGINT) AS all_attempts,
       CAST(sum(complete_pass) AS BIGINT) AS all_completions
FROM silver GROUP BY player_name"""),

    "passer_rating": _with(PERFORMANCE, f"""
SELECT player_name, game_id, pass_attempt, complete_pass, passing_yards,
       pass_touchdown, interception, {finite("passer_rating")} FROM perf"""),

    "zero_division": _with(SILVER + f""",
counts AS (
  SELECT player_name, game_id, {official("pass_attempt")},
         {official("complete_pass", "official_completions")}, {sums("complete_pass")}
  FROM silver GROUP BY player_name, game_id),
rates AS (
  SELECT player_name, game_id,
         {r2(ratio("official_completions", "pass_attempt"))} AS official_rate,
         {r2(ratio("complete_pass", "pass_attempt"))} AS all_rate
  FROM counts)""", """
SELECT player_name, game_id,
       CASE WHEN isnan(official_rate) THEN -1.0::DOUBLE
            WHEN isinf(official_rate) THEN -2.0::DOUBLE ELSE official_rate END AS official_rate,
       CASE WHEN isnan(all_rate) THEN -1.0::DOUBLE
            WHEN isinf(all_rate) THEN -2.0::DOUBLE ELSE all_rate END AS all_rate,
       CASE WHEN isnan(all_rate) THEN 0.0::DOUBLE
            WHEN isinf(all_rate) THEN -2.0::DOUBLE ELSE all_rate END AS all_rate_nan_filled
FROM rates"""),

    "score_bucket_counts": _with(UNFILLED, f"""
SELECT {BUCKET} AS score_bucket, count(*) AS n_plays, min(score_diff) AS lowest,
       max(score_diff) AS highest, count(*) FILTER (WHERE score_diff IS NULL) AS n_unknown
FROM unfilled GROUP BY ALL"""),

    "home_away_counts": _with(UNFILLED, f"""
SELECT player_name, {HOME} AS home_or_away, count(*) AS n_plays FROM unfilled GROUP BY ALL"""),

    "pressure_type_counts": _with(UNFILLED, f"""
SELECT player_name, {PRESSURE} AS pressure_type, count(*) AS n_plays
FROM unfilled GROUP BY ALL"""),

    "rolling4": _with(PERFORMANCE, f"""
SELECT player_name, season, "week", game_id,
       {_rolling(("epa", "cpoe", "complete_pass", "completion_pct", "pass_touchdown",
                  "passer_rating", "yards_per_attempt", "interception", "rushing_yards",
                  "rush_touchdown", "sack", "fumble"))}
FROM perf {_FOUR}"""),

    "cumulative": _with(PERFORMANCE + """,
thrown AS (
  SELECT * REPLACE (CASE WHEN pass_attempt > 0 THEN passing_yards END AS passing_yards,
                    CASE WHEN pass_attempt > 0 THEN complete_pass END AS complete_pass)
  FROM perf)""", f"""
SELECT player_name, season, "week", game_id, {_running()} FROM thrown {_TO_DATE}"""),

    "sorted_receivers": _with(SILVER + f""",
receivers AS (
  SELECT player_name, receiver_player_name, {mean("epa")}, {TARGETS_N}
  FROM silver WHERE {TARGETED} GROUP BY player_name, receiver_player_name)""", """
SELECT *, CAST(row_number() OVER (PARTITION BY player_name
         ORDER BY epa DESC NULLS FIRST, receiver_player_name) AS INTEGER) AS place
FROM receivers"""),

    "qb_performance": _with(PERFORMANCE, f"""
SELECT * REPLACE ({finite("passer_rating")}, {finite("completion_pct")},
                  {finite("yards_per_attempt")}) FROM perf"""),

    "game_momentum": _with(PERFORMANCE, f"""
SELECT player_name, season, game_id, "week", opponent_team, home_or_away, epa,
       {finite("passer_rating")}, {finite("completion_pct")}, passing_yards, rushing_yards,
       pass_touchdown, rush_touchdown, interception, sack,
       {_rolling(("epa", "passer_rating", "completion_pct", "rushing_yards",
                  "pass_touchdown", "rush_touchdown", "interception", "sack"))}
FROM perf {_FOUR}"""),

    "season_progression": _with(PERFORMANCE, f"""
SELECT season, game_id, player_name, "week", season_type, opponent_team, home_or_away,
       epa, cpoe, {finite("passer_rating")}, {finite("yards_per_attempt")}, pass_attempt,
       complete_pass, {finite("completion_pct")}, passing_yards, pass_touchdown,
       interception, air_yards, sack, rushing_yards, rush_touchdown, {_running()}
FROM perf {_TO_DATE}"""),

    "situational_splits": _split(
        f"down, {BUCKET} AS score_bucket, quarter, {HOME} AS home_or_away",
        f"{mean('epa')}, {official('pass_attempt')}, {official('passing_yards')}, "
        f"{sums('complete_pass', 'pass_touchdown', 'interception', 'sack')}, {RUSH}, {PLAYS_N}",
        "down IS NOT NULL", f"{PCT}, {YPA}, {YPC}"),

    "efficiency_profile": _split(
        "game_id, pass_length, pass_location",
        f"{official('pass_attempt')}, {sums('complete_pass')}, {AIR}, "
        f"{sums('pass_touchdown', 'interception')}, {mean('epa')}, {mean('cpoe')}, {PLAYS_N}",
        "pass_attempt = 1 AND pass_length IS NOT NULL",
        f"{PCT}, {rate('air_yards', 'pass_attempt', 'air_yards_per_attempt')}, {YAC_REC}"),

    "pressure_overview": _split(
        PRESSURE_KEY,
        f"{mean('epa')}, {mean('cpoe')}, {GAINED}, {PASSING}, {AIR}, {RUSH}, "
        f"{DROPBACKS}, {SCRAMBLES}, {PLAYS_N}",
        "down IS NOT NULL",
        f"{PCT}, {YPA}, {rate('air_yards', 'pass_attempt', 'air_yards_per_attempt')}, {YPC}"),

    "pressure_by_down": _split(
        f"{PRESSURE_KEY}, down",
        f"{mean('epa')}, {mean('cpoe')}, {GAINED}, {PASSING}, {AIR}, {RUSH}, "
        f"{DROPBACKS}, {SCRAMBLES}, {PLAYS_N}",
        "down IS NOT NULL", f"{PCT}, {YPC}"),

    "pressure_by_quarter": _split(
        f"{PRESSURE_KEY}, quarter",
        f"{mean('epa')}, {mean('cpoe')}, {PASSING}, {RUSH}, {DROPBACKS}, {SCRAMBLES}, {PLAYS_N}",
        "down IS NOT NULL", f"{PCT}, {YPC}"),

    "pressure_by_opponent": _split(
        f"game_id, {PRESSURE_KEY}, opponent_team",
        f'min("week") AS "week", {mean("epa")}, {mean("cpoe")}, {PASSING}, {AIR}, {RUSH}, '
        f"{DROPBACKS}, {SCRAMBLES}, {PLAYS_N}",
        "down IS NOT NULL", f"{PCT}, {YPA}, {YPC}"),

    "pressure_air_yards": _split(
        PRESSURE_KEY,
        f"{official('pass_attempt')}, {mean('air_yards', 'avg_air_yards')}, "
        f"{mean('yards_after_catch', 'avg_yac')}, {DROPBACKS}, {PLAYS_N}",
        "down IS NOT NULL AND pass_attempt = 1"),

    "receiver_overview": _split(
        "receiver_player_name",
        f"{mean('epa')}, {mean('cpoe')}, {CAUGHT}, {AIR}, {TARGETS_N}", TARGETED,
        f"{PCT}, {AIR_TARGET}, {YAC_REC}, "
        f"{rate('passing_yards', 'complete_pass', 'yards_per_reception')}"),

    "receiver_by_down": _split(
        "receiver_player_name, down",
        f"{mean('epa')}, {CAUGHT}, {sums('air_yards')}, {TARGETS_N}", TARGETED,
        f"{PCT}, {AIR_TARGET}"),

    "receiver_by_situation": _split(
        f"receiver_player_name, {BUCKET} AS score_bucket",
        f"{mean('epa')}, {CAUGHT}, {TARGETS_N}", TARGETED, PCT),

    "receiver_redzone": _split(
        "receiver_player_name", f"{mean('epa')}, {CAUGHT}, {TARGETS_N}",
        f"{TARGETED} AND is_redzone = 1", PCT),
}
