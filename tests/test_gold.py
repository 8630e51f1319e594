import math

import pytest

from gridstats.operators.ordering import in_order
from gridstats.operators.windows import rolling_mean, running_total
from gridstats.plans.form import game_momentum, season_progression
from gridstats.plans.performance import OUTPUT, qb_performance
from gridstats.plans.splits import SPLIT_TABLES, build

PLAY_DDL = (
    "player_name string, game_id string, season int, week int, season_type string,"
    " home_team string, away_team string, opponent_team string, pass_attempt int,"
    " complete_pass int, passing_yards int, pass_touchdown int, interception int,"
    " rushing_yards int, rush_touchdown int, rush_attempt int, sack int, fumble int,"
    " fumble_lost int, fumble_forced int, fumble_not_forced int, air_yards int,"
    " yards_after_catch double, yards_gained int, epa double, cpoe double,"
    " two_point_conv_result string, pass_length string, pass_location string,"
    " score_diff int, down int, quarter int, qb_hit int, qb_scramble int,"
    " qb_dropback int, receiver_player_name string, is_redzone int")

PLAY = dict(
    game_id="2031_04_ELK_OWL", season=2031, week=4, season_type="REG", home_team="OWL",
    away_team="ELK", opponent_team="ELK", pass_attempt=1, complete_pass=1,
    passing_yards=14, pass_touchdown=0, interception=0, rushing_yards=11,
    rush_touchdown=0, rush_attempt=2, sack=0, fumble=0, fumble_lost=0, fumble_forced=0,
    fumble_not_forced=0, air_yards=9, epa=0.75, cpoe=-1.5)

SPLIT_PLAY = dict(
    game_id="2031_04_ELK_OWL", week=4, home_team="OWL", opponent_team="ELK",
    down=1, quarter=1, score_diff=0, is_redzone=0,
    pass_attempt=1, complete_pass=1, passing_yards=12, pass_touchdown=0, interception=0,
    pass_length="short", pass_location="left", air_yards=7, yards_after_catch=5.0,
    yards_gained=12, receiver_player_name="R.Rook", epa=0.4, cpoe=-1.5,
    rush_attempt=0, rushing_yards=0, rush_touchdown=0,
    sack=0, fumble=0, qb_hit=0, qb_scramble=0, qb_dropback=1)


@pytest.fixture
def plays(rows):
    """Plays of several players, or of one when no name is given."""
    def make(base, *overrides):
        records = [base | o for o in overrides]
        frame = rows(PLAY_DDL, *records)
        named = any("player_name" in r for r in records)
        return frame if named else frame.drop("player_name")
    return make


def one(frame):
    (row,) = frame.collect()
    return row


# --- game-by-game performance ----------------------------------------------------

def test_single_play_game(plays):
    got = one(qb_performance(plays(PLAY, {}), team="OWL", player="A.Able"))
    assert list(got.asDict()) == list(OUTPUT) and len(OUTPUT) == 30
    assert got["passer_rating"] == 118.8
    assert got["completion_pct"] == 100.0
    assert got["yards_per_attempt"] == 14.0
    assert got["total_yards"] == 25
    assert (got["home_or_away"], got["team"], got["player_name"]) == ("Home", "OWL", "A.Able")


def test_sack_is_not_an_attempt(plays):
    got = one(qb_performance(plays(
        PLAY, {}, dict(sack=1, complete_pass=0, passing_yards=0, epa=-1.5)), team="OWL"))
    assert (got["pass_attempt"], got["passing_yards"], got["sack"]) == (1, 14, 1)
    assert got["rushing_yards"] == 22
    assert (got["epa"], got["cpoe"]) == (-0.38, -1.5)


def test_no_official_attempt_leaves_nan(plays):
    got = one(qb_performance(plays(PLAY, dict(fumble=1)), team="OWL"))
    assert (got["pass_attempt"], got["complete_pass"]) == (0, 0)
    assert all(math.isnan(got[c]) for c in
               ("completion_pct", "yards_per_attempt", "passer_rating"))


def test_sums_of_nothing_are_zero_and_means_are_null(plays):
    got = one(qb_performance(plays(
        PLAY, dict(rushing_yards=None, epa=None, passing_yards=None)), team="OWL"))
    assert (got["rushing_yards"], got["passing_yards"], got["total_yards"]) == (0, 0, 0)
    assert got["epa"] is None


def test_differing_context_still_gives_one_row_per_game(plays):
    got = one(qb_performance(plays(
        PLAY, dict(epa=1.0), dict(home_team="ELK", epa=0.0), dict(home_team="ELK", epa=0.0)),
        team="OWL"))
    assert (got["home_team"], got["epa"], got["rushing_yards"]) == ("ELK", 0.33, 33)


def test_players_are_kept_apart(plays):
    frame = plays(PLAY, dict(player_name="A.Able"), dict(player_name="B.Baker"),
                  dict(player_name="B.Baker"))
    got = {r["player_name"]: r["rushing_yards"]
           for r in qb_performance(frame, team="OWL").collect()}
    assert got == {"A.Able": 11, "B.Baker": 22}


def test_team_can_depend_on_the_game(plays):
    from pyspark.sql import functions as F
    own = F.when(F.col("opponent_team") == F.col("home_team"), F.col("away_team")) \
        .otherwise(F.col("home_team"))
    frame = plays(PLAY, dict(home_team="FOX", away_team="ELK", opponent_team="FOX"))
    got = one(qb_performance(frame, team=own))
    assert (got["team"], got["home_or_away"]) == ("ELK", "Away")


# --- split tables ------------------------------------------------------------------

def test_efficiency_by_style(plays):
    frame = plays(SPLIT_PLAY,
                  dict(air_yards=9, yards_after_catch=2.0, epa=0.9, cpoe=4.0),
                  dict(air_yards=5, yards_after_catch=6.0, epa=0.1, cpoe=0.0),
                  dict(pass_length="deep", pass_location="middle", air_yards=30,
                       yards_after_catch=0.0))
    got = {r["pass_length"]: r for r in build("efficiency_profile", frame).collect()}
    columns = ("pass_attempt", "complete_pass", "air_yards", "yards_after_catch", "epa",
               "cpoe", "completion_pct", "air_yards_per_attempt", "yac_per_reception",
               "n_plays")
    assert tuple(got["short"][c] for c in columns) == (
        2, 2, 14, 8.0, 0.5, 2.0, 100.0, 7.0, 4.0, 2)
    assert tuple(got["deep"][c] for c in columns) == (
        1, 1, 30, 0.0, 0.4, -1.5, 100.0, 30.0, 0.0, 1)
    assert "player_name" not in build("efficiency_profile", frame).columns


def test_efficiency_zero_division(plays):
    got = one(build("efficiency_profile", plays(
        SPLIT_PLAY, dict(complete_pass=0, air_yards=13, yards_after_catch=0.0))))
    assert got["yac_per_reception"] == 0.0
    assert got["completion_pct"] == 0.0
    assert got["air_yards_per_attempt"] == 13.0


def test_rate_over_no_attempts_stays_infinite(plays):
    got = one(build("efficiency_profile", plays(SPLIT_PLAY, dict(fumble=1))))
    assert (got["pass_attempt"], got["complete_pass"]) == (0, 1)
    assert got["completion_pct"] == math.inf


def test_efficiency_drops_unknown_length_but_keeps_unknown_location(plays):
    frame = plays(SPLIT_PLAY, {}, dict(pass_length=None), dict(pass_location=None))
    got = build("efficiency_profile", frame).collect()
    assert {r["pass_location"] for r in got} == {"left", None}


def test_every_score_bucket_appears(plays):
    frame = plays(SPLIT_PLAY, *[dict(score_diff=d) for d in (-20, -7, 0, 7, 21)])
    got = build("situational_splits", frame, team="OWL", player="A.Able")
    assert {r["score_bucket"] for r in got.collect()} == {
        "Losing big", "Losing", "Tied", "Winning", "Winning big"}
    assert got.columns == [
        "down", "score_bucket", "quarter", "home_or_away", "epa", "pass_attempt",
        "complete_pass", "passing_yards", "pass_touchdown", "interception", "sack",
        "rush_attempt", "rushing_yards", "rush_touchdown", "n_plays", "player_name",
        "completion_pct", "yards_per_attempt", "yards_per_carry", "gold_loaded_at"]


def test_situational_splits_need_a_team(plays):
    with pytest.raises(ValueError, match="team"):
        build("situational_splits", plays(SPLIT_PLAY, {}))


def test_situational_passing_yards_are_official_only(plays):
    frame = plays(SPLIT_PLAY, dict(rushing_yards=6, rush_attempt=4), dict(fumble=1))
    got = one(build("situational_splits", frame, team="OWL"))
    assert (got["passing_yards"], got["complete_pass"], got["completion_pct"]) == (12, 2, 200.0)
    assert got["yards_per_carry"] == 1.5


def test_pressure_overview(plays):
    frame = plays(SPLIT_PLAY, dict(qb_hit=1, qb_scramble=1, sack=1), dict(qb_hit=1),
                  dict(qb_scramble=1, pass_attempt=0, rush_attempt=1, rushing_yards=7,
                       complete_pass=0, passing_yards=0),
                  dict(down=None, qb_hit=1))
    got = {r["pressure_type"]: r for r in build("pressure_overview", frame).collect()}
    assert set(got) == {"hit", "scramble"}
    hit = got["hit"]
    assert (hit["n_plays"], hit["pass_attempt"], hit["complete_pass"], hit["passing_yards"]) \
        == (2, 1, 2, 24)
    assert (hit["completion_pct"], hit["yards_per_attempt"], hit["air_yards_per_attempt"]) \
        == (200.0, 24.0, 14.0)
    assert (hit["sack"], hit["qb_scramble"], hit["total_dropbacks"]) == (1, 1, 2)
    assert got["scramble"]["yards_per_carry"] == 7.0
    assert got["scramble"]["completion_pct"] == 0.0


def test_pressure_tables_group_by_their_keys(plays):
    frame = plays(SPLIT_PLAY, {}, dict(down=2, quarter=3), dict(down=2, quarter=3, week=2))
    by_down = {r["down"]: r["n_plays"] for r in build("pressure_by_down", frame).collect()}
    by_quarter = {r["quarter"]: r["n_plays"]
                  for r in build("pressure_by_quarter", frame).collect()}
    assert by_down == {1: 1, 2: 2} and by_quarter == {1: 1, 3: 2}
    opponent = one(build("pressure_by_opponent", frame))
    assert (opponent["opponent_team"], opponent["week"], opponent["n_plays"]) == ("ELK", 2, 3)


def test_pressure_air_yards_looks_at_passes(plays):
    frame = plays(SPLIT_PLAY, dict(air_yards=4), dict(air_yards=9), dict(pass_attempt=0))
    got = one(build("pressure_air_yards", frame))
    assert (got["avg_air_yards"], got["avg_yac"], got["n_plays"]) == (6.5, 5.0, 2)


def test_receiver_tables(plays):
    frame = plays(SPLIT_PLAY, dict(is_redzone=1, pass_touchdown=1), dict(complete_pass=0,
                  passing_yards=0, yards_after_catch=0.0, score_diff=-14, down=3),
                  dict(receiver_player_name=None), dict(down=None))
    overview = one(build("receiver_overview", frame))
    assert (overview["n_targets"], overview["completion_pct"]) == (2, 50.0)
    assert (overview["air_yards_per_target"], overview["yac_per_reception"],
            overview["yards_per_reception"]) == (7.0, 5.0, 12.0)
    assert {r["down"]: r["n_targets"]
            for r in build("receiver_by_down", frame).collect()} == {1: 1, 3: 1}
    assert {r["score_bucket"] for r in build("receiver_by_situation", frame).collect()} \
        == {"Tied", "Losing big"}
    red = one(build("receiver_redzone", frame))
    assert (red["n_targets"], red["pass_touchdown"]) == (1, 1)


def test_splits_by_player_and_extra_key(plays):
    frame = plays(SPLIT_PLAY, dict(player_name="A.Able", season=2024),
                  dict(player_name="A.Able", season=2025),
                  dict(player_name="B.Baker", season=2025))
    pooled = build("pressure_overview", frame)
    assert pooled.columns[:2] == ["player_name", "pressure_type"]
    assert {r["player_name"]: r["n_plays"] for r in pooled.collect()} \
        == {"A.Able": 2, "B.Baker": 1}
    apart = build("pressure_overview", frame, extra_keys=["season"])
    assert apart.count() == 3 and apart.columns[1] == "season"


@pytest.mark.parametrize("name", SPLIT_TABLES)
def test_every_split_table_of_one_player_equals_that_players_rows(plays, name):
    several = plays(SPLIT_PLAY, dict(player_name="A.Able", is_redzone=1),
                    dict(player_name="A.Able", down=2, qb_hit=1, is_redzone=1),
                    dict(player_name="B.Baker", is_redzone=1))
    single = several.where("player_name = 'A.Able'").drop("player_name")

    def values(frame):
        kept = [c for c in sorted(frame.columns) if c not in ("gold_loaded_at", "player_name")]
        return sorted(map(tuple, frame.select(*kept).collect()))

    ours = build(name, several, team="OWL").where("player_name = 'A.Able'")
    assert values(ours) == values(build(name, single, team="OWL", player="A.Able"))


def test_presentation_order(plays):
    frame = plays(SPLIT_PLAY, dict(receiver_player_name="Low", epa=0.0),
                  dict(receiver_player_name="Unknown", epa=None),
                  dict(receiver_player_name="High", epa=2.0))
    table = in_order(build("receiver_overview", frame), SPLIT_TABLES["receiver_overview"].order)
    assert [r["receiver_player_name"] for r in table.collect()] == ["Unknown", "High", "Low"]


# --- windows -------------------------------------------------------------------------

SERIES = "player_name string, season int, week int, game_id string, x double, n int"
WHOLE = dict(partition_by=["player_name", "season"], order_by=["week", "game_id"])


def series(rows, xs, player="A.Able"):
    return rows(SERIES, *[dict(player_name=player, season=2025, week=i + 1, game_id=f"g{i}",
                               x=x, n=None if x is None else int(x) if x == x else 0)
                          for i, x in enumerate(xs)])


def test_rolling_mean_skips_nulls_and_lets_nan_leave(rows):
    frame = series(rows, [1.0, None, math.nan, 3.0, 5.0, 7.0, 9.0])
    got = [r["m"] for r in rolling_mean(frame, {"x": "m"}, 4, **WHOLE).orderBy("week").collect()]
    assert got[:2] == [1.0, 1.0]
    assert all(math.isnan(v) for v in got[2:6])
    assert got[6] == 6.0


def test_rolling_mean_of_fewer_rows(rows):
    got = [r["m"] for r in rolling_mean(series(rows, [None, 1.0, 2.0, 4.0, 8.0]), {"x": "m"}, 4,
                                        **WHOLE).orderBy("week").collect()]
    assert got == [None, 1.0, 1.5, 2.33, 3.75]


def test_running_total_is_null_on_null_rows(rows):
    got = [r["t"] for r in running_total(series(rows, [1.0, None, 2.0]), {"n": "t"},
                                         **WHOLE).orderBy("week").collect()]
    assert got == [1, None, 3]


def test_windows_refuse_a_single_partition(rows):
    with pytest.raises(ValueError, match="partition"):
        rolling_mean(series(rows, [1.0]), {"x": "m"}, 4, partition_by=[], order_by=["week"])


@pytest.fixture
def games(plays):
    frame = plays(PLAY, *[
        dict(player_name=p, week=w, game_id=f"g{w}", season=s, passing_yards=10 * w)
        for p in ("A.Able", "B.Baker") for s in (2024, 2025) for w in range(1, 7)])
    return qb_performance(frame, team="OWL")


def test_momentum_and_progression_restart_every_season(games):
    momentum = game_momentum(games)
    assert momentum.columns[:3] == ["player_name", "season", "game_id"]
    assert len(momentum.columns) == 2 + 22
    assert len(game_momentum(games, by_player=False).columns) == 22
    progression = season_progression(games)
    assert len(progression.columns) == 1 + 28
    assert len(season_progression(games, by_player=False).columns) == 28
    # A game id occurs once per player here, so season 2024 and 2025 pool into one
    # game; the totals run over the player's six games.
    last = [r for r in progression.collect() if r["week"] == 6]
    assert {r["passing_yards_cumulative"] for r in last} == {2 * 210}
    assert {r["attempts_cumulative"] for r in last} == {12}


def test_seasons_do_not_leak_into_each_other(plays):
    frame = plays(PLAY, *[
        dict(player_name="A.Able", week=w, season=s, game_id=f"{s}_{w}", rushing_yards=w)
        for s in (2024, 2025) for w in range(1, 7)])
    games = qb_performance(frame, team="OWL")
    rolled = {(r["season"], r["week"]): r["rushing_yards_rolling4"]
              for r in game_momentum(games).collect()}
    assert rolled[(2025, 1)] == 1.0 and rolled[(2025, 6)] == 4.5
    totals = {(r["season"], r["week"]): r["rushing_yards_cumulative"]
              for r in season_progression(games).collect()}
    assert totals[(2024, 6)] == totals[(2025, 6)] == 21
