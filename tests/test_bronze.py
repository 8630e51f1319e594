import math

import pytest

from gridstats import schema as S
from gridstats.operators import bronze as B
from gridstats.operators.dedup import exclude_recorded, keep_any
from gridstats.operators.quality import null_report
from gridstats.plans.layers import bronze_plays, new_plays

NAMES = ("game_id string, play_id int, passer_player_name string,"
         " rusher_player_name string, receiver_player_name string")


@pytest.fixture
def three_plays(rows):
    return rows(NAMES,
                dict(game_id="g1", play_id=1, passer_player_name="A.Able"),
                dict(game_id="g1", play_id=2, rusher_player_name="A.Able"),
                dict(game_id="g1", play_id=3, receiver_player_name="A.Able"))


def ids(frame, *columns):
    return sorted(tuple(r[c] for c in columns) for r in frame.collect())


def test_one_player_passed_or_ran(three_plays):
    assert ids(B.plays_of(three_plays, "A.Able"), "play_id") == [(1,), (2,)]


def test_all_players_get_their_plays(rows):
    plays = rows(NAMES,
                 dict(game_id="g1", play_id=1, passer_player_name="A.Able"),
                 dict(game_id="g1", play_id=2, passer_player_name="A.Able",
                      rusher_player_name="B.Baker"),
                 dict(game_id="g1", play_id=3, passer_player_name="A.Able",
                      rusher_player_name="A.Able"),
                 dict(game_id="g1", play_id=4, receiver_player_name="A.Able"))
    everyone = B.plays_by_player(plays)
    assert ids(everyone, "player_name", "play_id") == [
        ("A.Able", 1), ("A.Able", 2), ("A.Able", 3), ("B.Baker", 2)]
    assert ids(B.plays_by_player(plays, ["B.Baker"]), "player_name", "play_id") == [
        ("B.Baker", 2)]
    assert B.plays_by_player(plays, []).count() == 0


def test_player_columns_can_be_ids(rows):
    plays = rows("game_id string, play_id int, passer_id string, rusher_id string",
                 dict(game_id="g1", play_id=1, passer_id="00-1"),
                 dict(game_id="g1", play_id=2, rusher_id="00-2"))
    got = new_plays(plays, players=["00-2"], passer="passer_id", rusher="rusher_id")
    assert ids(got, "player_name", "play_id") == [("00-2", 2)]


def test_dedup_is_repeatable(rows):
    plays = rows("game_id string, play_id int, ingest_seq int",
                 dict(game_id="g", play_id=1, ingest_seq=9),
                 dict(game_id="g", play_id=1, ingest_seq=4),
                 dict(game_id="g", play_id=2, ingest_seq=1))
    assert ids(keep_any(plays, S.PLAY_KEY), "play_id", "ingest_seq") == [(1, 4), (2, 1)]
    unordered = plays.withColumnRenamed("ingest_seq", "epa")
    first = ids(keep_any(unordered, S.PLAY_KEY), "play_id", "epa")
    again = ids(keep_any(unordered.repartition(3), S.PLAY_KEY), "play_id", "epa")
    assert first == again and len(first) == 2


def test_recorded_and_keyless_plays_are_left_out(rows):
    ddl = "game_id string, play_id int"
    new = rows(ddl, dict(game_id="g", play_id=1), dict(game_id="g", play_id=2),
               dict(play_id=1), dict(game_id="g"), dict(game_id="h", play_id=1))
    recorded = rows(ddl, dict(game_id="g", play_id=1), dict(game_id="g", play_id=1),
                    dict(play_id=1), dict(game_id="g"))
    assert ids(exclude_recorded(new, recorded, S.PLAY_KEY), "game_id", "play_id") == [
        ("g", 2), ("h", 1)]


def test_keys_are_compared_as_numbers(rows):
    new = rows("game_id string, play_id double", dict(game_id="g", play_id=1.0))
    recorded = rows("game_id string, play_id int", dict(game_id="g", play_id=1))
    assert exclude_recorded(new, recorded, S.PLAY_KEY).count() == 0


def test_a_play_recorded_for_one_player_is_new_for_another(rows):
    plays = rows(NAMES, dict(game_id="g", play_id=1, passer_player_name="A.Able",
                             rusher_player_name="B.Baker"))
    recorded = new_plays(plays, players=["A.Able"])
    assert ids(new_plays(plays, recorded), "player_name") == [("B.Baker",)]


@pytest.fixture
def raw_play(rows):
    def make(*records):
        return rows(S.RAW_DDL, *[
            dict(game_id="g", play_id=i, season=2025, passer_player_name="A.Able") | r
            for i, r in enumerate(records)])
    return make


def test_clean_fills_nulls_only(raw_play):
    got = B.clean(raw_play({}, dict(epa=math.nan, td_player_name="X.Yz", sack=1)))
    first, second = got.orderBy("play_id").collect()
    assert all(first[c] == 0 for c in S.FILL_WITH_ZERO_FLOAT + S.FILL_WITH_ZERO_INT)
    assert first["td_player_name"] == "No TD"
    assert first["down"] is None and first["pass_length"] is None
    assert math.isnan(second["epa"])
    assert second["td_player_name"] == "X.Yz" and second["sack"] == 1


def test_bronze_has_the_fixed_columns(raw_play):
    single = bronze_plays(raw_play({}), player="A.Able")
    assert single.columns == [*S.PLAY_COLUMNS, "bronze_loaded_at"]
    assert len(single.columns) == 51
    every = bronze_plays(raw_play({}))
    assert every.columns == ["player_name", *S.PLAY_COLUMNS, "bronze_loaded_at"]


def test_null_report_is_taken_before_filling(raw_play):
    report = null_report(raw_play(dict(epa=1.0), {}, dict(game_id=None))).first().asDict()
    assert report == dict(n_plays=3, game_id_nulls=1, play_id_nulls=0, epa_nulls=2)


def test_filled_nulls_count_as_zero_in_means(raw_play):
    from gridstats.plans.layers import silver_plays
    from gridstats.plans.performance import qb_performance
    silver = silver_plays(bronze_plays(raw_play(dict(epa=1.0), {})))
    assert qb_performance(silver, team="NE").first()["epa"] == 0.5


def test_column_lists_agree():
    fills = set(S.FILL_WITH_ZERO_FLOAT) | set(S.FILL_WITH_ZERO_INT)
    assert len(S.PLAY_COLUMNS) == 50 and len(S.CAST_TYPES) == 49
    assert len(S.FILL_WITH_ZERO_FLOAT) == 11 and len(S.FILL_WITH_ZERO_INT) == 18
    assert fills | set(S.RENAMES) <= set(S.PLAY_COLUMNS)
