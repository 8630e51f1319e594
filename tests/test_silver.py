from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridstats import schema as S
from gridstats.operators import silver as V
from gridstats.operators.dedup import keep_last
from gridstats.operators.quality import require_columns
from gridstats.plans.layers import bronze_plays, silver_plays


def test_missing_columns_are_named(rows):
    frame = rows("game_id string, week int", dict(game_id="g", week=1))
    with pytest.raises(ValueError, match="season"):
        require_columns(frame, ["game_id", "week", "season"])


def test_complete_columns_pass(rows):
    frame = rows("game_id string, week int, season int", dict(game_id="g"))
    require_columns(frame, ["game_id", "week", "season"])


FEATURES = ("game_id string, opponent_team string, week int, season int, epa double,"
            " yard_line string, play_description string")


@pytest.mark.parametrize("epa, yard_line, success, redzone", [
    (1.25, "BUF 1", 1, 1), (-0.5, "NE 30", 0, 0)])
def test_features(rows, epa, yard_line, success, redzone):
    frame = rows(FEATURES, dict(game_id="g", opponent_team="BUF", epa=epa,
                                yard_line=yard_line, play_description="text"))
    got = V.add_features(frame).first()
    assert (got["is_success"], got["is_redzone"]) == (success, redzone)
    assert got["two_point_conv_result"] is None


def test_two_point_result_replaces_the_source_column(rows):
    ddl = FEATURES + ", two_point_conv_result string"
    got = V.add_features(rows(ddl, dict(two_point_conv_result="success"))).first()
    assert got["two_point_conv_result"] is None


def test_lenient_cast(rows):
    frame = rows("a double, b int, c string, d string, untouched date, e double",
                 dict(a=7.9, b=300, c="12", d="x", e=127.9),
                 dict(a=-7.9, b=1, c="12.0", d="1", e=-128.9),
                 dict(a=float("nan"), c="", d="99999999999", e=128.0))
    types = dict(a="int", b="tinyint", c="int", d="int", e="tinyint", absent="int")
    got = V.enforce_schema(frame, types)
    assert [tuple(r) for r in got.collect()] == [
        (7, None, 12, None, None, 127), (-7, 1, None, 1, None, -128), (None,) * 6]
    assert got.columns == frame.columns
    assert dict(got.dtypes)["untouched"] == "date"


def test_last_arrival_wins(rows):
    ddl = "game_id string, play_id int, bronze_loaded_at timestamp, ingest_seq int, v string"
    early, late = datetime(2026, 1, 1), datetime(2026, 1, 2)
    frame = rows(ddl,
                 dict(game_id="g", play_id=1, bronze_loaded_at=early, ingest_seq=9, v="old"),
                 dict(game_id="g", play_id=1, bronze_loaded_at=late, ingest_seq=1, v="new"),
                 dict(game_id="g", play_id=2, bronze_loaded_at=late, ingest_seq=1, v="a"),
                 dict(game_id="g", play_id=2, bronze_loaded_at=late, ingest_seq=2, v="b"),
                 dict(game_id="g", play_id=3, ingest_seq=5, v="unstamped"),
                 dict(game_id="g", play_id=3, bronze_loaded_at=early, ingest_seq=1, v="stamped"))
    got = {r["play_id"]: r["v"] for r in keep_last(frame, S.PLAY_KEY).collect()}
    assert got == {1: "new", 2: "b", 3: "stamped"}


@pytest.fixture
def bronze(rows):
    def make(*records):
        raw = rows(S.RAW_DDL, *[
            dict(game_id="g", season=2025, passer_player_name="A.Able") | r for r in records])
        return bronze_plays(raw, loaded_at=datetime(2026, 1, 1))
    return make


def test_silver_columns_and_types(bronze):
    silver = silver_plays(bronze(dict(play_id=1)))
    assert len(silver.columns) == 53 + 1  # and player_name
    types = dict(silver.dtypes)
    assert types["air_yards"] == "int" and types["yards_after_catch"] == "double"
    assert types["sack"] == "tinyint" and types["is_redzone"] == "tinyint"
    assert set(S.RENAMES.values()) <= set(silver.columns)
    assert not {*S.RENAMES, "bronze_loaded_at", "ingest_seq"} & set(silver.columns)


def test_keys_that_do_not_fit_collapse_into_one(bronze):
    frame = bronze(dict(play_id=1), dict(play_id=2)).withColumn(
        "play_id", F.col("play_id") + F.lit(2 ** 40))
    assert [r["play_id"] for r in silver_plays(frame).collect()] == [None]


def test_incomplete_bronze_is_refused(bronze):
    with pytest.raises(ValueError, match="epa"):
        silver_plays(bronze(dict(play_id=1)).drop("epa"))
