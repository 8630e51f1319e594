"""Corrected plays: appended as later arrivals where asked for."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridstats import schema as S
from gridstats.plans.runs import add_digests, run_bronze, run_silver
from gridstats.sources.lineitem_plays import plays_from_lineitem
from gridstats.sources.tables import read_table

DAYS = [datetime(2026, 1, d) for d in range(1, 9)]


def load(raw, path, day, **options):
    return run_bronze(raw, path, loaded_at=DAYS[day], **{"corrections": True, **options}).n_plays


def corrected(raw, game, value):
    return raw.withColumn("epa", F.when(F.col("game_id") == game, F.lit(value))
                          .otherwise(F.col("epa")))


@pytest.fixture(scope="module")
def raw(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "plays")
    plays_from_lineitem(spark, sf_dir, [1996]).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def game(raw):
    return raw.where(f"{S.PASSER} IS NOT NULL").orderBy("game_id").first()["game_id"]


@pytest.mark.parametrize("options", [{}, {"season_in_key": True}])
def test_a_corrected_value_reaches_silver_and_can_be_taken_back(
        spark, raw, game, tmp_path, options):
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    total = load(raw, bronze, 0, **options)
    assert load(raw, bronze, 1, **options) == 0
    new = corrected(raw, game, 7.25)
    changed = load(new, bronze, 2, **options)
    assert 0 < changed < total and load(new, bronze, 3, **options) == 0
    run_silver(spark, bronze, silver, season_in_key="season_in_key" in options)
    table = read_table(spark, silver)
    assert table.count() == total and S.CONTENT_DIGEST not in table.columns
    assert {r["epa"] for r in table.where(F.col("game_id") == game).collect()} == {7.25}
    # The first values once more are a correction, too: the last arrival counts.
    assert load(raw, bronze, 4, **options) == changed
    run_silver(spark, bronze, silver, season_in_key="season_in_key" in options)
    assert read_table(spark, silver).where("epa = 7.25").count() == 0


def test_off_by_default_corrections_are_not_taken(spark, raw, game, tmp_path):
    bronze = f"{tmp_path}/bronze"
    load(raw, bronze, 0, corrections=False)
    assert load(corrected(raw, game, 7.25), bronze, 1, corrections=False) == 0
    assert S.CONTENT_DIGEST not in read_table(spark, bronze).columns


def test_other_types_and_filled_nulls_are_no_correction(spark, raw, tmp_path):
    bronze = f"{tmp_path}/bronze"
    load(raw, bronze, 0)
    same = raw.withColumns({"play_id": F.col("play_id").cast("double"),
                            "sack": F.col("sack").cast("double"),
                            "epa": F.coalesce("epa", F.lit(0.0)),
                            "game_date": F.col("game_date").cast("string")})
    assert raw.where("epa IS NULL").count() > 0 and load(same, bronze, 1) == 0


def test_digests_can_be_added_later_and_then_stay(spark, raw, game, tmp_path):
    bronze = f"{tmp_path}/bronze"
    half = raw.where("week < 5")
    load(half, bronze, 0, corrections=False)
    with pytest.raises(ValueError, match="add_digests"):
        load(raw, bronze, 1)
    add_digests(spark, bronze)
    assert load(half, bronze, 2) == 0
    # A run that does not look for corrections still writes digests.
    rest = load(raw, bronze, 3, corrections=False)
    assert rest > 0 and load(raw, bronze, 4) == 0
    table = read_table(spark, bronze)
    assert table.where(f"{S.CONTENT_DIGEST} IS NULL").isEmpty()
    assert load(corrected(raw, game, 7.25), bronze, 5) > 0


def test_corrections_need_more_than_keys(raw, tmp_path):
    with pytest.raises(ValueError, match="key_table"):
        load(raw, f"{tmp_path}/bronze", 0, key_table=True)
