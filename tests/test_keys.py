"""The key table beside bronze: what it saves, and that it may be lost."""

import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from gridstats import schema as S
from gridstats.plans import runs
from gridstats.plans.layers import new_plays
from gridstats.plans.runs import run_bronze
from gridstats.sources import keys, versions
from gridstats.sources.lineitem_plays import plays_from_lineitem
from gridstats.sources.tables import read_table, replace_table

STAMP = datetime(2026, 1, 1)


def rows_of(frame):
    return sorted(map(repr, frame.select(*sorted(frame.columns)).collect()))


@pytest.fixture
def bronze(spark, sf_dir, tmp_path):
    path = str(tmp_path / "bronze")
    run_bronze(plays_from_lineitem(spark, sf_dir, [1995, 1996]), path, key_table=True,
               loaded_at=STAMP)
    return path


def test_runs_with_and_without_the_table_agree(spark, sf_dir, tmp_path, bronze):
    raw = plays_from_lineitem(spark, sf_dir, [1996, 1997]).withColumn(
        "game_id", F.when(F.col("drive") != 5, F.col("game_id")))
    plain = str(tmp_path / "plain")
    run_bronze(plays_from_lineitem(spark, sf_dir, [1995, 1996]), plain, loaded_at=STAMP)
    a = run_bronze(raw, bronze, key_table=True, loaded_at=STAMP)
    b = run_bronze(raw, plain, loaded_at=STAMP)
    assert a == b and a.n_plays > 0
    assert rows_of(read_table(spark, bronze)) == rows_of(read_table(spark, plain))
    assert run_bronze(raw, bronze, key_table=True).n_plays == 0
    assert keys.differences(spark, bronze) == (0, 0)


def test_a_run_reads_keys_and_no_wide_file(spark, sf_dir, bronze, monkeypatch):
    read = versions.read

    def narrow(spark_, path, version, partitions=None):
        assert path != bronze, "bronze was read"
        return read(spark_, path, version, partitions)

    monkeypatch.setattr(runs.versions, "read", narrow)
    again = run_bronze(plays_from_lineitem(spark, sf_dir, [1996]), bronze, key_table=True)
    assert again.n_plays == 0


def test_recorded_keys_are_not_shuffled(spark, sf_dir, bronze):
    base = versions.current(spark, bronze)
    known = keys.recorded(spark, bronze, base)
    fresh = new_plays(plays_from_lineitem(spark, sf_dir, [1996, 1997]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(keys.exclude_bucketed(fresh, known, keys.n_buckets(spark, bronze)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    delivered, recorded = plan[plan.index("LeftAnti"):].rsplit("\n   +- ", 1)
    assert "Bucketed: true" in recorded and "SelectedBucketsCount" in recorded
    assert "Exchange" not in recorded and "Exchange hashpartitioning(_key_" in delivered


def test_a_lost_table_is_built_again(spark, sf_dir, bronze):
    gone = keys.keys_path(bronze)
    shutil.rmtree(gone)
    assert keys.differences(spark, bronze)[0] > 0
    assert run_bronze(plays_from_lineitem(spark, sf_dir, [1996]), bronze,
                      key_table=True).n_plays == 0
    assert keys.differences(spark, bronze) == (0, 0)


def test_a_table_left_behind_catches_up(spark, sf_dir, bronze):
    run_bronze(plays_from_lineitem(spark, sf_dir, [1997]), bronze)       # without the table
    assert keys.differences(spark, bronze)[0] > 0
    assert run_bronze(plays_from_lineitem(spark, sf_dir, [1997]), bronze,
                      key_table=True).n_plays == 0
    assert keys.differences(spark, bronze) == (0, 0)
    assert len(versions.current(spark, keys.keys_path(bronze)).directories) == 2


def test_a_replaced_bronze_replaces_the_keys(spark, sf_dir, bronze):
    replace_table(read_table(spark, bronze).where("season = 1995"), bronze,
                  partition_by=["season"])
    report = run_bronze(plays_from_lineitem(spark, sf_dir, [1996]), bronze, key_table=True)
    assert report.n_plays > 0 and keys.differences(spark, bronze) == (0, 0)


def test_many_writes_become_one(spark, sf_dir, bronze, monkeypatch):
    monkeypatch.setattr(keys, "MOST_WRITES", 2)
    monkeypatch.setattr(keys, "ROWS_PER_BUCKET", 50)
    lengths = []
    for season in (1997, 1998, 1999):
        run_bronze(plays_from_lineitem(spark, sf_dir, [season]), bronze, key_table=True)
        lengths.append(len(versions.current(spark, keys.keys_path(bronze)).directories))
    assert lengths == [2, 2, 2]
    assert versions.current(spark, keys.keys_path(bronze)).notes[keys.BUCKETS] > \
        keys.LEAST_BUCKETS
    assert keys.differences(spark, bronze) == (0, 0)


def test_other_number_types_are_compared_as_they_are_stored(spark, sf_dir, bronze):
    raw = plays_from_lineitem(spark, sf_dir, [1996]).withColumn(
        "play_id", F.col("play_id").cast("double"))
    assert run_bronze(raw, bronze, key_table=True).n_plays == 0


def test_seasons_and_the_key_table_exclude_each_other(spark, sf_dir, tmp_path):
    with pytest.raises(ValueError, match="key_table"):
        run_bronze(plays_from_lineitem(spark, sf_dir, [1996]), str(tmp_path / "b"),
                   key_table=True, season_in_key=True)


def test_keys_of_one_player(spark, sf_dir, tmp_path):
    path = str(tmp_path / "one")
    raw = plays_from_lineitem(spark, sf_dir, [1996])
    first = run_bronze(raw, path, player="Supplier#000000003", key_table=True)
    assert first.n_plays > 0 and set(S.PLAY_KEY) == set(
        versions.current(spark, keys.keys_path(path)).schema.names)
    assert run_bronze(raw, path, player="Supplier#000000003", key_table=True).n_plays == 0
