from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from gridstats import schema as S
from gridstats.sources.lineitem_plays import plays_from_lineitem
from gridstats.sources.plays import read_plays
from gridstats.sources.tables import (
    append_table, read_table, read_table_if_any, rebalanced, replace_table)


@pytest.fixture(scope="module")
def play_files(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plays") / "by_season")
    plays_from_lineitem(spark, sf_dir).write.partitionBy("season").parquet(path)
    return path


def test_season_filter_selects_directories(spark, play_files):
    plays = read_plays(spark, play_files, [1996, 1998])
    assert {r["season"] for r in plays.select("season").distinct().collect()} == {1996, 1998}
    assert "PartitionFilters: [season" in plan_of(plays).replace("isnotnull(", "").replace(
        "PartitionFilters: [(season", "PartitionFilters: [season")


def test_only_used_columns_are_read(spark, play_files):
    plan = plan_of(read_plays(spark, play_files).select("game_id", "epa"))
    assert "ReadSchema: struct<game_id:string,epa:double>" in plan


def test_other_columns_can_be_kept(spark, play_files, tmp_path):
    path = str(tmp_path / "with_ids")
    spark.read.parquet(play_files).selectExpr("*", "'00-1' AS passer_id").write.parquet(path)
    assert "passer_id" not in read_plays(spark, path).columns
    assert "passer_id" in read_plays(spark, path, extra_columns=["passer_id"]).columns
    with pytest.raises(ValueError, match="rusher_id"):
        read_plays(spark, path, extra_columns=["rusher_id"])


def test_without_seasons_everything_is_read(spark, sf_dir, play_files):
    assert read_plays(spark, play_files).count() == plays_from_lineitem(spark, sf_dir).count()


def test_season_filter_reaches_the_line_scan(spark, sf_dir):
    plays = plays_from_lineitem(spark, sf_dir, seasons=[1996])
    plan = plan_of(plays)
    assert "1996-01-01" in plan.split("PushedFilters")[0] and plays.count() > 0
    assert {r["season"] for r in plays.select("season").distinct().collect()} == {1996}


def test_one_play_can_have_no_player(spark, sf_dir):
    plays = plays_from_lineitem(spark, sf_dir)
    nobody = plays.where(f"{S.PASSER} IS NULL AND {S.RUSHER} IS NULL")
    assert 0 < nobody.count() < plays.count()


def test_missing_table_is_none_but_other_errors_surface(spark, tmp_path):
    assert read_table_if_any(spark, str(tmp_path / "nowhere")) is None
    assert read_table_if_any(spark, str(tmp_path)) is None
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception) as error:
        read_table_if_any(spark, str(broken))
    assert "PATH_NOT_FOUND" not in str(error.value)


def test_append_adds_and_replace_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.range(100).selectExpr("id", "cast(id % 3 as int) AS season", "id AS k")
    append_table(rebalanced(frame, "season"), path, partition_by=["season"])
    append_table(rebalanced(frame, "season"), path, partition_by=["season"])
    assert read_table(spark, path).count() == 200
    replace_table(frame, path, partition_by=["season"], cluster_by=["k"])
    assert read_table(spark, path).count() == 100


def test_clustered_files_cover_disjoint_key_ranges(spark, tmp_path):
    from pyspark.sql import functions as F
    path = str(tmp_path / "t")
    frame = spark.range(20_000).selectExpr("id % 1000 AS k", "id AS v").repartition(7)
    replace_table(frame.repartition(7), path, cluster_by=["k", "v"])
    ranges = sorted((r["lo"], r["hi"]) for r in read_table(spark, path).groupBy(
        F.input_file_name()).agg(F.min("k").alias("lo"), F.max("k").alias("hi")).collect())
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def _deliveries(spark, sf_dir, path, *kinds):
    """One season, delivered in as many files as there are kinds of ``sack``."""
    plays = plays_from_lineitem(spark, sf_dir, [1996]).withColumn("sack", F.col("play_id") % 2)
    for n, kind in enumerate(kinds):
        part = plays.where(F.col("play_id") % len(kinds) == n).withColumn(
            "sack", F.col("sack").cast(kind))
        part = part.drop("season") if n else part.drop("season", "ingest_seq")
        part.coalesce(1).write.parquet(f"{path}/tmp{n}")
        files = [f for f in Path(f"{path}/tmp{n}").iterdir() if f.name.startswith("part-")]
        Path(f"{path}/plays/season=1996").mkdir(parents=True, exist_ok=True)
        for f in files:
            f.rename(f"{path}/plays/season=1996/part-{n:05d}{f.suffix}")
    return f"{path}/plays", plays


@pytest.mark.parametrize("kinds", [
    ("int", "double"), ("double", "int"), ("tinyint", "int", "bigint", "double", "float"),
    ("int", "double") * 3, ("bigint", "bigint")])
def test_files_of_one_season_may_differ_in_type(spark, sf_dir, tmp_path, kinds):
    path, plays = _deliveries(spark, sf_dir, tmp_path, *kinds)
    read = read_plays(spark, path, [1996])
    assert dict(read.dtypes)["sack"] == "double"
    assert rows_of(read.selectExpr("game_id", "play_id", "sack", "epa", "season")) == rows_of(
        plays.selectExpr("game_id", "cast(play_id as bigint)", "cast(sack as double)", "epa",
                         "season"))
    # Files of equal types are read together, whatever lies between them.
    scans = plan_of(read.select("sack")).count("FileScan")
    assert scans == len(set(kinds))


def test_files_of_another_kind_are_refused_by_name(spark, sf_dir, tmp_path):
    path, _ = _deliveries(spark, sf_dir, tmp_path, "int", "string")
    with pytest.raises(ValueError, match="sack string"):
        read_plays(spark, path, [1996])


def rows_of(frame):
    return sorted(map(repr, frame.collect()))
