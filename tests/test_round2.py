"""Keys at any scale, declared types, ties, and what runs carry."""

import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from gridstats import schema as S
from gridstats.operators.dedup import keep_any, keep_last
from gridstats.plans.runs import run_bronze, run_gold, run_silver
from gridstats.sources.lineitem_plays import plays_from_lineitem
from gridstats.sources.plays import read_plays


@pytest.mark.parametrize("first", [2**31 // 8 - 40, 2**31 - 40, 2**40])
def test_every_line_keeps_a_key_of_its_own(spark, tmp_path, sf_dir, first):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").limit(1).drop(
        "l_orderkey", "l_linenumber")
    many = spark.range(first, first + 80).withColumnRenamed("id", "l_orderkey").crossJoin(
        lines).withColumn("l_linenumber", F.lit(1))
    twin = many.withColumn("l_orderkey", F.col("l_orderkey") - 2147483647)
    many.unionByName(twin).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet(f"{sf_dir}/supplier.parquet").write.parquet(f"{tmp_path}/supplier.parquet")
    plays = plays_from_lineitem(spark, str(tmp_path))
    assert plays.count() == 160
    assert plays.select(*S.PLAY_KEY).distinct().count() == 160


def _season(spark, sf_dir, season, **types):
    plays = plays_from_lineitem(spark, sf_dir, seasons=[season])
    return plays.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def test_deliveries_with_other_number_types_join_one_table(spark, sf_dir, tmp_path):
    bronze, silver, gold = (f"{tmp_path}/{n}" for n in ("bronze", "silver", "gold"))
    run_bronze(_season(spark, sf_dir, 1996), bronze)
    run_bronze(_season(spark, sf_dir, 1997, sack="double", play_id="double"), bronze)
    again = run_bronze(_season(spark, sf_dir, 1997), bronze, season_in_key=True)
    assert again.n_plays == 0
    assert run_silver(spark, bronze, silver)
    written = run_gold(spark, silver, gold, team="NE", extra_keys=["season"],
                       tables=["pressure_overview"])
    table = spark.read.parquet(f"{gold}/gold_{written[0]}")
    assert {r["season"] for r in table.select("season").distinct().collect()} == {1996, 1997}


def test_text_where_a_number_belongs_is_refused(spark, sf_dir, tmp_path):
    with pytest.raises(ValueError, match="sack"):
        run_bronze(_season(spark, sf_dir, 1996, sack="string"), f"{tmp_path}/bronze")
    assert not (tmp_path / "bronze").exists()


def test_seasons_are_read_with_their_own_types(spark, sf_dir, tmp_path):
    for season, kind in ((1996, "int"), (1997, "double")):
        _season(spark, sf_dir, season, sack=kind).drop("season").write.parquet(
            f"{tmp_path}/season={season}")
    plays = read_plays(spark, str(tmp_path))
    assert plays.schema["sack"].dataType.simpleString() == "double"
    assert plays.agg(F.sum("sack")).first()[0] == plays.where("sack = 1").count()
    assert read_plays(spark, str(tmp_path), seasons=[1997, 2050]).where("season = 1996").isEmpty()


@pytest.mark.parametrize("seq", [5, None])
def test_ties_are_broken_alike_in_any_order(rows, seq):
    ddl = "game_id string, play_id int, epa double, a int, b int, ingest_seq int"
    tied = [dict(game_id="g", play_id=1, epa=e, a=a, b=b, ingest_seq=seq)
            for e, a, b in ((1.0, 1, None), (1.0, None, 1), (2.0, 1, None))]
    for keep in (keep_any, keep_last):
        kept = {keep(rows(ddl, *order).coalesce(1), S.PLAY_KEY).first()
                for order in permutations(tied)}
        assert len(kept) == 1


def test_recorded_side_reads_the_delivered_seasons_only(spark, sf_dir, tmp_path):
    from gridstats.plans.layers import new_plays

    for season in (1996, 1997):
        run_bronze(_season(spark, sf_dir, season), f"{tmp_path}/bronze")
    recorded = spark.read.parquet(f"{tmp_path}/bronze").where("season in (1997)")
    plan = plan_of(new_plays(_season(spark, sf_dir, 1997), recorded, season_in_key=True))
    assert re.search(r"PartitionFilters: \[[^\]]*season", plan)


def test_silver_of_one_player_needs_the_player(spark, sf_dir, tmp_path):
    raw = _season(spark, sf_dir, 1996)
    name = raw.where("passer_player_name is not null").first()["passer_player_name"]
    ids = raw.withColumns({"pid": F.col(S.PASSER), "rid": F.col(S.RUSHER)})
    report = run_bronze(ids, f"{tmp_path}/bronze", player=name, passer="pid", rusher="rid")
    assert report.n_plays > 0
    run_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver")
    with pytest.raises(ValueError, match="player"):
        run_gold(spark, f"{tmp_path}/silver", f"{tmp_path}/gold", team="NE")
