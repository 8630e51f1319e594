from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridstats import schema as S
from gridstats.plans.runs import (
    GOLD_TABLES, gold_table_path, read_gold, run_bronze, run_gold, run_silver)
from gridstats.registry.spark_queries import QUERIES, TEAM
from gridstats.sources.lineitem_plays import plays_from_lineitem
from gridstats.sources.tables import read_table

PLAYER = "Supplier#000000003"


def rows_of(frame):
    return sorted(map(repr, frame.select(*sorted(frame.columns)).collect()))


@pytest.fixture(scope="module")
def layers(spark, sf_dir, tmp_path_factory):
    """Bronze in two deliveries, silver and gold, for all players."""
    root = tmp_path_factory.mktemp("layers")
    paths = {name: str(root / name) for name in ("bronze", "silver", "gold")}
    first = run_bronze(plays_from_lineitem(spark, sf_dir, range(1995, 1999)), paths["bronze"],
                       loaded_at=datetime(2026, 1, 1))
    second = run_bronze(plays_from_lineitem(spark, sf_dir), paths["bronze"],
                        loaded_at=datetime(2026, 1, 2))
    third = run_bronze(plays_from_lineitem(spark, sf_dir), paths["bronze"])
    assert run_silver(spark, paths["bronze"], paths["silver"])
    written = run_gold(spark, paths["silver"], paths["gold"], team=TEAM)
    return {"reports": (first, second, third), "written": written, **paths}


def test_bronze_appends_only_what_is_new(spark, layers):
    first, second, third = layers["reports"]
    bronze = read_table(spark, layers["bronze"])
    assert first.n_plays > 0 and second.n_plays > 0
    assert bronze.count() == first.n_plays + second.n_plays
    assert bronze.select(*S.player_key(bronze.columns)).distinct().count() == bronze.count()


def test_repeated_bronze_run_adds_nothing(layers):
    assert layers["reports"][2].n_plays == 0


def test_null_counts_are_taken_before_the_fill(spark, layers):
    assert layers["reports"][0].nulls["epa"] > 0
    assert layers["reports"][0].nulls["game_id"] == 0
    assert read_table(spark, layers["bronze"]).where("epa IS NULL").count() == 0


def test_bronze_files_lie_in_season_directories(layers):
    from pathlib import Path
    seasons = {p.name for p in Path(layers["bronze"]).glob("_write=*/*") if p.is_dir()}
    assert {"season=1995", "season=2001"} <= seasons


def test_all_gold_tables_are_written(layers):
    assert layers["written"] == list(GOLD_TABLES) and len(GOLD_TABLES) == 14


@pytest.mark.parametrize("name", GOLD_TABLES)
def test_stored_gold_equals_the_lazy_plan(spark, sf_dir, layers, name):
    from gridstats.functions.numeric import finite_or_null
    stored = finite_or_null(read_gold(spark, layers["gold"], name).drop("gold_loaded_at"))
    assert rows_of(stored) == rows_of(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name, column, down", [
    ("qb_performance", "week", False), ("efficiency_profile", "game_id", False),
    ("receiver_overview", "epa", True), ("receiver_redzone", "pass_touchdown", True)])
def test_presentation_order_of_stored_tables(spark, layers, name, column, down):
    values = [r[0] for r in read_gold(spark, layers["gold"], name, ordered=True)
              .select(column).collect()]
    assert values == sorted(values, reverse=down) and len(set(values)) > 1


def test_one_player_run_equals_that_players_rows(spark, sf_dir, layers, tmp_path):
    paths = {name: str(tmp_path / name) for name in ("bronze", "silver", "gold")}
    run_bronze(plays_from_lineitem(spark, sf_dir, [1997]), paths["bronze"], player=PLAYER)
    run_silver(spark, paths["bronze"], paths["silver"])
    run_gold(spark, paths["silver"], paths["gold"], team=TEAM, player=PLAYER,
             tables=["qb_performance", "game_momentum"])
    for name in ("qb_performance", "game_momentum"):
        single = read_gold(spark, paths["gold"], name).drop("gold_loaded_at")
        several = (read_gold(spark, layers["gold"], name)
                   .where((F.col("player_name") == PLAYER) & (F.col("season") == 1997)))
        assert single.count() > 0
        assert rows_of(single) == rows_of(several.select(*single.columns))


def test_recorded_seasons_limit_the_comparison(spark, sf_dir, tmp_path):
    path = str(tmp_path / "bronze")
    raw = plays_from_lineitem(spark, sf_dir, [1999])
    appended = run_bronze(raw, path).n_plays
    assert run_bronze(raw, path, recorded_seasons=[1999]).n_plays == 0
    assert appended > 0


def test_nothing_is_written_for_empty_input(spark, sf_dir, tmp_path):
    empty = plays_from_lineitem(spark, sf_dir).where("season = 1900")
    bronze, silver, gold = (str(tmp_path / n) for n in ("bronze", "silver", "gold"))
    assert run_bronze(empty, bronze).n_plays == 0
    assert not run_silver(spark, bronze, silver)
    assert run_gold(spark, silver, gold, team=TEAM) == []
    assert not (tmp_path / "silver").exists() and not (tmp_path / "gold").exists()


def test_unknown_gold_table_is_refused(spark, layers):
    with pytest.raises(ValueError, match="nonsense"):
        run_gold(spark, layers["silver"], layers["gold"], team=TEAM, tables=["nonsense"])


def test_gold_path():
    assert gold_table_path("/w/gold/", "qb_performance") == "/w/gold/gold_qb_performance"


def test_gold_reads_silver_six_times_and_folds_the_same_tables(
        spark, layers, tmp_path, monkeypatch):
    from gridstats.plans import runs, splits

    writes = []

    def counted(table, path, **options):
        files = table.inputFiles()
        writes.append(any(layers["silver"] in f for f in files))
        replace_table(table, path, **options)

    replace_table = runs.replace_table
    monkeypatch.setattr(runs, "replace_table", counted)
    stamp = datetime(2026, 1, 3)
    run_gold(spark, layers["silver"], str(tmp_path), team=TEAM, extra_keys=["season"],
             loaded_at=stamp)
    assert sum(writes) == 6 and len(writes) == 16
    silver = read_table(spark, layers["silver"])
    for family in splits.FAMILIES.values():
        for name in () if family.by_season else family.tables:
            direct = splits.build(name, silver, extra_keys=["season"], loaded_at=stamp)
            stored = read_gold(spark, str(tmp_path), name)
            assert sorted(stored.dtypes) == sorted(direct.dtypes)
            assert rows_of(stored) == rows_of(direct)
