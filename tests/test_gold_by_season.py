"""Gold that costs what changed: equal to a whole run, reading one season only."""

from datetime import datetime

import pytest

from gridstats.plans import runs
from gridstats.plans.runs import (
    GOLD_TABLES, gold_table_path, partial_path, read_gold, run_bronze, run_gold, run_silver)
from gridstats.plans.splits import FAMILIES, GAME_TABLES
from gridstats.registry.spark_queries import TEAM
from gridstats.sources import versions
from gridstats.sources.lineitem_plays import plays_from_lineitem

STAMP = datetime(2026, 1, 1)
FIRST, ALL = [1995, 1996], [1995, 1996, 1997]


def rows_of(frame):
    return sorted(map(repr, frame.select(*sorted(frame.columns)).collect()))


def gold(spark, paths, name="gold", **options):
    return run_gold(spark, paths["silver"], paths[name], **{
        "team": TEAM, "by_season": True, "loaded_at": STAMP, **options})


@pytest.fixture(scope="module")
def grown(spark, sf_dir, tmp_path_factory):
    """Two seasons, all layers; then a third, with what gold read for it."""
    root = tmp_path_factory.mktemp("layers")
    paths = {name: str(root / name) for name in ("bronze", "silver", "gold", "whole")}

    def upto(seasons):
        run_bronze(plays_from_lineitem(spark, sf_dir, seasons), paths["bronze"],
                   season_in_key=True, loaded_at=STAMP)
        run_silver(spark, paths["bronze"], paths["silver"], season_in_key=True, loaded_at=STAMP)

    upto(FIRST)
    assert gold(spark, paths) == list(GOLD_TABLES)
    before = {t: versions.current(spark, gold_table_path(paths["gold"], t)) for t in GOLD_TABLES}
    upto(ALL)
    read, seen = versions.read, []
    patch = pytest.MonkeyPatch()

    def watched(spark_, path, version, partitions=None):
        seen.append((path.rpartition("/")[2], partitions))
        return read(spark_, path, version, partitions)

    patch.setattr(runs.versions, "read", watched)
    patch.setattr(runs, "_read_filled", lambda s, p: read(s, p, versions.current(s, p)))
    assert gold(spark, paths) == list(GOLD_TABLES)
    patch.undo()
    run_gold(spark, paths["silver"], paths["whole"], team=TEAM, loaded_at=STAMP)
    return paths, before, seen


@pytest.mark.parametrize("name", GOLD_TABLES)
def test_tables_equal_those_of_a_whole_run(spark, grown, name):
    paths, _, _ = grown
    by_season, whole = (read_gold(spark, paths[p], name) for p in ("gold", "whole"))
    assert sorted(by_season.dtypes) == sorted(whole.dtypes)
    assert rows_of(by_season) == rows_of(whole) != []


def test_only_the_new_season_of_silver_is_read(grown):
    _, _, seen = grown
    silver = [partitions for path, partitions in seen if path == "silver"]
    assert len(silver) == 1 + len(GAME_TABLES) + len(FAMILIES)
    assert all(p == {"season=1997"} for p in silver)


def test_directories_of_other_seasons_are_taken_over(spark, grown):
    paths, before, _ = grown
    for name in ("qb_performance", "game_momentum", "season_progression", *GAME_TABLES):
        now = versions.current(spark, gold_table_path(paths["gold"], name))
        assert set(before[name].directories) < set(now.directories)
        new = set(now.directories) - set(before[name].directories)
        assert {versions.partition_of(d) for d in new} == {"season=1997"}


def test_nothing_new_reads_no_silver(spark, grown, monkeypatch):
    paths, _, _ = grown
    numbers = [versions.current(spark, partial_path(paths["gold"], f)).number for f in FAMILIES]
    gold(spark, paths)
    assert numbers == [versions.current(spark, partial_path(paths["gold"], f)).number
                       for f in FAMILIES]


def test_other_settings_rebuild_everything(spark, grown, tmp_path):
    paths, _, _ = grown
    paths = {**paths, "gold": str(tmp_path / "gold")}
    tables = ["efficiency_profile", "situational_splits"]
    gold(spark, paths, tables=tables)
    plain = {t: read_gold(spark, paths["gold"], t) for t in tables}
    assert all("season" not in t.columns for t in plain.values())
    gold(spark, paths, tables=tables, extra_keys=["season"], team="XX")
    wanted = str(tmp_path / "wanted")
    run_gold(spark, paths["silver"], wanted, team="XX", tables=tables, extra_keys=["season"],
             loaded_at=STAMP)
    for name in tables:
        assert rows_of(read_gold(spark, paths["gold"], name)) == rows_of(
            read_gold(spark, wanted, name))


def test_one_player_takes_all_seasons(spark, sf_dir, tmp_path):
    paths = {name: str(tmp_path / name) for name in ("bronze", "silver", "gold")}
    run_bronze(plays_from_lineitem(spark, sf_dir, [1995]), paths["bronze"],
               player="Supplier#000000003")
    run_silver(spark, paths["bronze"], paths["silver"])
    with pytest.raises(ValueError, match="player"):
        gold(spark, paths, player="Supplier#000000003")
