"""Plays computed from lines: only the lines are sorted and shuffled."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from gridstats import schema as S
from gridstats.plans.layers import bronze_plays, new_plays, silver_plays
from gridstats.registry import spark_queries as R
from gridstats.session import METHOD_LIMIT
from gridstats.sources.lineitem_plays import plays_from_lineitem

LINE = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
        " l_linestatus string, l_shipdate timestamp")


@pytest.fixture(scope="module")
def lines_dir(spark, tmp_path_factory):
    """Lines of two suppliers, with copies that differ, nulls and a line without a player."""
    rows = [(order, order % 7, order % 2, 1 + order % 7, float(order % 50 + less), 1.0,
             0.01 * (order % 11) if order % 13 else None, 0.01 * (order % 9),
             "NRA"[order % 3] if order % 17 else None, "OF"[order % 2], "1996-03-04 00:00:00")
            for order in range(60) for less in range(1 + 2 * (order % 5 == 0))]
    path = str(tmp_path_factory.mktemp("lines"))
    lines = spark.createDataFrame(rows, LINE.replace("timestamp", "string")).withColumn(
        "l_shipdate", F.to_timestamp("l_shipdate"))
    lines.repartition(3).write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(0, "A"), (1, "B")], "s_suppkey long, s_name string").write.parquet(
        f"{path}/supplier.parquet")
    return path


def _same(a, b):
    assert a.columns == b.columns and a.dtypes == b.dtypes
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_the_same_copy_is_kept(spark, lines_dir):
    whole = new_plays(plays_from_lineitem(spark, lines_dir))
    assert whole.count() < plays_from_lineitem(spark, lines_dir).where(
        "play_type <> 'no_play'").count()
    _same(R._distinct(spark, lines_dir).select(*whole.columns), whole)


def test_silver_is_the_same_without_a_second_deduplication(spark, lines_dir):
    whole = silver_plays(bronze_plays(plays_from_lineitem(spark, lines_dir),
                                      loaded_at=R.FIRST_LOAD), R.SECOND_LOAD)
    once = silver_plays(R._bronze(spark, lines_dir), R.SECOND_LOAD, distinct=True)
    _same(once, whole)
    assert plan_of(once).count("Window [row_number()") == 1


def test_keys_that_the_cast_changes_are_still_deduplicated(spark, lines_dir):
    bronze = R._bronze(spark, lines_dir).withColumn(
        "play_id", F.col("play_id") + F.lit(2 ** 40))
    assert bronze.schema["play_id"].dataType.simpleString() == "bigint"
    silver = silver_plays(bronze, distinct=True)
    assert silver.where("play_id is null").count() == silver.select(
        S.PLAYER, "game_id").distinct().count() < bronze.count()


@pytest.mark.parametrize("name", ["silver_plays", "bronze_plays"])
def test_no_derived_column_is_shuffled(spark, sf_dir, name):
    plan = R.QUERIES[name](spark, sf_dir)._jdf.queryExecution().sparkPlan()
    pending, outputs = [plan], []
    while pending:
        node = pending.pop()
        if node.nodeName() == "WindowGroupLimit":
            outputs.append(node.output().size())
        pending.extend(node.children().apply(i) for i in range(node.children().size()))
    # Keys, the lines' columns, and what orders copies; plays have 50 columns and more.
    assert outputs and max(outputs) <= 16


def test_generated_methods_stay_small_in_any_session(spark, sf_dir):
    own = spark.newSession()
    own.conf.set(METHOD_LIMIT, "65535")
    R.QUERIES["silver_plays"](own, sf_dir)
    assert own.conf.get(METHOD_LIMIT) == "8000"
    own.conf.set(METHOD_LIMIT, "4000")
    R.QUERIES["silver_plays"](own, sf_dir)
    assert own.conf.get(METHOD_LIMIT) == "4000"


def test_counts_of_rates_store_no_column_that_nobody_reads(spark, lines_dir, monkeypatch):
    held = []
    monkeypatch.setattr(R, "stored", lambda df, name: held.append(df.columns) or df)
    counts = R.gold_nonfinite_counts(spark, lines_dir)
    (columns,) = held
    read = set()
    pending = [counts._jdf.queryExecution().optimizedPlan()]
    while pending:
        node = pending.pop()
        if node.nodeName() == "Aggregate":
            read |= {a.name() for a in _items(node.references().toSeq())}
        pending.extend(_items(node.children()))
    assert {"down", "pass_length", "air_yards", S.PLAYER} <= read & set(columns)
    assert not {"play_id", "yard_line", "play_description", "td_player_name"} & set(columns)


def _items(seq):
    return [seq.apply(i) for i in range(seq.size())]
