"""Physical plans: what must hold however large the tables are."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from gridstats import schema as S
from gridstats.operators.dedup import keep_any, keep_last
from gridstats.plans.performance import qb_performance
from gridstats.plans.runs import run_bronze, run_silver
from gridstats.plans.splits import SPLIT_TABLES, build
from gridstats.registry.spark_queries import QUERIES, TEAM
from gridstats.plans.layers import new_plays
from gridstats.sources.lineitem_plays import plays_from_lineitem
from gridstats.sources.tables import read_table

# Ungrouped aggregates end in one row, so their last step may use one task.
ONE_ROW = {"bronze_null_report"}


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    """Plans as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return {name: plan_of(query(spark, sf_dir)) for name, query in QUERIES.items()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", QUERIES)
def test_no_step_gathers_rows_or_leaves_the_jvm(plans, name):
    plan = plans[name]
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
    assert "BroadcastExchange" not in plan
    assert "CollectLimit" not in plan
    if name not in ONE_ROW:
        assert "SinglePartition" not in plan


@pytest.mark.parametrize("name", QUERIES)
def test_deduplication_thins_out_copies_before_the_shuffle(plans, name):
    plan = plans[name]
    windows = re.findall(r"Window \[row_number\(\)", plan)
    if name == "sorted_receivers":
        windows.pop()
    # A second window on the same keys needs no exchange, hence no partial limit.
    partial = plan.count("row_number(), 1, Partial")
    assert bool(windows) == bool(partial)
    assert plan.count("row_number(), 1, Final") == len(windows)


@pytest.mark.parametrize("name", SPLIT_TABLES)
def test_split_tables_aggregate_by_hash_on_both_sides(plans, name):
    assert "SortAggregate" not in plans[name]
    assert plans[name].count("HashAggregate") == 2


def test_plays_are_aggregated_by_hash_before_text_is_folded(plans):
    plan = plans["qb_performance"]
    assert plan.rindex("SortAggregate") < plan.index("HashAggregate")


def test_anti_join_needs_no_shuffle_of_its_own(plans):
    plan = plans["bronze_new_plays"]
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    by_play = [e for e in exchanges if e.startswith("play_id")]
    by_supplier = [e for e in exchanges if "suppkey" in e]
    assert (len(by_play), len(by_supplier)) == (2, 4) and len(exchanges) == 6
    assert "LeftAnti" in plan


def test_bronze_and_silver_deduplication_share_one_shuffle(plans):
    exchanges = re.findall(r"Exchange hashpartitioning\(play_id", plans["silver_features"])
    assert len(exchanges) == 1


def test_scans_read_only_what_is_used(spark, sf_dir):
    """Where arrivals are declared unique; ties are otherwise broken by all columns."""
    plays = new_plays(plays_from_lineitem(spark, sf_dir), unique_arrival=True)
    plan = plan_of(plays.groupBy(S.PLAYER, "home_team").count())
    lineitem = re.search(r"FileScan parquet \[(l_[^\]]*)\]", plan).group(1)
    columns = {c.split("#")[0] for c in lineitem.split(",")}
    assert columns == {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                       "l_returnflag", "l_shipdate"}


@pytest.fixture(scope="module")
def skewed(spark, sf_dir):
    """A third of all rows are copies of one play, another third lacks its game."""
    plays = plays_from_lineitem(spark, sf_dir).where(f"{S.PASSER} IS NOT NULL")
    copies = plays.limit(1).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.lit(6000)))).withColumn(
        "ingest_seq", F.col("ingest_seq") + F.col("copy")).drop("copy")
    unknown = plays.withColumn("game_id", F.lit(None).cast("string"))
    return plays, plays.unionByName(copies).unionByName(unknown).repartition(4)


@pytest.mark.parametrize("keep", [keep_any, keep_last])
def test_copies_and_null_keys_keep_every_key_once(skewed, keep):
    plays, frame = skewed
    keys = list(S.PLAY_KEY)
    kept = keep(frame, keys)
    assert kept.count() == kept.select(*keys).distinct().count()
    assert kept.select(*keys).exceptAll(frame.select(*keys).distinct()).isEmpty()
    assert frame.select(*keys).distinct().exceptAll(kept.select(*keys)).isEmpty()


def test_few_copies_are_shuffled(spark, skewed):
    """Rows that cross the exchange, from the finished plan's own metrics."""
    _, frame = skewed
    hot = frame.groupBy(*S.PLAY_KEY).count().orderBy(F.desc("count")).first()
    assert hot["count"] > 6000
    kept = keep_any(frame.where(F.col("play_id") == hot["play_id"]).repartition(4),
                    list(S.PLAY_KEY))
    kept.collect()
    stages, written = [kept._jdf.queryExecution().executedPlan()], []
    while stages:
        node = stages.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stages.append(node.executedPlan())
        elif name in ("ResultQueryStage", "ShuffleQueryStage"):
            stages.append(node.plan())
        else:
            if name == "Exchange":
                written.append(
                    node.metrics().apply("shuffleRecordsWritten").value())
            children = node.children()
            stages.extend(children.apply(i) for i in range(children.size()))
    # The topmost exchange belongs to the deduplication: at most one row per
    # task and key, of four tasks and two keys (with and without a game).
    assert written[0] <= 8


def test_clustered_silver_combines_games_on_the_map_side(spark, sf_dir, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    run_bronze(plays_from_lineitem(spark, sf_dir), bronze)
    run_silver(spark, bronze, silver)
    stored = read_table(spark, silver)
    files = (stored.select("player_name", "game_id", F.input_file_name().alias("file"))
             .distinct().groupBy("player_name", "game_id").agg(F.count(F.lit(1)).alias("n")))
    spread = files.agg(F.avg("n")).first()[0]
    assert spread < 1.1
    assert "SortAggregate" not in plan_of(build("pressure_by_opponent", stored))
    assert qb_performance(stored, team=TEAM).count() == files.count()
