"""Registered queries on tables where one supplier holds a third of all lines."""

import pytest

import __spark_entry__ as contract
from oracle_check import TABLES, connect, differences

HOT = 3
SKEW_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    # Several map tasks, since a partition is split along them.
    "spark.sql.files.maxPartitionBytes": "40KB",
    "spark.sql.files.openCostInBytes": "1KB",
}


@pytest.fixture(scope="module")
def skewed_dir(sf_dir, tmp_path_factory):
    path = tmp_path_factory.mktemp("skewed")
    for table in TABLES:
        if table != "lineitem":
            (path / f"{table}.parquet").symlink_to(f"{sf_dir}/{table}.parquet")
    database = connect(sf_dir)
    # Half of all lines once more for the hot supplier, as lines of other orders.
    database.execute(f"""
        COPY (SELECT * FROM lineitem UNION ALL
              SELECT * REPLACE ({HOT} AS l_suppkey,
                                l_orderkey + 1000000 * (1 + l_suppkey) AS l_orderkey)
              FROM lineitem WHERE l_suppkey % 2 = 0)
        TO '{path}/lineitem.parquet' (FORMAT parquet, ROW_GROUP_SIZE 2048)""")
    (share,) = database.execute(
        f"SELECT avg(CAST(l_suppkey = {HOT} AS INT)) "
        f"FROM '{path}/lineitem.parquet'").fetchone()
    assert share > 1 / 3
    return str(path)


@pytest.fixture
def shuffle_joins(spark):
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key in SKEW_SETTINGS:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", [
    "qb_performance", "game_momentum", "efficiency_profile", "situational_splits",
    "pressure_by_opponent", "receiver_by_down", "bronze_new_plays", "silver_dedup_last"])
def test_results_hold_under_skew(spark, skewed_dir, shuffle_joins, name):
    ours = contract.queries()[name](spark, skewed_dir).toPandas()
    theirs = connect(skewed_dir).execute(contract.oracle_sql()[name]).df()
    assert differences(ours, theirs) is None


def test_the_hot_side_of_the_player_join_is_split(spark, skewed_dir, shuffle_joins):
    frame = contract.queries()["silver_features"](spark, skewed_dir)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
