"""Every registered query against its SQL in another engine, on whole tables."""

import pytest

import __spark_entry__ as contract
from gridstats.registry.oracle import ORACLE
from gridstats.registry.spark_queries import QUERIES
from oracle_check import connect, differences


@pytest.fixture(scope="module")
def database(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, sf_dir, database, name):
    ours = contract.queries()[name](spark, sf_dir).toPandas()
    theirs = database.execute(contract.oracle_sql()[name]).df()
    assert len(ours) > 0
    assert differences(ours, theirs) is None


def test_entry_runs_the_flagship_query(spark):
    frame = contract.entry(spark)
    assert frame.columns == contract.entry(spark).columns
    assert frame.count() > 0


def test_inputs_reach_the_rare_branches(database):
    """The stand-in plays must exercise what the queries claim to cover."""
    sql = contract.oracle_sql()
    (nan,) = database.execute(
        f"SELECT count(*) FROM ({sql['qb_performance']}) WHERE passer_rating IS NULL").fetchone()
    (zero,) = database.execute(
        f"SELECT count(*) FROM ({sql['efficiency_profile']}) "
        "WHERE completion_pct IS NULL").fetchone()
    (over,) = database.execute(
        f"SELECT count(*) FROM ({sql['efficiency_profile']}) "
        "WHERE completion_pct > 100").fetchone()
    buckets = database.execute(sql["score_bucket_counts"]).fetchall()
    assert nan > 0 and zero > 0 and over > 0 and len(buckets) == 5
