"""A player's games are moved once for the windows over them, and sums stay exact."""

import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from gridstats import schema as S
from gridstats.operators import exact
from gridstats.plans.form import game_momentum
from gridstats.plans.performance import CONTEXT, qb_performance
from gridstats.registry.spark_queries import QUERIES


@pytest.fixture
def shuffle_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["game_momentum", "season_progression", "rolling4", "cumulative"])
def test_games_are_moved_once_after_their_contexts(spark, sf_dir, shuffle_joins, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    later = [re.findall(r"([a-z_]+)#", e) for e in exchanges if "suppkey" not in e]
    assert sorted(map(len, later)) == [1, 3, 2 + len(CONTEXT)]
    assert [S.PLAYER] in later


def _plays(spark):
    """Two players, two seasons, and a game whose plays disagree about its context."""
    none = ("sack", "fumble", "fumble_lost", "fumble_forced", "fumble_not_forced",
            "interception", "rush_touchdown")
    return spark.range(400).selectExpr(
        "if(id % 2 = 0, 'A', 'B') AS player_name",
        "if(id % 11 = 0, null, concat('g', id % 14)) AS game_id",
        "cast(2000 + id % 14 div 7 AS int) AS season",
        "cast(id % 7 + if(id % 50 = 1, 1, 0) AS int) AS week",
        "if(id % 50 = 3, 'POST', 'REG') AS season_type",
        "if(id % 40 < 20, 'NE', 'KC') AS home_team",
        "'SF' AS away_team", "concat('T', id % 3) AS opponent_team",
        "cast(id % 3 > 0 AS tinyint) AS pass_attempt",
        "cast(id % 3 = 1 AS tinyint) AS complete_pass",
        "cast(id % 30 AS int) AS passing_yards", "cast(id % 9 AS int) AS rushing_yards",
        "cast(id % 17 = 0 AS tinyint) AS pass_touchdown", "cast(id % 5 AS int) AS air_yards",
        *[f"cast(0 AS tinyint) AS {c}" for c in none],
        "id / 7.0D AS epa", "id / 3.0D AS cpoe", "cast(null AS string) AS two_point_conv_result")


def test_gathered_games_are_the_same(spark):
    plain = game_momentum(qb_performance(_plays(spark), team="NE")).drop("gold_loaded_at")
    together = game_momentum(qb_performance(
        _plays(spark), team="NE", gather=(S.PLAYER,))).drop("gold_loaded_at")
    rows = sorted(map(str, plain.collect()))
    assert sorted(map(str, together.collect())) == rows and len(rows) > 14


def test_only_keys_of_a_game_gather_it(spark):
    with pytest.raises(ValueError, match="season"):
        qb_performance(_plays(spark), team="NE", gather=(S.PLAYER, "season"))
    with pytest.raises(ValueError, match=S.PLAYER):
        qb_performance(_plays(spark).drop(S.PLAYER), team="NE", gather=(S.PLAYER,))


def test_sums_on_both_sides_of_the_64_bit_path_are_the_nearest_double(spark):
    draw = random.Random(3)
    edges = [(sign * (limit + by) for sign in (1, -1) for by in (-1, 0, 1))
             for limit in exact.SMALL]
    rows = [(a, b, c, d) for a, b, c in zip(*edges) for d in (0, 1, -1)]
    rows += [tuple(draw.randint(-limit, limit) for limit in exact.SMALL) + (draw.choice([0, 7]),)
             for _ in range(300)]
    rows += [(*[limit * sign for limit in exact.SMALL], 0) for sign in (1, -1)]
    rows += [(0, 0, 0, 0), (-(2 ** 63), 0, 0, 0), (0, -(2 ** 63), 2 ** 63 - 1, 0)]
    names = list(exact.partial("v"))
    table = spark.createDataFrame(
        [(i, *row, None) for i, row in enumerate(rows)],
        "id int, " + ", ".join(f"{n} bigint" for n in names[:-1]) + f", {names[-1]} double")
    got = {r.id: r.s for r in table.groupBy("id").agg(
        F.expr(exact.value(exact.merged("v"))).alias("s")).collect()}
    for i, row in enumerate(rows):
        wanted = sum(Fraction(x, exact.STEP ** level) for level, x in enumerate(row))
        assert got[i] == float(wanted), row


def test_small_sums_take_the_64_bit_path_and_wild_ones_do_not(spark):
    sql = exact.value(exact.partial("v"))
    small, rest = sql.split(" ELSE coalesce")
    assert "DECIMAL" not in small and "DECIMAL" in rest
    values = spark.createDataFrame(
        [(1, 0.1), (1, 0.2), (2, float("inf")), (2, 1.0), (3, None), (4, 2.0 ** 40), (4, 0.5)],
        "id int, v double")
    got = {r.id: r.s for r in values.groupBy("id").agg(F.expr(sql).alias("s")).collect()}
    assert got == {1: float(Fraction(0.1) + Fraction(0.2)), 2: float("inf"), 3: None,
                   4: 2.0 ** 40 + 0.5}
