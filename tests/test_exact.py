"""Sums and means that no order of rows can change."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gridstats.operators import exact, measures
from gridstats.plans.performance import qb_performance
from gridstats.plans.runs import run_bronze, run_silver
from gridstats.plans.splits import FAMILIES, SPLIT_TABLES, build, partial_sums
from gridstats.sources.lineitem_plays import plays_from_lineitem
from gridstats.sources.tables import read_table


def summed(spark, values, parts=1):
    frame = spark.createDataFrame([(v,) for v in values], "epa double").repartition(parts)
    return frame.agg(exact.exact_sum("epa").alias("v")).first()["v"]


@pytest.mark.parametrize("seed", range(4))
def test_the_sum_is_the_nearest_double(spark, seed):
    r = random.Random(seed)
    values = [r.uniform(-10, 10) * 10.0 ** r.randrange(-4, 6) for _ in range(500)] + [0.1] * 10
    assert summed(spark, values, 3) == math.fsum(values)


def test_cancelling_values_leave_what_is_left(spark):
    assert summed(spark, [1e9, 2.0 ** -60, -1e9]) == 2.0 ** -60
    assert (1e9 + 2.0 ** -60) - 1e9 == 0


def test_values_beyond_the_range_and_no_values(spark):
    assert math.isnan(summed(spark, [1.0, math.nan]))
    assert summed(spark, [1.0, math.inf]) == math.inf
    assert math.isnan(summed(spark, [math.inf, -math.inf]))
    assert summed(spark, [0.5, 2.0 ** 40]) == 2.0 ** 40 + 0.5
    assert summed(spark, [-0.5, None]) == -0.5
    assert summed(spark, [None]) is None and summed(spark, []) is None


def test_stored_parts_add_up_to_the_same(spark):
    r = random.Random(5)
    frame = spark.createDataFrame([(r.randrange(9), r.gauss(0, 3)) for _ in range(900)],
                                  "k int, epa double")
    parts = frame.groupBy("k").agg(*[
        F.expr(f"{sql} AS {name}") for name, sql in exact.partial("epa").items()])
    folded = parts.agg(F.expr(exact.value(exact.merged("epa"))).alias("v")).first()["v"]
    assert folded == frame.agg(exact.exact_sum("epa").alias("v")).first()["v"]


@pytest.fixture(scope="module")
def plays(spark, sf_dir, tmp_path_factory):
    """Silver whose value columns are real numbers of very different size."""
    root = tmp_path_factory.mktemp("real")
    run_bronze(plays_from_lineitem(spark, sf_dir), f"{root}/bronze")
    run_silver(spark, f"{root}/bronze", f"{root}/silver")
    silver = read_table(spark, f"{root}/silver")
    noise = F.xxhash64("game_id", "play_id", "player_name")

    def real(k):
        return (F.pmod(noise, F.lit(1000 + k)) - 500) / F.lit(7.0) * F.pow(
            F.lit(10.0), F.pmod(noise, F.lit(9)) - 4)
    silver = silver.withColumns({c: real(k) for k, c in enumerate(sorted(measures.REAL))})
    silver.write.parquet(f"{root}/real")
    return spark.read.parquet(f"{root}/real").cache()


def rows_of(frame):
    return sorted(map(repr, frame.drop("gold_loaded_at").collect()))


def tables_of(plays):
    """Overviews of all plays, straight and folded, and the per-game means."""
    few = plays.drop("player_name")
    straight = [build(name, few) for name in ("pressure_overview", "pressure_air_yards",
                                              "receiver_overview")]
    folded = [build(name, partial_sums(family, few), folded=True)
              for family, name in (("pressure", "pressure_overview"),
                                   ("pressure", "pressure_air_yards"),
                                   ("receivers", "receiver_overview"))]
    games = qb_performance(few.withColumn("game_id", F.lit("one")), team="NE")
    return [rows_of(t) for t in (*straight, *folded, games)]


def test_a_hundred_orders_and_partitionings_give_equal_tables(spark, plays):
    wanted = tables_of(plays.coalesce(1))
    assert wanted[:3] == wanted[3:6]
    for seed in range(4):
        shuffled = plays.repartition(seed + 2, F.xxhash64("play_id", F.lit(seed)))
        assert tables_of(shuffled) == wanted
    # Cheaper, and many more: the mean of each order on its own.
    few = plays.drop("player_name").select("epa", "cpoe")
    mean = None
    for seed in range(100):
        shuffled = few.orderBy(F.rand(seed)).coalesce(1) if seed % 10 == 0 else \
            few.repartition(seed % 7 + 1, F.rand(seed))
        row = shuffled.agg(F.expr(exact.value(exact.partial("epa"))).alias("s"),
                           measures.mean("epa"), measures.mean("cpoe")).first()
        mean = mean or row
        assert row == mean


def test_every_real_column_is_summed_exactly():
    assert measures.REAL == {"epa", "qb_epa", "air_epa", "yac_epa", "xyac_epa", "cpoe",
                             "yards_after_catch"}
    for family in FAMILIES.values():
        assert set(family.tables) <= set(SPLIT_TABLES)
