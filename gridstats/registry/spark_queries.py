"""One query per operator and gold table, over the plays of all players.

Every query is a lazy plan over the whole of ``lineitem`` and ``supplier``.
NaN and infinities are shown as NULL, except where a query is about them.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridstats import schema as S
from gridstats.functions import football as fb
from gridstats.functions.numeric import INF, finite_or_null, ratio, round_half_even
from gridstats.operators import bronze as B
from gridstats.operators import silver as V
from gridstats.operators.dedup import keep_last, recorded_keys
from gridstats.operators.measures import official, total
from gridstats.operators.ordering import in_order, sort_columns
from gridstats.operators.quality import null_report
from gridstats.operators.windows import rolling_mean, running_total
from gridstats.plans.form import (
    CUMULATIVE, GAME_ORDER, ROLLING_ROWS, SEASON_OF_PLAYER, game_momentum,
    season_progression)
from gridstats.plans.layers import bronze_plays, new_plays, silver_plays
from gridstats.plans.performance import qb_performance
from gridstats.plans.splits import SPLIT_TABLES, build
from gridstats.session import keep_compiled
from gridstats.sources.lineitem_plays import SOURCE, plays_from_lineitem, plays_of_lines
from gridstats.sources.scratch import stored

Query = Callable[[SparkSession, str], DataFrame]

TEAM = "NE"
ONE_PLAYER = "Supplier#000000001"
SEASONS = range(1996, 1998)
EARLIER_SEASONS = range(1995, 1999)
FIRST_LOAD = datetime(2026, 1, 1)
SECOND_LOAD = datetime(2026, 1, 2)


def _distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New plays of all lines; plays are wide, so their lines are shuffled instead."""
    keep_compiled(spark)
    return new_plays(plays_from_lineitem(spark, sf_dir, with_source=True),
                     source=SOURCE, rebuild=plays_of_lines)


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.clean(_distinct(spark, sf_dir), FIRST_LOAD)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_plays(_bronze(spark, sf_dir), distinct=True)


def _performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qb_performance(_silver(spark, sf_dir), team=TEAM)


def _games_of_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The performance table with a player's games together, for windows over them."""
    return qb_performance(_silver(spark, sf_dir), team=TEAM, gather=(S.PLAYER,))


def _unfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct plays under their silver names, nulls as they came."""
    return V.rename_columns(_distinct(spark, sf_dir))


def _stored(df: DataFrame) -> DataFrame:
    return finite_or_null(df.drop("gold_loaded_at"))


# --- sources and bronze ----------------------------------------------------

def src_season_scan(spark, sf_dir):
    return plays_from_lineitem(spark, sf_dir, seasons=SEASONS).select(
        "game_id", "play_id", "season", "week", "play_type", "epa",
        S.PASSER, S.RUSHER)


def bronze_recorded_keys(spark, sf_dir):
    bronze = bronze_plays(plays_from_lineitem(spark, sf_dir), loaded_at=FIRST_LOAD)
    return recorded_keys(bronze, S.player_key(bronze.columns))


def bronze_player_plays(spark, sf_dir):
    return new_plays(plays_from_lineitem(spark, sf_dir)).select(
        S.PLAYER, "game_id", "play_id", "week", "down", "play_type", "epa", "ingest_seq")


def bronze_player_filter(spark, sf_dir):
    """How the one-player filter decides on every play of the table."""
    decision = B.passed_or_ran(ONE_PLAYER)
    return plays_from_lineitem(spark, sf_dir).groupBy("season").agg(
        F.count_if(decision).alias("n_kept"),
        F.count_if(~decision).alias("n_other_player"),
        F.count_if(decision.isNull()).alias("n_unknown"))


def bronze_multi_player_explode(spark, sf_dir):
    plays = B.plays_by_player(plays_from_lineitem(spark, sf_dir))
    return plays.groupBy(S.PLAYER).agg(F.count(F.lit(1)).alias("n_plays"))


def bronze_new_plays(spark, sf_dir):
    """Everything delivered again to a table that holds the earlier seasons.

    Plays of the fifth drive arrive without their game, so their key is unknown.
    """
    recorded = bronze_plays(plays_from_lineitem(spark, sf_dir, seasons=EARLIER_SEASONS),
                            loaded_at=FIRST_LOAD)
    delivered = plays_from_lineitem(spark, sf_dir).withColumn(
        "game_id", F.when(F.col("drive") != 5, F.col("game_id")))
    return new_plays(delivered, recorded).select(
        S.PLAYER, "game_id", "play_id", "season", "week", "ingest_seq")


def bronze_clean(spark, sf_dir):
    cleaned = B.clean(B.plays_by_player(plays_from_lineitem(spark, sf_dir)), FIRST_LOAD)
    return cleaned.select(
        S.PLAYER, *S.PLAY_KEY, *S.FILL_WITH_ZERO_FLOAT, *S.FILL_WITH_ZERO_INT,
        "td_player_name", "down")


def bronze_null_report(spark, sf_dir):
    return null_report(_distinct(spark, sf_dir))


def bronze_plays_table(spark, sf_dir):
    """Every column of bronze but its load stamp, under the types it is stored in;
    the date is shown as text."""
    bronze = _bronze(spark, sf_dir)
    return B.as_declared(bronze).drop(S.BRONZE_LOADED_AT).withColumn(
        "game_date", F.col("game_date").cast("string"))


# --- silver ------------------------------------------------------------------

def silver_cast(spark, sf_dir):
    """Casts that lose range, fractions and non-numeric text."""
    types = {"play_id": "tinyint", "epa": "int", "yrdln": "int", "cpoe": "tinyint",
             "air_yards": "string"}
    return V.enforce_schema(
        plays_from_lineitem(spark, sf_dir).select("ingest_seq", "game_id", *types), types)


def silver_dedup_last(spark, sf_dir):
    """Plays of the first drive arrive a second time with another value."""
    first = plays_from_lineitem(spark, sf_dir)
    again = first.where("drive = 1").withColumn("epa", F.col("epa") + 1)
    loaded = (B.clean(B.plays_by_player(first), FIRST_LOAD)
              .union(B.clean(B.plays_by_player(again), SECOND_LOAD)))
    keys = S.player_key(loaded.columns)
    load_day = F.when(F.col(S.BRONZE_LOADED_AT) == F.lit(SECOND_LOAD), 2).otherwise(1)
    return keep_last(loaded, keys).select(
        *keys, "epa", "ingest_seq", load_day.alias("load_day"))


def silver_features(spark, sf_dir):
    return _silver(spark, sf_dir).select(
        S.PLAYER, "game_id", "play_id", "opponent_team", "quarter", "yard_line",
        "play_description", "score_diff", "own_score", "opp_score",
        "is_success", "is_redzone", "two_point_conv_result")


def silver_plays_table(spark, sf_dir):
    """Every column of silver but its load stamp, the date as text."""
    return _silver(spark, sf_dir).drop("silver_loaded_at").withColumn(
        "game_date", F.col("game_date").cast("string"))


# --- functions and aggregates ------------------------------------------------

def official_pass_totals(spark, sf_dir):
    return _silver(spark, sf_dir).groupBy(S.PLAYER).agg(
        official("pass_attempt", "official_attempts"),
        official("complete_pass", "official_completions"),
        official("passing_yards", "official_passing_yards"),
        total("pass_attempt", "all_attempts"),
        total("complete_pass", "all_completions"))


def passer_rating(spark, sf_dir):
    games = _silver(spark, sf_dir).groupBy(S.PLAYER, "game_id").agg(
        official("pass_attempt"), official("complete_pass"), official("passing_yards"),
        total("pass_touchdown"), total("interception"))
    rating = fb.passer_rating("pass_attempt", "complete_pass", "passing_yards",
                              "pass_touchdown", "interception")
    return finite_or_null(games.select("*", rating.alias("passer_rating")))


def zero_division(spark, sf_dir):
    """Rates per game with NaN shown as -1 and infinity as -2."""
    games = _silver(spark, sf_dir).groupBy(S.PLAYER, "game_id").agg(
        official("pass_attempt"), official("complete_pass", "official_completions"),
        total("complete_pass"))

    def shown(value):
        return (F.when(F.isnan(value), F.lit(-1.0))
                .when(value == F.lit(INF), F.lit(-2.0)).otherwise(value))

    official_rate = round_half_even(ratio("official_completions", "pass_attempt"), 2)
    all_rate = round_half_even(ratio("complete_pass", "pass_attempt"), 2)
    return games.select(
        S.PLAYER, "game_id",
        shown(official_rate).alias("official_rate"),
        shown(all_rate).alias("all_rate"),
        shown(F.nanvl(all_rate, F.lit(0.0))).alias("all_rate_nan_filled"))


def score_bucket_counts(spark, sf_dir):
    return (_unfilled(spark, sf_dir)
            .groupBy(fb.score_bucket().alias("score_bucket"))
            .agg(F.count(F.lit(1)).alias("n_plays"),
                 F.min("score_diff").alias("lowest"),
                 F.max("score_diff").alias("highest"),
                 F.count_if(F.col("score_diff").isNull()).alias("n_unknown")))


def home_away_counts(spark, sf_dir):
    return (_unfilled(spark, sf_dir)
            .groupBy(S.PLAYER, fb.home_or_away(F.lit(TEAM)).alias("home_or_away"))
            .agg(F.count(F.lit(1)).alias("n_plays")))


def pressure_type_counts(spark, sf_dir):
    return (_unfilled(spark, sf_dir)
            .groupBy(S.PLAYER, fb.pressure_type().alias("pressure_type"))
            .agg(F.count(F.lit(1)).alias("n_plays")))


def rolling4(spark, sf_dir):
    metrics = ("epa", "cpoe", "complete_pass", "completion_pct", "pass_touchdown",
               "passer_rating", "yards_per_attempt", "interception", "rushing_yards",
               "rush_touchdown", "sack", "fumble")
    outputs = {m: f"{m}_rolling4" for m in metrics}
    rolled = rolling_mean(_games_of_players(spark, sf_dir), outputs, ROLLING_ROWS,
                          partition_by=SEASON_OF_PLAYER, order_by=GAME_ORDER)
    return finite_or_null(rolled.select(
        *SEASON_OF_PLAYER, *GAME_ORDER, *outputs.values()))


def cumulative(spark, sf_dir):
    """Running totals where games without an attempt have no passing figures."""
    threw = F.col("pass_attempt") > 0
    games = _games_of_players(spark, sf_dir).withColumns({
        c: F.when(threw, F.col(c)) for c in ("passing_yards", "complete_pass")})
    running = running_total(games, CUMULATIVE,
                            partition_by=SEASON_OF_PLAYER, order_by=GAME_ORDER)
    return running.select(*SEASON_OF_PLAYER, *GAME_ORDER, *CUMULATIVE.values())


def sorted_receivers(spark, sf_dir):
    """A player's receivers by value, best first; the place makes order a value."""
    order = ("-epa", "receiver_player_name")
    receivers = build("receiver_overview", _silver(spark, sf_dir)).select(
        S.PLAYER, "receiver_player_name", "epa", "n_targets")
    place = F.row_number().over(
        Window.partitionBy(S.PLAYER).orderBy(*sort_columns(order)))
    return in_order(receivers.withColumn("place", place), (S.PLAYER, *order))


# --- gold tables -------------------------------------------------------------

def qb_performance_table(spark, sf_dir):
    return _stored(_performance(spark, sf_dir))


def game_momentum_table(spark, sf_dir):
    return _stored(game_momentum(_games_of_players(spark, sf_dir)))


def season_progression_table(spark, sf_dir):
    return _stored(season_progression(_games_of_players(spark, sf_dir)))


def _split_query(name: str) -> Query:
    def split_table(spark, sf_dir):
        return _stored(build(name, _silver(spark, sf_dir), team=TEAM))
    return split_table


RATES_SEEN = {
    "qb_performance": ("completion_pct", "yards_per_attempt", "passer_rating"),
    "situational_splits": ("completion_pct", "yards_per_attempt", "yards_per_carry"),
    "efficiency_profile": ("completion_pct", "air_yards_per_attempt", "yac_per_reception"),
    "pressure_overview": ("completion_pct", "yards_per_attempt", "air_yards_per_attempt",
                          "yards_per_carry"),
    "receiver_overview": ("completion_pct", "air_yards_per_target", "yac_per_reception",
                          "yards_per_reception"),
}


# Columns of silver that none of these tables reads.
NOT_IN_RATES = (
    "play_id", "game_date", "drive", "yard_line", "play_description", "play_type",
    "qb_epa", "air_epa", "yac_epa", "xyac_epa", "td_team", "td_player_name",
    "fumble_out_of_bounds", "own_score", "opp_score", "is_success", "is_redzone",
    "silver_loaded_at")


def gold_nonfinite_counts(spark, sf_dir):
    """NaN, infinities and NULLs in the rates of five gold tables, as they are stored.

    The tables group by different keys; silver is deduplicated and stored once for them."""
    silver = stored(_silver(spark, sf_dir).drop(*NOT_IN_RATES), "nonfinite-silver")

    def counts(name: str, rates: tuple[str, ...]) -> DataFrame:
        table = (qb_performance(silver, team=TEAM) if name == "qb_performance"
                 else build(name, silver, team=TEAM))
        value = F.col("value")
        return table.select(F.inline(F.array(*[
            F.struct(F.lit(rate).alias("rate"), F.col(rate).alias("value"))
            for rate in rates]))).groupBy("rate").agg(
                F.count_if(F.isnan(value)).alias("n_nan"),
                F.count_if(value == F.lit(INF)).alias("n_positive"),
                F.count_if(value == F.lit(-INF)).alias("n_negative"),
                F.count_if(value.isNull()).alias("n_null"),
                F.count(F.lit(1)).alias("n_rows")).withColumn("table_name", F.lit(name))
    return reduce(DataFrame.unionByName, [counts(*seen) for seen in RATES_SEEN.items()])


QUERIES: dict[str, Query] = {
    **{query.__name__: query for query in (
        src_season_scan, bronze_recorded_keys, bronze_player_plays,
        bronze_player_filter, bronze_multi_player_explode, bronze_new_plays,
        bronze_clean, bronze_null_report,
        silver_cast, silver_dedup_last, silver_features,
        official_pass_totals, passer_rating, zero_division, score_bucket_counts,
        home_away_counts, pressure_type_counts, rolling4, cumulative,
        sorted_receivers, gold_nonfinite_counts)},
    "bronze_plays": bronze_plays_table,
    "silver_plays": silver_plays_table,
    "qb_performance": qb_performance_table,
    "game_momentum": game_momentum_table,
    "season_progression": season_progression_table,
    **{name: _split_query(name) for name in SPLIT_TABLES},
}
