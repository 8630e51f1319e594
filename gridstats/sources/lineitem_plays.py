"""Play rows derived from order lines.

No football data comes with the test tables, so every line of ``lineitem`` is
read as a play: the supplier is the player, a supplier's ship month is a game,
and the other attributes follow from the line by fixed rules. The mapping is a
join and a projection; it grows with the tables.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Silver keeps play ids in 32 bits. A line's number is divided by the largest one:
# the remainder is the play id and the quotient ends the game id, so that two lines
# never share both, however many there are.
MAX_PLAY_ID = 2_147_483_647

# Expressions over lineitem; each stage may use the names of those before it.
_LINE = {
    "line": "cast(l_orderkey as bigint) * 8 + l_linenumber",
    "season": "year(l_shipdate)",
    "week": "month(l_shipdate)",
    "disc": "cast(rint(l_discount * 100) as int)",
    "tax": "cast(rint(l_tax * 100) as int)",
    "qty": "cast(l_quantity as int)",
    "p": "l_returnflag <> 'R'",
    "r": "l_returnflag = 'R' and l_linenumber <> 7",
}
_KIND = {
    "opp": "element_at(array('BUF','MIA','NYJ','KC','DAL','PHI','SF','LAR'),"
           " cast((l_suppkey + week) % 8 as int) + 1)",
    "at_home": "(l_suppkey + week) % 2 = 0",
    "sk": "p and tax = 8",
    "scramble": "r and l_linestatus = 'F'",
    "fumbled": "disc = 10",
}
_OUTCOME = {
    "cp": "p and not sk and qty % 3 <> 0",
    "score": "if(l_partkey % 13 = 0, null, cast(l_partkey % 41 - 20 as int))",
    "own": "cast(20 + l_partkey % 15 as int)",
    "epa": "if(l_linenumber = 7 and l_partkey % 10 = 0, null,"
           " (disc - 5) / 4.0D)",
}
_PLAY = {
    "game_id": "concat(season, '_', lpad(week, 2, '0'), '_', l_suppkey, '_', line div"
               f" {MAX_PLAY_ID})",
    "play_id": f"cast(line % {MAX_PLAY_ID} as int)",
    "season": "season",
    "season_type": "if(week <= 10, 'REG', 'POST')",
    "game_date": "cast(l_shipdate as date)",
    "week": "week",
    "home_team": "if(at_home, 'NE', opp)",
    "away_team": "if(at_home, opp, 'NE')",
    "defteam": "opp",
    "receiver_player_name":
        "if(p and not sk and l_partkey % 11 <> 0, concat('R', l_partkey % 12), null)",
    "drive": "l_linenumber",
    "qtr": "cast(l_partkey % 4 + 1 as int)",
    "down": "if(l_linenumber = 5, null, (l_linenumber - 1) % 4 + 1)",
    "yrdln": "case when l_partkey % 50 = 0 then '50'"
             " when l_partkey % 2 = 0 then concat(opp, ' ', l_partkey % 50)"
             " else concat('NE ', l_partkey % 50) end",
    "desc": "case when l_linenumber = 5 and l_partkey % 4 = 0 then"
            " 'TWO-POINT CONVERSION ATTEMPT. TWO-POINT CONVERSION SUCCEEDS.'"
            " when l_linenumber = 5 and l_partkey % 4 = 1 then"
            " 'TWO-POINT CONVERSION ATTEMPT. ATTEMPT FAILS.'"
            " when p then 'pass' else 'run' end",
    "play_type": "case when p then 'pass' when r then 'run' else 'no_play' end",
    "yards_gained": "case when cp then qty - 5 when r then qty % 20 - 2 else 0 end",
    "yards_after_catch": "if(cp, qty % 12, null)",
    "epa": "epa",
    "qb_epa": "epa",
    "air_epa": "epa / 2",
    "yac_epa": "epa / 2",
    "xyac_epa": "epa / 2",
    "pass_attempt": "cast(p as int)",
    "complete_pass": "cast(cp as int)",
    "passing_yards": "if(cp, qty - 5, null)",
    "air_yards": "if(p, cast(l_partkey % 40 - 5 as int), null)",
    "pass_touchdown": "cast(cp and qty >= 47 as int)",
    "interception": "cast(p and not sk and not cp and qty % 9 = 0 as int)",
    "sack": "cast(sk as int)",
    "cpoe": "if(p, (l_partkey % 17 - 8) / 2.0D, null)",
    "pass_location": "if(p and not sk, element_at(array('left','middle','right'),"
                     " cast(l_partkey % 3 as int) + 1), null)",
    "td_team": "if((cp and qty >= 47) or (r and qty >= 48), 'NE', null)",
    "td_player_name": "if((cp and qty >= 47) or (r and qty >= 48), s_name, null)",
    "pass_length": "if(p and not sk, if(l_partkey % 40 > 20, 'deep', 'short'), null)",
    "qb_hit": "cast(p and tax >= 6 as int)",
    "qb_scramble": "cast(scramble as int)",
    "qb_dropback": "cast(p or scramble as int)",
    "rush_attempt": "cast(r as int)",
    "rushing_yards": "if(r, qty % 20 - 2, null)",
    "rush_touchdown": "cast(r and qty >= 48 as int)",
    "fumble": "cast(fumbled as int)",
    "fumble_forced": "cast(fumbled and l_partkey % 2 = 0 as int)",
    "fumble_not_forced": "cast(fumbled and l_partkey % 2 = 1 as int)",
    "fumble_lost": "cast(fumbled and l_linestatus = 'F' as int)",
    "fumble_out_of_bounds": "cast(fumbled and l_partkey % 5 = 0 as int)",
    "two_point_conv_result": "cast(null as string)",
    "score_differential": "score",
    "posteam_score": "own",
    "defteam_score": "own - score",
    "passer_player_name": "if(p, s_name, null)",
    "rusher_player_name": "if(r, s_name, null)",
    "ingest_seq": "l_partkey",
}


def _named(expressions: dict[str, str]) -> list[str]:
    return [f"{expression} AS `{name}`" for name, expression in expressions.items()]


def _within(season: int, date_type: DataType) -> Column:
    """The season as a range over the ship date, which the scan can use."""
    shipped = F.col("l_shipdate")
    return ((shipped >= F.lit(f"{season}-01-01").cast(date_type))
            & (shipped < F.lit(f"{season + 1}-01-01").cast(date_type)))


# What a play is computed from, and thus all of it that needs to be moved.
SOURCE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount",
          "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "s_name")


def plays_of_lines(lines: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Raw plays of order lines with their supplier's name. Play columns that ``lines``
    has already are taken from there; ``keep`` names columns to keep beside the plays."""
    known = set(lines.columns)
    for stage in (_LINE, _KIND, _OUTCOME):
        lines = lines.selectExpr("*", *_named(stage))
    return lines.selectExpr(
        *_named({name: f"`{name}`" if name in known else e for name, e in _PLAY.items()}),
        *[f"`{name}`" for name in keep])


def plays_from_lineitem(spark: SparkSession, sf_dir: str,
                        seasons: Iterable[int] | None = None,
                        with_source: bool = False) -> DataFrame:
    """Raw plays, optionally of some seasons only (a range filter on the scan), and
    optionally with the columns they were computed from, see ``plays_of_lines``.

    The player join is left to Spark: broadcast while the supplier table is
    below the checked threshold, otherwise a shuffle join whose oversized
    partitions adaptive execution splits.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    if seasons is not None:
        date_type = lines.schema["l_shipdate"].dataType
        lines = lines.where(reduce(lambda a, b: a | b, [
            _within(s, date_type) for s in sorted(set(seasons))]))
    players = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_name")
    joined = lines.join(players, F.col("l_suppkey") == F.col("s_suppkey"))
    return plays_of_lines(joined, SOURCE if with_source else ())
