"""Bronze: choose players' plays, project the fixed columns, fill nulls."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstats import schema as S


def timestamp_column(loaded_at: datetime | None) -> Column:
    """Load stamp: the given time, or the start of the query."""
    return F.current_timestamp() if loaded_at is None else F.lit(loaded_at)


def passed_or_ran(player: str, passer: str = S.PASSER,
                  rusher: str = S.RUSHER) -> Column:
    """Whether a player passed or ran. Being the receiver does not count."""
    return (F.col(passer) == player) | (F.col(rusher) == player)


def plays_of(plays: DataFrame, player: str, *, passer: str = S.PASSER,
             rusher: str = S.RUSHER) -> DataFrame:
    """Plays one player passed or ran."""
    return plays.where(passed_or_ran(player, passer, rusher))


def plays_by_player(plays: DataFrame, players: Iterable[str] | None = None, *,
                    passer: str = S.PASSER, rusher: str = S.RUSHER) -> DataFrame:
    """Every play once for each player who passed or ran it, as ``player_name``.

    The filter before the explode is on the source columns, so it reaches the
    scan. Nearly all plays involve one player; the array is spelled out to stay
    within generated code.
    """
    wanted = None if players is None else sorted(set(players))
    if wanted is None:
        involved = F.col(passer).isNotNull() | F.col(rusher).isNotNull()
    else:
        involved = F.col(passer).isin(wanted) | F.col(rusher).isin(wanted)
    names = (F.when(F.col(passer).isNull(), F.array(rusher))
             .when(F.col(rusher).isNull() | (F.col(rusher) == F.col(passer)),
                   F.array(passer))
             .otherwise(F.array(passer, rusher)))
    exploded = plays.where(involved).withColumn(S.PLAYER, F.explode(names))
    return exploded if wanted is None else exploded.where(F.col(S.PLAYER).isin(wanted))


FILLS = ({c: "0.0D" for c in S.FILL_WITH_ZERO_FLOAT}
         | {c: "0" for c in S.FILL_WITH_ZERO_INT}
         | {"td_player_name": f"'{S.FILL_TD_PLAYER}'"})


def clean(plays: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    """The fixed play columns with nulls filled and the load stamp added.

    ``coalesce`` rather than ``fillna``: the latter would also overwrite NaN.
    """
    lineage = [c for c in (S.PLAYER, S.INGEST_SEQ, S.CONTENT_DIGEST) if c in plays.columns]
    filled = plays.selectExpr(
        *lineage,
        *[f"coalesce({c}, {FILLS[c]}) AS {c}" if c in FILLS else f"`{c}`"
          for c in S.PLAY_COLUMNS])
    return filled.withColumn(S.BRONZE_LOADED_AT, timestamp_column(loaded_at))


def with_digest(plays: DataFrame) -> DataFrame:
    """``content_digest``: what the play columns hold once filled and stored, so that
    a delivery and its stored rows have the same, whatever types it came in."""
    def stored(c: str) -> str:
        text = isinstance(plays.schema[c].dataType, T.StringType)
        typed = f"{'try_cast' if text else 'cast'}(`{c}` AS {S.BRONZE_TYPES[c]})"
        return f"coalesce({typed}, {FILLS[c]}) AS `{c}`" if c in FILLS else f"{typed} AS `{c}`"
    values = ", ".join(stored(c) for c in S.PLAY_COLUMNS)
    return plays.withColumn(S.CONTENT_DIGEST, F.expr(f"md5(to_json(struct({values})))"))


_NUMBERS = (T.NumericType, T.BooleanType, T.NullType)
_KINDS = {
    "string": (T.StringType, T.NullType),
    "date": (T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType, T.NullType),
}


def require_kinds(plays: DataFrame) -> None:
    """Raise ``ValueError`` naming columns whose type cannot be stored as declared:
    text where a number belongs, or the other way round."""
    wrong = [f"{c} {plays.schema[c].dataType.simpleString()}" for c, t in S.BRONZE_TYPES.items()
             if c in plays.columns and not isinstance(
                 plays.schema[c].dataType, _KINDS.get(t, _NUMBERS))]
    if wrong:
        raise ValueError(f"columns of another kind than declared: {wrong}")


def as_declared(plays: DataFrame) -> DataFrame:
    """The columns under the types that bronze declares. Numbers are widened;
    dates delivered as text become NULL if they are none."""
    def declared(c: str) -> Column:
        if c not in S.BRONZE_TYPES:
            return F.col(c)
        cast = F.col(c).try_cast if isinstance(plays.schema[c].dataType, T.StringType) \
            else F.col(c).cast
        return cast(S.BRONZE_TYPES[c]).alias(c)
    return plays.select(*map(declared, plays.columns))
