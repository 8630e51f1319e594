"""Raw plays to bronze rows, bronze rows to silver rows, as lazy plans."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame

from gridstats import schema as S
from gridstats.operators import bronze as B
from gridstats.operators import silver as V
from gridstats.operators.dedup import (
    exclude_recorded, exclude_unchanged, keep_any, keep_last)
from gridstats.operators.quality import require_columns


def new_plays(raw: DataFrame, recorded: DataFrame | None = None, *,
              player: str | None = None, players: Iterable[str] | None = None,
              passer: str = S.PASSER, rusher: str = S.RUSHER,
              season_in_key: bool = False, corrections: bool = False,
              unique_arrival: bool = False, source: Sequence[str] = (),
              rebuild: Callable[[DataFrame, Iterable[str]], DataFrame] | None = None
              ) -> DataFrame:
    """Distinct plays of the wanted players that ``recorded`` does not hold.

    ``player`` selects one player and leaves the rows without a player column;
    otherwise every play is kept once per player involved, for all players or
    for ``players``. Nulls are still unfilled. With ``season_in_key`` plays are
    compared with recorded ones of their own season only. With ``corrections`` plays
    get a digest of their contents, and recorded plays that now come with other
    contents are plays to add, too. ``unique_arrival``
    declares that copies of a play differ in ``ingest_seq``.

    Where plays are computed from fewer columns, ``raw`` may hold those beside them as
    ``source``: copies are told apart by the plays as ever, but only the key and
    ``source`` are sorted and shuffled, and ``rebuild`` computes the plays kept once
    more. It gets those columns and the names of those to keep beside the plays.
    """
    if player is not None:
        chosen = B.plays_of(raw, player, passer=passer, rusher=rusher)
    else:
        chosen = B.plays_by_player(raw, players, passer=passer, rusher=rusher)
    keys = S.player_key(chosen.columns)
    if season_in_key:
        keys = [*keys, "season"]
    distinct = keep_any(chosen, keys, unique_arrival=unique_arrival,
                        contents=[c for c in chosen.columns if c not in source])
    if rebuild is not None:
        beside = [S.PLAYER] if S.PLAYER in keys else []
        distinct = rebuild(distinct.select(*keys, *source), beside)
    if corrections:
        distinct = B.with_digest(distinct)
    if recorded is None:
        return distinct
    exclude = exclude_unchanged if corrections else exclude_recorded
    return exclude(distinct, recorded, keys)


def bronze_plays(raw: DataFrame, recorded: DataFrame | None = None, *,
                 loaded_at: datetime | None = None, **selection) -> DataFrame:
    """Rows to append to bronze."""
    return B.clean(new_plays(raw, recorded, **selection), loaded_at)


def silver_plays(bronze: DataFrame, loaded_at: datetime | None = None, *,
                 season_in_key: bool = False, unique_arrival: bool = False,
                 distinct: bool = False) -> DataFrame:
    """The silver table for a bronze table.

    Deduplication follows the cast, so keys that do not fit their type collapse
    into one NULL key, or one for each season with ``season_in_key``. ``distinct``
    declares that no two rows of ``bronze`` share a key: where the cast leaves the
    key's types as they are, nothing is left to deduplicate then.
    """
    require_columns(bronze, S.PLAY_COLUMNS)
    lineage = [c for c in (S.PLAYER, S.BRONZE_LOADED_AT, S.INGEST_SEQ)
               if c in bronze.columns]
    typed = V.enforce_schema(bronze.select(*lineage, *S.PLAY_COLUMNS), S.CAST_TYPES)
    renamed = V.rename_columns(typed)
    keys = S.player_key(renamed.columns) + (["season"] if season_in_key else [])
    same_types = all(bronze.schema[k].dataType == renamed.schema[k].dataType for k in keys)
    latest = renamed if distinct and same_types else keep_last(
        renamed, keys, unique_arrival=unique_arrival)
    return V.add_features(latest.drop(S.BRONZE_LOADED_AT, S.INGEST_SEQ), loaded_at)
