"""Aggregates of the gold tables. Sums over nothing are 0, not NULL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridstats.functions.football import OFFICIAL_PASS
from gridstats.functions.numeric import round_half_even
from gridstats.operators import exact
from gridstats.schema import CAST_TYPES

MEAN_PLACES = 2

# Columns of fractions, whose sums would depend on the order of the plays.
REAL = frozenset(c for c, t in CAST_TYPES.items() if t == "double")


def total(column: str, alias: str | None = None) -> Column:
    value = exact.value(exact.partial(column)) if column in REAL else f"sum({column})"
    return F.expr(f"coalesce({value}, 0) AS {alias or column}")


def official(column: str, alias: str | None = None) -> Column:
    """Sum over official pass plays only; an unknown status does not count."""
    return F.expr(f"coalesce(sum({column}) FILTER (WHERE {OFFICIAL_PASS}), 0)"
                  f" AS {alias or column}")


def _rounded_mean(value: str, count: str, alias: str) -> Column:
    return round_half_even(F.expr(f"try_divide({value}, {count})"), MEAN_PLACES).alias(alias)


def mean(column: str, alias: str | None = None) -> Column:
    value = exact.value(exact.partial(column)) if column in REAL else f"sum({column})"
    return _rounded_mean(value, f"count({column})", alias or column)


def dependent(column: str) -> Column:
    """Value of a column that is the same on every row of the group."""
    return F.expr(f"min({column}) AS {column}")


def n_rows(alias: str) -> Column:
    return F.expr(f"count(*) AS {alias}")


def _partial(column: str) -> dict[str, str]:
    return exact.partial(column) if column in REAL else {f"{column}_sum": f"sum({column})"}


def parts(*, sums: Iterable[str], means: Iterable[str], officials: Iterable[str]) -> list[Column]:
    """Partial sums and counts that ``Folded`` turns into the measures above."""
    held = [partial for c in (*sums, *means) for partial in _partial(c).items()]
    return [
        *[F.expr(f"{sql} AS {name}") for name, sql in held],
        *[F.expr(f"count({c}) AS {c}_n") for c in means],
        *[official(c, f"{c}_official") for c in officials],
        n_rows("rows_n"),
    ]


class Folded:
    """The measures over partial sums in place of plays."""

    @staticmethod
    def _sum(column: str) -> str:
        return exact.value(exact.merged(column)) if column in REAL else f"sum({column}_sum)"

    @staticmethod
    def total(column: str, alias: str | None = None) -> Column:
        return F.expr(f"coalesce({Folded._sum(column)}, 0) AS {alias or column}")

    @staticmethod
    def official(column: str, alias: str | None = None) -> Column:
        return total(f"{column}_official", alias or column)

    @staticmethod
    def mean(column: str, alias: str | None = None) -> Column:
        return _rounded_mean(Folded._sum(column), f"sum({column}_n)", alias or column)

    @staticmethod
    def dependent(column: str) -> Column:
        return dependent(column)

    @staticmethod
    def n_rows(alias: str) -> Column:
        return total("rows_n", alias)
