"""Sums of doubles that do not depend on the order of the rows.

A double is cut into four whole numbers: itself rounded, and what remains in units of
2^-21, 2^-42 and 2^-63. Each is exact, and so are sums of whole numbers, however rows
are shuffled, combined or folded from partial sums. Bits below 2^-63 are rounded off
row by row. Magnitudes from 2^30 on, infinities and NaN are summed as they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMIT = 2.0 ** 30
STEP = 2 ** 21
LEVELS = range(4)


def _level(column: str, level: int) -> str:
    """Whole units of 2^(-21 level). Scaling by powers of two is exact, and so is the
    difference of two doubles that are nearly equal."""
    here = f"rint({column} * {float(STEP ** level)!r}D)"
    if level:
        here += f" - rint({column} * {float(STEP ** (level - 1))!r}D) * {float(STEP)!r}D"
    return f"CASE WHEN abs({column}) < {LIMIT!r}D THEN CAST({here} AS BIGINT) END"


def partial(column: str) -> dict[str, str]:
    """SQL of the aggregates that hold an exact sum, by the names they are stored under."""
    return {
        **{f"{column}_x{i}": f"sum({_level(column, i)})" for i in LEVELS},
        f"{column}_wild": f"sum(CASE WHEN NOT abs({column}) < {LIMIT!r}D THEN {column} END)",
    }


def merged(column: str) -> dict[str, str]:
    """SQL that adds up stored aggregates."""
    return {name: f"sum({name})" for name in partial(column)}


# Sums up to these, without units of 2^-63, come to less than 2^63 units of 2^-42.
SMALL = (2 ** 19, 2 ** 39, 2 ** 61)


def _units(parts: list[str], number: str, literal: str) -> str:
    """The sum in units of the last of these levels, and as a double."""
    units = " + ".join(f"{number.format(part)} * {STEP ** (len(parts) - 1 - i)}{literal}"
                       for i, part in enumerate(parts))
    return f"CAST({units} AS DOUBLE) / {float(STEP ** (len(parts) - 1))!r}D"


def value(aggregates: dict[str, str]) -> str:
    """SQL for the sum as the nearest double; NULL if there was nothing to add.

    Decimals are slow. Where the units fit 64 bits these are rounded to a double, which
    gives the same one.
    """
    *whole, wild = aggregates.values()
    *upper, last = whole
    exact = _units(whole, "CAST({} AS DECIMAL(20,0))", "BD")
    small = " AND ".join(f"{part} BETWEEN -{limit}L AND {limit}L"
                         for part, limit in zip(upper, SMALL, strict=True))
    return (f"CASE WHEN {wild} IS NULL AND {last} = 0L AND {small}"
            f" THEN {_units(upper, '{}', 'L')}"
            f" ELSE coalesce({exact} + {wild}, {exact}, {wild}) END")


def exact_sum(column: str) -> Column:
    return F.expr(value(partial(column)))
