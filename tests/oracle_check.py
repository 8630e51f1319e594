"""Compare registered queries with their SQL, values and column names."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for column in frame.columns:
        if pd.api.types.is_numeric_dtype(frame[column]):
            frame[column] = frame[column].astype("float64")
        else:
            frame[column] = frame[column].astype("object").where(frame[column].notna(), None)
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def differences(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """None if both hold the same rows, else what differs first."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(set(ours.columns) ^ set(theirs.columns))}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows instead of {len(theirs)}"
    a, b = _canonical(ours), _canonical(theirs)
    for column in a.columns:
        same = (a[column] == b[column]) | (a[column].isna() & b[column].isna())
        if not same.all():
            at = same.idxmin()
            return (f"{(~same).sum()} values in {column}, first "
                    f"{a.loc[at].to_dict()} instead of {b.loc[at].to_dict()}")
    return None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from gridstats.session import build_session

    directory = sys.argv[1]
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(directory)
    for name in names:
        start = time.time()
        ours = entry.queries()[name](spark, directory).toPandas()
        middle = time.time()
        theirs = con.execute(entry.oracle_sql()[name]).df()
        print(f"{name:28s} {len(ours):7d} spark {middle - start:6.2f}s "
              f"sql {time.time() - middle:6.2f}s {differences(ours, theirs) or 'same'}",
              flush=True)
