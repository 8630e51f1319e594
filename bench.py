"""Time every registered query and the stored layers; print one JSON line.

BENCH_SF_DIR  input tables         (default /root/testdata/sf0.1)
BENCH_CPUS    local cores          (default 8)
BENCH_RUNS    timed runs per query and layer (default 3; the median counts)
BENCH_DIR     folder for layer tables, shared by all executors on a cluster
              (default: spark.checkpoint.dir, in local mode a temporary one)

Each query runs once before it is timed, and is written in full to Spark's
``noop`` sink: a count would let the optimizer drop most of the work.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from datetime import datetime

from gridstats.plans.runs import GOLD_TABLES, run_bronze, run_gold, run_silver
from gridstats.registry.spark_queries import QUERIES, TEAM
from gridstats.session import build_session
from gridstats.sources.lineitem_plays import plays_from_lineitem
from gridstats.sources.scratch import shared_folder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def time_queries(spark, names) -> dict[str, float]:
    times = {}
    for name in names:
        def run():
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        run()
        times[name] = round(statistics.median(seconds(run) for _ in range(RUNS)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    return times


def time_layers(spark) -> dict[str, float]:
    """Raw plays to bronze, silver and all gold tables, stored as Parquet: one round
    to warm up, then the median of ``RUNS``. Raw plays come from several files, as
    one row group would keep all but one core idle."""
    root = os.environ.get("BENCH_DIR") or shared_folder(spark)
    root = f"{root.rstrip('/')}/bench-{os.getpid()}-{time.time_ns()}"
    raw = f"{root}/raw"
    plays_from_lineitem(spark, SF_DIR).repartition(2 * CPUS).write.parquet(raw)
    rounds = [_layer_round(spark, raw, f"{root}/{n}") for n in range(RUNS + 1)][1:]
    times = {name: statistics.median(r[name] for r in rounds) for name in rounds[0]}
    times["total"] = sum(times.values())
    times |= _next_season(spark, raw, f"{root}/grown")
    return {name: round(t, 3) for name, t in times.items()}


def _next_season(spark, raw: str, root: str) -> dict[str, float]:
    """What the last season costs when it is delivered to layers that hold the others,
    once; to be held against the whole runs above."""
    bronze, silver, gold = (f"{root}/{layer}" for layer in ("bronze", "silver", "gold"))
    plays = spark.read.parquet(raw)
    last = plays.agg({"season": "max"}).first()[0]

    def load(part):
        return run_bronze(part, bronze, season_in_key=True, loaded_at=datetime(2026, 1, 1))

    def derive():
        return (seconds(lambda: run_silver(spark, bronze, silver, season_in_key=True)),
                seconds(lambda: run_gold(spark, silver, gold, team=TEAM, by_season=True)))

    load(plays.where(plays["season"] < last))
    derive()
    times = {"next_season_bronze": seconds(lambda: load(plays.where(plays["season"] == last)))}
    times["next_season_silver"], times["next_season_gold"] = derive()
    return times


def _layer_round(spark, raw: str, root: str) -> dict[str, float]:
    bronze, silver, gold = (f"{root}/{layer}" for layer in ("bronze", "silver", "gold"))

    def load():
        return run_bronze(spark.read.parquet(raw), bronze, season_in_key=True,
                          loaded_at=datetime(2026, 1, 1))

    times = {
        "bronze": seconds(load),
        "bronze_again_adds_nothing": seconds(load),
        "silver": seconds(lambda: run_silver(spark, bronze, silver)),
    }
    for name in GOLD_TABLES:
        times[f"gold_{name}"] = seconds(
            lambda: run_gold(spark, silver, gold, team=TEAM, tables=[name]))
    return times


def main() -> None:
    spark = build_session("gridstats-bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": str(CPUS),
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    times = time_queries(spark, sys.argv[1:] or QUERIES)
    layers = time_layers(spark)
    scale = re.search(r"sf([\d.]+)/?$", SF_DIR)
    print(json.dumps({
        "metric": "total time of all registered queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "layers": layers,
        "sf": float(scale.group(1)) if scale else SF_DIR,
        "cpus": CPUS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
