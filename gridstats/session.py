"""A session with the settings the plans in this package are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Nothing here fixes a cluster size: the number of shuffle partitions is a
# starting point that adaptive execution coalesces, and joins are broadcast only
# below the byte threshold that Spark checks against statistics.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Streaming deduplication keeps every play's key; on the heap they would not fit.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Play rows are wide. Beyond 8000 bytes the JVM leaves a generated method
    # interpreted; below this limit Spark generates smaller ones instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Plans have hundreds of expressions; recording the Python line of each one
    # takes longer than creating it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def keep_compiled(spark: SparkSession) -> None:
    """The limit on generated methods for a session that was built elsewhere. One that
    has a lower limit keeps it."""
    if int(spark.conf.get(METHOD_LIMIT)) > int(SETTINGS[METHOD_LIMIT]):
        spark.conf.set(METHOD_LIMIT, SETTINGS[METHOD_LIMIT])


def build_session(app_name: str = "gridstats", master: str | None = None,
                  shuffle_partitions: int | None = None, **settings: str) -> SparkSession:
    """``shuffle_partitions``: shuffled bytes of the largest layer over 128 MB, and at
    least two per core. Adaptive execution merges what smaller tables do not need."""
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
