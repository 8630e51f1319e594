"""Intermediate tables that end a lineage, in the folder the cluster names for it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, from the session.

    Only in local mode, where there is one machine, a temporary one is set instead;
    on a cluster every executor would write to a disk of its own."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="gridstats-shared-")
        spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder if "://" in folder or folder.startswith("file:") else "file://" + folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: a lost executor costs a
    read and not the work before it, and the work is done once however often the
    rows are used."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/gridstats/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
