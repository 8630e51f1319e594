"""From raw documents to sharded training text, one stage per operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstats.llm.decontam import benchmark_table, with_leaks
from gridstats.llm.mixing import mixed_documents
from gridstats.llm.quality import with_quality
from gridstats.llm.queries import trusted_documents
from gridstats.llm.sharding import with_shards
from gridstats.llm.shared import stored
from gridstats.llm.simhash import keep_one


def _free(docs: DataFrame, name: str) -> str:
    """The name, or a longer one that no column has."""
    while name in docs.columns:
        name += "_"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    into = _free(docs, "_quality")
    rated = with_quality(docs, trusted_documents(spark, sf_dir), into=into)
    return rated.where(F.col(into)["kept"]).drop(into)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of SimHash near-duplicates."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    into = _free(docs, "_leaks")
    searched = with_leaks(docs, benchmark_table(spark, sf_dir), into=into)
    return searched.where(F.size(into) == 0).drop(into)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies and parts of documents, so that sources weigh what they should."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard, its place there, and its size; columns of these
    names give way."""
    new = ("shard", "slot", "size")
    placed = with_shards(docs, into="shard")
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new],
                         *[F.col("shard")[c].alias(c) for c in new])


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# Fingerprints, random walks and hashed multinomials are beyond SQL. Tests compare
# operators behind the stages with brute force or by their properties; the stages as
# such and their chain are only run on an odd and an empty table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
