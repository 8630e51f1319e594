"""Rows that repeat a text and a key are dealt like others."""

import pytest
from pyspark.sql import functions as F

from gridstats.llm.sharding import with_shards


@pytest.mark.parametrize("key", ["7", "CAST(NULL AS BIGINT)"])
def test_repeated_rows_are_spread_over_shards(spark, key):
    other = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(
        F.sha2(F.col("id").cast("string"), 256), 4).alias("text"))
    same = spark.range(2000).select(F.expr(key).alias("doc_id"), F.repeat(
        F.lit("the same text "), 18).alias("text"))
    none = spark.range(3000).select(F.expr(key).alias("doc_id"),
                                    F.lit(None).cast("string").alias("text"))
    docs = other.unionByName(same).unionByName(none)
    placed = with_shards(docs).select("doc_id", "text", "shard.*").collect()
    assert sorted(map(repr, [(r["doc_id"], r["text"]) for r in placed])) == sorted(
        map(repr, [tuple(r) for r in docs.collect()]))
    size, slots = [0] * 16, [[] for _ in range(16)]
    for r in placed:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    mean = sum(size) / 16
    assert max(abs(s - mean) for s in size) <= 0.03 * mean
