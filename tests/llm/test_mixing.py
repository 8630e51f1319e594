"""Quotas by naive highest quotients; many sources; repeated keys; helper names."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridstats.llm import mixing as M
from gridstats.llm import sharding, simhash


def naive(ideals, blocks):
    """Seats one by one to the highest quotient, ties to the first source."""
    seats = Counter()
    for _ in range(int(sum(ideals) + 0.5)):
        best = max(range(len(ideals)), key=lambda i: (ideals[i] / (2 * seats[i] + 1), -i))
        seats[best] += 1
    return [min(seats[i], 2 * blocks[i]) for i in range(len(ideals))]


@pytest.mark.parametrize("seed", range(3))
def test_quotas_equal_naive_highest_quotients(spark, seed):
    r = random.Random(seed)
    rows, wanted = [], {}
    for shard in range(12):
        n = r.randrange(1, 9)
        blocks = [r.randrange(0, 40) for _ in range(n)]
        ideals = [b * r.choice([0.25, 0.5, 1.0, 1.5, 2.0, r.random() * 2]) for b in blocks]
        rows += [(shard, i, x, b) for i, (x, b) in enumerate(zip(ideals, blocks))]
        wanted.update({(shard, i): q for i, q in enumerate(naive(ideals, blocks))})
    cells = spark.createDataFrame(rows, "_shard long, _rank int, _ideal double, _blocks long")
    got = {(r["_shard"], r["_rank"]): r["_quota"] for r in M._quotas(cells).collect()}
    assert got == wanted


def test_all_blocks_of_a_shard_are_of_one_size(spark):
    sized = spark.range(3000).selectExpr(
        "id AS doc_id", "cast(id % 7 * id % 400 AS long) AS size",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 20) END AS source")
    kept = M.with_mix(sized, shard_words=40_000)
    lengths = kept.select(F.explode("mix.parts.length").alias("n")).groupBy("n").count()
    assert kept.count() == 3000 and lengths.count() > 0
    taken = kept.groupBy("source").agg(F.sum("mix.taken").alias("t"),
                                       F.first("mix.target").alias("x")).collect()
    assert all(abs(r["t"] - r["x"]) <= max(0.01 * r["x"], 2) for r in taken)


def test_many_sources(spark):
    n = 200_000
    sized = spark.range(n).selectExpr(
        "id AS doc_id", "cast(1 + id % 50 AS long) AS size", "concat('s', id) AS source")
    mixed = M.with_mix(sized)
    row = mixed.agg(F.count("*"), F.sum("mix.taken"), F.sum("mix.target"), F.max(
        F.col("mix.taken") - 2 * F.col("size"))).first()
    assert row[0] == n and abs(row[1] - row[2]) < 0.01 * row[2] and row[3] <= 0


def test_ranks_follow_code_points_over_ranges(spark):
    names = ["", "a", "Z", "é", "中", "\U0001f600", None] + [f"n{i}" for i in range(500)]
    totals = spark.createDataFrame([(n,) for n in names], "_source string").repartition(5)
    got = {r["_source"]: r["_rank"] for r in M._ranked(totals).collect()}
    order = sorted((n for n in names if n is not None), key=lambda n: n.encode()) + [None]
    assert got == {n: i + 1 for i, n in enumerate(order)}


def largest_task(frame, *keys):
    return frame.groupBy(*keys).count().agg(F.max("count")).first()[0]


def test_repeated_documents_are_dealt_by_number(spark):
    n = 30_000
    sized = spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN id END AS doc_id",
        "CASE WHEN id % 3 = 1 THEN 0L ELSE 7L END AS size", "'one' AS source")
    rows = M._numbered(sized, ["source", "doc_id", "size"], 500)
    copies = rows.groupBy("doc_id", "size").agg(
        F.count("*").alias("n"), F.countDistinct("_copy").alias("d"), F.max("_copy").alias("m"))
    assert copies.where("n > 500 AND (d <> n OR m <> n - 1)").isEmpty()
    assert copies.where("n > 500").count() == 2
    mixed = M.with_mix(sized, shard_rows=500)
    assert mixed.count() == n
    # 'one' is alone and stops at twice its size.
    assert mixed.where("mix.taken <> 3 * size / 2").groupBy("size").count().count() <= 1
    again = M.with_mix(sized.repartition(7), shard_rows=500)

    def shown(frame):
        return sorted(map(tuple, frame.groupBy("doc_id", "size", "mix.taken").count()
                          .where("doc_id IS NULL").select("size", "taken", "count").collect()))
    assert shown(again) == shown(mixed)


def test_documents_without_words_are_not_in_the_mix(spark):
    docs = spark.createDataFrame(
        [(i, t, "s", 1) for i, t in enumerate(["a b c", None, "", " \n", "d e", "f"])],
        "doc_id long, text string, source string, n_chars long")
    assert {r["doc_id"] for r in M.mixed_documents(docs).collect()} <= {0, 4, 5}


HELPERS = ("_in _size _key _n _end _rank _total _start _whole _extra _shard _order _copy _block"
           " _from _quota _of_source _range _piece _place _to _offset _bytes _pieces _group"
           " _within _row _n _k _h fp row out mix shard slot size least root quality _leaks"
           " _quality source_size key").split()


def test_columns_named_like_helpers_pass_through_all(spark, sf_dir, tmp_path):
    base = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    extra = {c: F.lit(f"{c} {i}") for i, c in enumerate(dict.fromkeys(HELPERS))}
    docs = base.withColumns(extra)
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    wanted = {c: f"{c} {i}" for i, c in enumerate(dict.fromkeys(HELPERS))}

    def unchanged(frame, *new):
        first = frame.select(*[f"`{c}`" for c in wanted if c not in new]).distinct().collect()
        assert [r.asDict() for r in first] == [
            {c: v for c, v in wanted.items() if c not in new}]

    unchanged(M.with_mix(docs.withColumn("size", M.word_count()), into="mix"), "mix", "size")
    unchanged(M.mixed_documents(docs))
    unchanged(sharding.with_shards(docs, into="shard"), "shard")
    unchanged(simhash.keep_one(docs))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{name}")
        back = spark.read.parquet(f"{tmp_path}/{name}")
        new = ("shard", "slot", "size") if name == "sharding" else ()
        assert set(back.columns) == set(docs.columns)
        unchanged(back, *new)
