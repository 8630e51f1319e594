"""Mix sources to target weights by Sainte-Lague apportionment of token blocks.

Documents are dealt into shards by a seeded hash, those of a small source into few of
them, so that its streams are long enough to be cut. In a shard, the words of a
source in seeded order form one stream; all streams of a shard are cut into blocks
of the same number of tokens. Each shard apportions blocks to sources by highest quotients
x / (2k + 1), where x is the source's target in blocks. A source's quota of q
blocks out of n takes every block q div n times and (q mod n) blocks, spread
evenly from a seeded start, once more. What a document gives is a closed form of
its place in the stream: no row per block is made, and no step needs more than
one shard's share of a source together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridstats.llm.shared import (
    apart, as_one, broadcast_if_small, quoted, stored, text_of, words_of)

WEIGHTS = (3, 1, 2)        # of sources in code point order, repeating
SHARE_PERCENT = 150        # of all words that the mix holds
CAP = 2                    # times its size that a source may give
BLOCK_TOKENS = 512
# Of the shortest stream of a shard: where it has fewer, all blocks of the shard are
# smaller. A source is off its target by half a block in a stream at most.
LEAST_BLOCKS = 256
SHARD_WORDS = 1_000_000    # words and rows of a shard, which bound what is ordered
SHARD_ROWS = 4_000         # together
SALTS = 256                # groups in which the rows of a repeated document are numbered


def word_count(text: str = "text") -> Column:
    return F.size(words_of(text_of(text))).cast("long")


def _ranked(totals: DataFrame) -> DataFrame:
    """``_rank``: the place of a source in code point order, NULL last, from 1.

    Sources are ordered range by range, so that there may be any number of them."""
    order = [F.col("_source").isNull(), F.col("_source")]
    ranges = stored(totals.repartitionByRange(*order).withColumn(
        "_part", F.spark_partition_id()), "mix-sources")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranges.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranges.withColumn("_rank", within).join(broadcast_if_small(parts), "_part").select(
        *totals.columns, (F.col("_rank") + F.col("_before")).alias("_rank"))


def source_targets(sized: DataFrame, *, source: str = "source", size: str = "size",
                   weights=WEIGHTS) -> DataFrame:
    """Per source: rank in code point order (NULL last), rows, size and target words.

    Sources share the mix by weight; where a target would pass ``CAP`` times the
    size it stops there and the excess goes to the others by weight. Who stops is
    found in rounds: what is left for a weight only grows when others stop. All of it
    is in hundredths of a word and in whole numbers.
    """
    totals = sized.groupBy(quoted(source).alias("_source")).agg(
        F.sum(quoted(size)).alias("_source_size"), F.count("*").alias("_source_rows"))
    ranked = _ranked(totals).withColumn("_weight", F.get(
        F.array(*map(F.lit, weights)), ((F.col("_rank") - 1) % len(weights)).cast("int")))
    ranked = stored(ranked, "mix-ranks")
    total = ranked.agg(F.sum("_source_size")).first()[0] or 0
    wide = "decimal(38,0)"
    left, open_weight, known = SHARE_PERCENT * total, None, -1
    stops = F.lit(False)
    while True:
        state = ranked.agg(
            F.count_if(stops).alias("n"),
            F.sum(F.when(stops, F.col("_source_size"))).alias("given"),
            F.sum(F.when(~stops, F.col("_weight"))).alias("open")).first()
        left = SHARE_PERCENT * total - 100 * CAP * (state["given"] or 0)
        open_weight = state["open"] or 0
        if state["n"] == known or not open_weight:
            break
        known = state["n"]
        stops = (F.col("_source_size").cast(wide) * F.lit(100 * CAP * open_weight).cast(wide)
                 <= F.col("_weight") * F.lit(left).cast(wide))
    target = F.when(stops, (CAP * F.col("_source_size")).cast("double")).otherwise(
        F.col("_weight") * F.lit(float(left)) / F.lit(100.0 * max(open_weight, 1)))
    return ranked.select("_source", "_rank", "_source_rows", "_source_size",
                         F.lit(total).alias("_total"), target.alias("_target"))


def _number(*parts) -> Column:
    """A seeded number from 0 to 2^32 - 1."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 8), 16, 10).cast("long")


def _quotas(cells: DataFrame) -> DataFrame:
    """Sainte-Lague per shard: ``_quota`` blocks for each of its sources.

    The divisor is found by bisection; the blocks that rounding by it leaves over
    go by highest quotient, ties to the first source. An array holds one number
    per source of a shard.
    """
    rows = cells.groupBy("_shard").agg(F.sort_array(F.collect_list(F.struct(
        "_rank", "_ideal", "_blocks"))).alias("_rows"))
    rows = rows.withColumn("_seats", F.round(F.aggregate(
        "_rows", F.lit(0.0), lambda a, r: a + r["_ideal"])).cast("long"))

    def seats(divisor: Column) -> Column:
        return F.aggregate("_rows", F.lit(0).cast("long"), lambda a, r: a + F.floor(
            r["_ideal"] / divisor + 0.5))

    def halve(range_: Column, _: Column) -> Column:
        middle = (range_["lo"] + range_["hi"]) / 2
        fits = seats(middle) <= F.col("_seats")
        return F.struct(F.when(fits, range_["lo"]).otherwise(middle).alias("lo"),
                        F.when(fits, middle).otherwise(range_["hi"]).alias("hi"))

    start = F.struct(F.lit(0.0).alias("lo"), F.lit(4.0).alias("hi"))
    rows = rows.withColumn("_divisor", F.aggregate(
        F.sequence(F.lit(1), F.lit(60)), start, halve)["hi"])
    given = F.floor(F.col("_row._ideal") / F.col("_divisor") + 0.5)
    each = rows.select("_shard", "_seats", F.explode("_rows").alias("_row"), "_divisor") \
        .select("_shard", "_seats", "_row.*", given.alias("_given"))
    shard = Window.partitionBy("_shard")
    best = shard.orderBy((F.col("_ideal") / (2 * F.col("_given") + 1)).desc(), "_rank")
    more = F.row_number().over(best) <= F.col("_seats") - F.sum("_given").over(shard)
    return each.select("_shard", "_rank", F.least(
        F.col("_given") + more.cast("long"), CAP * F.col("_blocks")).alias("_quota"))


def _numbered(rows: DataFrame, identity: list[str], over: int) -> DataFrame:
    """``_copy``: 0, or for rows that more than ``over`` share their identity a number
    from 0 to n - 1. Such rows are interchangeable, so it does not matter which gets
    which; they are numbered in salted groups."""
    many = stored(rows.groupBy(*identity).agg(F.count("*").alias("_n"))
                  .where(F.col("_n") > over).select(*identity), "mix-repeats")
    if many.isEmpty():
        return rows.withColumn("_copy", F.lit(0).cast("long"))
    marked = [F.col(c).alias(f"_same{i}") for i, c in enumerate(identity)]
    many = broadcast_if_small(many.select(*marked))
    same = reduce(lambda a, b: a & b, [
        F.col(c).eqNullSafe(F.col(f"_same{i}")) for i, c in enumerate(identity)])
    rest = rows.join(many, same, "left_anti").withColumn("_copy", F.lit(0).cast("long"))
    mine = stored(rows.join(many, same, "left_semi").withColumn(
        "_id", F.monotonically_increasing_id()), "mix-repeated-rows")
    mine = mine.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(SALTS)))
    before = Window.partitionBy(*identity).orderBy("_salt").rowsBetween(
        Window.unboundedPreceding, -1)
    counts = stored(mine.groupBy(*identity, "_salt").agg(F.count("*").alias("_n")).select(
        F.xxhash64(*identity).alias("_of"), F.col("_salt").alias("_in_salt"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "mix-copies")
    place = F.row_number().over(Window.partitionBy(*identity, "_salt").orderBy("_id")) - 1
    numbered = mine.withColumn("_place", place).withColumn("_is", F.xxhash64(*identity)).join(
        broadcast_if_small(counts), (F.col("_is") == F.col("_of"))
        & (F.col("_salt") == F.col("_in_salt")))
    return rest.unionByName(numbered.select(
        *rows.columns, (F.col("_place") + F.col("_before")).alias("_copy")))


def with_mix(sized: DataFrame, *, size: str = "size", source: str = "source",
             key: str = "doc_id", tie_break: tuple[Column, ...] = (), seed: int = 0,
             block_tokens: int = BLOCK_TOKENS, shard_words: int = SHARD_WORDS,
             shard_rows: int = SHARD_ROWS, into: str = "mix") -> DataFrame:
    """All rows and columns, and a struct column ``into`` (replacing one of that
    name): ``source_size``, ``target``, ``taken`` words, ``whole`` (times the whole
    document is taken) and ``parts`` (word ranges taken once more, as structs of
    first word and length).

    A NULL source is a source of its own, last in order. Rows of one key, NULL too, are
    told apart by size and ``tie_break``, and by number where more than ``shard_rows``
    agree in all. Rows of size 0 take nothing. An empty table stays empty. Columns of
    any name are carried as they are. There may be any number of sources.
    """
    kept = [c for c in sized.columns if c != into]
    targets = source_targets(sized, source=source, size=size)
    n_rows = sized.count()
    ties = [F.col(f"_tie{i}") for i in range(len(tie_break))]
    rows = sized.select(
        as_one(kept), quoted(size).cast("long").alias("_size"),
        quoted(source).alias("_of_source"), quoted(key).alias("_key"),
        *[t.alias(f"_tie{i}") for i, t in enumerate(tie_break)])
    rows = _numbered(rows, ["_of_source", "_key", "_size",
                            *[f"_tie{i}" for i in range(len(tie_break))]], shard_rows)
    rows = rows.join(broadcast_if_small(targets), F.col("_of_source").eqNullSafe(
        F.col("_source"))).drop("_source", "_of_source")
    size, key = "_size", "_key"
    name = F.concat_ws("/", F.coalesce(F.col("_key").cast("string"), F.lit("null")), F.col("_size"),
                       *[F.coalesce(t.cast("string"), F.lit("null")) for t in ties], "_copy")
    total = F.col("_total")
    shards = F.greatest(F.lit(1), F.ceil(total / shard_words), F.lit(-(-n_rows // shard_rows)))
    # A source is dealt to as many neighbouring shards as its streams stay long in.
    mine = F.greatest(F.lit(1), F.least(shards, F.greatest(
        F.floor(F.col("_source_size") / (LEAST_BLOCKS * block_tokens)),
        F.ceil(F.col("_source_rows") / shard_rows))))
    first = _number(F.lit(seed), F.lit("source"), F.col("_rank"))
    rows = rows.withColumns({
        "_shard": F.pmod(first + F.pmod(_number(F.lit(seed), name), mine), shards),
        "_order": F.md5(F.concat_ws("/", F.lit(seed), F.lit("order"), name))})
    words = F.col("_words")
    cells = rows.groupBy("_shard", "_rank").agg(
        F.sum(size).alias("_words"), F.first("_target").alias("_target"),
        F.first("_source_size").alias("_source_size"))
    shortest = F.min(F.when(words > 0, words)).over(Window.partitionBy("_shard"))
    block = F.greatest(F.lit(1), F.least(
        F.lit(block_tokens), F.coalesce(F.floor(shortest / LEAST_BLOCKS), F.lit(1))))
    cells = cells.withColumn("_block", block).withColumns({
        "_blocks": F.ceil(words / F.col("_block")),
        "_ideal": F.when(words > 0, F.col("_target") * words / (
            F.col("_source_size") * F.col("_block"))).otherwise(0.0)})
    cells = stored(cells, "mix-cells")
    cells = (cells.select("_shard", "_rank", "_block", "_blocks")
             .join(_quotas(cells), ["_shard", "_rank"]).withColumn(
        "_from", F.pmod(_number(F.lit(seed), F.lit("from"), F.col("_shard"), F.col("_rank")),
                        F.greatest(F.col("_blocks"), F.lit(1)))))
    rows = rows.join(broadcast_if_small(stored(cells, "mix-quotas")), ["_shard", "_rank"])

    stream = Window.partitionBy("_shard", "_rank").orderBy(
        "_order", key, *ties, "_copy").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_end", F.sum(size).over(stream))
    blocks = F.greatest(F.col("_blocks"), F.lit(1))
    whole = F.floor(F.col("_quota") / blocks)
    rows = rows.withColumns({"_whole": whole, "_extra": F.col("_quota") - whole * blocks,
                             "_n": blocks, "_start": F.col("_end") - F.col(size)})

    def picked(i: Column) -> Column:
        """Extra blocks before block i: evenly spread from the seeded start."""
        return F.floor((i * F.col("_extra") + F.col("_from")) / F.col("_n"))

    def taken(x: Column) -> Column:
        i = F.floor(x / F.col("_block"))
        return (picked(i) * F.col("_block")
                + (picked(i + 1) - picked(i)) * (x - i * F.col("_block")))

    first, end = F.col("_start"), F.col("_end")
    inside = F.filter(F.sequence(F.floor(first / F.col("_block")),
                                 F.floor((end - 1) / F.col("_block"))),
                      lambda i: picked(i + 1) > picked(i))

    def part(i: Column) -> Column:
        a = F.greatest(i * F.col("_block"), first)
        b = F.least((i + 1) * F.col("_block"), end)
        return F.struct((a - first).alias("first"), (b - a).alias("length"))

    mix = F.struct(
        "_source_size", F.col("_target").alias("target"),
        (F.col("_whole") * F.col(size) + taken(end) - taken(first)).alias("taken"),
        F.col("_whole").alias("whole"),
        F.when(F.col(size) > 0, F.transform(inside, part)).otherwise(F.array()).alias("parts"))
    mix = mix.withField("source_size", F.col("_source_size")).dropFields("_source_size")
    return rows.select("_in", mix.alias("_out")).select(*apart(kept), F.col("_out").alias(into))


def mixed_documents(docs: DataFrame, *, text: str = "text", key: str = "doc_id",
                    source: str = "source", chars: str = "n_chars", **options) -> DataFrame:
    """The documents of the mix, columns as they came: one row per whole copy taken,
    and one row with the parts taken once more, white space as in the original.

    Documents without words have nothing to take and are left out, NULL texts too.
    Repeated rows are documents each; texts of any length are cut whole."""
    names = docs.columns
    sized = docs.select(as_one(names, "row"), word_count(text).alias("size"),
                        quoted(source).alias("source"), quoted(key).alias("doc_id"))
    mixed = with_mix(sized, tie_break=(F.xxhash64(F.col("row")[text]),), **options)
    mix, original = F.col("mix"), F.col("row")[text]
    pieces = F.regexp_extract_all(F.coalesce(original, F.lit("")), F.lit(
        "([^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*)"), 1)
    excerpt = F.when(F.size(mix["parts"]) > 0, F.array(F.array_join(F.flatten(F.transform(
        mix["parts"], lambda p: F.slice(pieces, (p["first"] + 1).cast("int"),
                                        p["length"].cast("int")))), ""))) \
        .otherwise(F.array().cast("array<string>"))
    copies = F.when(F.col("size") > 0, mix["whole"]).otherwise(0).cast("int")
    out = mixed.select("row", F.explode(F.concat(
        F.array_repeat(original, copies), excerpt)).alias("out"))
    new = {text: F.col("out")}
    if chars in names:
        new[chars] = F.char_length("out").cast("long")
    return out.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in names])
