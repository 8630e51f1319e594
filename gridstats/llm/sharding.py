"""Size-balanced shards by sampled splitters.

Records are ordered by (text hash, key hash), so that equal texts lie together.
Keys are sampled with a chance in proportion to their size; quantiles of the
sample bound fine ranges of the order. The exact size of every range is then
summed, ranges holding more than their share (a group of copies, above all) are
subdivided by the key hash, and neighbouring ranges fill the shards. Rows that repeat
a text and a key so often that they overfill a range are numbered, and their number
takes the place of the key hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridstats.llm.shared import apart, as_one, broadcast_if_small, quoted, stored, text_of

SHARDS = 16
RANGES = 1024              # fine ranges that the splitters bound
SAMPLES_PER_RANGE = 16     # expected sampled keys per range
OVERFULL = 1.5             # times the mean range size from which a range is subdivided
SALTS = 256                # groups in which the rows of a repeated key are numbered
HASH_DIGITS = 13           # of an MD5, as a number that a double holds exactly


def _hash(value: Column) -> Column:
    return F.conv(F.substring(F.md5(value), 1, HASH_DIGITS), 16, 10).cast("long")


def sized_keys(docs: DataFrame, *, text: str = "text", key: str = "doc_id",
               keep: list[str] | None = None) -> DataFrame:
    """The columns to ``keep`` as one struct ``_in``, and ``_shard``: size, CRC-32, the
    hashes of text and key, and the key."""
    value = text_of(text)
    return docs.select(as_one(docs.columns if keep is None else keep), F.struct(
        (F.octet_length(value) + 1).cast("long").alias("size"),
        F.crc32(F.encode(value, "UTF-8")).alias("crc"), _hash(value).alias("group"),
        _hash(F.coalesce(quoted(key).cast("string"), F.lit("null"))).alias("within"),
        quoted(key).alias("key")).alias("_shard"))


def _splitters(keyed: DataFrame, total: int, ranges: int) -> DataFrame:
    """One row with ``ranges - 1`` quantiles of the size-weighted sample.

    A record is sampled if its key hash, as a fraction, is below its size times
    the rate: repeatable, and about ``ranges * SAMPLES_PER_RANGE`` rows whatever
    the input. A record larger than that counts as often as its size says.
    """
    s = F.col("_shard")
    expected = s["size"] * F.lit(ranges * SAMPLES_PER_RANGE / total)
    fraction = s["within"] / F.lit(float(16 ** HASH_DIGITS))
    copies = F.floor(expected) + (fraction < expected - F.floor(expected)).cast("long")
    sample = keyed.select(s["group"].alias("g"), copies.alias("n")).where("n > 0")
    quantiles = [i / ranges for i in range(1, ranges)]
    return sample.agg(F.percentile("g", F.array(*map(F.lit, quantiles)),
                                   F.col("n")).alias("q"))


def _rank_in(sorted_values: Column, value: Column) -> Column:
    return F.size(F.filter(sorted_values, lambda x: x <= value))


def _numbered(keyed: DataFrame, total: int, rows: int, ranges: int) -> DataFrame:
    """The same rows; where those of one text and key hold more bytes or rows than a
    range should, their ``within`` is spread evenly by a number from 0 to n - 1.

    Such rows are written with an arbitrary id, so that a task that is run again
    sees the same one, and numbered in salted groups.
    """
    s, pair = F.col("_shard"), ["_group", "_within"]
    marked = keyed.withColumns({"_group": s["group"], "_within": s["within"]})
    repeated = stored(marked.groupBy(*pair).agg(
        F.sum(s["size"]).alias("bytes"), F.count("*").alias("n")).where(
        (F.col("n") > 1) & ((F.col("bytes") > total / ranges) | (F.col("n") > rows / ranges)))
        .select(*pair), "repeated")
    if repeated.isEmpty():
        return keyed
    rest = marked.join(broadcast_if_small(repeated), pair, "left_anti")
    mine = stored(marked.join(broadcast_if_small(repeated), pair, "left_semi").withColumn(
        "_copy", F.monotonically_increasing_id()), "repeated-rows")
    mine = mine.withColumn("_salt", F.pmod(F.xxhash64("_copy"), F.lit(SALTS)))
    same = Window.partitionBy(*pair)
    counts = mine.groupBy(*pair, "_salt").agg(F.count("*").alias("_n"))
    counts = stored(counts.select(*pair, "_salt", F.sum("_n").over(same).alias("_all"), (
        F.sum("_n").over(same.orderBy("_salt").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)) - F.col("_n")).alias("_before")),
        "repeated-counts")
    place = F.row_number().over(Window.partitionBy(*pair, "_salt").orderBy("_copy"))
    mine = mine.withColumn("_place", place).join(
        broadcast_if_small(counts), [*pair, "_salt"])
    number = (F.col("_before") + F.col("_place") - 1) / F.col("_all")
    mine = mine.withColumn("_shard", s.withField("within", F.floor(
        number * F.lit(float(16 ** HASH_DIGITS))).cast("long")))
    return rest.select(*keyed.columns).unionByName(mine.select(*keyed.columns))


def with_shards(docs: DataFrame, *, text: str = "text", key: str = "doc_id",
                shards: int = SHARDS, ranges: int = RANGES, keep: list[str] | None = None,
                into: str = "shard") -> DataFrame:
    """All rows and columns, or those to ``keep``, and a struct column ``into``
    (replacing one of that name): ``size``, ``text_crc32``, ``shard`` and ``slot``.

    Shards differ in bytes by about one fine range, unless a single record is
    larger. Slots run from 0 in every shard without gaps, in the order of the
    ranges; ranges are numbered side by side, so no task orders a whole shard.
    A NULL text has no bytes, a NULL key is a key like others; identical rows are
    interchangeable. An empty table stays empty. Texts are read once, to be stored with
    their sizes and hashes, and once more if they are kept. Columns of any name are
    carried as they are.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c != into]
    keyed = stored(sized_keys(docs, text=text, key=key, keep=names), "shard-keys")
    s = F.col("_shard")
    total, rows = keyed.agg(F.coalesce(F.sum(s["size"]), F.lit(0)), F.count("*")).first()
    keyed = _numbered(keyed, total, rows, ranges)
    coarse = int(ranges ** 0.5)
    bounds = _splitters(keyed, max(total, 1), ranges).select(F.struct(
        F.transform(F.sequence(F.lit(coarse), F.lit(ranges - 1), F.lit(coarse)),
                    lambda i: F.get("q", i - 1)).alias("coarse"),
        F.transform(F.sequence(F.lit(0), F.lit(ranges - 1), F.lit(coarse)),
                    lambda i: F.slice("q", i + 1, coarse - 1)).alias("fine")).alias("b"))
    bounds = stored(bounds, "splitters")
    ranged = keyed.withColumn("_bounds", bounds.scalar())
    ranged = ranged.withColumn("_coarse", _rank_in(F.col("_bounds.coarse"), s["group"]))
    ranged = ranged.withColumn("_range", F.col("_coarse") * coarse + _rank_in(
        F.get("_bounds.fine", F.col("_coarse")), s["group"])).drop("_bounds", "_coarse")

    sizes = ranged.groupBy("_range").agg(
        F.sum(s["size"]).alias("_bytes"), F.count("*").alias("_rows"))

    def pieces_of(held: Column, whole: int) -> Column:
        limit = max(1.0, OVERFULL * whole / ranges)
        return F.when(held > limit, F.ceil(held / F.lit(limit / OVERFULL))).otherwise(F.lit(1))

    pieces = F.greatest(pieces_of(F.col("_bytes"), total),
                        pieces_of(F.col("_rows"), rows)).cast("long")
    split = stored(sizes.select("_range", pieces.alias("_pieces")), "range-pieces")
    ranged = ranged.join(broadcast_if_small(split), "_range").withColumn("_piece", F.floor(
        s["within"] / F.lit(float(16 ** HASH_DIGITS)) * F.col("_pieces")).cast("long")) \
        .drop("_pieces")

    cells = ranged.groupBy("_range", "_piece").agg(
        F.sum(s["size"]).alias("_bytes"), F.count("*").alias("_rows"))
    order = Window.orderBy("_range", "_piece").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    middle = F.sum("_bytes").over(order) - F.col("_bytes") / 2
    cells = cells.withColumn("_to", F.least(F.lit(shards - 1), F.floor(
        middle * F.lit(shards / max(total, 1))).cast("int")))
    offset = F.sum("_rows").over(Window.partitionBy("_to").orderBy("_range", "_piece").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)) - F.col("_rows")
    cells = stored(cells.select("_range", "_piece", "_to", offset.alias("_offset")),
                   "shard-ranges")
    place = F.row_number().over(Window.partitionBy("_range", "_piece").orderBy(
        s["group"], s["within"], s["key"]))
    out = ranged.withColumn("_place", place).join(
        broadcast_if_small(cells), ["_range", "_piece"])
    return out.select("_in", F.struct(
        s["size"].alias("size"), s["crc"].alias("text_crc32"), F.col("_to").alias("shard"),
        (F.col("_offset") + F.col("_place") - 1).alias("slot")).alias("_out")).select(
        *apart(names), F.col("_out").alias(into))
