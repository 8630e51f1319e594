"""Source divergence: in which words the sources of a language differ.

Words are counted by sorting pointers. Every task lays pointers to the starts of
words over the Arrow buffer of its texts and sorts them, a slice of texts at a
time, by (language, source) and then by the bytes they point to: a multikey
quicksort that compares eight bytes at once and goes on with the next eight only
inside runs that are still equal. Equal runs give occurrences and documents. What
leaves a task is one row per run; the rest are aggregations and integer arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridstats.llm.shared import ship_package, stored

SCALE = 1_000_000_000
MIN_DOCS = 3
TOP_TERMS = 200
SLICE_BYTES = 16 << 20        # text whose words are sorted together, or a single text
PAIRS_AT_ONCE = 1 << 20       # pairs of sources of the same words held at a time

# A word is a run of ASCII letters and of all characters beyond ASCII: in UTF-8,
# the bytes of letters and all bytes above 0x7F.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[65:91] = IN_WORD[97:123] = IN_WORD[128:] = True
_MASKS = np.array([(~0 << (64 - 8 * n)) & ((1 << 64) - 1) for n in range(9)], np.uint64)


def word_pointers(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and texts of all words; ``ends`` has the end of every text."""
    inside = IN_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[0] = edge[ends] = True
    before = np.concatenate(([False], inside))[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate((inside, [False]))[1:]
    stops = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, stops - starts, np.searchsorted(ends, starts, side="right")


def _eight(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The next eight bytes of every pointer as one number, zero past the word's end."""
    value = np.zeros(len(starts), np.uint64)
    for i in range(8):
        value = (value << np.uint64(8)) | data[starts + i]
    return value & _MASKS[np.clip(lengths, 0, 8)]


def multikey_sort(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray,
                  groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the pointers by group and word, and which begin a run.

    Pointers of a run keep their order, so those of one text lie together."""
    data = np.concatenate((data, np.zeros(8, np.uint8)))
    order, first = np.arange(len(starts)), np.zeros(len(starts), bool)
    places, run, depth = order.copy(), groups, 0
    while len(places):
        pointers = order[places]
        left = lengths[pointers] - depth
        key = _eight(data, starts[pointers] + np.minimum(depth, lengths[pointers]), left)
        by = np.lexsort((key, run))
        order[places], run, key, left = pointers[by], run[by], key[by], left[by]
        begins = np.concatenate(
            ([True], (run[1:] != run[:-1]) | (key[1:] != key[:-1])))
        first[places[begins]] = True
        heads = np.flatnonzero(begins)
        sizes = np.diff(np.append(heads, len(places)))
        open_ = (np.maximum.reduceat(left, heads) > 8) & (sizes > 1)
        chosen = np.repeat(open_, sizes)
        run = np.repeat(np.arange(len(heads)), sizes)[chosen]
        places, depth = places[chosen], depth + 8
    return order, first


def _utf8(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The words pointed to, as Arrow strings."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    index = np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
    offsets = np.concatenate(([0], ends)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets), pa.py_buffer(data[index].tobytes())).cast(pa.string())


def _runs(batch: pa.RecordBatch, slice_bytes: int) -> Iterator[pa.RecordBatch]:
    texts = batch.column(0).cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:][:len(texts) + 1]
    buffer = texts.buffers()[2]
    whole = np.frombuffer(buffer, np.uint8) if buffer else np.zeros(0, np.uint8)
    langs, sources = (batch.column(i).dictionary_encode() for i in (1, 2))
    group = (langs.indices.to_numpy().astype(np.int64) * max(len(sources.dictionary), 1)
             + sources.indices.to_numpy())
    row = 0
    while row < len(texts):
        last = int(np.searchsorted(offsets, offsets[row] + slice_bytes, side="right")) - 1
        last = min(max(last, row + 1), len(texts))
        data = LOWER[whole[offsets[row]:offsets[last]]]
        starts, lengths, doc = word_pointers(data, offsets[row + 1:last + 1] - offsets[row])
        if len(starts):
            order, first = multikey_sort(data, starts, lengths, group[row:last][doc])
            heads, owner = np.flatnonzero(first), doc[order]
            new_doc = first | np.concatenate(([True], owner[1:] != owner[:-1]))
            shown = order[heads]
            code = group[row:last][doc[shown]]
            n_sources = len(sources.dictionary)
            yield pa.RecordBatch.from_pydict({
                "lang": langs.dictionary.take(pa.array(code // n_sources)),
                "source": sources.dictionary.take(pa.array(code % n_sources)),
                "term": _utf8(data, starts[shown], lengths[shown]),
                "n": np.diff(np.append(heads, len(order))),
                "docs": np.add.reduceat(new_doc.astype(np.int64), heads)})
        row = last


def _named(column: str) -> Column:
    return F.coalesce(F.col("`" + column.replace("`", "``") + "`").cast("string"), F.lit(""))


def term_counts(docs: DataFrame, *, text: str = "text", lang: str = "lang",
                source: str = "source", min_docs: int = MIN_DOCS,
                slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(lang, term, n, cells): words found in ``min_docs`` rows of a language or more,
    their occurrences, and those of every source as an array of (source, n).

    Every slice sends a word once per language and source, so a frequent word is no
    larger than any other. The exchange by language and word serves both
    aggregations; an array is as long as a language has sources."""
    ship_package()

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _runs(batch, slice_bytes)

    counted = docs.select(_named(text), _named(lang), _named(source)).mapInArrow(
        runs, "lang string, source string, term string, n long, docs long")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_source = (counted.repartition(parts, "lang", "term").groupBy("lang", "term", "source")
                 .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    return (by_source.groupBy("lang", "term")
            .agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"),
                 F.collect_list(F.struct("source", "n")).alias("cells"))
            .where(F.col("docs") >= min_docs).drop("docs"))


def _share(n: Column, total: Column, size: Column, scale: int) -> Column:
    """1 + floor(scale * (n + 1) / (total + size)), in whole numbers of 38 digits."""
    def wide(c: Column) -> Column:
        return c.cast("decimal(19,0)")
    return F.lit(1) + F.call_function(
        "div", F.lit(scale).cast("decimal(19,0)") * wide(n + 1),
        wide(F.greatest(total + size, F.lit(1))))


def _gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)"""
    return F.call_function("div", (p - q) * (p - q), q)


def _common_pairs(lists: DataFrame) -> DataFrame:
    """(a, b, rest): for every ordered pair of groups the sum, over the words both
    have, of what their words differ by beyond the sums over the words of each.

    ``lists`` has one row per word, ``cells`` an array of (gid, p, p0). Pairs are
    laid out in numpy, ``PAIRS_AT_ONCE`` at a time, and combined before they leave."""
    def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) * (p - q) // q

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(0)
            flat = cells.flatten()
            if not len(flat):
                continue
            gid, p, p0 = (flat.field(i).to_numpy() for i in range(3))
            groups, at = np.unique(gid, return_inverse=True)
            sizes = np.asarray(cells.value_lengths())
            begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
            ends = np.cumsum(np.repeat(sizes, sizes))
            codes, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for low in range(0, int(ends[-1]), PAIRS_AT_ONCE):
                k = np.arange(low, min(low + PAIRS_AT_ONCE, int(ends[-1])))
                i = np.searchsorted(ends, k, side="right")
                j = begin[i] + k - np.concatenate(([0], ends))[i]
                i, j = i[i != j], j[i != j]
                rest = gap(p[i], p[j]) - gap(p[i], p0[j]) - gap(p0[i], p[j]) + gap(p0[i], p0[j])
                codes, place = np.unique(
                    np.concatenate((codes, at[i] * len(groups) + at[j])), return_inverse=True)
                added = np.zeros(len(codes), np.int64)
                np.add.at(added, place, np.concatenate((sums, rest)))
                sums = added
            yield pa.RecordBatch.from_pydict({
                "a": groups[codes // len(groups)], "b": groups[codes % len(groups)], "rest": sums})

    return (lists.mapInArrow(pairs, "a long, b long, rest long")
            .groupBy("a", "b").agg(F.sum("rest").alias("rest")))


def source_divergence(docs: DataFrame, *, text: str = "text", lang: str = "lang",
                      source: str = "source", min_docs: int = MIN_DOCS, scale: int = SCALE,
                      top_terms: int = TOP_TERMS,
                      slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """How far the words of every source stand from the other sources of its language
    (part ``pair``), and the words it has most of against its language (``term``).

    Columns lang, source, part, item, value, rank. A word's share in a group is
    1 + floor(scale * (n + 1) / (all words + different words)); the value of a word
    is floor((p - q)^2 / q). All of it is arithmetic in whole numbers.

    NULL texts, languages and sources are empty strings; every row is a document,
    repeated rows too; a group whose texts are all empty has its pairs and no terms;
    an empty table gives no rows; ties are ordered by the item's bytes. Other columns
    of the input, whatever their names, are not read.

    Pairs of sources are the result, so they are as many as a language has; what they
    cost is bounded by the words that both have: words that only one or none has are
    summed from a table of the different shares of each source.
    """
    terms = stored(term_counts(docs, text=text, lang=lang, source=source, min_docs=min_docs,
                               slice_bytes=slice_bytes)
                   .withColumn("tid", F.monotonically_increasing_id()), "divergence-terms")
    single = terms.select("lang", "term", "tid", F.col("n").alias("n_lang"), F.inline("cells"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("size"), F.sum("n").alias("total_lang"))
    totals = single.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count("*").alias("present"))
    occurring = docs.select(_named(lang).alias("lang"), _named(source).alias("source")).distinct()
    none = {c: F.coalesce(F.col(c), F.lit(0).cast("long"))
            for c in ("size", "total_lang", "total", "present")}
    groups = (occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .withColumns(none))
    groups = stored(groups.select(
        "*", F.monotonically_increasing_id().alias("gid"),
        _share(F.lit(0).cast("long"), F.col("total"), F.col("size"), scale).alias("p0")),
        "divergence-groups")
    cells = stored(single.join(groups, ["lang", "source"]).select(
        "gid", "tid", "lang", "source", "term", "p0",
        _share(F.col("n"), F.col("total"), F.col("size"), scale).alias("p"),
        _share(F.col("n_lang"), F.col("total_lang"), F.col("size"), scale).alias("q")),
        "divergence-cells")
    return _terms(cells, top_terms).unionByName(_pairs(groups, cells))


def _ranked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")))


def _terms(cells: DataFrame, top: int) -> DataFrame:
    more = cells.where(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        _gap(F.col("p"), F.col("q")).alias("value"))
    return _ranked(more).where(F.col("rank") <= top)


def _pairs(groups: DataFrame, cells: DataFrame) -> DataFrame:
    shares = (cells.groupBy("gid", "p").agg(F.count("*").alias("k")).groupBy("gid")
              .agg(F.collect_list(F.struct("p", "k")).alias("shares")))
    sides = groups.join(shares, "gid", "left").select(
        "lang", "source", "gid", "p0", "present", "size", "shares")
    common = _common_pairs(cells.groupBy("tid").agg(
        F.collect_list(F.struct("gid", "p", "p0")).alias("cells")).select("cells"))

    def side(letter: str) -> DataFrame:
        return sides.select("lang", *[F.col(c).alias(f"{c}_{letter}")
                                      for c in sides.columns if c != "lang"])

    def over(shares: Column, gap) -> Column:
        return F.coalesce(F.aggregate(shares, F.lit(0).cast("long"), lambda total, s:
                                      total + s["k"] * gap(s["p"])), F.lit(0).cast("long"))

    p0_a, p0_b = F.col("p0_a"), F.col("p0_b")
    value = (over(F.col("shares_a"), lambda p: _gap(p, p0_b))
             + over(F.col("shares_b"), lambda p: _gap(p0_a, p))
             + (F.col("size_a") - F.col("present_a") - F.col("present_b")) * _gap(p0_a, p0_b)
             + F.coalesce(F.col("rest"), F.lit(0).cast("long")))
    both = (side("a").join(side("b"), "lang").where("gid_a <> gid_b")
            .join(common, (F.col("gid_a") == F.col("a")) & (F.col("gid_b") == F.col("b")), "left"))
    return _ranked(both.select("lang", F.col("source_a").alias("source"),
                               F.lit("pair").alias("part"), F.col("source_b").alias("item"),
                               value.alias("value")))
