"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints within a few bits of each other are searched for in an index over
fingerprints sorted by Gray rank, where neighbours share most bits. A node keeps
the bits all its members share, as a mask and a pattern, without those that its
parent has; the differences of a query from the nodes on a path add up, and a
group is left out as soon as they exceed the allowed distance.

The top level of the hierarchy is what Spark distributes: the 64 bits form
``distance + 2`` blocks, of which a pair within the distance shares at least two.
For every two blocks there is a table, keyed by their bits; a pair meets in at
least one table, and no task needs fingerprints of another key. Keys with very
many fingerprints get further levels by the same rule before any task sees them.
Only distinct fingerprints are searched, and a group of n linked ones gives n - 1
links, so copies and near copies never multiply.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from gridstats.llm.shared import (
    apart, as_one, broadcast_if_small, quoted, ship_package, stored, text_of)

SHINGLE = 3
DISTANCE = 3
SEED = 42
FANOUT = 16                # members of a node
SEARCH_PAIRS = 1 << 17     # query-node pairs looked at together
HOT_GROUP = 20_000         # fingerprints under a key from which it gets more levels

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_BLANKS = {c: " " for c in range(9, 14)}
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of one text, whole; 0 for texts without words and for NULL."""
    import xxhash

    words = [w for w in (text or "").translate(_LOWER).translate(_BLANKS).split(" ") if w]
    if not words:
        return 0
    parts = [words[i:len(words) - shingle + 1 + i] for i in range(shingle)]
    shingles = map(" ".join, zip(*parts)) if len(words) >= shingle else [" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at:at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """The SimHash of every text as a (signed) long."""
    ship_package()

    @F.pandas_udf(LongType())
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts],
                                  np.uint64).view(np.int64))
    return simhash(text)


# --- the index -----------------------------------------------------------------

def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of a code in Gray order: the prefix XOR of its bits."""
    rank = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _shared_bits(ones: np.ndarray, zeros: np.ndarray, starts: np.ndarray):
    return np.bitwise_and.reduceat(ones, starts), np.bitwise_and.reduceat(zeros, starts)


def build_index(codes: np.ndarray, groups: np.ndarray) -> list[tuple]:
    """Levels of (first child, children, mask, pattern), the lowest first.

    ``codes`` are sorted by group and Gray rank. No node spans two groups; the
    highest level has one node per group, in the order of the groups.
    """
    ones, zeros, owner = codes, ~codes, groups
    levels = []
    while True:
        new_group = np.r_[True, owner[1:] != owner[:-1]]
        first = np.flatnonzero(new_group)
        place = np.arange(len(owner)) - np.repeat(first, np.diff(np.r_[first, len(owner)]))
        starts = np.flatnonzero(new_group | (place % FANOUT == 0))
        ones, zeros = _shared_bits(ones, zeros, starts)
        levels.append([starts, np.diff(np.r_[starts, len(owner)]), ones | zeros, ones])
        owner = owner[starts]
        if len(np.unique(owner)) == len(owner):
            break
    for below, above in zip(levels, levels[1:]):
        # What the parent has factored out need not be compared again.
        below[2] = below[2] & ~np.repeat(above[2], above[1])
    return [tuple(level) for level in levels]


def search(codes: np.ndarray, groups: np.ndarray, distance: int) -> Iterator[np.ndarray]:
    """Pairs (i, j), i < j, of one group within the distance, as arrays of two rows."""
    levels = build_index(codes, groups)
    roots = np.unique(groups, return_inverse=True)[1]
    size = np.bincount(roots)[roots]
    queries = np.flatnonzero(size > 1)
    at = 0
    while at < len(queries):
        cost = np.cumsum(size[queries[at:at + SEARCH_PAIRS // 2]])
        step = max(1, int(np.searchsorted(cost, SEARCH_PAIRS, "right")))
        query = queries[at:at + step]
        at += step
        node, found = roots[query], np.zeros(len(query), np.int64)
        for first, count, mask, pattern in reversed(levels):
            found = found + np.bitwise_count((codes[query] ^ pattern[node]) & mask[node])
            near = found <= distance
            query, node, found = query[near], node[near], found[near]
            n = count[node]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            query, found = np.repeat(query, n), np.repeat(found, n)
            node = np.repeat(first[node], n) + inside
        close = (query < node)
        query, node = query[close], node[close]
        close = np.bitwise_count(codes[query] ^ codes[node]) <= distance
        yield np.stack([query[close], node[close]])


def _forest(pairs: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Labels after joining the pairs: every label is the least of its tree."""
    while True:
        a, b = label[pairs[0]], label[pairs[1]]
        apart = a != b
        if not apart.any():
            return label
        low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
        np.minimum.at(label, high, low)
        while (label != label[label]).any():
            label = label[label]


def _links(codes: np.ndarray, groups: np.ndarray, distance: int) -> pd.DataFrame:
    label = np.arange(len(codes))
    for pairs in search(codes, groups, distance):
        label = _forest(pairs, label)
    linked = np.flatnonzero(label != np.arange(len(codes)))
    ends = np.stack([codes[linked], codes[label[linked]]]).view(np.int64)
    return pd.DataFrame({"a": ends[0], "b": ends[1]})


def _search_partition(distance: int):
    """Links in a partition sorted by table and key; holds whole keys at a time."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None

        def solve(pdf: pd.DataFrame) -> pd.DataFrame:
            codes = pdf["fp"].to_numpy().view(np.uint64)
            change = (pdf[["t", "k"]].diff().fillna(1) != 0).any(axis=1).to_numpy()
            groups = np.cumsum(change)
            order = np.lexsort((gray_rank(codes), groups))
            return _links(codes[order], groups[order], distance)

        for pdf in batches:
            if rest is not None:
                pdf = pd.concat([rest, pdf], ignore_index=True)
            last = ((pdf["t"] == pdf["t"].iloc[-1]) & (pdf["k"] == pdf["k"].iloc[-1])).to_numpy()
            cut = int(np.argmax(last))
            rest = pdf.iloc[cut:].reset_index(drop=True)
            if cut:
                yield solve(pdf.iloc[:cut].reset_index(drop=True))
        if rest is not None:
            yield solve(rest)
    return run


# --- tables, links, components ---------------------------------------------------

def _blocks(bits: list[int], parts: int) -> list[list[int]]:
    return [b.tolist() for b in np.array_split(np.array(bits), parts)]


def _masked(code: Column, bits: list[int]) -> Column:
    mask = sum(1 << b for b in bits)
    return code.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def _tables(code: Column, distance: int) -> tuple[Column, Column]:
    """Table numbers with keys, and per table the finer keys of a hot key."""
    tables, finer = [], []
    for t, (one, two) in enumerate(combinations(_blocks(list(range(64)), distance + 2), 2)):
        key = one + two
        rest = [b for b in range(64) if b not in key]
        tables.append(F.struct(F.lit(t).alias("t"), _masked(code, key).alias("k")))
        finer.append(F.array(*[
            F.struct(F.lit(1000 + t * 100 + i).alias("t"), _masked(code, key + sub).alias("k"))
            for i, sub in enumerate(_blocks(rest, distance + 1))]))
    return F.array(*tables), F.array(*finer)


def links(codes: DataFrame, distance: int = DISTANCE, hot_group: int = HOT_GROUP) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` within the distance:
    not all pairs, but enough to connect whatever is connected."""
    tables, finer = _tables(F.col("fp"), distance)
    keyed = codes.select("fp", F.explode(tables).alias("e")).select("fp", "e.t", "e.k")
    hot = (keyed.groupBy("t", "k").count().where(F.col("count") > hot_group)
           .select("t", "k", F.lit(True).alias("hot")))
    hot = stored(hot, "simhash-hot")
    if hot.isEmpty():
        spread = keyed
    else:
        entries = F.when(F.col("hot"), F.get(finer, F.col("t"))).otherwise(
            F.array(F.struct("t", "k")))
        spread = (keyed.join(hot, ["t", "k"], "left")
                  .select("fp", F.explode(entries).alias("e")).select("fp", "e.t", "e.k"))
    ship_package()
    n = max(1, int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = spread.repartition(n, "t", "k").sortWithinPartitions("t", "k")
    return placed.mapInPandas(_search_partition(distance), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges: root is the least node reachable.

    Alternating large-star and small-star steps; each replaces edges by edges to
    the least neighbour and keeps what is connected connected. Every round is
    written, so a lost executor costs one round.
    """
    def least(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))

    edges = stored(edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(least(both), "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        small = (large.join(least(large), "u")
                 .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        edges = stored(small, "links")
        # No sum of hashes may overflow: the upper halves are left out.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").bitwiseAND(0x7FFFFFFF))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def with_fingerprints(docs: DataFrame, *, text: str = "text", shingle: int = SHINGLE,
                      into: str = "fp") -> DataFrame:
    return docs.withColumn(into, fingerprints(text_of(text), shingle))


def near_duplicates(prints: DataFrame, *, key: str = "doc_id", distance: int = DISTANCE,
                    hot_group: int = HOT_GROUP) -> DataFrame:
    """(fp, component): for every fingerprint the least key of its component.

    ``prints`` has the columns ``key`` and ``fp`` and is read more than once:
    pass a stored table. Fingerprint 0 (texts without words, NULL texts) links
    like any other; NULL keys count only where a component has no other.
    """
    codes = stored(prints.groupBy("fp").agg(F.min(key).alias("least")), "fingerprints")
    linked = components(links(codes.select("fp"), distance, hot_group))
    member = codes.join(linked, codes["fp"] == linked["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    lowest = member.groupBy("root").agg(F.min("least").alias("component"))
    return member.join(lowest, "root").select("fp", "component")


def keep_one(docs: DataFrame, *, text: str = "text", key: str = "doc_id",
             shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of every component, columns as they came: the one with the
    least key (NULL last), among rows of that key the least text; of identical
    rows one stays. An empty table stays empty."""
    names = docs.columns
    row = F.struct(quoted(key).isNull().alias("n"), quoted(key).alias("k"), F.xxhash64(
        quoted(text), *[quoted(c) for c in names if c != text]).alias("h"))
    prints = stored(docs.select(row.alias("_row"), fingerprints(
        text_of(text), shingle).alias("fp")), "prints")
    codes = stored(prints.groupBy("fp").agg(F.min("_row").alias("least")), "fingerprints")
    linked = components(links(codes.select("fp"), distance))
    member = codes.join(linked, codes["fp"] == linked["node"], "left").select(
        F.coalesce("root", "fp").alias("root"), "least")
    winners = stored(member.groupBy("root").agg(F.min("least").alias("least"))
                     .select("least.*"), "kept")
    marked = docs.select(as_one(names), row.alias("_row"))
    winners = winners.select(F.col("n").alias("_n"), F.col("k").alias("_k"), F.col("h").alias("_h"))
    same = ((F.col("_row.n") == F.col("_n")) & F.col("_row.k").eqNullSafe(F.col("_k"))
            & (F.col("_row.h") == F.col("_h")))
    kept = marked.join(broadcast_if_small(winners), same, "left_semi")
    # Identical rows have the same key and hash; where there are any, one stays.
    if not prints.groupBy("_row").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["_row"])
    return kept.select(*apart(names))
