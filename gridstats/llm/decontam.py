"""Benchmark passages in documents: CGK embedding, bit-sampling LSH, edit distance.

A CGK walk reads a sequence of words step by step, writes the word it stands on,
and moves on or stays by a random bit of step and word. Sequences within a small
edit distance give outputs within a small Hamming distance. Output positions are
sampled, and equal samples (of one of several tables and walks) make a candidate;
candidates are verified by the exact edit distance of the whole item.

Windows start at anchors, words whose hash is least among their neighbours, which
a document and an item choose alike. The window at an item's anchor is the longest
of a few sizes that fits into the item; a document is embedded at all sizes from
every one of its anchors.

Walks from anchors miss some pairs, those of short items above all. Pieces of words
find them: an item within e edits, cut into e + 1 pieces, has a piece that no edit
touches. Every piece is looked for at every word of a document, so no pair within
the distance is lost.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstats.llm.shared import ship_package, text_of

MAX_EDIT_SHARE = 0.2       # of an item's words that may differ
SIZES = (2, 4, 8, 16, 32)  # words of a window
LEAST_SIZE = 8             # of windows of items with LONG_ITEM words or more
LONG_ITEM = 12
RADIUS = 2                 # neighbours on either side that an anchor beats
WALKS = 2
TABLES = 10                # per walk and size
SAMPLES = 6                # output positions per table
STEPS_PER_WORD = 1.6       # a walk reads half a word per step
LONG_SEARCH = 512          # starts of longer items are tried in steps, regions wider by one
BLOCK_ITEMS = 20_000       # items searched for in one pass over the documents
WORDS_AT_ONCE = 1 << 18
ANCHORS_AT_ONCE = 1 << 15
CACHED_WORDS = 500_000

MATCH_SCHEMA = ("array<struct<item_id: long, start_word: int, end_word: int, start: int,"
                " end: int, distance: int, item_words: int>>")

_EDGES = re.compile(r"^\W+|\W+$")
_COMMON_ENDS = ".,;:!?"     # the rest is looked for by the pattern
_MIX = 0x9E3779B97F4A7C15   # an odd number; another multiple per walk


class Words:
    """64-bit hashes of words, case and punctuation at the ends left out."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, words: list[str]) -> np.ndarray:
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(known) > CACHED_WORDS:
                known.clear()
            fresh = set(words).difference(known)
            known.update(zip(fresh, map(_word_hash, fresh)))
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _word_hash(word: str) -> int:
    """Of the folded word without what stands at its ends and is neither letter, digit
    nor underscore, or of the whole word where nothing would remain."""
    folded = word.casefold()
    plain = folded.rstrip(_COMMON_ENDS)
    if not plain.isalnum():
        plain = _EDGES.sub("", folded) or folded
    return xxhash.xxh64_intdigest(plain)


def anchors(hashes: np.ndarray) -> np.ndarray:
    """Positions whose hash none of the neighbours undercuts."""
    padded = np.r_[np.full(RADIUS, np.iinfo(np.uint64).max, np.uint64), hashes,
                   np.full(RADIUS, np.iinfo(np.uint64).max, np.uint64)]
    keep = np.ones(len(hashes), bool)
    for d in range(1, RADIUS + 1):
        keep &= hashes <= padded[RADIUS - d:len(padded) - RADIUS - d]
        keep &= hashes <= padded[RADIUS + d:len(padded) - RADIUS + d or None]
    return np.flatnonzero(keep)


def _samples() -> dict[int, list[np.ndarray]]:
    """Sampled steps per size, one row per table, for every walk."""
    random = np.random.default_rng(8)
    chosen = {}
    for size in SIZES:
        steps = max(2, int(size * STEPS_PER_WORD))
        k = min(SAMPLES, steps)
        chosen[size] = [np.array([np.sort(random.choice(steps, k, replace=False))
                                  for _ in range(TABLES)]) for _ in range(WALKS)]
    return chosen


SAMPLED = _samples()
FACTORS = np.random.default_rng(9).integers(1, 1 << 63, SAMPLES, np.uint64) * 2 + 1


def window_keys(hashes: np.ndarray, starts: np.ndarray, sizes) -> Iterator[tuple[int, np.ndarray]]:
    """(size, keys) of the windows at the starts, a row of keys per table.

    ``hashes`` must be followed by enough padding for the walk.
    """
    steps = max(2, int(max(sizes) * STEPS_PER_WORD))
    for walk in range(WALKS):
        at, written = starts.copy(), np.empty((steps, len(starts)), np.uint64)
        factor = np.uint64((2 * walk + 1) * _MIX % (1 << 64))
        for step in range(steps):
            word = hashes[at]
            written[step] = word
            at += ((word * factor) >> np.uint64(63 - step % 64)).astype(np.int64) & 1
        for size in sizes:
            keys = np.empty((TABLES, len(starts)), np.uint64)
            for table, chosen in enumerate(SAMPLED[size][walk]):
                key = np.full(len(starts), (size * WALKS + walk) * TABLES + table, np.uint64)
                for step, by in zip(chosen, FACTORS):
                    key = (key + written[step]) * by
                keys[table] = key ^ (key >> np.uint64(29))
            yield size, keys


def _pad() -> np.ndarray:
    return np.zeros(int(max(SIZES) * STEPS_PER_WORD) + RADIUS + 1, np.uint64)


def piece_keys(hashes: np.ndarray, sizes) -> Iterator[tuple[int, np.ndarray]]:
    """(size, keys) of as many words from every start on; the last starts, which
    have no word of ``max(sizes)`` after them, are left out."""
    count = max(0, len(hashes) - max(sizes, default=1) + 1)
    key = np.zeros(count, np.uint64)
    for size in range(1, max(sizes, default=0) + 1):
        key = (key + hashes[size - 1:size - 1 + count]) * np.uint64(_MIX)
        key ^= key >> np.uint64(29)
        if size in sizes:
            yield size, key + np.uint64(size)


class ItemIndex:
    """LSH tables over the windows of benchmark items, and their pieces."""

    def __init__(self, items: list[tuple[int, str | None]]):
        words = Words()
        self.items: list[tuple[int, np.ndarray]] = []
        for item_id, text in items:
            hashes = words((text or "").split())
            if len(hashes):
                self.items.append((item_id, hashes))
        keys, owners, offsets, seeds, used, pieces = [], [], [], set(), set(), set()
        for number, (_, hashes) in enumerate(self.items):
            n = len(hashes)
            inner = anchors(hashes)
            inner = inner[(inner >= RADIUS) & (inner < n - RADIUS)]
            least = min(LEAST_SIZE if n >= LONG_ITEM else 1, n)
            inner = inner[n - inner >= least]
            if not len(inner):
                # No anchor that a document surely shares: its first word becomes one.
                inner = np.zeros(1, np.int64)
                seeds.add(int(hashes[0]))
            padded = np.r_[hashes, _pad()]
            fit = np.array([max([s for s in SIZES if s <= n - o], default=min(SIZES))
                            for o in inner])
            for size in np.unique(fit).tolist():
                used.add(size)
                at = inner[fit == size]
                for _, found in window_keys(padded, at, (size,)):
                    keys.append(found.ravel())
                    owners.append(np.full(found.size, number))
                    offsets.append(np.tile(at, TABLES))
            cuts = np.arange(int(MAX_EDIT_SHARE * n) + 2) * n // (int(MAX_EDIT_SHARE * n) + 1)
            lengths = np.diff(cuts)
            for size, found in piece_keys(padded, np.unique(lengths).tolist()):
                pieces.add(size)
                at = cuts[:-1][lengths == size]
                keys.append(found[at])
                owners.append(np.full(len(at), number))
                offsets.append(at)
        none = np.zeros(0, np.int64)
        keys = np.concatenate(keys) if keys else none.astype(np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.owners = (np.concatenate(owners) if owners else none)[order]
        self.offsets = (np.concatenate(offsets) if offsets else none)[order]
        self.seeds = np.array(sorted(seeds), np.uint64)
        self.sizes = tuple(sorted(used)) or SIZES[:1]
        self.pieces = tuple(sorted(pieces))
        lengths = np.array([len(h) for _, h in self.items], np.int64)
        # Half the edits allowed: no region then holds two matches side by side.
        self.steps = np.where(lengths > LONG_SEARCH, (MAX_EDIT_SHARE * lengths // 2).astype(
            np.int64), 1)
        self.filter = None

    def lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(column of the key, entry) for every entry that equals a key."""
        if self.filter is None:
            # Some 30 places a key, so that few are asked for in vain, within the cache.
            bits = min(max((32 * len(self.keys)).bit_length(), 16), 24)
            self.filter, self.shift = np.zeros(1 << bits, bool), np.uint64(64 - bits)
            self.filter[self.keys >> self.shift] = True
        maybe = np.flatnonzero(self.filter[keys.ravel() >> self.shift])
        wanted = keys.ravel()[maybe]
        low = np.searchsorted(self.keys, wanted, "left")
        n = np.searchsorted(self.keys, wanted, "right") - low
        entry = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(maybe % keys.shape[1], n), entry


def best_match(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """(distance, end) of the part of the region nearest to the item by edit
    distance, the first of equals: bit-parallel, a bit per word of the item."""
    n = len(item)
    where: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        where[w] = where.get(w, 0) | 1 << i
    every, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score, best = every, 0, n, (n, 0)
    for at, w in enumerate(region.tolist(), 1):
        equal = where.get(w, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (every & ~(horizontal | plus))
        down = plus & horizontal
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1) & every, (down << 1) & every
        plus = down | (every & ~(vertical | up))
        minus = up & vertical
        if score < best[0]:
            best = (score, at)
    return best


def find(texts: list[str | None], index: ItemIndex, words: Words,
         max_edit_share: float = MAX_EDIT_SHARE) -> list[list[dict]]:
    """Matches in every text, in order of place."""
    found: list[list[dict]] = [[] for _ in texts]
    at = 0
    while at < len(texts):
        hashes, starts, first, total = [], [], at, 0
        while at < len(texts) and (at == first or total < WORDS_AT_ONCE):
            h = words((texts[at] or "").split())
            starts.append(total)
            hashes += [h, _pad()]
            total += len(h) + len(hashes[1])
            at += 1
        joined = np.concatenate(hashes)
        lengths = [len(h) for h in hashes[::2]]
        _search(texts, first, joined, np.array(starts), lengths, index, max_edit_share, found)
    return found


def _candidates(anchor: np.ndarray, entry: np.ndarray, index, starts: np.ndarray) -> np.ndarray:
    """Rows of (item, estimated start, document). The document is that of the anchor;
    the start may lie before it, where the text lacks words of the item, and is clipped.
    Starts of long items are rounded down to whole steps."""
    doc = np.searchsorted(starts, anchor, "right") - 1
    owner = index.owners[entry]
    place = np.maximum(anchor - index.offsets[entry] - starts[doc], 0)
    return np.stack([owner, starts[doc] + place - place % index.steps[owner], doc])


def _search(texts, first, joined, starts, lengths, index, max_edit_share, found) -> None:
    places = [anchors(joined[s:s + n]) + s for s, n in zip(starts, lengths)]
    if len(index.seeds):
        places += [np.flatnonzero(np.isin(joined, index.seeds))]
    places = np.unique(np.concatenate(places)) if places else np.zeros(0, np.int64)
    candidates = []
    for at in range(0, len(places), ANCHORS_AT_ONCE):
        part = places[at:at + ANCHORS_AT_ONCE]
        for _, keys in window_keys(joined, part, index.sizes):
            column, entry = index.lookup(keys)
            if len(column):
                candidates.append(_candidates(part[column], entry, index, starts))
    for at in range(0, len(joined), WORDS_AT_ONCE):
        part = joined[at:at + WORDS_AT_ONCE + max(index.pieces, default=1) - 1]
        for _, keys in piece_keys(part, index.pieces):
            column, entry = index.lookup(keys[None, :])
            if len(column):
                candidates.append(_candidates(at + column, entry, index, starts))
    if not candidates:
        return
    seen: set[tuple[int, int, int]] = set()
    spans_of: dict[int, list[tuple[int, int]]] = {}     # of the document at hand
    by_place = np.unique(np.concatenate(candidates, axis=1)[::-1], axis=1)
    for doc, place, owner in by_place.T.tolist():
        item_id, item = index.items[owner]
        allowed = int(max_edit_share * len(item))
        low = max(starts[doc], place - allowed)
        high = min(starts[doc] + lengths[doc], place + len(item) + allowed
                   + int(index.steps[owner]) - 1)
        # Every word of the item that the region lacks is an edit.
        present = set(joined[low:high].tolist())
        if sum(w in present for w in item.tolist()) < len(item) - allowed:
            continue
        distance, end = best_match(item, joined[low:high])
        if distance > allowed:
            continue
        region = joined[low:low + end]
        back, length = best_match(item[::-1], region[::-1])
        start = low + end - length - starts[doc]
        hit = (doc, owner, int(low + end - starts[doc]))
        if hit in seen:
            continue
        seen.add(hit)
        if doc not in spans_of:
            spans_of = {doc: [m.span() for m in re.finditer(r"\S+", texts[first + doc])]}
        spans = spans_of[doc]
        found[first + doc].append({
            "item_id": item_id, "start_word": int(start), "end_word": hit[2],
            "start": spans[start][0], "end": spans[hit[2] - 1][1],
            "distance": distance, "item_words": len(item)})
    for rows in found[first:first + len(starts)]:
        rows.sort(key=lambda r: (r["start_word"], r["item_id"], r["end_word"]))


_WORDS = Words()


def _matches(text: Column, index) -> Column:
    ship_package()

    @F.pandas_udf(MATCH_SCHEMA)
    def search(texts: pd.Series) -> pd.Series:
        return pd.Series(find(list(texts), index.value, _WORDS))
    return search(text)


def item_blocks(benchmark: DataFrame, *, key: str = "item_id", text: str = "text",
                block: int = BLOCK_ITEMS) -> Iterator[list[tuple]]:
    """The items, a bounded block at a time; items without words are no queries."""
    items = benchmark.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).where(
        F.col("t").rlike("\\S"))
    blocks = -(-items.count() // block)
    for b in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("k", "t"), F.lit(blocks)) == b)
        yield sorted(((r["k"], r["t"]) for r in mine.collect()),
                     key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def with_leaks(docs: DataFrame, benchmark: DataFrame, *, text: str = "text",
               into: str = "leaks") -> DataFrame:
    """All rows and columns, and ``into`` (replacing a column of that name): an array
    of the benchmark passages in the text, with the item, the words and characters
    it spans, and its edit distance in words.

    NULL and empty texts hold none; a NULL item id is reported as NULL; equal items
    are each reported. Without items nothing is found. Texts are searched whole.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if c != into]
    out = docs.drop(into).withColumn(into, F.array().cast(MATCH_SCHEMA))
    for items in item_blocks(benchmark):
        index = spark.sparkContext.broadcast(ItemIndex(items))
        out = out.withColumn("_more", _matches(text_of(text), index)).select(
            *names, F.concat(into, "_more").alias(into))
    return out


def benchmark_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")
