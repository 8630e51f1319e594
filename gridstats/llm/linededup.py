"""Lines that many documents share: two Bloom filters, then exact confirmation.

Every task adds the hashes of its documents' lines to two Bloom filters, one of
hashes seen once and one of hashes seen again. Filters of several tasks are merged
bit by bit: a hash that two tasks saw once has all its bits set in both, so the
bits common to both belong to the filter of hashes seen again. Only lines which
that filter suspects are counted exactly, by 128-bit digests that every task has
combined before they are shuffled; texts and other lines never move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.llm.shared import ship_package, stored, text_of

BLANKS = b" \t\n\v\f\r"
BITS_PER_LINE = 16
HASHES = 3
# A filter holds at most so many bits (64 MB). A corpus of more than about 10^8
# different lines fills it, and more digests are then counted than lines repeat.
MAX_BITS = 1 << 29
MIN_BITS = 1 << 19
PIECE = 1 << 16               # bytes of a filter that are merged as one row
COUNTED_AT_ONCE = 300_000     # digests that a task combines before it passes them on
BROADCAST_KEYS = 300_000      # digests broadcast at most: about 30 MB as a set


def line_keys(text: bytes | None) -> list[bytes]:
    """The keys of a text's lines: without blanks at both ends, A-Z lower-cased."""
    return [line.strip(BLANKS) for line in (text or b"").lower().split(b"\n")]


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars)


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


class SeenTwice:
    """Hashes seen once and hashes seen again, as two Bloom filters."""

    def __init__(self, bits: int):
        self.mask = np.uint64(bits - 1)
        self.once = np.zeros(bits // 8, np.uint8)
        self.again = np.zeros(bits // 8, np.uint8)

    def _places(self, hashes: np.ndarray) -> list[np.ndarray]:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        return [((hashes + np.uint64(i) * step) & self.mask).astype(np.int64)
                for i in range(HASHES)]

    @staticmethod
    def _set(filter_: np.ndarray, places: list[np.ndarray]) -> None:
        for p in places:
            np.bitwise_or.at(filter_, p >> 3, np.left_shift(1, p & 7).astype(np.uint8))

    @staticmethod
    def _has(filter_: np.ndarray, places: list[np.ndarray]) -> np.ndarray:
        found = np.ones(len(places[0]), bool)
        for p in places:
            found &= (filter_[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)
        return found

    def add(self, hashes: np.ndarray) -> None:
        different, counts = np.unique(hashes, return_counts=True)
        places = self._places(different)
        again = self._has(self.once, places) | (counts > 1)
        self._set(self.again, [p[again] for p in places])
        self._set(self.once, places)

    def suspected(self, hashes: np.ndarray) -> np.ndarray:
        return self._has(self.again, self._places(hashes))


def merge(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]):
    """(once, again) of what two tasks saw."""
    return left[0] | right[0], left[1] | right[1] | (left[0] & right[0])


def _lines(batch: pa.RecordBatch, min_chars: int) -> Iterator[tuple[int, list[bytes]]]:
    for row, text in enumerate(batch.column(0).to_pylist()):
        yield row, [k for k in dict.fromkeys(line_keys(text)) if _long_enough(k, min_chars)]


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64, len(keys))


def filter_bits(docs: DataFrame, text: str = "text") -> int:
    """A power of two that gives every line its bits, between the two bounds."""
    value = text_of(text)
    lines = docs.agg(F.sum(F.length(value) - F.length(F.replace(value, F.lit("\n"), F.lit("")))
                           + 1)).first()[0] or 0
    return int(min(MAX_BITS, max(MIN_BITS, 1 << (lines * BITS_PER_LINE).bit_length())))


def seen_again(docs: DataFrame, *, text: str = "text", min_chars: int = 1,
               bits: int | None = None) -> np.ndarray:
    """The filter of line hashes that two documents or more may share.

    It comes to the driver, in pieces of ``PIECE`` bytes and ``MAX_BITS`` at most."""
    bits = bits or filter_bits(docs, text)
    schema = "piece int, once binary, again binary"

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = SeenTwice(bits)
        for batch in batches:
            seen.add(_hashes([k for _, keys in _lines(batch, min_chars) for k in keys]))
        pack = zstandard.ZstdCompressor(level=1).compress
        once, again = (f.reshape(-1, PIECE) for f in (seen.once, seen.again))
        for piece in np.flatnonzero(once.any(axis=1)).tolist():
            yield pa.RecordBatch.from_pydict({
                "piece": pa.array([piece], pa.int32()),
                "once": [pack(once[piece].tobytes())], "again": [pack(again[piece].tobytes())]})

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        pieces: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                new = tuple(np.frombuffer(unpack(row[c]), np.uint8) for c in ("once", "again"))
                old = pieces.get(row["piece"])
                pieces[row["piece"]] = merge(old, new) if old else new
        pack = zstandard.ZstdCompressor(level=1).compress
        for piece, (_, again) in pieces.items():
            yield pa.RecordBatch.from_pydict({
                "piece": pa.array([piece], pa.int32()), "again": [pack(again.tobytes())]})

    ship_package()
    parts = (docs.select(text_of(text).cast("binary")).mapInArrow(collect, schema)
             .repartition("piece").mapInArrow(merged, "piece int, again binary"))
    again = np.zeros(bits // 8, np.uint8)
    unpack = zstandard.ZstdDecompressor().decompress
    for row in parts.toLocalIterator():
        again[row["piece"] * PIECE:][:PIECE] = np.frombuffer(unpack(row["again"]), np.uint8)
    return again


def _suspect(again: np.ndarray) -> SeenTwice:
    """The filter of a task, over the bytes that were broadcast."""
    seen = SeenTwice(8)
    seen.again, seen.mask = again, np.uint64(8 * len(again) - 1)
    return seen


def _suspected(batch: pa.RecordBatch, seen: SeenTwice, min_chars: int):
    """(row, key) of the lines under suspicion, every key once a row."""
    found = [(row, k) for row, keys in _lines(batch, min_chars) for k in keys]
    hit = seen.suspected(_hashes([k for _, k in found])) if found else ()
    return [f for f, h in zip(found, hit) if h]


def shared_lines(docs: DataFrame, filter_, *, text: str = "text", min_docs: int = 10,
                 min_chars: int = 1, first_by: str | None = None) -> DataFrame:
    """(digest, first): keys that ``min_docs`` rows or more hold, counted exactly, and
    the least value of ``first_by`` among those rows, NULL last.

    ``filter_`` is the broadcast filter. A row counts once, however often it has
    the line."""
    order = _order(first_by)
    kind = docs.select(order.alias("first")).schema["first"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, counts, first, type_ = _suspect(filter_.value), {}, {}, None

        def passed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "digest": pa.array([_digest(k) for k in counts], pa.binary()),
                "n": pa.array(counts.values(), pa.int64()),
                "first": pa.array([first[k][1] for k in counts], type_)})

        for batch in batches:
            type_, places = batch.column(1).type, batch.column(1).to_pylist()
            for row, key in _suspected(batch, seen, min_chars):
                counts[key] = counts.get(key, 0) + 1
                place = (places[row] is None, places[row])
                if key not in first or place < first[key]:
                    first[key] = place
            if len(counts) >= COUNTED_AT_ONCE:
                yield passed_on()
                counts, first = {}, {}
        if counts:
            yield passed_on()

    counted = docs.select(text_of(text).cast("binary"), order.alias("first")).mapInArrow(
        count, f"digest binary, n long, first {kind}")
    return (counted.groupBy("digest").agg(
        F.sum("n").alias("n"),
        F.min(F.struct(F.col("first").isNull(), "first"))["first"].alias("first"))
        .where(F.col("n") >= min_docs).select("digest", "first"))


def _texts_with(docs: DataFrame, shared: DataFrame, filter_, text: str,
                min_chars: int) -> DataFrame:
    """(text_md5, shared): the shared lines of every different text that has any."""
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _suspect(filter_.value)
        for batch in batches:
            found = _suspected(batch, seen, min_chars)
            yield pa.RecordBatch.from_pydict({
                "text_md5": batch.column(1).take(pa.array([r for r, _ in found], pa.int64())),
                "digest": pa.array([_digest(k) for _, k in found], pa.binary())})

    value = text_of(text)
    lines = docs.select(value.cast("binary"), F.md5(value)).mapInArrow(
        listed, "text_md5 string, digest binary")
    return (lines.distinct().join(shared, "digest").groupBy("text_md5")
            .agg(F.collect_list(F.struct("digest", "first")).alias("shared")))


def _kept(text: bytes, mine, shared: dict, seen: SeenTwice | None, min_chars: int,
          keep_first: bool) -> tuple[int, int, bytes]:
    """Lines of a text, lines dropped, and the text without them."""
    lines, keys = text.split(b"\n"), line_keys(text)
    suspects = [i for i, k in enumerate(keys) if _long_enough(k, min_chars)] if shared else []
    if seen is not None and suspects:
        hit = seen.suspected(_hashes([keys[i] for i in suspects]))
        suspects = [i for i, h in zip(suspects, hit) if h]
    gone, stays = set(), set()
    for i in suspects:
        digest = _digest(keys[i])
        if digest in shared:
            if keep_first and digest not in stays and shared[digest] == mine:
                stays.add(digest)
            else:
                gone.add(i)
    kept = b"\n".join(line for i, line in enumerate(lines) if i not in gone) if gone else text
    return len(lines), len(gone), kept


RESULT = "struct<n_lines: bigint, n_dropped: bigint, text: string>"


def _result(rows: list[tuple[int, int, bytes]]) -> pa.Array:
    n, dropped, kept = zip(*rows) if rows else ((), (), ())
    return pa.StructArray.from_arrays(
        [pa.array(n, pa.int64()), pa.array(dropped, pa.int64()),
         pa.array(kept, pa.binary()).cast(pa.string())], ["n_lines", "n_dropped", "text"])


def _dropping(shared, filter_, min_chars: int, keep_first: bool):
    @F.arrow_udf(RESULT)
    def without(texts: pa.Array, order: pa.Array) -> pa.Array:
        gone, seen = shared.value, _suspect(filter_.value)
        return _result([_kept(t, mine, gone, seen, min_chars, keep_first)
                        for t, mine in zip(texts.to_pylist(), order.to_pylist())])
    return without


def _dropping_listed(min_chars: int, keep_first: bool):
    @F.arrow_udf(RESULT)
    def without(texts: pa.Array, order: pa.Array, listed: pa.Array) -> pa.Array:
        return _result([
            _kept(t, mine, {s["digest"]: s["first"] for s in shared or ()}, None, min_chars,
                  keep_first)
            for t, mine, shared in zip(texts.to_pylist(), order.to_pylist(), listed.to_pylist())])
    return without


def without_shared_lines(docs: DataFrame, *, text: str = "text", min_docs: int = 10,
                         min_chars: int = 1, first_by: str | None = None,
                         into: str = "lines", bits: int | None = None,
                         broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """All rows and columns, and a struct column ``into`` (replacing one of that
    name): lines before (``n_lines``), lines dropped, and the text without them.

    A line is dropped from every text if ``min_docs`` rows (2 or more) hold its key:
    the line without blanks at both ends, A-Z lower-cased, of ``min_chars`` code
    points or more. With ``first_by``, the first such line stays in the row that has
    the least value of that column, NULL last; rows that share this value keep one
    each. NULL and empty texts are one empty line. Rows count as documents whatever
    their keys are, so repeated rows count each. Long texts are read whole. Shared
    digests are broadcast if a count proves them few (``broadcast_keys``); otherwise
    they are joined to the texts that hold them.
    """
    if min_docs < 2:
        raise ValueError("a line of a single document is not shared: min_docs must be 2 or more")
    context, keep_first = docs.sparkSession.sparkContext, first_by is not None
    filter_ = context.broadcast(seen_again(docs, text=text, min_chars=min_chars, bits=bits))
    shared = stored(shared_lines(docs, filter_, text=text, min_docs=min_docs,
                                 min_chars=min_chars, first_by=first_by), "shared-lines")
    value, order = text_of(text), _order(first_by)
    few = shared.limit(broadcast_keys + 1).collect() if broadcast_keys else []
    if broadcast_keys and len(few) <= broadcast_keys:
        known = context.broadcast({bytes(r["digest"]): r["first"] for r in few})
        return docs.withColumn(
            into, _dropping(known, filter_, min_chars, keep_first)(value.cast("binary"), order))
    listed = stored(_texts_with(docs, shared, filter_, text, min_chars), "texts-sharing-lines")
    rows = docs.select(F.struct(*map(_quoted, docs.columns)).alias("row"), value.alias("text"),
                       order.alias("order"), F.md5(value).alias("text_md5"))
    joined = rows.join(listed, "text_md5", "left")
    kept = _dropping_listed(min_chars, keep_first)(
        F.col("text").cast("binary"), F.col("order"), F.col("shared"))
    return joined.select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c != into], kept.alias(into))


def _order(column: str | None) -> Column:
    return F.lit(None).cast("int") if column is None else _quoted(column)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
