"""Token-id files of bit or byte planes, and the reader that restores them.

Ids are cut into chunks of a fixed number. A chunk is transposed: plane k holds
byte k (or bit k) of all its ids, and every plane is compressed by itself, so that
the high planes, nearly constant, cost next to nothing. A footer holds the chunk
index (offset and length of every plane) and the documents' lengths; any document
is read from the chunks that hold it.

    chunk planes ... | footer (zstandard, JSON) | footer length, 8 bytes | PLANES01
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridstats.llm.files import read_at, write_whole
from gridstats.llm.shared import new_path, ship_package, spread, stored, text_of

CHUNK_IDS = 1 << 16
LEVEL = 3
END = b"PLANES01"
CACHED_PIECES = 690_000  # different pieces that a worker keeps the ids of
NEW_PIECES = 10_000        # room left for the new ones among the pieces cut at a time
WORDS_AT_ONCE = 1000       # words that go through the library as one text
CHARS_AT_ONCE = 1 << 18    # text that is cut into pieces at a time
FILE_IDS = 64 << 20        # ids after which a task starts a new file

INDEX_SCHEMA = "path string, part int, file int, ids long"


# --- planes -------------------------------------------------------------------------

def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """Byte or bit planes of little-endian unsigned 32-bit ids; planes of zeros at
    the high end are left out."""
    rows = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if planes == "bits":
        bits = np.unpackbits(rows.reshape(4, -1, 1), axis=2, bitorder="little")
        rows = np.packbits(bits.transpose(0, 2, 1).reshape(32, -1), axis=1, bitorder="little")
    used = np.flatnonzero(rows.any(axis=1))
    return [row.tobytes() for row in rows[:used[-1] + 1 if len(used) else 0]]


def from_planes(parts: list[bytes], count: int, planes: str) -> np.ndarray:
    if planes == "bits":
        rows = np.zeros((32, (count + 7) // 8), np.uint8)
        for row, part in zip(rows, parts):
            row[:] = np.frombuffer(part, np.uint8)
        bits = np.unpackbits(rows, axis=1, count=count, bitorder="little")
        rows = np.packbits(bits.reshape(4, 8, count).transpose(0, 2, 1), axis=2,
                           bitorder="little")[:, :, 0]
    else:
        rows = np.zeros((4, count), np.uint8)
        for row, part in zip(rows, parts):
            row[:] = np.frombuffer(part, np.uint8)
    return np.ascontiguousarray(rows.T).view("<u4").reshape(-1)


class PlaneWriter:
    """Appends documents' ids to one file."""

    def __init__(self, stream, planes: str = "bytes", chunk_ids: int = CHUNK_IDS):
        import zstandard

        self.stream, self.planes, self.chunk_ids = stream, planes, chunk_ids
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.chunks, self.docs, self.at, self.total = [], [], 0, 0
        self.held, self.held_ids = [], 0

    def add(self, ids: np.ndarray, key: int | None) -> None:
        self.docs.append([key, len(ids)])
        self.total += len(ids)
        self.held.append(ids)
        self.held_ids += len(ids)
        if self.held_ids >= self.chunk_ids:
            ids = np.concatenate(self.held)
            whole = len(ids) - len(ids) % self.chunk_ids
            for start in range(0, whole, self.chunk_ids):
                self._chunk(ids[start:start + self.chunk_ids])
            self.held, self.held_ids = [ids[whole:]], len(ids) - whole

    def _chunk(self, ids: np.ndarray) -> None:
        sizes = []
        for plane in to_planes(ids, self.planes):
            packed = self.packer.compress(plane)
            self.stream.write(packed)
            sizes.append(len(packed))
        self.chunks.append([self.at, len(ids), sizes])
        self.at += sum(sizes)

    def close(self) -> None:
        if self.held_ids:
            self._chunk(np.concatenate(self.held))
        footer = self.packer.compress(json.dumps(
            {"planes": self.planes, "chunk_ids": self.chunk_ids, "chunks": self.chunks,
             "docs": self.docs}).encode())
        self.stream.write(footer + len(footer).to_bytes(8, "little") + END)


class PlaneReader:
    def __init__(self, stream):
        import zstandard

        size = stream.size()
        stream.seek(size - 16)
        tail = stream.read(16)
        if tail[8:] != END:
            raise ValueError("not a plane file")
        length = int.from_bytes(tail[:8], "little")
        stream.seek(size - 16 - length)
        self.unpacker = zstandard.ZstdDecompressor()
        footer = json.loads(self.unpacker.decompress(stream.read(length)))
        self.stream, self.planes = stream, footer["planes"]
        self.chunks, self.docs = footer["chunks"], footer["docs"]
        self.chunk_ids = footer["chunk_ids"]

    def chunk(self, number: int) -> np.ndarray:
        at, count, sizes = self.chunks[number]
        self.stream.seek(at)
        parts = [self.unpacker.decompress(self.stream.read(n)) for n in sizes]
        return from_planes(parts, count, self.planes)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """Key and ids of every document, reading chunk after chunk."""
        rest, following = np.zeros(0, "<u4"), 0
        for key, count in self.docs:
            parts = [rest]
            have = len(rest)
            while have < count:
                parts.append(self.chunk(following))
                have += len(parts[-1])
                following += 1
            rest = np.concatenate(parts) if len(parts) > 1 else rest
            yield key, rest[:count]
            rest = rest[count:]


# --- encoding -------------------------------------------------------------------------

# What the byte-level pre-tokenizer takes for letters, numbers and white space among
# the characters below U+0250.
_LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_NUMBERS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_SPACES = "\t-\r \u0085\u00a0"


def _piece(letters: str) -> re.Pattern:
    return re.compile(
        f" ?[{letters}]+| ?[{_NUMBERS}]+|'s|'t|'re|'ve|'m|'ll|'d|"
        f" ?[^{_SPACES}{letters}{_NUMBERS}]+|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+")


_PIECE = _piece(_LETTERS)
# Sets of characters below U+0100 are matched faster; most texts have no others.
_LATIN_PIECE = _piece(_LETTERS.replace("\u024f", "\u00ff"))
_HIGH = re.compile("[^\0-\u00ff]")
_WORD = re.compile(f" [{_LETTERS}]+")
_BEYOND = re.compile("[^\0-\u024f]")
# A blank between letters always starts a piece: a text may be cut there.
_CUT = re.compile(f"(?<=[{_LETTERS}]) (?=[{_LETTERS}])")


class _Places(dict):
    """Numbers of pieces, from 0 in the order of their first lookup; ``new`` lists those
    that were given one."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = place = len(self)
        self.new.append(piece)
        return place


class Encoder:
    """The library's ids of texts, by pieces that it has encoded before.

    The byte-level pre-tokenizer cuts a text into pieces that are encoded by
    themselves. Texts of characters below U+0250 are cut the same way here, and each
    different piece goes through the library once, words after a blank many at a time:
    the first id of such a word, and no other, starts with the blank. Texts with other
    characters or special strings, and all texts where the vocabulary has another
    pre-tokenizer, are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        cutter = made.get("pre_tokenizer") or {}
        self.by_piece = (
            made.get("normalizer") is None and cutter.get("type") == "ByteLevel"
            and cutter.get("use_regex", True) and not cutter.get("add_prefix_space"))
        self.special = [t.content for t in
                        self.tokenizer.get_added_tokens_decoder().values()]
        self.after_blank = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        self.after_blank[[i for token, i in self.tokenizer.get_vocab().items()
                          if token.startswith("\u0120")]] = True
        self._forget()

    def _forget(self) -> None:
        self.places = _Places()
        self.flat, self.used = np.zeros(1 << 16, "<u4"), 0
        # Where a piece's ids begin in ``flat``, and how many they are.
        self.starts, self.lengths = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32)
        self.again = np.zeros(1 << 14, bool)      # whether a piece came back in a later lot

    def _drop_rare(self) -> None:
        """Forget the pieces that came in one lot only, and of the others what exceeds half
        the room. Most pieces of a corpus are rare; the frequent ones stay learned."""
        n = len(self.places)
        kept = np.flatnonzero(self.again[:n])[:CACHED_PIECES // 2]
        stay = np.zeros(n, bool)
        stay[kept] = True
        pieces = list(compress(self.places, stay.tolist()))
        low, length = self.starts[kept], self.lengths[kept]
        ends = np.concatenate(([0], np.cumsum(length)))
        ids = self.flat[np.arange(ends[-1]) + np.repeat(low - ends[:-1], length)]
        self._forget()
        self.places.update(zip(pieces, range(len(pieces))))
        self._append(ids, np.arange(len(pieces)), ends)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in
                self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that all follow a blank, and where those of each begin."""
        lots = ["".join(words[i:i + WORDS_AT_ONCE]) for i in range(0, len(words), WORDS_AT_ONCE)]
        ids = np.concatenate([np.zeros(0, "<u4"), *self._encode(lots)])
        begin = np.flatnonzero(self.after_blank[ids])
        if len(begin) != len(words):
            raise ValueError("words do not start where the vocabulary says")
        return ids, begin

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces that have the last places."""
        first = len(self.places) - len(pieces)
        plain = np.fromiter(map(bool, map(_WORD.fullmatch, pieces)), bool, len(pieces))
        ids, begin = self._encode_words(list(compress(pieces, plain)))
        found = self._encode(list(compress(pieces, ~plain)))
        more = np.cumsum([0, *map(len, found)]) + len(ids)
        ids = np.concatenate([ids, *found])
        self._append(ids, first + np.flatnonzero(plain), np.append(begin, more[0]),
                     first + np.flatnonzero(~plain), more)

    def _append(self, ids: np.ndarray, *held: np.ndarray) -> None:
        """Ids at the end of ``flat``; ``held`` alternates places and where their ids begin,
        with the end of the last."""
        while len(self.flat) < self.used + len(ids):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while len(self.starts) < len(self.places):
            for name in ("starts", "lengths", "again"):
                grown = getattr(self, name)
                setattr(self, name, np.concatenate((grown, np.zeros_like(grown))))
        self.flat[self.used:self.used + len(ids)] = ids
        for places, at in zip(held[::2], held[1::2]):
            self.starts[places] = self.used + at[:-1]
            self.lengths[places] = np.diff(at)
        self.used += len(ids)

    def _by_pieces(self, texts: list[str]) -> list[np.ndarray]:
        cut = [(_PIECE if _HIGH.search(t) else _LATIN_PIECE).findall(t) for t in texts]
        count = sum(map(len, cut))
        if len(self.places) + min(count, NEW_PIECES) > CACHED_PIECES:
            self._drop_rare()
        known = len(self.places)
        at = np.fromiter(map(self.places.__getitem__, chain.from_iterable(cut)), np.int32, count)
        self.again[at[at < known]] = True
        if self.places.new:
            self._learn(self.places.new)
            self.places.new = []
        low, length = self.starts[at], self.lengths[at]
        ends = np.concatenate(([0], np.cumsum(length)))
        ids = self.flat[np.arange(ends[-1]) + np.repeat(low - ends[:-1], length)]
        return np.split(ids, ends[np.cumsum([len(c) for c in cut])[:-1]])

    def batch(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of every text, in order."""
        held: list[str] = []
        size = 0
        for text in texts:
            text = text or ""
            if not self.by_piece or _BEYOND.search(text) or any(
                    s in text for s in self.special):
                yield from self._by_pieces(held) if held else ()
                yield self._encode([text])[0]
                held, size = [], 0
            elif len(text) > 2 * CHARS_AT_ONCE:
                yield from self._by_pieces(held) if held else ()
                yield np.concatenate([self._by_pieces([part])[0] for part in _segments(text)])
                held, size = [], 0
            else:
                held.append(text)
                size += len(text)
                if size > CHARS_AT_ONCE:
                    yield from self._by_pieces(held)
                    held, size = [], 0
        yield from self._by_pieces(held) if held else ()


def _segments(text: str) -> Iterator[str]:
    """A long text in parts that start where a piece does."""
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + CHARS_AT_ONCE)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark runs the tasks side by side
    if not os.path.exists(path):
        import public_tokenizers

        path = public_tokenizers.path(path)
    return Encoder(path)


# --- tables ---------------------------------------------------------------------------

def write_token_files(docs: DataFrame, folder: str, *, text: str = "text", key: str = "doc_id",
                      vocabulary: str = "byte_bpe_50k.json", end_id: int = 0,
                      planes: str = "bytes", partitions: int | None = None) -> DataFrame:
    """Files of ids in ascending key order and a table of them (path, part, file,
    ids); ``part`` and ``file`` give the order.

    Every text's ids are followed by ``end_id``; NULL and empty texts give that
    alone. NULL keys come first, rows of one key in the order of their texts' hashes;
    equal rows are told apart by where they were read, so no key, however frequent,
    has to fit one task. Ranges are sampled without texts. Files belong to one attempt
    of a task; the table lists those that succeeded.
    """
    ship_package()
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select(F.col(key).cast("long").alias("k"), text_of(text).alias("t"))
               .withColumns({"h": F.xxhash64("t"), "row": F.monotonically_increasing_id()})
               .repartitionByRange(n, "k", "h", "row").sortWithinPartitions("k", "h", "t"))
    ordered = ordered.select("k", "t", F.spark_partition_id().alias("part"))
    end = np.array([end_id], "<u4")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(vocabulary).batch
        rows = (row for pdf in batches
                for row in zip(pdf["k"].astype("Int64"), encode(pdf["t"]), pdf["part"]))
        row, number = next(rows, None), 0
        while row is not None:
            path = f"{folder}/{uuid.uuid4().hex}.planes"
            with write_whole(path) as stream:
                out = PlaneWriter(stream, planes)
                part = int(row[2])
                while row is not None and out.total < FILE_IDS:
                    k = None if pd.isna(row[0]) else int(row[0])
                    out.add(np.concatenate((row[1], end)), k)
                    row = next(rows, None)
                out.close()
            yield pd.DataFrame({"path": [path], "part": [part], "file": [number],
                                "ids": [out.total]})
            number += 1

    return stored(ordered.mapInPandas(write, INDEX_SCHEMA), "token-files")


def read_token_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """One row per document read back: key, start among all ids, length, CRC-32."""
    ship_package()
    order = Window.orderBy("part", "file").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = files.withColumn("before", F.sum("ids").over(order) - F.col("ids"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, before in zip(pdf["path"], pdf["before"]):
                rows, at = [], int(before)
                with read_at(path) as stream:
                    for key, ids in PlaneReader(stream).documents():
                        rows.append((key, at, len(ids), zlib.crc32(ids.tobytes())))
                        at += len(ids)
                        if len(rows) == 10_000:
                            yield _documents(rows)
                            rows = []
                yield _documents(rows)

    return spread(placed, files.count(), "path").mapInPandas(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _documents(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
    return frame.astype({"doc_id": "Int64", "start": "int64", "n_tokens": "int64",
                         "ids_crc32": "int64"})


def token_folder(spark: SparkSession) -> str:
    return new_path(spark, "tokens")
