"""Vector codes: product quantisation in whole numbers over a trie of distinct parts.

Vectors are cut into equal parts; equal parts at the same position are merged with
their number and sorted, so that parts which begin alike lie together. A round walks
this order depth first like a trie: the squared distances to all codebook entries
are accumulated from one component to the next, once for each distinct prefix, and a
leaf takes the nearest entry and adds the part, times its number, to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.llm.shared import ship_package, stored

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LEAVES = 8192                 # leaves of the trie held at once


def largest_component(dims: int) -> int:
    """Components are clamped to this, so that distances of whole vectors fit 63 bits."""
    return min(isqrt((1 << 62) // max(dims, 1)) // 2, (1 << 31) - 1)


def scaled(vector: Column, dims: int, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, clamped."""
    bound = float(largest_component(dims))
    return F.transform(vector, lambda x: F.greatest(F.lit(-bound), F.least(
        F.lit(bound), F.floor(x.cast("double") * scale).cast("double"))).cast("int"))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x) < F.lit(float("inf")))), F.lit(False))


def _rows(column: pa.Array, dims: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dims).astype(np.int64)


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, the place of every row, and numbers."""
    order = np.lexsort(rows.T[::-1])
    ordered = rows[order]
    new = np.concatenate(([True], (ordered[1:] != ordered[:-1]).any(axis=1)))
    place = np.empty(len(rows), np.int64)
    place[order] = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    return ordered[heads], place, np.diff(np.append(heads, len(rows)))


class Trie:
    """Walks distinct parts in lexicographic order, depth first.

    ``path`` is the way down to the last leaf: after every component, the distances
    of that prefix to all entries. A leaf goes on from the deepest prefix that it
    shares with the leaf before it. Leaves come in blocks, whose nodes of one depth
    are computed together.
    """

    def __init__(self, book: np.ndarray):
        self.book = book                                    # entries x components
        self.path = np.zeros((book.shape[1], len(book)), np.int64)
        self.last: np.ndarray | None = None

    def distances(self, leaves: np.ndarray) -> np.ndarray:
        """Squared distances of every leaf to every entry."""
        n, depth = leaves.shape
        before = leaves[:1] - 1 if self.last is None else self.last[None]
        differs = leaves != np.concatenate((before, leaves[:-1]))
        # A leaf that equals the one before it opens no node.
        shared = np.where(differs.any(axis=1), differs.argmax(axis=1), depth)
        above, node = np.zeros((1, len(self.book)), np.int64), np.zeros(n, np.int64)
        for d in range(depth):
            opening = np.flatnonzero(shared <= d)
            step = leaves[opening, d, None] - self.book[None, :, d]
            opened = above[node[opening]] + step * step
            # Node 0 is the one on the way to the last leaf of the block before.
            above = np.concatenate((self.path[d][None], opened))
            node = np.cumsum(shared <= d)
            self.path[d] = above[node[-1]]
        self.last = leaves[-1]
        return above[node]


def nearest(leaves: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every sorted part, the lower index at ties, and its distance."""
    code, error = np.zeros(len(leaves), np.int64), np.zeros(len(leaves), np.int64)
    trie = Trie(book)
    for low in range(0, len(leaves) if book.shape[1] else 0, LEAVES):
        far = trie.distances(leaves[low:low + LEAVES])
        code[low:low + LEAVES], error[low:low + LEAVES] = far.argmin(axis=1), far.min(axis=1)
    return code, error


def distinct_parts(vectors: DataFrame, dims: int, parts: int = PARTS) -> DataFrame:
    """(part, digits, n): distinct parts at every position with their number, in
    lexicographic order within files. ``digits`` are the components as big-endian
    numbers of four bytes above the least, so that bytes sort like components.

    Every batch merges its equal parts before the exchange, so a vector that fills a
    third of the table sends one row a batch. Ranges of parts keep prefixes together."""
    width = dims // parts

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _rows(batch.column(0), dims)
            for part in range(parts):
                leaves, _, n = _distinct(rows[:, part * width:(part + 1) * width])
                digits = (leaves + (1 << 31)).astype(">u4").tobytes()
                size = 4 * width
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(np.full(len(leaves), part, np.int32)),
                    "digits": pa.array([digits[i:i + size] for i in
                                        range(0, len(digits), size)], pa.binary()),
                    "n": pa.array(n, pa.int64())})

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, number = None, 0
        for batch in batches:
            rows = []
            for part, digits, n in zip(*(c.to_pylist() for c in batch.columns)):
                if (part, digits) == last:
                    number += n
                else:
                    if last is not None:
                        rows.append((*last, number))
                    last, number = (part, digits), n
            yield _parts_batch(rows)
        if last is not None:
            yield _parts_batch([(*last, number)])

    schema = "part int, digits binary, n long"
    local = stored(vectors.mapInArrow(cut, schema), "vector-parts")
    ordered = local.repartitionByRange("part", "digits").sortWithinPartitions("part", "digits")
    return ordered.mapInArrow(merged, schema)


def _parts_batch(rows: list[tuple]) -> pa.RecordBatch:
    part, digits, n = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_pydict({
        "part": pa.array(part, pa.int32()), "digits": pa.array(digits, pa.binary()),
        "n": pa.array(n, pa.int64())})


def _round(parts: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round. Tasks send sums and numbers per entry and
    component, which are as few as the codebooks are small."""
    n_parts, entries, width = books.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = [Trie(book) for book in books]
        sums = np.zeros(books.shape, np.int64)
        numbers = np.zeros((n_parts, entries), np.int64)
        for batch in batches:
            part = batch.column(0).to_numpy()
            digits = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u4")
            leaves = digits.reshape(len(part), width).astype(np.int64) - (1 << 31)
            n = batch.column(2).to_numpy()
            for p in np.unique(part):
                mine, weight = leaves[part == p], n[part == p]
                for low in range(0, len(mine), LEAVES):
                    block, times = mine[low:low + LEAVES], weight[low:low + LEAVES]
                    code = tries[p].distances(block).argmin(axis=1)
                    np.add.at(sums[p], code, block * times[:, None])
                    np.add.at(numbers[p], code, times)
        p, e = np.nonzero(numbers)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(p, pa.int32()), "entry": pa.array(e, pa.int32()),
            "sums": pa.array(sums[p, e].tolist(), pa.list_(pa.int64())),
            "n": pa.array(numbers[p, e], pa.int64())})

    found = (parts.mapInArrow(assign, "part int, entry int, sums array<long>, n long")
             .select("part", "entry", "n", F.posexplode("sums").alias("at", "sum"))
             .groupBy("part", "entry", "at")
             .agg(F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"), F.sum("n").alias("n")))
    new = books.copy()
    for r in found.collect():
        new[r["part"], r["entry"], r["at"]] = int(r["sum"]) // r["n"]
    return new


def dimensions(vectors: DataFrame, vector: str = "vector", parts: int = PARTS) -> int:
    """The most frequent length that can be cut into ``parts``, the longer at ties."""
    sizes = (vectors.groupBy(F.size(vector).alias("size")).count()
             .where((F.col("size") > 0) & (F.col("size") % parts == 0))
             .orderBy(F.col("count").desc(), F.col("size").desc()).first())
    return sizes["size"] if sizes else 0


def train(vectors: DataFrame, dims: int, *, parts: int = PARTS, entries: int = ENTRIES,
          rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts x entries x components) of (id, components).

    They start as the parts of the ``entries`` smallest ids. Every later value is the
    floor of a mean over all vectors; entries without a part stay.
    """
    ids = [r["id"] for r in vectors.select("id").distinct()
           .orderBy(F.col("id").asc_nulls_last()).limit(entries).collect()]
    here = F.col("id").isin([i for i in ids if i is not None])
    if None in ids:
        here = here | F.col("id").isNull()
    first = (vectors.where(here).groupBy("id").agg(F.min("components").alias("components"))
             .orderBy(F.col("id").asc_nulls_last()).collect())
    books = np.array([r["components"] for r in first], np.int64)
    books = books.reshape(len(first), parts, dims // parts).transpose(1, 0, 2)
    table = stored(distinct_parts(vectors.select("components"), dims, parts), "distinct-parts")
    for _ in range(rounds):
        books = _round(table, books)
    return books


def codes(components: Column, books: np.ndarray) -> Column:
    """A struct of the code of every part, in hexadecimal, and the sum of distances."""
    n_parts, _, width = books.shape

    @F.arrow_udf("struct<code: string, error: bigint>")
    def coded(column: pa.Array) -> pa.Array:
        rows = _rows(column, n_parts * width)
        total, code = np.zeros(len(rows), np.int64), np.zeros((len(rows), n_parts), np.uint8)
        for part in range(n_parts if len(rows) else 0):
            leaves, place, _ = _distinct(rows[:, part * width:(part + 1) * width])
            best, error = nearest(leaves, books[part])
            code[:, part] = best[place]
            total += error[place]
        return pa.StructArray.from_arrays(
            [pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(total)],
            ["code", "error"])
    return coded(components)


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all final components in the order part, entry, position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_codes(table: DataFrame, *, vector: str = "embedding", key: str = "vec_id",
               label: str = "label", parts: int = PARTS, entries: int = ENTRIES,
               rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) of every usable vector.

    Dropped are vectors that are NULL, hold NULL, NaN or infinite components, or have
    another length than most (``dimensions``). Components are clamped to what lets
    distances fit a long (``largest_component``: 32,768 for 64 dimensions). Repeated
    rows count each and get a row each; an id that repeats starts one codebook entry,
    with the least of its vectors; NULL ids come last. With fewer vectors than
    ``entries`` the codebooks are as small. Label errors are summed over equal labels,
    NULL labels together, and NULL where they leave the range of a long. An empty
    table gives no rows. Other columns, whatever their names, are not read.
    """
    if entries > 256 or parts < 1:
        raise ValueError("codes have two hexadecimal digits: at most 256 entries")
    ship_package()
    named = table.select(F.col(key).alias("id"), F.col(label).alias("label"),
                         F.col(vector).alias("vector")).where(usable(F.col("vector")))
    dims = dimensions(named, parts=parts)
    kept = named.where(F.size("vector") == dims) if dims else named.limit(0)
    ready = stored(kept.select("id", "label", scaled(F.col("vector"), dims, scale)
                               .alias("components")), "vector-components")
    if not dims:
        books = np.zeros((parts, 1, 1), np.int64)
    else:
        books = train(ready.select("id", "components"), dims, parts=parts, entries=entries,
                      rounds=rounds)
    coded = stored(ready.select("id", "label", codes(F.col("components"), books).alias("c"))
                   .select("id", "label", "c.*"), "vector-codes")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(
        F.try_sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "id", "label", "code", "error", "label_error",
        F.lit(books_digest(books)).alias("codebooks_sha256"))
