"""Vector codes against a plain version, and what odd vectors give."""

import hashlib
import math
import random

import numpy as np
import pytest

from gridstats.llm import vectorcodes as V

DDL = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=8, entries=16, rounds=6):
    """Product quantisation by the definition: {row number: (code, error)}, codebooks."""
    kept = [(i, v, [math.floor(4096 * float(np.float32(x))) for x in e])
            for i, (v, e, _) in enumerate(rows)
            if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    width = len(kept[0][2]) // parts
    starts = {}
    for _, v, c in kept:
        starts[v] = min(starts.get(v, c), c)
    books = []
    first = sorted(starts, key=lambda v: (v is None, v))[:entries]
    for p in range(parts):
        books.append([starts[v][p * width:(p + 1) * width] for v in first])

    def best(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for step in range(rounds):
        for p in range(parts):
            members = {}
            for _, _, c in kept:
                part = c[p * width:(p + 1) * width]
                members.setdefault(best(part, books[p])[1], []).append(part)
            for k, ps in members.items():
                books[p][k] = [sum(col) // len(ps) for col in zip(*ps)]
    coded = {}
    for i, _, c in kept:
        found = [best(c[p * width:(p + 1) * width], books[p]) for p in range(parts)]
        coded[i] = ("".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found))
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    return coded, hashlib.sha256(flat.encode()).hexdigest()


def made(n, dims, seed, values=4):
    r = random.Random(seed)
    rows = [(i, [r.randrange(-values, values) / 7 for _ in range(dims)],
             r.choice([None, 1, 2])) for i in range(n)]
    return rows + [rows[3]] * 5 + [(n, None, 1), (n + 1, [None] + [0.5] * (dims - 1), 1),
                                   (n + 2, [math.nan] + [0.0] * (dims - 1), None),
                                   (n + 3, [math.inf] * dims, 2), (None, [0.25] * dims, 2)]


@pytest.mark.parametrize("n, dims, seed", [(60, 16, 1), (9, 8, 2), (40, 40, 3)])
def test_codes_equal_a_plain_version(spark, n, dims, seed):
    rows = made(n, dims, seed)
    random.Random(0).shuffle(rows)
    coded, digest = plain(rows)
    got = V.with_codes(spark.createDataFrame(rows, DDL).repartition(5)).collect()
    assert sorted((str(r["id"]), r["code"], r["error"]) for r in got) == sorted(
        (str(rows[i][0]), *c) for i, c in coded.items())
    assert {r["codebooks_sha256"] for r in got} == {digest}
    for label in {rows[i][2] for i in coded}:
        total = sum(c[1] for i, c in coded.items() if rows[i][2] == label)
        assert {r["label_error"] for r in got if r["label"] == label} == {total}


@pytest.mark.parametrize("leaves", [1, 3, 8192])
def test_walk_over_blocks_of_leaves(monkeypatch, leaves):
    monkeypatch.setattr(V, "LEAVES", leaves)
    r = np.random.default_rng(leaves)
    rows, _, numbers = V._distinct(r.integers(-3, 3, (200, 4)))
    assert numbers.sum() == 200 and rows.tolist() == sorted(rows.tolist())
    book = r.integers(-3, 3, (16, 4))
    far = ((rows[:, None] - book) ** 2).sum(axis=2)
    code, error = V.nearest(rows, book)
    assert code.tolist() == far.argmin(axis=1).tolist() and (error == far.min(axis=1)).all()
    shuffled = r.permutation(np.repeat(rows, 2, axis=0))
    assert (V.Trie(book).distances(shuffled)
            == ((shuffled[:, None] - book) ** 2).sum(axis=2)).all()


def test_prefixes_are_computed_once():
    rows, _, _ = V._distinct(np.array([[a, b, c] for a in range(2) for b in range(3)
                                       for c in range(5)] * 2))
    trie, opened = V.Trie(np.zeros((1, 3), np.int64)), []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, tuple) and len(key) == 3 and isinstance(key[0], np.ndarray):
                opened.append(len(key[0]))
            return np.asarray(super().__getitem__(key))

    trie.distances(rows.view(Counted))
    assert opened == [2, 6, 30]


def test_odd_vectors_and_other_columns(spark):
    rows = [(1, [0.0] * 8, 1), (2, [1e30, -1e30] * 4, 1), (3, [0.5] * 9, 1), (4, [], 1)]
    frame = spark.createDataFrame(rows, DDL).selectExpr(
        "*", "'x' AS id", "'y' AS code", "'z' AS error", "'v' AS vector", "0 AS components")
    got = {r["id"]: r for r in V.with_codes(frame).collect()}
    assert set(got) == {1, 2} and got[1]["error"] == got[2]["error"] == 0
    assert got[1]["code"] == "00" * 8 and got[2]["code"] == "01" * 8
    for frame in (spark.createDataFrame([], DDL), spark.createDataFrame(rows[2:], DDL)):
        assert V.with_codes(frame).collect() == []
    with pytest.raises(ValueError, match="256"):
        V.with_codes(frame, entries=300)


def test_a_vector_that_repeats_is_one_part_a_batch(spark):
    rows = [(i, [1.0] * 8 if i % 3 else [float(i)] * 8, 0) for i in range(3000)]
    frame = spark.createDataFrame(rows, DDL).repartition(3)
    parts = V.distinct_parts(
        frame.select(V.scaled(frame["embedding"], 8).alias("c")), 8).collect()
    assert len(parts) == 8 * 1001 and sum(r["n"] for r in parts) == 8 * 3000
    assert sorted(r["n"] for r in parts)[-8:] == [2000] * 8
