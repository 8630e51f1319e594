"""Lines of many documents against a plain version; the filters; odd texts."""

import random
from collections import Counter

import numpy as np
import pytest

from gridstats.llm import linededup as L

DDL = "doc_id long, text string"
BLANK = " \t\n\v\f\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def plain(rows, min_docs, min_chars=1, first=False):
    texts = [(i, (t or "").split("\n")) for i, t in rows]
    held = Counter(k for _, ls in texts for k in {key(x) for x in ls} if len(k) >= min_chars)
    gone = {k for k, n in held.items() if n >= min_docs}
    least = {}
    for i, ls in texts:
        for k in map(key, ls):
            least[k] = min(least.get(k, (True, 0)), (i is None, i or 0))
    out = []
    for i, ls in texts:
        kept, seen = [], set()
        for x in ls:
            k = key(x)
            stays = first and k not in seen and least[k] == (i is None, i or 0)
            if k not in gone or stays:
                kept.append(x)
            seen.add(k)
        out.append((i, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def made(seed, n=60):
    r = random.Random(seed)
    common = ["Terms of use", "é ÀB ", "x", "", "  ", "A\rb", "中\U0001f600", " wide"]
    rows = []
    for i in range(n):
        lines = [r.choice(" \t\r") * r.randrange(3) + r.choice(common).swapcase() * r.randrange(2)
                 + r.choice(["", " ", "\v"]) for _ in range(r.randrange(8))]
        lines += [f"line {r.randrange(40)}" for _ in range(r.randrange(6))]
        r.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    return rows + [(n, None), (n + 1, ""), (n + 2, "\n\n"), (None, rows[0][1]),
                   rows[5], rows[5], (n + 3, "x\n" * 20_000)]


def got(frame, **options):
    kept = L.without_shared_lines(frame, into="r", **options).select("doc_id", "r.*").collect()
    return sorted((tuple(r) for r in kept), key=repr)


@pytest.mark.parametrize("options", [
    {}, {"broadcast_keys": 0}, {"bits": L.MIN_BITS}, {"min_docs": 2}, {"min_chars": 3},
    {"first_by": "doc_id"}, {"first_by": "doc_id", "broadcast_keys": 0}])
@pytest.mark.parametrize("seed", [1, 2])
def test_lines_equal_a_plain_version(spark, options, seed):
    rows = made(seed)
    frame = spark.createDataFrame(rows, DDL).repartition(5)
    wanted = plain(rows, options.get("min_docs", 6), options.get("min_chars", 1),
                   "first_by" in options)
    assert got(frame, **{"min_docs": 6, **options}) == wanted
    assert sum(r[2] for r in wanted) > (90 if "min_chars" in options else 20_000)


def test_a_full_filter_costs_time_and_no_result(spark, monkeypatch):
    monkeypatch.setattr(L, "PIECE", 8)
    rows = made(3)
    frame = spark.createDataFrame(rows, DDL).repartition(4)
    assert got(frame, min_docs=6, bits=64) == plain(rows, 6)
    assert L.seen_again(frame, bits=64).all()


def test_digests_are_passed_on_in_bounded_lots(spark, monkeypatch):
    monkeypatch.setattr(L, "COUNTED_AT_ONCE", 5)
    rows = made(4)
    assert got(spark.createDataFrame(rows, DDL).repartition(3), min_docs=6) == plain(rows, 6)


def test_merged_filters_hold_all_that_two_tasks_saw():
    r = np.random.default_rng(1)
    a, b = (np.unique(r.integers(0, 1 << 63, 3000, np.uint64)) for _ in range(2))
    b[:500] = a[:500]
    left, right, both = (L.SeenTwice(1 << 19) for _ in range(3))
    left.add(a[:2000])
    left.add(np.concatenate((a[1900:], a[-5:])))
    right.add(b)
    both.once, both.again = L.merge((left.once, left.again), (right.once, right.again))
    assert both.suspected(np.concatenate((a[:500], a[1900:2000], a[-5:]))).all()
    assert both.suspected(a[600:1800]).mean() < 0.01


def test_only_suspects_are_counted(spark):
    rows = [(i, f"own {i}\nshared\n{i * i + 0.5}") for i in range(3000)]
    frame = spark.createDataFrame(rows, DDL)
    filter_ = spark.sparkContext.broadcast(L.seen_again(frame))
    assert L._suspect(filter_.value).suspected(L._hashes([b"shared"])).all()
    own = L._hashes([f"own {i}".encode() for i in range(3000)])
    assert L._suspect(filter_.value).suspected(own).mean() < 0.01
    assert L.shared_lines(frame, filter_, min_docs=2).count() == 1


def test_other_columns_stay(spark):
    rows = [(i, "a\nb", "keep", 7, "m") for i in range(12)]
    frame = spark.createDataFrame(
        rows, "doc_id long, text string, row string, shared int, text_md5 string")
    for n in (0, 100):
        kept = L.without_shared_lines(frame, broadcast_keys=n)
        assert kept.columns == [*frame.columns, "lines"]
        assert {tuple(r)[2:5] for r in kept.collect()} == {("keep", 7, "m")}
        assert L.without_shared_lines(kept, broadcast_keys=n).columns == kept.columns
    assert L.without_shared_lines(frame.limit(0)).collect() == []
    with pytest.raises(ValueError, match="min_docs"):
        L.without_shared_lines(frame, min_docs=1)
