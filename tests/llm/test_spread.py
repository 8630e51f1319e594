"""Work that must not end up in one task, whatever the size of its rows."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridstats.llm import tokenfile, warc
from gridstats.llm.shared import spread

public_tokenizers = pytest.importorskip("public_tokenizers")


def tasks_with_rows(frame):
    return len(frame.groupBy(F.spark_partition_id()).count().collect())


def test_files_are_read_back_in_several_tasks(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    files = tokenfile.write_token_files(docs, tokenfile.token_folder(spark), partitions=6)
    back = tokenfile.read_token_files(spark, files)
    assert files.count() == 6 and tasks_with_rows(back) > 2
    assert back.count() == 400


def test_archives_are_read_back_in_several_tasks(spark):
    pages = spark.range(400).selectExpr("id AS page_id", "'u' AS url", "repeat(id, 50) AS html")
    files = warc.write_archives(pages.repartition(4), warc.archive_folder(spark))
    back = warc.read_archives(spark, files, split_bytes=4096)
    assert tasks_with_rows(back) > 2 and back.count() == 400


def test_tasks_are_bounded_by_rows_and_cores(spark):
    assert spread(spark.range(3), 3, "id").rdd.getNumPartitions() == 3
    assert spread(spark.range(9), 0, "id").rdd.getNumPartitions() == 1
    assert spread(spark.range(9), 10**9, "id").rdd.getNumPartitions() == \
        4 * spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("text", ["'same'", "concat('text ', id)"])
def test_a_frequent_key_is_dealt_to_several_tasks(spark, text):
    docs = spark.range(6000).selectExpr(
        "CASE WHEN id % 3 > 0 THEN id END AS doc_id", f"{text} AS text")
    files = tokenfile.write_token_files(docs, tokenfile.token_folder(spark), partitions=8)
    assert max(r["ids"] for r in files.collect()) < 0.25 * files.agg(F.sum("ids")).first()[0]
    back = tokenfile.read_token_files(spark, files).orderBy("start").collect()
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in back]
    assert keys == sorted(keys) and len(keys) == 6000
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(back, back[1:]))


def test_pieces_equal_the_library_on_odd_texts():
    import random

    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    r = random.Random(3)
    alphabet = [*" \t\n\r\v\f\x85\xa0\x1c\x1f'strevmld.,!?aZé中²¼½19ªºµ×÷ÿɏɐ _-<|>", "'s", "'ll",
                "  ", "\n\n", " a", " the", "'re", "<|endoftext|>", "don't"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(25))) for _ in range(20_000)]
    texts += [a + chr(c) + b for c in range(0x252) for a in ("", "a", " ", "1") for b in (" b", "1")]
    library = Tokenizer.from_file(path)
    wanted = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    encoder = tokenfile.Encoder(path)
    assert [ids.tolist() for ids in encoder.batch([*texts, None])] == [*wanted, []]


def test_long_texts_are_cut_where_pieces_start_and_tables_are_bounded(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(tokenfile, "CHARS_AT_ONCE", 100)
    monkeypatch.setattr(tokenfile, "CACHED_PIECES", 50)
    r = np.random.default_rng(1)
    text = " ".join("".join(map(chr, r.integers(97, 123, 5))) + ".,\n"[k % 3] * (k % 2)
                    for k in range(3000))
    wanted = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    encoder = tokenfile.Encoder(path)
    short = [text[:40], text[50:90]]
    got = [ids.tolist() for ids in encoder.batch([*short, text, *short])]
    assert got[2] == wanted and got[:2] == got[3:]
    assert len(encoder.places) <= 50 + 200
    assert collections.Counter(map(len, got))[len(wanted)] == 1


def test_pieces_that_come_back_are_not_encoded_again(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(tokenfile, "CHARS_AT_ONCE", 300)
    monkeypatch.setattr(tokenfile, "CACHED_PIECES", 400)
    monkeypatch.setattr(tokenfile, "NEW_PIECES", 100, raising=False)
    r = np.random.default_rng(2)
    rare = ["".join(map(chr, r.integers(97, 123, 9))) for _ in range(3000)]
    texts = [" the cat " + " ".join(rare[k:k + 5]) + "!" for k in range(0, 3000, 5)]
    encoder, learned = tokenfile.Encoder(path), collections.Counter()
    learn = encoder._learn
    encoder._learn = lambda pieces: learned.update(pieces) or learn(pieces)
    got = [ids.tolist() for ids in encoder.batch(texts)]
    library = Tokenizer.from_file(path)
    assert got == [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert len(encoder.places) <= 500
    assert learned[" the"] == learned[" cat"] == learned["!"] == 1
