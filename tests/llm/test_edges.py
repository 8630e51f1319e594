"""NULLs, empty and very long texts, repeated rows, empty tables, clashing names."""

import pytest

import corpus_pipeline
from gridstats.llm import queries as Q
from gridstats.llm import simhash, warc
from gridstats.llm.mixing import with_mix, word_count
from gridstats.llm.quality import with_quality
from gridstats.llm.sharding import with_shards

DDL = ("doc_id long, text string, lang string, source string, n_chars long,"
       " size long, shard int, quality string, fp string")
LONG = ("alpha beta gamma delta epsilon zeta eta theta iota kappa " * 900).strip()
ROWS = [
    (1, "one two three four five six seven eight nine ten eleven", "en", "a"),
    (1, "one two three four five six seven eight nine ten eleven", "en", "a"),
    (2, None, None, None), (3, "", "en", "a"), (None, " \t\n", "en", "b"),
    (4, LONG, "en", "b"), (5, "x" * 50_000, "de", "a"), (6, "é中\U0001f600 \x00", "fr", None),
    (7, "mail a@b.co card 4111 1111 1111 1111 ip 1.2.3.4 tel +1 (212) 555-0100", "en", "a"),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with odd rows, and one with none."""
    made = {}
    for name, rows in (("odd", ROWS), ("none", [])):
        d = str(tmp_path_factory.mktemp(name))
        full = [(*r, len(r[1] or ""), 9, 9, "q", "f") for r in rows]
        spark.createDataFrame(full, DDL).write.parquet(f"{d}/documents.parquet")
        labels = [(1, 1, 0), (4, 1, 1), (2, None, None), (7, 0, 1), (None, 1, 1)] if rows else []
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
            f"{d}/labels.parquet")
        items = [(1, "theta iota kappa alpha beta gamma delta epsilon zeta eta theta iota"),
                 (2, None), (3, ""), (None, "nowhere to be found in any of these texts")]
        spark.createDataFrame(items if rows else [], "item_id long, text string").write.parquet(
            f"{d}/benchmark.parquet")
        pages = [(r[0], f"http://x/ {n}\n", r[1]) for n, r in enumerate(rows)]
        spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(
            f"{d}/pages.parquet")
        vectors = [(r[0], [0.5, -0.25] * 4, n % 2) for n, r in enumerate(rows)]
        spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int"
                              ).write.parquet(f"{d}/embeddings.parquet")
        made[name] = d
    return made


@pytest.mark.parametrize("name", list(Q.QUERIES))
def test_every_row_has_a_defined_result(spark, folder, name):
    if name not in ("op8_decontamination", "op13_source_divergence"):
        assert len(Q.QUERIES[name](spark, folder["odd"]).collect()) == len(ROWS)
    assert Q.QUERIES[name](spark, folder["none"]).collect() == []


def test_benchmark_passages_in_a_long_text(spark, folder):
    found = Q.op8_decontamination(spark, folder["odd"]).collect()
    assert {r["doc_id"] for r in found} == {4} and {r["item_id"] for r in found} == {1}
    assert len(found) >= 800


def test_pipeline_runs_over_odd_and_empty_tables(spark, folder):
    odd = corpus_pipeline.run(spark, folder["odd"]).collect()
    assert {r["doc_id"] for r in odd} <= {1, 7}
    assert corpus_pipeline.run(spark, folder["none"]).collect() == []


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder['odd']}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder["odd"]).columns == docs.columns


def test_columns_of_the_same_name_are_left_alone_or_replaced(spark, folder):
    docs = spark.read.parquet(f"{folder['odd']}/documents.parquet")
    trusted = Q.trusted_documents(spark, folder["odd"])
    rated = with_quality(docs, trusted).select("doc_id", "fp", "quality.n_words")
    assert {r["fp"] for r in rated.collect()} == {"f"}
    placed = with_shards(docs, into="shard")
    assert placed.columns == [c for c in docs.columns if c != "shard"] + ["shard"]
    mixed = with_mix(docs.withColumn("words", word_count()), size="words", into="mix")
    assert mixed.where("size <> 9").isEmpty()
    assert simhash.keep_one(docs).columns == docs.columns


def test_archives_of_odd_pages(spark, folder):
    pages = spark.read.parquet(f"{folder['odd']}/pages.parquet")
    files = warc.write_archives(pages, warc.archive_folder(spark))
    for split in (97, 1 << 20):
        back = warc.read_archives(spark, files, split_bytes=split).collect()
        assert len(back) == len(ROWS)
        assert sorted(bytes(r["payload"]) for r in back if r["record_type"] == "response") == \
            sorted((r[1] or "").encode() for r in ROWS)
