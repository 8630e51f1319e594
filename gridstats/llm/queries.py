"""One query per operator, over the whole of the table it is meant for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstats.llm.decontam import benchmark_table, with_leaks
from gridstats.llm.divergence import source_divergence
from gridstats.llm.linededup import without_shared_lines
from gridstats.llm.mixing import with_mix, word_count
from gridstats.llm.oracle import ORACLE
from gridstats.llm.pii import with_personal_data
from gridstats.llm.quality import with_quality
from gridstats.llm.sharding import with_shards
from gridstats.llm.shared import stored, text_of
from gridstats.llm.simhash import fingerprints, near_duplicates
from gridstats.llm.tokencount import token_counts
from gridstats.llm.tokenfile import read_token_files, token_folder, write_token_files
from gridstats.llm.toxicity import train, with_toxicity
from gridstats.llm.vectorcodes import with_codes
from gridstats.llm.warc import archive_folder, read_archives, write_archives

LONG_TEXT_TOKENS = 4096


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trusted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    prints = stored(docs.select("doc_id", fingerprints(text_of()).alias("fp")), "prints")
    component = near_duplicates(prints)
    return prints.join(component, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_personal_data(docs).select("doc_id", "personal.*")


def _fifth(key: str = "doc_id") -> Column:
    """Rows held out of training: a fifth, by the CRC-32 of the key as text."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, _table(spark, sf_dir, "labels").where(~_fifth()))
    scored = with_toxicity(docs, model, into="score")
    return scored.select("doc_id", F.coalesce(_fifth(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = with_quality(_table(spark, sf_dir, "documents"), trusted_documents(spark, sf_dir))
    return rated.select("doc_id", *[f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score")])


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    counted = docs.select("doc_id", F.octet_length(text_of()).cast("long").alias("n_bytes"),
                          token_counts(text_of()).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > LONG_TEXT_TOKENS)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    sized = stored(docs.select("doc_id", "source", word_count().alias("size")), "mix-sizes")
    return with_mix(sized).select(
        "doc_id", "size", "mix.source_size", "mix.target", "mix.taken")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    placed = with_shards(docs, keep=["doc_id"])
    return placed.select(
        "doc_id", "shard.size", "shard.text_crc32", F.lit("bytes").alias("law"),
        "shard.shard", "shard.slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_leaks(docs, benchmark_table(spark, sf_dir))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_archives(_table(spark, sf_dir, "pages"), archive_folder(spark))
    return read_archives(spark, files, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_token_files(_table(spark, sf_dir, "documents"), token_folder(spark))
    return read_token_files(spark, files)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_codes(_table(spark, sf_dir, "embeddings")).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


def op12_shared_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_shared_lines(docs).select(
        "doc_id", "lines.n_lines", "lines.n_dropped",
        F.sha2(F.col("lines.text").cast("binary"), 256).alias("kept_sha256"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_personal_data": op2_personal_data,
    "op3_toxicity": op3_toxicity,
    "op4_quality_rules": op4_quality_rules,
    "op5_token_counts": op5_token_counts,
    "op6_mixing": op6_mixing,
    "op7_sharding": op7_sharding,
    "op8_decontamination": op8_decontamination,
    "op9_warc": op9_warc,
    "op10_token_files": op10_token_files,
    "op11_vector_codes": op11_vector_codes,
    "op12_shared_lines": op12_shared_lines,
    "op13_source_divergence": op13_source_divergence,
}

__all__ = ["ORACLE", "QUERIES"]
