"""Quality rules: text statistics and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed n-grams are counted, one from trusted documents and
one from the whole corpus. A document's score is the mean, over its n-grams, of
log p(bucket | trusted) - log p(bucket | corpus); documents below a fixed
threshold are rejected, the same way on every run. All of it is built from
DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.llm.shared import broadcast_if_small, stored, text_of, words_of

BUCKETS = 16_384          # hash buckets of the two multinomials
SMOOTHING = 1.0           # added to every bucket's count
# Mean log ratio below which a document is rejected. Prose in the proportions of
# the corpus scores near 0, whatever its language; text that the trusted
# documents never contain scores near log p(trusted)/p(corpus) of its n-grams.
THRESHOLD = -0.1
MIN_WORDS = 10            # base rule: fewer words fail
MAX_REPEAT_PERCENT = 20   # base rule: more words in repeated windows fail
WINDOW = 5


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once; an expression used inside a
    lambda would otherwise be computed again for every element."""
    return F.get(F.transform(F.array(value), body), 0)


def _pairs(left: Column, right: Column, skip: int) -> Column:
    """Hash of left[i] and right[i + skip] wherever both exist."""
    n = F.greatest(F.size(right) - skip, F.lit(0))
    return F.zip_with(F.slice(left, 1, n), F.slice(right, skip + 1, n),
                      lambda a, b: F.xxhash64(a, b))


def hashed(words: Column) -> Column:
    """64-bit hashes of the words, of neighbouring pairs, and of runs of four.

    Every step is one pass over the array; runs are built from shorter runs.
    """
    singles = F.transform(words, lambda w: F.xxhash64(w))
    return _let(singles, lambda one: _let(_pairs(one, one, 1), lambda two: F.struct(
        one.alias("one"), two.alias("two"), _pairs(two, two, 2).alias("four"))))


def _covered(pairs: Column) -> Column:
    """Words in windows that occur twice or more, given sorted (window, start)."""
    def repeated(p: Column, k: Column) -> Column:
        return (F.coalesce(F.get(pairs, k - 1)["w"] == p["w"], F.lit(False))
                | F.coalesce(F.get(pairs, k + 1)["w"] == p["w"], F.lit(False)))

    starts = F.array_sort(F.transform(F.filter(pairs, repeated), lambda p: p["i"]))
    return _let(starts, lambda s: F.aggregate(
        F.transform(s, lambda x, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(s, k + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x))


def repeat_words(hashes: Column) -> Column:
    """Words in 5-word windows found twice or more, the first included.

    A text without a repeated run of four words has no repeated window; only the
    others have their windows sorted. Windows are compared by 64-bit hashes:
    among the windows of one text of a million words two different ones agree
    with a chance of about 1 in 40 million.
    """
    four = hashes["four"]
    any_repeat = F.size(F.array_distinct(four)) < F.size(four)
    windows = F.transform(_pairs(four, hashes["one"], WINDOW - 1),
                          lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    return F.when(any_repeat, _let(F.sort_array(windows), _covered)).otherwise(
        F.lit(0).cast("long"))


def _bucket(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets)).cast("int")


def log_ratios(docs: DataFrame, trusted: DataFrame, *, text: str = "text",
               key: str = "doc_id", buckets: int = BUCKETS,
               smoothing: float = SMOOTHING) -> DataFrame:
    """One row with the log ratio of every bucket, counted over all documents.

    ``trusted`` has the keys of trusted documents. It is broadcast only after a
    count has bounded it. Counts are combined in every map task, so a task sends
    at most ``buckets`` rows. Without trusted documents all ratios are 0.
    """
    ids = broadcast_if_small(
        trusted.select(F.col(key).alias("_key")).where("_key is not null").distinct()
        .withColumn("_trusted", F.lit(1)))
    grams = docs.select(F.col(key).alias("_key"),
                        hashed(words_of(text_of(text))).alias("_h"))
    counts = (grams.join(ids, "_key", "left")
              .select("_trusted", F.explode(F.concat("_h.one", "_h.two")).alias("_gram"))
              .groupBy(_bucket(F.col("_gram"), buckets).alias("_bucket"))
              .agg(F.count("*").alias("_all"), F.count("_trusted").alias("_good")))
    counts = stored(counts, "quality-counts")
    spark = docs.sparkSession
    total = counts.agg(F.coalesce(F.sum("_all"), F.lit(0)).alias("_n"),
                       F.coalesce(F.sum("_good"), F.lit(0)).alias("_m"))
    n, m = total.first()
    if m == 0:
        ratio = F.lit(0.0)
    else:
        def share(column: str, of: int) -> Column:
            return F.log((F.coalesce(F.col(column), F.lit(0)) + smoothing)
                         / (of + smoothing * buckets))
        ratio = share("_good", m) - share("_all", n)
    every = spark.range(buckets).select(F.col("id").cast("int").alias("_bucket"))
    return (every.join(counts, "_bucket", "left")
            .select(F.struct("_bucket", ratio.alias("r")).alias("_entry"))
            .agg(F.transform(F.sort_array(F.collect_list("_entry")),
                             lambda e: e["r"]).alias("weights")))


def with_quality(docs: DataFrame, trusted: DataFrame, *, text: str = "text",
                 key: str = "doc_id", buckets: int = BUCKETS,
                 threshold: float = THRESHOLD, into: str = "quality") -> DataFrame:
    """All rows and columns, and a struct column ``into`` (replacing one of that
    name) with the counts, the score, and what the rules decided.

    A NULL text counts as empty; a text without words has score 0 and fails the
    base rules. Rows are judged one by one: repeated rows and NULL keys get a
    verdict each, NULL keys are never trusted. Any length of text is taken whole.
    """
    weights = log_ratios(docs, trusted, text=text, key=key, buckets=buckets)
    plain = docs.drop(into)
    value = text_of(text)
    lines = F.filter(F.split(value, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    q = F.col(into)
    words = plain.withColumn(into, F.struct(
        words_of(value).alias("words"),
        F.length(F.regexp_replace(value, "[^#*$%&|<>]+", "")).cast("long").alias("symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")
        .alias("dup_lines")))
    prepared = words.withColumn(into, F.struct(
        F.size(q["words"]).cast("long").alias("n"),
        F.length(F.array_join(q["words"], "")).cast("long").alias("chars"),
        q["symbols"].alias("symbols"), q["dup_lines"].alias("dup_lines"),
        hashed(q["words"]).alias("hashes"), weights.scalar().alias("weights")))

    def total(of: Column) -> Column:
        return F.aggregate(of, F.lit(0.0), lambda a, h: a + F.get(
            q["weights"], _bucket(h, buckets)))

    n, hashes = q["n"], q["hashes"]
    measured = prepared.withColumn(into, F.struct(
        n.alias("n_words"), q["chars"].alias("word_chars"), q["symbols"].alias("n_symbols"),
        q["dup_lines"].alias("n_dup_lines"), repeat_words(hashes).alias("n_repeat_words"),
        F.when(n > 0, (total(hashes["one"]) + total(hashes["two"])) / (2 * n - 1))
        .otherwise(0.0).alias("score")))
    failed = (q["n_words"] < MIN_WORDS) | (
        100 * q["n_repeat_words"] > MAX_REPEAT_PERCENT * q["n_words"])
    return measured.withColumn(into, q.withField("base_failed", failed)
                               .withField("kept", ~failed & (q["score"] >= threshold)))
