"""Toxicity by class-conditional Kneser-Ney models.

Two models over character n-grams inside words, of toxic and of ordinary labelled
documents, are interpolated with absolute discounting. Their highest order is
counted per class; everything below is one chain of backoff distributions that the
classes share, built from the numbers of different characters an n-gram follows,
over both. A rare expression is thus judged by the parts it shares with others, and
what neither class has seen says nothing.

A word's evidence is its log-likelihood under the toxic model less that under the
ordinary one, divided by its length. Insults are few words among many, so a
document's evidence is the mean over its ``WORST`` most toxic words, wherever in
the text they stand. A logistic curve fitted on labelled documents held apart from
the counts turns it into a score.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.llm.shared import (
    Recent,
    broadcast_if_small,
    ship_package,
    stored,
    text_of,
    words_of,
)

ROWS_PER_CLASS = 2000      # labelled documents per class, at most, that a fit reads
CALIBRATION_SHARE = 0.25   # of them, for the logistic curve
ORDER = 5                  # characters of the longest n-grams
DISCOUNT = 0.75
CHARACTERS = 256           # the last backoff: any character, equally likely
WORST = 3
CACHED_WORDS = 800_000     # per worker process
CACHED_LENGTH = 48
START, END = "\x02", "\x03"

_BLANKS = {c: " " for c in range(9, 14)}


def _words(text: str) -> list[str]:
    # The JVM side lower-cases and cuts in the same way when it counts.
    return [w for w in text.lower().translate(_BLANKS).split(" ") if w]


def grams_of(word: str) -> list[str]:
    """Every character of the word and its end, after up to ORDER - 1 before it."""
    marked = START + word + END
    return [marked[max(0, k - ORDER + 1):k + 1] for k in range(1, len(marked))]


@dataclass
class Model:
    """Log ratios of seen n-grams and, for others, of their contexts: the shared
    backoff cancels out, so only the weights given to it differ."""

    gram: dict[str, float]
    context: dict[str, float]
    slope: float = 1.0
    offset: float = 0.0
    recent: Recent = field(default_factory=lambda: Recent(CACHED_WORDS))

    def __getstate__(self):
        return {**self.__dict__, "recent": Recent(CACHED_WORDS)}

    def word(self, word: str) -> float:
        value = self.recent.old.get(word)
        if value is None:
            total, gram, context = 0.0, self.gram.get, self.context.get
            for g in grams_of(word):
                ratio = gram(g)
                total += context(g[:-1], 0.0) if ratio is None else ratio
            value = total / (len(word) + 1)
        if len(word) <= CACHED_LENGTH:
            self.recent.put(word, value)
        return value

    def evidence(self, text: str | None) -> float:
        """Mean of the worst words; missing ones count 0, so that an empty text has 0."""
        words = _words(text) if text else []
        found = list(map(self.recent.new.get, words))
        if None in found:
            found = [self.word(w) if v is None else v for w, v in zip(words, found)]
        return sum(heapq.nlargest(WORST, found)) / WORST

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * evidence + self.offset, -30, 30)))


def _backoff(grams) -> list[tuple[Counter, Counter, Counter]]:
    """From the longest order below the top: how many different characters precede
    an n-gram, their sum per context, and the kinds of n-grams per context."""
    levels, current = [], set(grams)
    while True:
        current = [g[1:] for g in current if len(g) > 1]
        if not current:
            return levels
        count = Counter(current)
        total, kinds = Counter(), Counter()
        for g, n in count.items():
            total[g[:-1]] += n
            kinds[g[:-1]] += 1
        levels.append((count, total, kinds))
        current = list(count)


def _shared(gram: str, levels, level: int = 0) -> float:
    if not gram or level == len(levels):
        return 1 / CHARACTERS
    count, total, kinds = levels[level]
    below = _shared(gram[1:], levels, level + 1)
    here = total.get(gram[:-1], 0)
    if not here:
        return below
    return (max(count.get(gram, 0) - DISCOUNT, 0) + DISCOUNT * kinds[gram[:-1]] * below) / here


def kneser_ney(counts: dict[str, tuple[float, float]]) -> Model:
    """The model from occurrences of n-grams in (ordinary, toxic) documents."""
    levels = _backoff(counts)
    total, kinds = (Counter(), Counter()), (Counter(), Counter())
    for g, per_class in counts.items():
        for k, n in enumerate(per_class):
            if n > 0:
                total[k][g[:-1]] += n
                kinds[k][g[:-1]] += 1

    def weight(k: int, context: str) -> float:
        here = total[k].get(context, 0)
        return DISCOUNT * kinds[k][context] / here if here else 1.0

    gram, context = {}, {}
    for h in set(total[0]) | set(total[1]):
        context[h] = math.log(weight(1, h) / weight(0, h))
    for g, per_class in counts.items():
        below, h = _shared(g[1:], levels), g[:-1]
        p = [max(n - DISCOUNT, 0) / total[k][h] + weight(k, h) * below
             if total[k].get(h) else below for k, n in enumerate(per_class)]
        gram[g] = math.log(p[1] / p[0])
    return Model(gram, context)


def _calibrate(evidence: np.ndarray, label: np.ndarray, weight: np.ndarray):
    """Slope and offset of the logistic curve, by damped Newton steps."""
    scale = evidence.std() or 1.0
    x = np.stack([evidence / scale, np.ones(len(evidence))])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(beta @ x, -30, 30)))
        gradient = x @ (weight * (label - p)) - 1e-3 * beta
        curve = (x * weight * p * (1 - p)) @ x.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        beta = beta + step / max(1.0, np.abs(step).max())
    return beta[0] / scale, beta[1]


def evidence(text: Column, model) -> Column:
    ship_package()

    @F.pandas_udf("double")
    def worst_words(texts: pd.Series) -> pd.Series:
        fitted = model.value
        return pd.Series([fitted.evidence(t) for t in texts], dtype="float64")
    return worst_words(text)


def train(docs: DataFrame, labels: DataFrame, *, text: str = "text", key: str = "doc_id",
          label: str = "toxic", rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """The model fitted on at most ``rows_per_class`` labelled rows of each class,
    the first by a hash of the key, whole texts; NULL labels and keys are left out, and
    a key with both labels has label 1.

    Without labelled rows of both classes every score is near 1 if all labels are 1,
    else near 0.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where(
        "k is not null and y in (0, 1)").groupBy("k").agg(F.max("y").alias("y"))
    totals = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(totals) < 2:
        return Model({}, {}, 0.0, 30.0 if totals.get(1) else -30.0)
    chosen = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(rows_per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    held = F.pmod(F.xxhash64(F.lit("calibrate"), F.col("k")), F.lit(1000)) \
        < int(1000 * CALIBRATION_SHARE)
    chosen = stored(chosen.withColumn("held", held), "toxicity-rows")
    sample = stored(docs.select(F.col(key).alias("k"), text_of(text).alias("t")).join(
        broadcast_if_small(chosen), "k"), "toxicity-sample")

    counted = sample.where(~F.col("held")).select("y", F.explode(words_of(
        F.lower("t"))).alias("w"))
    words = counted.groupBy("w").agg(F.sum(1 - F.col("y")).alias("n0"), F.sum("y").alias("n1"))
    marked = F.concat(F.lit(START), "w", F.lit(END))
    grams = F.transform(F.sequence(F.lit(2), F.char_length("w") + 2), lambda k: F.substring(
        marked, F.greatest(k - (ORDER - 1), F.lit(1)), F.least(k, F.lit(ORDER))))
    counts = words.select(F.explode(grams).alias("g"), "n0", "n1").groupBy("g").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).orderBy("g").toPandas()
    model = kneser_ney({g: (a, b) for g, a, b in zip(counts["g"], counts["n0"], counts["n1"])})
    apart = sample.where("held").select("y", evidence(
        F.col("t"), spark.sparkContext.broadcast(model)).alias("e")).toPandas()
    y = apart["y"].to_numpy()
    if len(set(y)) == 2:
        share = np.array([totals[0] / (y == 0).sum(), totals[1] / (y == 1).sum()])
        weight = share[y] / share[y].mean()
        model.slope, model.offset = _calibrate(apart["e"].to_numpy(), y, weight)
        model.slope = max(model.slope, 0.0)
    return model


def with_toxicity(docs: DataFrame, model: Model, *, text: str = "text",
                  into: str = "toxicity") -> DataFrame:
    """All rows and columns, and a column ``into`` (replacing one of that name) with
    the score of every whole text, from 0 to 1. NULL and empty texts have the score
    of no evidence."""
    ship_package()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        fitted = shared.value
        return pd.Series(fitted.score(np.array([fitted.evidence(t) for t in texts])))
    return docs.withColumn(into, score(text_of(text)))
