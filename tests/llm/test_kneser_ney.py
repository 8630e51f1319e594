"""Class-conditional Kneser-Ney against its definition, counted naively."""

import math
import random
from collections import Counter

import pytest

from gridstats.llm import toxicity as T


def naive_ratio(word, classes):
    """log p(word | toxic) - log p(word | ordinary) per character, from whole lists."""
    seen = [[g for w in words for g in T.grams_of(w)] for words in classes]
    kinds = [set(seen[0]) | set(seen[1])]            # different n-grams, top order first
    while any(len(g) > 1 for g in kinds[-1]):
        kinds.append({g[1:] for g in kinds[-1] if len(g) > 1})

    def shared(g, level):
        if not g or level == len(kinds):
            return 1 / T.CHARACTERS
        # How many different n-grams one longer end in each n-gram of this level.
        ends = Counter(longer[1:] for longer in kinds[level - 1] if len(longer) > 1)
        here = {k: n for k, n in ends.items() if k[:-1] == g[:-1]}
        if not here:
            return shared(g[1:], level + 1)
        total = sum(here.values())
        return (max(here.get(g, 0) - T.DISCOUNT, 0) / total
                + T.DISCOUNT * len(here) / total * shared(g[1:], level + 1))

    def p(g, grams):
        here = Counter(x for x in grams if x[:-1] == g[:-1])
        below = shared(g[1:], 1)
        if not here:
            return below
        total = sum(here.values())
        return (max(here[g] - T.DISCOUNT, 0) / total
                + T.DISCOUNT * len(here) / total * below)

    return sum(math.log(p(g, seen[1]) / p(g, seen[0])) for g in T.grams_of(word)) / (len(word) + 1)


@pytest.mark.parametrize("seed", range(3))
def test_model_equals_the_definition(seed):
    r = random.Random(seed)
    classes = [["".join(r.choice(letters) for _ in range(r.randrange(1, 7))) for _ in range(40)]
               for letters in ("abc", "abd")]
    counts = [Counter(g for w in words for g in T.grams_of(w)) for words in classes]
    model = T.kneser_ney({g: (counts[0][g], counts[1][g]) for g in {*counts[0], *counts[1]}})
    for word in classes[0][:8] + classes[1][:8] + ["abab", "zz", "dddd", "c", "abcabcabc"]:
        assert model.word(word) == pytest.approx(naive_ratio(word, classes), abs=1e-12)


def test_the_worst_words_stand_for_a_text_of_any_length():
    model = T.Model({}, {})
    model.word = {"a": 1.0, "b": -1.0, "c": 3.0, "d": 2.0}.__getitem__
    assert model.evidence("b " * 1000 + "a c b d") == pytest.approx(2.0)
    assert model.evidence("c") == pytest.approx(1.0) and model.evidence("") == 0.0


def test_a_document_with_both_labels_is_toxic_on_every_run(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(i, "vile vile scum" if i % 2 else "good kind words") for i in range(40)],
        "doc_id long, text string")
    labels = [(i, i % 2) for i in range(40)] + [(1, 0), (3, 0)] * 3
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    one, two = (T.train(docs, frame.repartition(n)) for n in (1, 5))
    assert one.gram == two.gram and one.slope == two.slope
    clean = T.train(docs, spark.createDataFrame(labels[:40], "doc_id long, toxic int"))
    assert clean.gram == one.gram
