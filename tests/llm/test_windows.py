"""Windows that are not decoded change nothing."""

import random

import numpy as np
import pytest

from gridstats.llm import pii


@pytest.fixture(scope="module")
def tagger():
    return pii.fit(*pii.training_windows([]))


def every_window(text, tagger):
    """Added spans with all windows decoded, every character from the most central."""
    count = max(0, -(-(len(text) - pii.WINDOW) // pii.STRIDE)) + 1
    codes = np.full((count, pii.WINDOW), pii.PAD)
    for n in range(count):
        piece = pii.codes_of(text[n * pii.STRIDE:n * pii.STRIDE + pii.WINDOW])
        codes[n, :len(piece)] = piece
    best = {}
    for n, row in enumerate(tagger.decode(codes)):
        for at, tag in enumerate(row.tolist()):
            best.setdefault(n * pii.STRIDE + at, []).append((min(at, pii.WINDOW - 1 - at), tag))
    tags = [pii.TAGS[max(best[at])[1]] for at in range(len(text))]
    spans, before = [], "O"
    for at, tag in enumerate(tags):
        if tag[0] == "I" and before[1:] == tag[1:]:
            spans[-1][2] = at + 1
        elif tag != "O":
            spans.append([tag[2:], at, at + 1])
        before = tag
    return pii._added(text, pii.base_spans(text), spans)


def test_skipped_windows_change_nothing(tagger):
    rng = np.random.default_rng(11)
    choose = random.Random(11)
    spellings = [" (AT) ", "[At]", " {  at } ", "(\tat\n)", "[  AT]", "( at )"]
    texts = []
    for k in range(400):
        words = ["".join(choose.choice("abcdefghijklmnop") for _ in range(choose.randint(2, 9)))
                 for _ in range(60)]
        for _ in range(choose.randint(0, 4)):
            kind = choose.choice(pii.KINDS)
            value = pii._respelled(kind, pii._made(kind, rng), rng)
            if kind == "email" and choose.random() < 0.7:
                value = f"{words[0]}{choose.choice(spellings)}{words[1]}.org"
            words.insert(choose.randrange(len(words)), value)
        texts.append("x" * (k % 40) + " ".join(words))
    texts += ["I" * 300, "a@" * 90, "7" * 200, "mail (at) x", "@", ""]
    expected = [every_window(t, tagger) if t else [] for t in texts]
    assert [added for _, added in pii.find(texts, tagger)] == expected
    assert sum(map(len, expected)) > 200


def always(kind):
    """A tagger that takes every run of letters, brackets, dots and blanks for one span."""
    class Always:
        def decode(self, codes):
            tags = np.full(codes.shape, pii.TAGS.index(f"I-{kind}"))
            tags[codes == ord("|") - 32 + 5] = 0
            return tags
    return Always()


@pytest.mark.parametrize("at", ["(AT)", "[At]", "{ at }", "(  at\t)"])
def test_upper_case_and_spaced_at_signs_are_decoded(at):
    name, host = "jane" * 40, "example" * 20
    text = "|" * 70 + f"{name} {at} {host}.org" + "|" * 90
    (_, added), = pii.find([text], always("email"))
    assert added == every_window(text, always("email")) == [("email", 70, len(text) - 90)]
