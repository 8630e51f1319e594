"""Personal data: fixed patterns, and a character BiLSTM with CRF transitions.

The patterns give the base spans. The tagger, trained in numpy on labelled spans,
finds the same kinds in other spellings: a bidirectional LSTM reads windows of
characters, a CRF over its scores decodes each window, and overlapping windows are
reconciled over the whole text: every character takes its tag from the window in
which it lies most centrally, and spans are read from the one resulting sequence.
A tagged span is reported if, undone of its spelling, it is valid for its kind and
touches no base span.

A valid span holds a digit, an at sign or a bracketed "at". Only the windows that
decide the tags of such characters are decoded, and, as long as a span reaches the
edge of what is decided, the windows beside it: the others cannot change the result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.llm.shared import ship_package, text_of

KINDS = ("email", "ip", "card", "phone")

WINDOW, STRIDE = 64, 32
EMBEDDING, HIDDEN = 12, 20          # per character, per direction
EPOCHS, BATCH, RATE = 8, 32, 0.01
SEED = 2
TRAIN_ROWS = 300                    # labelled documents the tagger is fitted on, at most
TRAIN_WINDOWS = 900                 # windows of them, at most
SYNTHETIC_SPANS = 360               # labelled spans made from the formats, always added
WINDOWS_AT_ONCE = 2048

# --- base patterns ----------------------------------------------------------------

# The formats of the base spans.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9]+\.[0-9]+\.[0-9]+\.[0-9]+)|[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    twice = (sum(divmod(2 * v, 10)) for v in values[1::2])
    return (sum(values[::2]) + sum(twice)) % 10 == 0


def _digits(value: str) -> str:
    return "".join(c for c in value if "0" <= c <= "9")


def _card_ok(value: str) -> bool:
    digits = _digits(value)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _ip_ok(value: str) -> bool:
    parts = [p.lstrip("0") or "0" for p in value.split(".")]
    return all(len(p) <= 3 and int(p) <= 255 for p in parts)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From every at sign outwards: the local part reaches back as far as its
    characters go, but not into the match before. Linear, whatever the text."""
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            last = match.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", last)


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start; leftmost, not overlapping per kind.

    A run of digits that starts no address is passed over whole: where its first
    digit starts none, neither do the others.
    """
    if not text or not _TRIGGER.search(text):
        return []
    found = [("email", s, e) for s, e in _emails(text)]
    found += [("ip", *m.span()) for m in _IP.finditer(text) if m[1] and _ip_ok(m[1])]
    found += [("card", *m.span()) for m in _CARD.finditer(text) if _card_ok(m[0])]
    found += [("phone", *m.span()) for m in _PHONE.finditer(text)
              if 9 <= len(_digits(m[0])) <= 15]
    return found


def joined(spans: list[tuple[str, int, int]]) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in ordered)


# --- other spellings ----------------------------------------------------------------

_AT = re.compile(r"\s*[(\[{]\s*at\s*[)\]}]\s*|\s*@\s*", re.I)
_DOT = re.compile(r"\s*[(\[{]\s*(?:dot|\.)\s*[)\]}]\s*", re.I)
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_SPELLED_CARD = re.compile(r"[0-9](?:[\s./_\-]{0,2}[0-9])+")
_SPELLED_PHONE = re.compile(r"(?:00|\(|[0-9])[\s()./0-9-]*[0-9]")


def plausible(kind: str, value: str) -> bool:
    """Whether a tagged span is the kind it claims to be, its spelling undone."""
    if kind == "email":
        return bool(_EMAIL.fullmatch(_DOT.sub(".", _AT.sub("@", value))))
    if kind == "ip":
        plain = re.sub(r"\s*[,:]\s*|\s+\.\s*|\.\s+", ".", _DOT.sub(".", value))
        return bool(re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", plain)) and _ip_ok(plain)
    if kind == "card":
        return bool(_SPELLED_CARD.fullmatch(value)) and _card_ok(value)
    separated = value.startswith("00") or len(re.findall(r"[\s()./-]+", value)) >= 2
    return (bool(_SPELLED_PHONE.fullmatch(value)) and separated
            and 9 <= len(_digits(value)) <= 15)


# --- the tagger ---------------------------------------------------------------------

TAGS = ("O",) + tuple(f"{p}-{k}" for k in KINDS for p in "BI")
_NOT = -1e4


def _may_follow() -> np.ndarray:
    allowed = np.zeros((len(TAGS), len(TAGS)))
    for j, tag in enumerate(TAGS):
        if tag[0] == "I":
            for i, before in enumerate(TAGS):
                if before[1:] != tag[1:]:
                    allowed[i, j] = _NOT
    return allowed


ALLOWED = _may_follow()
START = np.array([_NOT if t[0] == "I" else 0.0 for t in TAGS])
PAD, LINE, OTHER_SPACE, LETTER, OTHER = range(5)


def codes_of(text: str) -> np.ndarray:
    """A small alphabet: printable ASCII by itself, the rest by its class."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    codes = np.where((points >= 32) & (points < 127), points - 32 + 5, 0)
    for i in np.flatnonzero(codes == 0):
        c = text[i]
        codes[i] = LINE if c == "\n" else OTHER_SPACE if c.isspace() else \
            LETTER if c.isalpha() else OTHER
    return codes


@dataclass
class Tagger:
    """Weights of the network; one array per layer and direction."""

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, random: np.random.Generator) -> Tagger:
        def normal(*shape):
            return random.normal(0, 1 / np.sqrt(shape[0]), shape)

        w = {"embed": random.normal(0, 0.3, (100, EMBEDDING)),
             "out": normal(2 * HIDDEN, len(TAGS)), "out_b": np.zeros(len(TAGS)),
             "trans": np.zeros((len(TAGS), len(TAGS)))}
        for d in "fb":
            w[f"x{d}"] = normal(EMBEDDING, 4 * HIDDEN)
            w[f"h{d}"] = normal(HIDDEN, 4 * HIDDEN)
            w[f"b{d}"] = np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]
        return cls(w)

    def _run(self, x: np.ndarray, d: str, keep: bool):
        """One direction over (time, batch, embedding): hidden states, and what
        the backward pass needs."""
        w, steps = self.weights, x.shape[0]
        order = range(steps) if d == "f" else range(steps - 1, -1, -1)
        inputs = x @ w[f"x{d}"] + w[f"b{d}"]
        h = np.zeros((x.shape[1], HIDDEN), x.dtype)
        c = np.zeros_like(h)
        out, saved = np.empty((*x.shape[:2], HIDDEN), x.dtype), []
        for t in order:
            z = inputs[t] + h @ w[f"h{d}"]
            gates = 1 / (1 + np.exp(-z[:, :3 * HIDDEN]))
            i, f, o = np.split(gates, 3, axis=1)
            g = np.tanh(z[:, 3 * HIDDEN:])
            before, c = c, f * c + i * g
            tanh = np.tanh(c)
            if keep:
                saved.append((t, i, f, o, g, before, tanh, h))
            h = o * tanh
            out[t] = h
        return out, saved

    def scores(self, codes: np.ndarray, keep: bool = False):
        """Tag scores as (time, batch, tag) for codes as (batch, time)."""
        x = self.weights["embed"][codes.T]
        forward, saved_f = self._run(x, "f", keep)
        backward, saved_b = self._run(x, "b", keep)
        both = np.concatenate([forward, backward], axis=2)
        return both @ self.weights["out"] + self.weights["out_b"], (x, both, saved_f, saved_b)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """Best tag sequence of every window under scores and transitions."""
        scores, _ = self.scores(codes)
        steps = self.weights["trans"] + ALLOWED
        best, back = scores[0] + START, []
        for t in range(1, len(scores)):
            paths = best[:, :, None] + steps
            back.append(paths.argmax(1))
            best = paths.max(1) + scores[t]
        tags = [best.argmax(1)]
        for pointers in reversed(back):
            tags.append(np.take_along_axis(pointers, tags[-1][:, None], 1)[:, 0])
        return np.stack(tags[::-1], axis=1)

    # -- training ---------------------------------------------------------------

    def _crf_gradient(self, scores: np.ndarray, gold: np.ndarray):
        """Gradients of the negative log-likelihood by forward-backward."""
        trans, (steps, batch, _) = self.weights["trans"], scores.shape

        def lse(a, axis):
            top = a.max(axis, keepdims=True)
            return (np.log(np.exp(a - top).sum(axis, keepdims=True)) + top).squeeze(axis)

        ahead, behind = np.empty_like(scores), np.zeros_like(scores)
        ahead[0] = scores[0]
        for t in range(1, steps):
            ahead[t] = lse(ahead[t - 1][:, :, None] + trans, 1) + scores[t]
        for t in range(steps - 2, -1, -1):
            behind[t] = lse(trans + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
        total = lse(ahead[-1], 1)
        by_score = np.exp(ahead + behind - total[None, :, None])
        pairs = np.exp(ahead[:-1][..., None] + trans + (scores + behind)[1:][:, :, None, :]
                       - total[None, :, None, None])
        by_trans = pairs.sum((0, 1))
        rows = np.arange(batch)
        for t in range(steps):
            by_score[t, rows, gold[:, t]] -= 1
        np.subtract.at(by_trans, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
        return by_score / batch, by_trans / batch

    def _lstm_gradient(self, d: str, x, saved, by_out, grads) -> np.ndarray:
        w = self.weights
        by_x = np.zeros_like(x)
        by_h = np.zeros((x.shape[1], HIDDEN))
        by_c = np.zeros_like(by_h)
        for t, i, f, o, g, before, tanh, h in reversed(saved):
            by_h = by_h + by_out[t]
            by_c = by_c + by_h * o * (1 - tanh ** 2)
            by_z = np.concatenate([by_c * g * i * (1 - i), by_c * before * f * (1 - f),
                                   by_h * tanh * o * (1 - o), by_c * i * (1 - g ** 2)], axis=1)
            grads[f"x{d}"] += x[t].T @ by_z
            grads[f"h{d}"] += h.T @ by_z
            grads[f"b{d}"] += by_z.sum(0)
            by_x[t] = by_z @ w[f"x{d}"].T
            by_h, by_c = by_z @ w[f"h{d}"].T, by_c * f
        return by_x

    def gradients(self, codes: np.ndarray, gold: np.ndarray) -> dict[str, np.ndarray]:
        scores, (x, both, saved_f, saved_b) = self.scores(codes, keep=True)
        by_score, by_trans = self._crf_gradient(scores, gold)
        grads = {k: np.zeros_like(v) for k, v in self.weights.items()}
        grads["trans"] = by_trans
        grads["out"] = np.einsum("tbh,tbk->hk", both, by_score)
        grads["out_b"] = by_score.sum((0, 1))
        by_both = by_score @ self.weights["out"].T
        by_x = self._lstm_gradient("f", x, saved_f, by_both[..., :HIDDEN], grads)
        by_x += self._lstm_gradient("b", x, saved_b, by_both[..., HIDDEN:], grads)
        np.add.at(grads["embed"], codes.T, by_x)
        return grads


def fit(codes: np.ndarray, gold: np.ndarray) -> Tagger:
    """Adam over shuffled batches; repeatable."""
    random = np.random.default_rng(SEED)
    tagger = Tagger.fresh(random)
    mean = {k: np.zeros_like(v) for k, v in tagger.weights.items()}
    square = {k: np.zeros_like(v) for k, v in tagger.weights.items()}
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(codes))
        for at in range(0, len(order), BATCH):
            rows, step = order[at:at + BATCH], step + 1
            for k, g in tagger.gradients(codes[rows], gold[rows]).items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.001 * (g * g - square[k])
                rate = RATE * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                tagger.weights[k] -= rate * mean[k] / (np.sqrt(square[k]) + 1e-8)
    return Tagger({k: v.astype(np.float32) for k, v in tagger.weights.items()})


# --- labelled windows -----------------------------------------------------------------

def _respelled(kind: str, value: str, random: np.random.Generator) -> str:
    """The span in another spelling of its kind, or as it is."""
    if random.random() < 0.4:
        return value
    if kind == "email":
        at = str(random.choice([" at@ ".replace("at@", "@"), " (at) ", "[at]", " [at] ", "(at)"]))
        return value.replace("@", at).replace(".", str(random.choice([".", "[dot]", " (dot) "])))
    if kind == "ip":
        return value.replace(".", str(random.choice(["[.]", " . ", "(.)", "[dot]"])))
    digits = _digits(value)
    if kind == "card":
        return str(random.choice([".", "/", "_", "  ", " - "])).join(
            digits[i:i + 4] for i in range(0, len(digits), 4))
    return str(random.choice(["", "00"])) + re.sub(r"^\+", "", value)


def _made(kind: str, random: np.random.Generator) -> str:
    """A span of the kind's format."""
    def number(n: int) -> str:
        return "".join(map(str, random.integers(0, 10, n)))

    def name() -> str:
        return "".join(chr(97 + c) for c in random.integers(0, 26, random.integers(2, 9)))

    if kind == "email":
        return f"{name()}{number(int(random.integers(0, 3)))}@{name()}.{name()[:3]}"
    if kind == "ip":
        return ".".join(map(str, random.integers(0, 256, 4)))
    if kind == "card":
        body = number(15)
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))
    return f"+{random.integers(1, 99)} ({number(3)}) {number(3)}-{number(4)}"


def _window(before: str, span: str, after: str, kind: str | None,
            random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """A window with the span at a random place and the tags of its characters."""
    text = before[-WINDOW:] + span + after[:WINDOW]
    start = min(len(before), WINDOW)
    low = max(0, start + len(span) - WINDOW)
    at = int(random.integers(min(low, start), start + 1))
    codes, tags = np.full(WINDOW, PAD), np.zeros(WINDOW, np.int64)
    piece = text[at:at + WINDOW]
    codes[:len(piece)] = codes_of(piece)
    if kind is not None:
        tag = TAGS.index(f"B-{kind}")
        tags[start - at:start - at + len(span)] = tag + 1
        if start - at < WINDOW:
            tags[start - at] = tag
    return codes, tags


def training_windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows around labelled spans of the texts, around digits that are none, and
    around spans made from the formats; some in other spellings."""
    random = np.random.default_rng(SEED)
    windows: list[tuple[np.ndarray, np.ndarray]] = []
    for text in texts:
        spans = base_spans(text)
        for kind, s, e in spans:
            windows.append(_window(text[max(0, s - WINDOW):s],
                                   _respelled(kind, text[s:e], random),
                                   text[e:e + WINDOW], kind, random))
        for m in re.finditer(r"\S*[0-9]\S*", text):
            if not any(s < m.end() and m.start() < e for _, s, e in spans):
                windows.append(_window(text[max(0, m.start() - WINDOW):m.start()], m[0],
                                       text[m.end():m.end() + WINDOW], None, random))
    if len(windows) > TRAIN_WINDOWS:
        windows = [windows[i] for i in random.permutation(len(windows))[:TRAIN_WINDOWS]]
    for n in range(SYNTHETIC_SPANS):
        kind = KINDS[n % len(KINDS)]
        words = ["".join(chr(97 + c) for c in random.integers(0, 26, random.integers(2, 9)))
                 for _ in range(24)]
        windows.append(_window(" ".join(words[:12]) + " ",
                               _respelled(kind, _made(kind, random), random),
                               " " + " ".join(words[12:]), kind, random))
    return (np.stack([w[0] for w in windows]), np.stack([w[1] for w in windows]))


def train(docs: DataFrame, *, text: str = "text", key: str = "doc_id",
          rows: int = TRAIN_ROWS) -> Tagger:
    """The tagger fitted on at most ``rows`` documents with digits or at signs, of
    each only what lies around them. Without any, on made spans alone."""
    t = F.col(text).cast("string")
    # A document's surroundings of digits, 120 at most; only labels are read from them.
    around = F.slice(F.regexp_extract_all(t, F.lit(
        "[^\\n]{0,64}[0-9@][^\\n]{0,96}"), 0), 1, 120)
    chosen, order = t.rlike("[0-9@]"), F.xxhash64(F.col(key), t)
    # The documents least by hash. Those above a bound that twice as many stay below
    # are left out before they are ordered, so that what comes to the driver does not
    # grow with the table.
    share = min(1.0, (2 * rows + 100) / max(1, docs.where(chosen).count()))
    bound = min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
    sample = (docs.where(order <= F.lit(bound)).where(chosen)
              .orderBy(order, F.col(key)).limit(rows)
              .select(F.array_join(around, "\n").alias("t")))
    return fit(*training_windows([r["t"] for r in sample.collect()]))


# --- whole texts ------------------------------------------------------------------------

# What a valid span holds: digits, or what ``_AT`` takes for an at sign.
_NEEDED = re.compile(r"[0-9@]+|[(\[{]\s*at\s*[)\]}]", re.I)
MARGIN = (WINDOW - STRIDE) // 2


def _last(text: str) -> int:
    """Number of the last of the windows that cover the text."""
    return max(0, -(-(len(text) - WINDOW) // STRIDE))


def _decided(n: int, last: int) -> tuple[int, int]:
    """First and last place in window ``n`` of the characters nearest to its middle,
    by which every character of a text belongs to one window."""
    return 0 if n == 0 else MARGIN, WINDOW if n == last else MARGIN + STRIDE


def _triggered(text: str) -> set[int]:
    """Windows that decide characters of which a valid span holds some."""
    wanted: set[int] = set()
    last = _last(text)
    for m in _NEEDED.finditer(text):
        low, high = (max(0, min(last, (at - MARGIN) // STRIDE)) for at in (m.start(), m.end() - 1))
        wanted.update(range(low, high + 1))
    return wanted


def _beside(rows: dict[int, np.ndarray], text: str) -> set[int]:
    """Windows not decoded yet into which a span may reach."""
    wanted: set[int] = set()
    last = _last(text)
    for n, row in rows.items():
        low, high = _decided(n, last)
        if n > 0 and n - 1 not in rows and TAGS[row[low]][0] == "I":
            wanted.add(n - 1)
        if n < last and n + 1 not in rows and row[high - 1]:
            wanted.add(n + 1)
    return wanted


def _spans(rows: dict[int, np.ndarray], text: str) -> list[tuple[str, int, int]]:
    """Spans of one text from its decoded windows, by number."""
    found, open_, last = [], None, _last(text)
    for n in sorted(rows):
        low, high = _decided(n, last)
        for at in (np.flatnonzero(rows[n][low:high]) + low).tolist():
            place, tag = n * STRIDE + at, TAGS[rows[n][at]]
            if place >= len(text):
                break
            if open_ and tag == f"I-{open_[0]}" and place == open_[2]:
                open_[2] = place + 1
                continue
            if open_:
                found.append(tuple(open_))
            open_ = [tag[2:], place, place + 1]
    if open_:
        found.append(tuple(open_))
    return found


def _added(text: str, base: list, tagged: list) -> list[tuple[str, int, int]]:
    added = []
    for kind, s, e in tagged:
        while s < e and text[s].isspace():
            s += 1
        while e > s and text[e - 1].isspace():
            e -= 1
        beside = text[max(0, s - 1):s] + text[e:e + 1]
        if (not any(c.isalnum() for c in beside) and plausible(kind, text[s:e])
                and not any(b < e and s < f for _, b, f in base)):
            added.append((kind, s, e))
    return added


def find(texts: list[str | None], tagger: Tagger) -> list[tuple[list, list]]:
    """(base spans, added spans) of every text, whole."""
    base = [base_spans(t) for t in texts]
    added: list[list] = [[] for _ in texts]
    waiting: dict[int, set[int]] = {}
    held = 0

    def flush() -> None:
        rows: dict[int, dict[int, np.ndarray]] = {n: {} for n in waiting}
        wanted = waiting
        while wanted:
            places = [(n, w) for n, windows in wanted.items() for w in sorted(windows)]
            for i in range(0, len(places), WINDOWS_AT_ONCE):
                part = places[i:i + WINDOWS_AT_ONCE]
                codes = np.full((len(part), WINDOW), PAD)
                for row, (n, w) in zip(codes, part):
                    piece = codes_of(texts[n][w * STRIDE:w * STRIDE + WINDOW])
                    row[:len(piece)] = piece
                for (n, w), tags in zip(part, tagger.decode(codes)):
                    rows[n][w] = tags
            wanted = {n: more for n in wanted if (more := _beside(rows[n], texts[n]))}
        for n in waiting:
            added[n] = _added(texts[n], base[n], _spans(rows[n], texts[n]))

    for n, text in enumerate(texts):
        windows = _triggered(text) if text else set()
        if windows:
            waiting[n] = windows
            held += len(windows)
            if held >= WINDOWS_AT_ONCE:
                flush()
                waiting, held = {}, 0
    flush()
    return list(zip(base, added))


FOUND_SCHEMA = ("struct<n_email: long, n_ip: long, n_card: long, n_phone: long,"
                " base_sha256: string, spans: string>")


def personal_data(text: Column, tagger: Tagger) -> Column:
    """Counts per kind, the digest of the base spans, and all spans of every text;
    NULL is empty, an empty text has none. Offsets are code points."""
    ship_package()

    @F.pandas_udf(FOUND_SCHEMA)
    def search(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for base, added in find(list(texts), tagger):
            spans = base + added
            rows.append([sum(k == kind for k, _, _ in spans) for kind in KINDS]
                        + [hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)])
        return pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
    return search(text)


def with_personal_data(docs: DataFrame, *, text: str = "text", key: str = "doc_id",
                       into: str = "personal") -> DataFrame:
    """All rows and columns, and a struct column ``into`` (replacing one of that name)."""
    tagger = train(docs, text=text, key=key)
    return docs.withColumn(into, personal_data(text_of(text), tagger))
