"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a text segment form a linked list; a heap holds its adjacent pairs
by merge rank. The lowest pair is popped and merged again and again, and the count
is the number of symbols less the number of merges: no identifiers are made.
Segments end where no vocabulary entry can cross, so each is merged on its own and
a task looks a repeated segment up.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from gridstats.llm.shared import Recent, ship_package

SPACE = "▁"           # how the vocabulary writes a blank
CACHED_SEGMENTS = 800_000  # of words, and as many of parts, per worker process
CACHED_LENGTH = 48         # characters up to which a segment is worth keeping


def count_after_merging(symbols: str, ranks: dict[str, float]) -> int:
    """Symbols left after merging; the lowest rank first, of equals the leftmost."""
    left = n = len(symbols)
    if n < 2:
        return n
    parts, rank_of = list(symbols), ranks.get
    heap = []
    for i in range(n - 1):
        pair = symbols[i:i + 2]
        rank = rank_of(pair)
        if rank is not None:
            heap.append((rank, i, pair))
    if not heap:
        return n
    heapq.heapify(heap)
    following, preceding = list(range(1, n + 1)), list(range(-1, n - 1))
    while heap:
        _, at, made = heapq.heappop(heap)
        other = following[at]
        # An entry is stale if either half has been merged since.
        if parts[at] is None or other >= n or parts[at] + parts[other] != made:
            continue
        parts[at], parts[other] = made, None
        left -= 1
        after, before = following[other], preceding[at]
        following[at] = after
        if after < n:
            preceding[after] = at
            pair = made + parts[after]
            rank = rank_of(pair)
            if rank is not None:
                heapq.heappush(heap, (rank, at, pair))
        if before >= 0:
            pair = parts[before] + made
            rank = rank_of(pair)
            if rank is not None:
                heapq.heappush(heap, (rank, before, pair))
    return left


class PieceCounter:
    """Counts tokens of a byte-pair piece vocabulary with byte fallback.

    Ranks come from the vocabulary's scores. A character outside the vocabulary
    stands for one token per byte and never merges, so segments end there too.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ranks = {model.id_to_piece(i): -model.get_score(i)
                      for i in range(model.vocab_size())
                      if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ranks):
            raise ValueError("a piece crosses the end of a word")
        self.known = {p for p in self.ranks if len(p) == 1}
        # No token can hold two neighbours that no vocabulary entry holds.
        self.neighbours = {p[i:i + 2] for p in self.ranks for i in range(len(p) - 1)}
        self.words, self.parts = Recent(CACHED_SEGMENTS), Recent(CACHED_SEGMENTS)

    def _part(self, part: str) -> int:
        n = self.parts.get(part)
        if n is None:
            if len(part) == 1 and part not in self.known:
                n = len(part.encode())
            else:
                n = count_after_merging(part, self.ranks)
            if len(part) <= CACHED_LENGTH:
                self.parts.put(part, n)
        return n

    def _word(self, word: str) -> int:
        n = self.words.old.get(word)
        if n is None:
            marked, start, n = SPACE + word, 0, 0
            joined = self.neighbours
            for i in range(1, len(marked)):
                if marked[i - 1:i + 1] not in joined:
                    n += self._part(marked[start:i])
                    start = i
            n += self._part(marked[start:])
        if len(word) <= CACHED_LENGTH:
            self.words.put(word, n)
        return n

    def _total(self, words: list[str]) -> int:
        found = list(map(self.words.new.get, words))
        if None not in found:
            return sum(found)
        return sum(self._word(w) if n is None else n for w, n in zip(words, found))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        # The vocabulary starts a text with a blank; a run of blanks goes with the
        # word after it. Words are looked up without the blank that starts them.
        plain = text.replace(SPACE, " ") if SPACE in text else text
        if plain[0] != " " and "  " not in plain:
            return self._total(plain.split(" "))
        marked = SPACE + plain.replace(" ", SPACE)
        return self._total([s[1:] for s in re.findall(f"{SPACE}+[^{SPACE}]*", marked)])


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def token_counts(text: Column, vocabulary: str = "piece_bpe_32k.model") -> Column:
    """Tokens of every text, as a long; ``vocabulary`` is a path, or the name of a
    public vocabulary file. NULL and empty texts have none; texts of any length
    are counted whole; special strings inside a text are ordinary text."""
    ship_package()

    @F.pandas_udf(LongType())
    def tokens(texts: pd.Series) -> pd.Series:
        import os

        path = vocabulary
        if not os.path.exists(path):
            import public_tokenizers

            path = public_tokenizers.path(vocabulary)
        count = counter(path).count
        return pd.Series([count(t) for t in texts], dtype="int64")
    return tokens(text)
