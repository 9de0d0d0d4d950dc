"""Periodic runs: longest common extensions by a difference cover drive a harmonic grid.

A run is a stretch of words that repeats with a period, at least twice, and that no neighbouring word
extends. For every period the positions on its grid are compared with those one period on: how far two
positions agree to the right and to the left tells the stretch. Only the suffixes at positions of a
difference cover are sorted; two positions reach sampled ones within a few words, and a sparse table of
minima over the sorted samples has the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm import suffixes
from gridtally.llm.common import WORDS

#: A perfect difference cover: every remainder is the difference of two members.
MODULUS, COVER = 13, (0, 1, 3, 9)
#: A run has at least so many words.
LEAST_LENGTH = 12
#: A run agrees with itself one period on over at least so many words, half the least length; so of a
#: grid position's neighbours half of that agree on one side.
SIDE = LEAST_LENGTH // 4
#: Words whose samples are sorted together, and grid positions compared at once.
BATCH_WORDS, BATCH_PAIRS = 200_000, 2_000_000

SCHEMA = "n_words long, runs array<struct<start: long, length: long, period: long>>, kept string"


def _shifts() -> np.ndarray:
    """[i % MODULUS, j % MODULUS]: the least shift that brings both to the cover."""
    table = np.full((MODULUS, MODULUS), MODULUS, np.int64)
    for i in range(MODULUS):
        for j in range(MODULUS):
            table[i, j] = next(
                d for d in range(MODULUS) if (i + d) % MODULUS in COVER and (j + d) % MODULUS in COVER
            )
    return table


SHIFTS = _shifts()


class Extensions:
    """How many words from two positions on are equal."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        ends = ids.min(initial=0) - 1 - np.arange(2 * MODULUS)  # equal to nothing
        self.ids = np.concatenate([ids, ends])
        # Each class of positions up to the first end, so that its last window is like no other.
        classes = [np.arange(r, n + 1, MODULUS) for r in COVER]
        at = np.concatenate(classes)
        windows = self.ids[at[:, None] + np.arange(MODULUS)]
        names = _names(windows)
        seq, word = [], []
        used = 0
        for k, c in enumerate(classes):
            seq += [names[used:used + len(c)], np.array([-1 - k])]
            word += [c, np.array([n])]
            used += len(c)
        word = np.concatenate(word)
        order, levels = suffixes.suffix_array(np.concatenate(seq))
        blocks = suffixes.common_prefixes(order, levels)
        self.rank = np.zeros(n + 1, np.int64)
        sampled = np.concatenate([np.append(np.ones(len(c), bool), False) for c in classes])
        self.rank[word[order[sampled[order]]]] = np.flatnonzero(sampled[order])
        common = blocks * MODULUS
        common[1:] += self._compared(word[order[1:]] + common[1:], word[order[:-1]] + common[1:],
                                     np.full(len(order) - 1, MODULUS))
        self.minima = [common.astype(np.int32)]
        width = 1
        while 2 * width <= len(common):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _compared(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, word by word, up to ``most`` of them."""
        equal = np.zeros(len(i), np.int64)
        going = np.arange(len(i))
        for d in range(MODULUS):
            going = going[d < most[going]]
            going = going[self._word(i[going] + d) == self._word(j[going] + d)]
            equal[going] += 1
        return equal

    def _word(self, at: np.ndarray) -> np.ndarray:
        return self.ids[np.minimum(at, len(self.ids) - 1)]

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For positions i < j up to the end: the length of their common extension."""
        shift = SHIFTS[i % MODULUS, j % MODULUS]
        equal = self._compared(i, j, shift)
        far = np.flatnonzero(equal == shift)
        a, b = self.rank[i[far] + shift[far]], self.rank[j[far] + shift[far]]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp(high - low + 1)[1] - 1
        least = np.empty(len(far), np.int64)
        for k in np.unique(level):
            of = np.flatnonzero(level == k)
            least[of] = np.minimum(self.minima[k][low[of]], self.minima[k][high[of] + 1 - (1 << k)])
        equal[far] += least
        return equal


def _names(windows: np.ndarray) -> np.ndarray:
    """The rank of each window among the distinct ones, in the order of their words."""
    order = np.lexsort(windows.T[::-1])
    fresh = np.any(windows[order[1:]] != windows[order[:-1]], axis=1)
    names = np.empty(len(windows), np.int64)
    names[order] = np.append(0, np.cumsum(fresh))
    return names


def grid(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions i and periods p: every i on the grid of p with i + p < n, 2 p <= n, in parts."""
    periods = np.arange(1, n // 2 + 1)
    counts = (n - 1) // periods
    upto = np.cumsum(counts)
    begin = 0
    while begin < len(periods):
        done = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, done + BATCH_PAIRS, "right")))
        c = counts[begin:end]
        p = np.repeat(periods[begin:end], c)
        step = np.arange(len(p)) - np.repeat(np.cumsum(c) - c, c)
        yield step * p, p
        begin = end


def candidates(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grid positions and periods that can lie in a run: SIDE words to one side agree as well."""
    if len(ids) < LEAST_LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x = np.concatenate([-1 - np.arange(SIDE), ids, -1 - SIDE - np.arange(SIDE)])
    found = []
    for i, p in grid(len(ids)):
        a = i + SIDE
        same = x[a] == x[a + p]
        a, p = a[same], p[same]
        right, left = np.ones(len(a), bool), np.ones(len(a), bool)
        for d in range(1, SIDE + 1):
            right &= x[a + d] == x[a + p + d]
            left &= x[a - d] == x[a + p - d]
        near = right | left
        found.append((a[near] - SIDE, p[near]))
    return np.concatenate([i for i, _ in found]), np.concatenate([p for _, p in found])


def runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Per text of word numbers its runs as rows (start, length, period), by start, then period."""
    out = [np.zeros((0, 3), np.int64) for _ in texts]
    waiting: list[tuple[int, np.ndarray, np.ndarray]] = []
    words = 0
    for k, ids in enumerate(texts):
        i, p = candidates(ids)
        if len(i):
            waiting.append((k, i, p))
            words += len(ids)
        if words >= BATCH_WORDS:
            _extend(texts, waiting, out)
            waiting, words = [], 0
    if waiting:
        _extend(texts, waiting, out)
    return out


def _extend(texts: list[np.ndarray], waiting: list, out: list) -> None:
    """The runs of the texts that wait, into ``out``."""
    parts, starts, used, at = [], [], 0, 0
    for n, (k, _, _) in enumerate(waiting):
        starts.append(at)
        parts += [texts[k] + used, np.array([-1 - n])]  # numbers of its own, and an end like no other
        used += int(texts[k].max()) + 1
        at += len(texts[k]) + 1
    ids = np.concatenate(parts)
    right, left = Extensions(ids), Extensions(ids[::-1])
    n = len(ids)
    for (k, i, p), start in zip(waiting, starts, strict=True):
        found = []
        for b in range(0, len(i), BATCH_PAIRS):
            a, q = i[b:b + BATCH_PAIRS] + start, p[b:b + BATCH_PAIRS]
            behind, ahead = left(n - a, n - a - q), right(a, a + q)
            length = behind + ahead + q
            whole = (behind + ahead >= q) & (length >= LEAST_LENGTH)
            found.append(np.unique(np.stack(
                [a - start - behind, length, q], axis=1)[whole], axis=0))
        every = np.unique(np.concatenate(found), axis=0)
        # One stretch may be found by multiples of its period; the smallest comes first.
        first = np.ones(len(every), bool)
        first[1:] = np.any(every[1:, :2] != every[:-1, :2], axis=1)
        every = every[first]
        out[k] = every[np.lexsort((every[:, 2], every[:, 0]))]


def kept(n: int, found: np.ndarray) -> np.ndarray:
    """The words that no run repeats: not behind the first period of any."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    return np.cumsum(edge[:n]) == 0


def judge(texts: pd.Series) -> pd.DataFrame:
    """The columns of SCHEMA for every text; null is an empty text."""
    words = [WORDS.findall(t or "") for t in texts]
    ids = []
    for each in words:
        numbers: dict[str, int] = {}
        ids.append(np.array([numbers.setdefault(w, len(numbers)) for w in each], np.int64))
    rows = []
    for each, found in zip(words, runs(ids), strict=True):
        left = each
        if len(found):
            left = [each[k] for k in np.flatnonzero(kept(len(each), found))]
        listed = [dict(zip(("start", "length", "period"), r, strict=True)) for r in found.tolist()]
        rows.append((len(each), listed, " ".join(left)))
    return pd.DataFrame(rows, columns=["n_words", "runs", "kept"])


def assess(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one more column, ``periods``, a struct of SCHEMA.

    ``runs`` has every run with at least LEAST_LENGTH words by start, then period; ``kept`` the words
    outside the repeated parts, joined by one space. Null and empty texts have no words and no runs;
    repeated rows are judged alike, each by itself; an empty table gives an empty one; a column
    ``periods`` of the input is replaced. One narrow pass without a shuffle. A text of n words is one
    row and one task; it needs about n log n comparisons of words and 200 bytes a word.
    """
    @F.pandas_udf(SCHEMA)
    def found(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield judge(part)

    return docs.withColumn("periods", found(F.col(f"`{text}`")))
