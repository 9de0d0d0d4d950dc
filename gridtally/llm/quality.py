"""Quality rules: what a text is made of, and how much of it repeats by its suffix array.

A text's words become numbers and its suffixes are sorted. The intervals of equal common prefixes
are its maximal repeated substrings; the union of their spans and the longest of them are limited.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm import suffixes
from gridtally.llm.common import WORDS

SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEAT_PERCENT = 20
#: The suffix-array limits: repeats of so many words count, they may cover so much of the
#: text, and the longest may have so many words. Words in them are also words in repeated
#: windows, so a limit that is not tighter than MOST_REPEAT_PERCENT would never reject a text.
#: Labelled clean texts repeat up to 13 words, so shorter repeats are left to the windows.
REPEAT_WORDS = 20
MOST_COVERED_PERCENT = 10
MOST_LONGEST = 50
#: Words whose suffixes are sorted together; texts are never cut, a longer one goes alone.
BATCH_WORDS = 200_000

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_covered_words long, longest_repeat long, base_failed boolean, kept boolean"
)


def _counts(text: str) -> tuple[list[str], int, int, int]:
    words = WORDS.findall(text)
    lines = [line for line in text.split("\n") if WORDS.search(line)] if "\n" in text else []
    return (words, sum(map(len, words)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)))


def _repeats(texts: list[list[str]]) -> list[tuple[int, int, int]]:
    """Per text: words in repeated windows, words in long repeats, the longest repeat."""
    ids, ends, used = [], [], 0
    for words in texts:
        numbers: dict[str, int] = {}  # of its own, so nothing repeats across texts
        ids.extend([numbers.setdefault(w, used + len(numbers)) for w in words])
        used += len(numbers)
        ids.append(-1 - len(ends))
        ends.append(len(ids))
    best = suffixes.longest_repeats(np.array(ids, np.int64))
    in_window = np.cumsum(np.append(0, suffixes.covered_by_windows(best, WINDOW)))
    in_repeat = np.cumsum(np.append(0, suffixes.covered(best, REPEAT_WORDS)))
    out, start = [], 0
    for end in ends:
        longest = int(best[start:end].max())
        out.append((int(in_window[end] - in_window[start]), int(in_repeat[end] - in_repeat[start]),
                    longest if longest >= REPEAT_WORDS else 0))
        start = end
    return out


def _judged(rows: list[tuple]) -> Iterator[tuple]:
    for (words, chars, symbols, dup), (windows, cover, longest) in zip(
            rows, _repeats([r[0] for r in rows]), strict=True):
        n = len(words)
        failed = n < LEAST_WORDS or 100 * windows > MOST_REPEAT_PERCENT * n
        kept = not failed and 100 * cover <= MOST_COVERED_PERCENT * n and longest <= MOST_LONGEST
        yield n, chars, symbols, dup, windows, cover, longest, failed, kept


def judge(texts: pd.Series) -> pd.DataFrame:
    """The columns of SCHEMA for every text; null is an empty text."""
    out, waiting, n = [], [], 0
    for text in texts:
        waiting.append(_counts(text or ""))
        n += len(waiting[-1][0])
        if n >= BATCH_WORDS:
            out.extend(_judged(waiting))
            waiting, n = [], 0
    if waiting:
        out.extend(_judged(waiting))
    names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
    return pd.DataFrame(out, columns=names)


def assess(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one more column, ``quality``, a struct of SCHEMA.

    Null and empty texts have no words and fail; repeated rows are judged alike, each by itself; an
    empty table gives an empty one; a column ``quality`` of the input is replaced. One narrow pass
    without a shuffle. A text is one row, and its suffix array needs about 100 bytes a word.
    """
    @F.pandas_udf(SCHEMA)
    def verdicts(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield judge(part)

    return docs.withColumn("quality", verdicts(F.col(f"`{text}`")))


def keep(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, with the columns they came with."""
    @F.pandas_udf("boolean")
    def passes(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield judge(part)["kept"]

    return docs.where(passes(F.col(f"`{text}`")))
