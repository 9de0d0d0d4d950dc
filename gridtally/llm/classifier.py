"""Quality classifier: averaged vectors of hashed word and character n-grams, softmax, numpy SGD.

A text is the mean of the learned vectors of its words, its pairs of adjacent words and the character
n-grams of its words, each found by hash. A softmax over that mean gives the class; vectors and softmax
are trained together by stochastic gradient descent over a bounded sample of labelled rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.llm.common import WORDS

#: Vectors, their length, and the lengths of character n-grams; a word stands between < and >.
BITS = 15
DIM = 8
CHARS = (3, 4, 5)
#: The bound of the training sample, in rows; a stable hash of the key picks them. Scores need none.
SAMPLE = 4096
#: Examples that gradient descent takes in all, over and over through the sample, and its first rate.
STEPS = 16_384
RATE = 1.0
THRESHOLD = 0.3
#: Odd numbers that deal a pair of word hashes over the buckets; a pair of equal words has bucket 0.
FIRST, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: What a gram's hash is multiplied by for each character.
PRIME = np.uint64(0x100000001B3)
#: Distinct words that a task remembers, and the longest of them.
REMEMBERED, LONG = 200_000, 64
SLICES = 16


class Words:
    """Number, hash and buckets of every word met; forgets all when there are too many.

    With the logits of a model only their sum over a word's buckets is kept, without them the buckets.
    """

    def __init__(self, logits: np.ndarray | None = None):
        self.logits = logits
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.hashes: list[int] = []
        self.buckets: list[np.ndarray] = []
        self.sums: list[float] = []
        self.counts: list[int] = []
        self.passing: list[str] = []

    def add(self, words: list[str]) -> None:
        """Numbers new words; their character n-grams are hashed together, as code points."""
        raw = [zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words]
        sizes = np.array([len(w) + 2 for w in words])
        begin = np.cumsum(sizes) - sizes
        text = "".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass")
        size = len(text) // 4
        points = np.zeros(size + max(CHARS), np.uint64)  # grams that begin too late are never used
        points[:size] = np.frombuffer(text, np.uint32)
        left = np.repeat(begin + sizes, sizes) - np.arange(size)  # characters up to the word's end
        grams = []
        for n in CHARS:
            h = np.full(size, n, np.uint64)
            for i in range(n):
                h = (h ^ points[i:size + i]) * PRIME
            grams.append((n, (h >> np.uint64(64 - BITS)).astype(np.int64)))
        own = np.array(raw, np.int64) % (1 << BITS)
        if self.logits is None:
            for k, (at, long) in enumerate(zip(begin.tolist(), sizes.tolist(), strict=True)):
                parts = [b[at:at + max(0, long - n + 1)] for n, b in grams]
                self.buckets.append(np.concatenate([own[k:k + 1], *parts]))
        else:
            values = np.zeros(size)
            for n, b in grams:
                values += np.where(left >= n, self.logits[b], 0.0)
            self.sums += (self.logits[own] + np.add.reduceat(values, begin)).tolist()
        self.counts += (1 + sum(np.maximum(0, sizes - n + 1) for n in CHARS)).tolist()
        self.numbers.update(zip(words, range(len(self.hashes), len(self.hashes) + len(words)), strict=True))
        self.hashes += raw
        self.passing = [w for w in words if len(w) > LONG]

    def look(self, text: str | None) -> list[int]:
        """The numbers of a text's words; good until the next text."""
        if len(self.hashes) > REMEMBERED:
            self.forget()
        for word in self.passing:
            self.numbers.pop(word)
        self.passing = []
        words = WORDS.findall(text or "")
        fresh = [w for w in set(words) if w not in self.numbers]
        if fresh:
            self.add(fresh)
        numbers = self.numbers
        return [numbers[w] for w in words]

    def pairs(self, numbers: list[int]) -> np.ndarray:
        """The buckets of adjacent words."""
        h = np.array([self.hashes[k] for k in numbers], np.uint64)
        mixed = (h[:-1] * FIRST + h[1:] * SECOND) >> np.uint64(64 - BITS)
        mixed[h[:-1] == h[1:]] = 0
        return mixed.astype(np.int64)


def features(text: str | None, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text in order, and the share of each among all its n-grams."""
    numbers = words.look(text)
    if not numbers:
        return np.zeros(0, np.uint16), np.zeros(0, np.float32)
    parts = [words.buckets[k] for k in numbers]
    counts = np.bincount(np.concatenate([*parts, words.pairs(numbers)]), minlength=1 << BITS)
    at = np.flatnonzero(counts)
    return at.astype(np.uint16), (counts[at] / counts.sum()).astype(np.float32)


@dataclass
class Model:
    """A trained classifier as what each bucket adds to the log odds of class 1, and their start."""

    logits: np.ndarray
    start: float

    def score(self, texts: pd.Series, words: Words) -> np.ndarray:
        """The probability of class 1; null and empty texts have that of the start alone."""
        odds = np.full(len(texts), self.start)
        for row, text in enumerate(texts):
            numbers = words.look(text)
            if numbers:
                pairs = self.logits[words.pairs(numbers)]
                total = sum([words.sums[k] for k in numbers]) + float(pairs.sum())
                odds[row] += total / (sum([words.counts[k] for k in numbers]) + len(pairs))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def train(examples: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """Stochastic gradient descent, one example a step, at a rate that falls to 0."""
    rng = np.random.default_rng(0)
    vectors = ((rng.random((1 << BITS, DIM)) - 0.5) / DIM).astype(np.float32)
    weights, start = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    order: list[int] = []
    for step in range(STEPS if examples else 0):
        if not order:
            order = rng.permutation(len(examples)).tolist()
        at, share, label = examples[order.pop()]
        rate = RATE * (1 - step / STEPS)
        rows = vectors[at]
        mean = share @ rows
        z = weights @ mean + start
        error = np.exp(z - z.max())
        error /= error.sum()
        error[label] -= 1
        back = error @ weights
        weights -= rate * np.outer(error, mean)
        start -= rate * 0.1 * error
        vectors[at] = rows - (rate * share)[:, None] * back
    spread = (weights[1] - weights[0]).astype(np.float64)
    return Model(vectors.astype(np.float64) @ spread, float(start[1] - start[0]))


def held_out(key: Column) -> Column:
    """The fold that nothing is learned from; a null key is in it."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 5 == 0


def examples(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """(key, label, text) of at most SAMPLE labelled documents outside the held-out fold.

    The rows are those of smallest hash, so reruns agree. A key with several labels has the one that
    most of them say (1 on a tie), a key with several texts the least text. Labels of keys without a
    document are passed over when they are joined, so they can make the sample smaller.
    """
    known = (
        labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"))
        .where(F.col("label").isNotNull() & ~held_out(F.col("key")))
        .groupBy("key").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    )
    draw = F.xxhash64("key")
    # A share by hash first, so that what is sorted is bounded however many labels there are.
    share = min(1.0, SAMPLE / max(1, known.count()))
    known = known.where(F.pmod(draw, F.lit(1 << 20)) < share * (1 << 20))
    known = known.orderBy(draw, "key").limit(SAMPLE)
    texts = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    # SAMPLE keys at most, of a few bytes each.
    return (
        texts.join(F.broadcast(known), "key").repartition(SLICES, "key", "label")
        .groupBy("key", "label").agg(F.min("text").alias("text"))
    )


def fit(labelled: DataFrame) -> Model:
    """A model from the rows of ``examples``: n-grams in many tasks, gradient descent in one.

    That task holds the buckets of at most SAMPLE texts, 6 bytes each and 2**BITS a text at the most.
    The driver gets the model, 8 bytes a bucket. Without rows every text has the score 0.5.
    """
    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for part in parts:
            made = [features(t, words) for t in part["text"]]
            yield pd.DataFrame({
                "draw": part["draw"], "label": part["label"],
                "at": [a.tobytes() for a, _ in made], "share": [s.tobytes() for _, s in made],
            })

    def learn(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [
            (np.frombuffer(r.at, np.uint16), np.frombuffer(r.share, np.float32), int(r.label))
            for part in parts for r in part.itertuples()
        ]
        model = train(rows)
        yield pd.DataFrame({"logits": [model.logits.tobytes()], "start": [model.start]})

    counted = labelled.select(F.xxhash64("key").alias("draw"), "label", "text").mapInPandas(
        count, "draw long, label int, at binary, share binary"
    )
    row = (
        counted.repartition(1).sortWithinPartitions("draw", "at", "share")
        .mapInPandas(learn, "logits binary, start double").collect()
    )
    if not row:
        return train([])
    return Model(np.frombuffer(row[0].logits, np.float64), row[0].start)


def assess(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """The rows of ``docs`` with ``quality_score`` and ``quality_predicted``, which replace such columns.

    Every whole text is scored in one narrow pass. Only texts are inputs of a score; labels other
    than null are learned from where ``held_out`` of the key is false. Null and empty texts get the
    score of a text without n-grams, repeated rows the same score; empty tables give empty ones, and
    without labels all scores are 0.5. Other columns of either table play no part.
    """
    model = fit(examples(docs, labels, key, text, label))

    @F.pandas_udf("double")
    def scores(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = Words(model.logits)
        for part in parts:
            yield pd.Series(model.score(part, words))

    scored = docs.withColumn("quality_score", scores(F.col(f"`{text}`")))
    return scored.withColumn(
        "quality_predicted", (F.col("quality_score") >= THRESHOLD).cast("int")
    )
