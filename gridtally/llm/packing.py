"""Packing token sequences into windows: non-negative least squares over length combinations.

Documents are cut into whole windows and one remainder. The remainders' histogram has fewer bins than
the window has tokens. Combinations of lengths that fill the window are enumerated (pairs, triples, and
deeper ones drawn along the histogram), their repeat counts are solved against the histogram by
non-negative least squares and rounded, and rounds over what is left follow. The few remainders that no
round places are packed greedily, one after the other, cut where a window ends. The last window is cut
into powers of two, so nothing is padded.

The plan is some thousands of combinations, whatever the number of documents. A document finds its
combination by its rank among those of its length; ranks are counted in SALT_ROWS-sized parts, so a
length that a third of all documents share is no single task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtally.llm import tokens
from gridtally.llm.common import stored

WINDOW = 4096
#: Lengths that may occur twice in a combination of three, the most frequent ones.
SHALLOW = 64
#: Most lengths in a combination; a length may occur in it more than once.
DEEPEST = 16
#: Combinations that one round adds, and updates that settle its repeat counts.
ROUND = 4096
UPDATES = 200
#: Rounds end when one places less than a hundredth of what is left, or here.
MOST_ROUNDS = 24
#: Rows whose ranks are counted in one part.
SALT_ROWS = 200_000
BIG = 1 << 44


def combinations(histogram: np.ndarray, shallow: int = SHALLOW) -> np.ndarray:
    """Rows of three lengths (0: none) that fill the window, of lengths that occur."""
    window = len(histogram)
    lengths = np.flatnonzero(histogram[1:]) + 1
    there = histogram > 0
    a = lengths[2 * lengths <= window]
    a = a[there[(window - a) % window]]
    pairs = np.stack([a, window - a, np.zeros_like(a)], 1)
    often = lengths[np.argsort(-histogram[lengths], kind="stable")[:shallow]]
    x, y = (g.ravel() for g in np.meshgrid(often, often))
    z = window - x - y
    fits = (x <= y) & (z > 0)
    x, y, z = x[fits], y[fits], z[fits]
    fits = there[z]
    triples = np.sort(np.stack([x[fits], y[fits], z[fits]], 1), 1)
    every = np.concatenate([pairs, np.unique(triples, axis=0)]) if len(triples) else pairs
    return every.astype(np.int64)


def deeper(histogram: np.ndarray, rng: np.random.Generator, most: int = ROUND,
           deepest: int = DEEPEST) -> np.ndarray:
    """Rows of up to ``deepest`` lengths (0: none) that fill the window, drawn along the histogram.

    A row starts with one length, every length that occurs in turn, the longest first. Lengths drawn
    in proportion to their numbers follow while there is room for more than two, and the pair (or the
    one length) that then fills the window exactly is the one whose rarer length is most frequent. A
    start for which none fits gives no row.
    """
    window = len(histogram)
    lengths = np.flatnonzero(histogram[1:]) + 1
    if not len(lengths):
        return np.zeros((0, deepest), np.int64)
    shares = np.cumsum(histogram[lengths]) / histogram.sum()
    mean = float((histogram[lengths] * lengths).sum() / histogram.sum())
    numbers = histogram.copy()
    numbers[0] = BIG  # a pair may be one length that fills the room by itself
    rows = np.zeros((most, deepest), np.int64)
    made, starts = 0, lengths[::-1]
    draws = lengths[np.minimum(np.searchsorted(shares, rng.random((most, deepest))), len(lengths) - 1)]
    for i in range(most):
        row = [int(starts[i % len(starts)])]
        room = window - row[0]
        for x in draws[i].tolist():
            if len(row) >= deepest - 2 or room <= 2 * mean:
                break
            if x < room:
                row.append(x)
                room -= x
        if room:
            rarer = np.minimum(numbers[1:room + 1], numbers[room - 1::-1] if room > 1 else numbers[:1])
            x = int(rarer.argmax()) + 1
            if not rarer[x - 1]:
                continue
            row += [x, room - x]
        rows[made, :len(row)] = row
        made += 1
    return np.unique(np.sort(rows[:made], 1), axis=0)[:, ::-1]


def solve(histogram: np.ndarray, combos: np.ndarray, updates: int = UPDATES) -> np.ndarray:
    """How often each combination is used: least squares with counts >= 0, then rounded.

    Multiplicative updates keep every count non-negative and never raise the squared distance between
    the histogram and the lengths used. The largest counts are rounded first, to the nearest number
    (at least one) that leaves no length used more often than it occurs.
    """
    counts = np.zeros(len(combos), np.int64)
    if not len(combos):
        return counts
    target = histogram.astype(float)
    target[0] = 0.0
    wanted = target[combos].sum(1)
    x = np.full(len(combos), target.sum() / max(1, np.count_nonzero(combos)))
    for _ in range(updates):
        uses = np.bincount(combos.ravel(), np.repeat(x, combos.shape[1]), len(histogram))
        uses[0] = 0.0
        x *= wanted / np.maximum(uses[combos].sum(1), 1e-12)
    rest = histogram.astype(np.int64).copy()
    for c in np.argsort(-x, kind="stable").tolist():
        row = combos[c]
        lengths, times = np.unique(row[row > 0], return_counts=True)
        counts[c] = min(max(1, int(x[c] + 0.5)), int((rest[lengths] // times).min()))
        rest[lengths] -= counts[c] * times
    return counts


def solved(histogram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(combinations, counts) that use up most of a histogram.

    Pairs and triples are solved together with deeper combinations, those that were used stay, and
    rounds over deeper combinations of the lengths still left follow. Their number is bounded by
    rounds and combinations a round, whatever the number of documents; what is left is for the greedy
    stream. Seeded, so reruns agree.
    """
    rng = np.random.default_rng(len(histogram))
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    every, numbers = [np.zeros((0, DEEPEST), np.int64)], [np.zeros(0, np.int64)]
    for i in range(MOST_ROUNDS):
        combos = deeper(left, rng)
        if not i:
            first = combinations(left)
            combos = np.concatenate([np.pad(first, ((0, 0), (0, DEEPEST - 3))), combos])
        counts = solve(left, combos)
        used = counts > 0
        combos, counts = combos[used], counts[used]
        every.append(combos)
        numbers.append(counts)
        placed = np.bincount(combos.ravel(), np.repeat(counts, DEEPEST), len(left)).astype(np.int64)
        placed[0] = 0
        if placed.sum() * 100 < left.sum() or not placed.sum():
            break
        left -= placed
    return np.concatenate(every), np.concatenate(numbers)


class Plan:
    """Which combination takes the k-th remainder of a length, and where."""

    def __init__(self, histogram: np.ndarray, combos: np.ndarray, counts: np.ndarray) -> None:
        used = np.zeros(len(histogram), np.int64)
        slots, sequence = [], 0
        for row, n in zip(combos.tolist(), counts.tolist(), strict=True):
            offset = 0
            for length in row if n else ():
                if length:
                    slots.append((length * BIG + used[length], used[length], sequence, offset))
                    used[length] += n
                    offset += length
            sequence += n
        slots.sort()
        self.keys, self.first, self.sequence, self.offset = (
            np.array(x, np.int64) for x in (zip(*slots, strict=True) if slots else ([],) * 4)
        )
        self.used, self.sequences = used, sequence

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of remainders whose rank is below ``used``."""
        at = np.searchsorted(self.keys, length * BIG + rank, "right") - 1
        return self.sequence[at] + rank - self.first[at], self.offset[at]


def last_cuts(total: int, window: int = WINDOW) -> np.ndarray:
    """Where the stream of rests is cut after its last whole window: at powers of two, largest first."""
    at, cuts = total - total % window, []
    for bit in range(window.bit_length() - 2, -1, -1):
        if total % window >> bit & 1:
            cuts.append(at)
            at += 1 << bit
    return np.array(cuts, np.int64)


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text",
           tokenizer: str | None = None) -> DataFrame:
    """(row, key, n, ids) of every document, stored; null text is the end id alone."""
    path = tokenizer or tokens.default_tokenizer()
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = tokens.encoder(path)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at:at + 500]
                ids = encoder.encode([None if pd.isna(t) else t for t in part["text"]])
                yield pd.DataFrame({
                    "row": part["row"], "key": part["key"],
                    "n": [len(i) // encoder.dtype.itemsize for i in ids], "ids": ids,
                })

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("key"),
                       F.col(f"`{text}`").alias("text"))
    return stored(rows.mapInPandas(run, f"row long, key {kind}, n long, ids binary"), "ids")


def pieces(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """(row, pieces) from (row, n): pieces are (start, length, sequence_id, offset)."""
    salts = max(1, -(-rows.count() // SALT_ROWS))
    each = rows.select(
        "row", "n", F.pmod(F.xxhash64("row"), F.lit(salts)).alias("salt"),
        F.floor(F.col("n") / window).alias("whole"), (F.col("n") % window).cast("int").alias("rest"),
    )
    counts = stored(each.groupBy("salt", "rest").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("whole").alias("whole")), "counts")
    histogram = np.zeros(window, np.int64)  # one row per length: at most the window's tokens
    for r in counts.where("rest > 0").groupBy("rest").agg(F.sum("rows").alias("n")).collect():
        histogram[r.rest] = r.n
    plan = Plan(histogram, *solved(histogram))
    full = int(counts.agg(F.coalesce(F.sum("whole"), F.lit(0))).first()[0])
    total = int(((histogram - plan.used) * np.arange(window)).sum())
    cuts = last_cuts(total, window)

    by_rest = Window.partitionBy("rest").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("salt", "rest",
                           F.coalesce(F.sum("rows").over(by_rest), F.lit(0)).alias("rank0"))
    within = Window.partitionBy("salt", "rest").orderBy("row")
    ranked = each.join(starts, ["salt", "rest"]).withColumn(
        "rank", F.col("rank0") + F.row_number().over(within) - 1)
    used = plan.used.tolist()
    quota = F.element_at(F.array(*[F.lit(u) for u in used]), F.col("rest") + 1)
    ranked = stored(ranked.select(
        "row", "salt", "whole", "rest", "rank",
        F.when((F.col("rest") > 0) & (F.col("rank") >= quota), F.col("rest")).otherwise(0)
        .cast("long").alias("left"),
    ), "ranks")
    order = Window.orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranked.groupBy("salt").agg(F.sum("whole").alias("w"), F.sum("left").alias("l")).select(
        "salt", F.coalesce(F.sum("w").over(order), F.lit(0)).alias("whole0"),
        F.coalesce(F.sum("l").over(order), F.lit(0)).alias("left0"))
    before = Window.partitionBy("salt").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranked.join(bases, "salt").select(
        "row", "whole", "rest", "rank", "left",
        (F.col("whole0") + F.coalesce(F.sum("whole").over(before), F.lit(0))).alias("whole_at"),
        (F.col("left0") + F.coalesce(F.sum("left").over(before), F.lit(0))).alias("left_at"),
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            in_plan = ((b["rest"] > 0) & (b["left"] == 0)).to_numpy()
            sequence, offset = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            sequence[in_plan], offset[in_plan] = plan.place(
                b["rest"].to_numpy(np.int64)[in_plan], b["rank"].to_numpy(np.int64)[in_plan])
            out = []
            for r, s, o, planned in zip(b.itertuples(index=False), sequence, offset, in_plan,
                                        strict=True):
                one = [{"start": i * window, "length": window, "sequence_id": r.whole_at + i,
                        "offset": 0} for i in range(r.whole)]
                start = r.whole * window
                if planned:
                    one.append({"start": start, "length": r.rest, "sequence_id": full + int(s),
                                "offset": int(o)})
                at, end = r.left_at, r.left_at + r.left
                while at < end:
                    # in the last, shorter part every power of two is a sequence of its own
                    tail = int(np.searchsorted(cuts, at, "right"))
                    head = int(cuts[tail - 1]) if tail else at - at % window
                    stop = min(end, int(cuts[tail]) if tail and tail < len(cuts)
                               else (total if tail else head + window))
                    one.append({"start": start, "length": stop - at,
                                "sequence_id": full + plan.sequences
                                + (total // window + tail - 1 if tail else at // window),
                                "offset": at - head})
                    start, at = start + stop - at, stop
                out.append(one)
            yield pd.DataFrame({"row": b["row"], "pieces": out})

    return placed.mapInPandas(cut, "row long, pieces array<struct<start: long, length: long, "
                                   "sequence_id: long, offset: long>>")


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
         tokenizer: str | None = None) -> DataFrame:
    """The pieces of all documents with their ids (little-endian uint32), in sequences of ``window``.

    (key, start, length, doc_tokens, sequence_id, offset, ids). Null and empty texts are one end id,
    so every row, repeated or not, has a piece; an empty table gives an empty one; other columns are
    not read. Texts are encoded once and their ids stored.
    """
    path = tokenizer or tokens.default_tokenizer()
    encoded = encode(docs, key, text, path)
    dtype = tokens.encoder(path).dtype.str
    plan = pieces(encoded.select("row", "n"), window)
    kind = docs.schema[key].dataType.simpleString()

    def slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                ids = np.frombuffer(r.ids, dtype)
                for p in r.pieces:
                    part = ids[p["start"]:p["start"] + p["length"]].astype("<u4").tobytes()
                    out.append((r.key, p["start"], p["length"], r.n, p["sequence_id"], p["offset"],
                                part))
                if len(out) >= 2000:
                    yield pd.DataFrame(out, columns=NAMES)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=NAMES)

    # hinted, so that small inputs go the way of large ones
    return encoded.join(plan.hint("merge"), "row").select("key", "n", "ids", "pieces").mapInPandas(
        slices, f"key {kind}, start long, length long, doc_tokens long, sequence_id long, "
                "offset long, ids binary")


NAMES = ["key", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
