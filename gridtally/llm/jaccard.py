"""N-gram Jaccard join by PartEnum signatures.

Sets of word shingles are dealt into size bands. Two sets of a band that are similar enough differ in at
most K shingles, so when the shingles' domain is cut into enough partitions, some partition holds at
most one difference; it is cut into three parts, and one of the three pairs of parts is the same in both
sets. Every such pair of parts is a signature, so similar sets share one.

Links are found without writing out the pairs of a group. Equal sets are one member. The member of a
signature's group with the smallest digest is its hub, and every other one is compared with it. Members
of a hub's cluster that are then still in different components are compared in blocks of bounded size,
and only links leave a block.

Most documents that share a signature are not similar. Before texts are moved, sketches of a bit or two
a shingle are compared in the same way; they tell for certain that two sets are too far apart, and only
documents for which they don't go on.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.common import WORDS, components, shuffles_freed, stored

#: Sizes of a band: its largest set has about 1.4 times the shingles of its smallest.
BAND = 1.4
#: Partitions beyond those that the pigeonhole needs, SPARE and one for every SPARE_OF of them; as
#: many may be left out by a set, so the share that may be does not shrink as sets grow.
SPARE, SPARE_OF = 4, 8
#: Signatures of fewer shingles are left out where that is safe.
LIGHT = 4
#: Bits of a signature that are kept; where two agree by chance, the sketches tell.
SIGNATURE = 48
#: Digests of sets that a task remembers, to sign one of equal texts.
SIGNED = 100_000
#: Members of a block.
BLOCK = 512
#: Pairs that a task gathers before it removes repeated ones.
GATHERED = 1_000_000

#: Bytes of texts whose words are hashed at once; a longer text is taken alone, in pieces.
CHUNK = 1 << 17
#: Places in a word for whose bytes the numbers lie in a table.
PLACES = 64
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Which numbers stand for bytes; the links are the same with any.
SEED = np.uint64(10)
#: Of every byte of UTF-8, whether it is part of a word, and what it is in lower case; only A-Z change.
SOLID = np.array([WORDS.match(chr(c)) is not None for c in range(256)])
LOWER = np.array([ord(chr(c).lower()) if c < 128 else c for c in range(256)], np.uint8)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _numbers(codes: np.ndarray) -> np.ndarray:
    """A random number for every place * 256 + byte."""
    return _mixed((codes.astype(np.uint64) + SEED) * GOLDEN)


NUMBERS = _numbers(np.arange(PLACES * 256))


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of texts that lie side by side in UTF-8, and how many of the words
    come before every bound of a text.

    A word's hash is the mixed sum of numbers that stand for its bytes in their places.
    """
    solid = SOLID.take(data)
    starts = np.append(True, ~solid)
    starts[bounds] = True
    starts = starts[:-1] & solid
    first, where = np.flatnonzero(starts), np.flatnonzero(solid)
    if not len(first):
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    at = np.flatnonzero(starts.take(where))
    codes = where - np.repeat(first, np.diff(at, append=len(where)))
    codes <<= 8
    codes += LOWER.take(data.take(where))
    numbers = NUMBERS.take(codes, mode="clip")
    far = np.flatnonzero(codes >= len(NUMBERS))
    if len(far):
        numbers[far] = _numbers(codes[far])
    return _mixed(np.add.reduceat(numbers, at)), np.searchsorted(first, bounds)


def _hashes_of_long(data: np.ndarray) -> np.ndarray:
    """Hashes of one text's words, by pieces that begin at white space."""
    gaps = np.flatnonzero(~SOLID.take(data))
    cuts = np.unique(np.searchsorted(gaps, np.arange(CHUNK, len(data), CHUNK)))
    pieces = np.split(data, gaps[cuts[cuts < len(gaps)]])
    return np.concatenate([word_hashes(x, np.array([0, len(x)]))[0] for x in pieces])


def _shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of so many words, by Horner's rule: a word counts by its place."""
    out = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        out *= GOLDEN
        out += words[i:i + len(out)]
    return _mixed(out)


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Every text's sorted 64-bit hashes of the distinct k-word shingles; fewer words are one shingle."""
    texts = texts.fill_null("").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)
    i = 0
    while i < len(texts):
        end = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, "right")) - 1)
        part = data[offsets[i]:offsets[end]]
        if len(part) > CHUNK:
            words = _hashes_of_long(part)
            bounds = np.array([0, len(words)])
        else:
            words, bounds = word_hashes(part, offsets[i:end + 1] - offsets[i])
        shingles = _shingles(words, k) if len(words) >= k else None
        bounds = bounds.tolist()
        for a, b in zip(bounds, bounds[1:]):
            out = shingles[a:b - k + 1] if b - a >= k else _shingles(words[a:b], b - a)[:b - a]
            out.sort()
            yield out[np.append(True, out[1:] != out[:-1])[:len(out)]]
        i = end


class Bands:
    """Which bands a set of so many shingles is in, and how many may differ there.

    Sets of sizes a <= b whose similarity is num / den or more differ in at most
    (a + b) (den - num) / (den + num) shingles, and a >= b num / den. A pair meets in the band of its
    larger set.
    """

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den
        self.low, self.high = [1], [1]
        self.of = cache(self._of)

    def _of(self, size: int) -> list[tuple[int, int]]:
        while self.low[-1] * self.num <= size * self.den:  # past all bands that could take it
            low = self.high[-1] + 1
            self.low.append(low)
            self.high.append(max(low, int(low * BAND)))
        own = next(i for i in range(len(self.high)) if size <= self.high[i])
        out = []
        for i in range(own, len(self.low)):
            if size * self.den < self.low[i] * self.num:
                break
            most = 2 * self.high[i] * (self.den - self.num) // (self.den + self.num)
            if most:
                out.append((i, most))
        return out


def signatures(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """The set's signatures in all its bands.

    With ``most`` differences and most // 2 + 1 + spare partitions, at least spare + 1 partitions of
    two similar sets hold at most one difference. A set leaves out its signatures of fewer than t
    shingles, for the largest t up to LIGHT for which at most ``spare`` partitions have such. Of two
    similar sets, take the one with the larger t: one of the agreeing partitions has none that it
    leaves out, and the other set leaves out even less.
    """
    sums, seeds = [], []
    where = _mixed(shingles ^ np.uint64(0xD6E8FEB86659FD93))
    high = where >> np.uint64(32)
    for band, most in bands.of(len(shingles)):
        spare = SPARE + (most // 2 + 1) // SPARE_OF
        parts = most // 2 + 1 + spare
        cell = (high * np.uint64(3 * parts) >> np.uint64(32)).view(np.int64)
        count = np.bincount(cell, minlength=3 * parts).reshape(parts, 3)
        own = np.zeros(3 * parts, np.uint64)
        np.add.at(own, cell, where)
        own = own.reshape(parts, 3)
        count = count.sum(1, keepdims=True) - count
        own = own.sum(1, keepdims=True, dtype=np.uint64) - own
        light = min(LIGHT, np.partition(count.min(1), spare)[spare])
        kept = np.flatnonzero(count.ravel() >= light)
        sums.append(own.ravel()[kept])
        seeds.append(kept.view(np.uint64) + np.uint64(band << 40))
    if not sums:
        return np.empty(0, np.uint64)
    sig = _mixed(_mixed(np.concatenate(sums)) + np.concatenate(seeds) * GOLDEN)
    return sig >> np.uint64(64 - SIGNATURE)


def digest(shingles: np.ndarray) -> tuple[int, int, int]:
    """The set's size and two sums that stand for it."""
    return (len(shingles), int(shingles.sum(dtype=np.uint64).astype(np.int64)),
            int(_mixed(shingles).sum(dtype=np.uint64).astype(np.int64)))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """For every remainder of the hashes, whether an odd number of them has it; a bit or two a shingle.

    The sketches of two sets differ in no more bits than the sets do in shingles. The remainders are by
    a power of two, so a sketch can be folded to half its size.
    """
    bits = 64 << max(0, (len(shingles) - 1).bit_length() - 6)
    times = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((times & 1).astype(np.uint8), bitorder="little").view(np.uint64)


def _folded(one: np.ndarray, words: int) -> np.ndarray:
    return one if len(one) == words else np.bitwise_xor.reduce(one.reshape(-1, words), axis=0)


def may_link(sizes: np.ndarray, sketches: np.ndarray, size: int, one: np.ndarray, num: int,
             den: int) -> np.ndarray:
    """Which sets of these sizes and sketches (a row each) may be similar to the one; none that is, is
    missed: sets of sizes a and b are if they differ in (a + b) (den - num) / (den + num) at most."""
    apart = np.bitwise_count(sketches ^ one).sum(1, dtype=np.int64)
    return ((np.minimum(sizes, size) * den >= np.maximum(sizes, size) * num)
            & (apart * (den + num) <= (sizes + size) * (den - num)))


def near_others(sizes: np.ndarray, sketches: list[np.ndarray], labels: np.ndarray, num: int,
                den: int) -> np.ndarray:
    """Which of the sets may be similar to one that has another label."""
    near = np.zeros(len(sizes), bool)
    words = np.array([len(s) for s in sketches])
    for width in np.unique(words):
        own = np.flatnonzero(words == width)
        at = np.flatnonzero((words >= width) & (sizes * num <= sizes[own].max() * den))
        folded = np.stack([_folded(sketches[i], width) for i in at])
        for i in own:
            hit = (may_link(sizes[at], folded, sizes[i], sketches[i], num, den)
                   & (labels[at] != labels[i]))
            near[at[hit]] = True
            near[i] |= hit.any()
    return near


def linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    small, large = sorted((len(a), len(b)))
    if not small or small * den < large * num:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * den >= (len(a) + len(b) - both) * num


def _batch(**columns: np.ndarray | pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def _sets(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [(*digest(s), sketch(s).tobytes()) for s in shingle_sets(batch["text"], k)]
        n, one, two, bits = zip(*out, strict=True) if out else ((), (), (), ())
        yield _batch(id=batch["id"], n=pa.array(n, pa.int64()), k1=pa.array(one, pa.int64()),
                     k2=pa.array(two, pa.int64()), sketch=pa.array(bits, pa.binary()))


def _signed(k: int, num: int, den: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sig, key): every set's signatures with its digest's first sum, of equal sets in a task once."""
    bands, seen = Bands(num, den), set()
    for batch in batches:
        sigs, keys, rows = [], [], 0
        for shingles in shingle_sets(batch["text"], k):
            this = digest(shingles)
            if this in seen:
                continue
            if len(seen) >= SIGNED:
                seen.clear()
            seen.add(this)
            own = signatures(shingles, bands)
            sigs.append(own)
            keys.append(np.full(len(own), this[1], np.int64))
            rows += len(own)
            if rows > 100_000:
                yield _batch(sig=np.concatenate(sigs).view(np.int64), key=np.concatenate(keys))
                sigs, keys, rows = [], [], 0
        if rows:
            yield _batch(sig=np.concatenate(sigs).view(np.int64), key=np.concatenate(keys))


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True) if found else ((), ())
    return _batch(a=pa.array(a, pa.int64()), b=pa.array(b, pa.int64()))


def _hubs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hub, key) of rows sorted by (sig, key): only the hub of the group at hand is remembered."""
    last_sig = last_hub = None
    waiting, rows = [], 0

    def flush() -> pa.RecordBatch:
        pairs = np.unique(np.concatenate(waiting), axis=0) if waiting else np.empty((0, 2), np.int64)
        waiting.clear()
        return _batch(hub=pairs[:, 0], key=pairs[:, 1])

    for batch in batches:
        sig, keys = batch["sig"].to_numpy(), batch["key"].to_numpy()
        if not len(sig):
            continue
        new = np.append(True, sig[1:] != sig[:-1])
        new[0] = sig[0] != last_sig
        start = np.maximum.accumulate(np.where(new, np.arange(len(sig)), -1))
        hub = np.where(start >= 0, keys[np.maximum(start, 0)], last_hub if start[0] < 0 else 0)
        last_sig, last_hub = sig[-1], hub[-1]
        pairs = np.stack([hub, keys], 1)[hub != keys]
        if len(pairs):
            waiting.append(np.unique(pairs, axis=0))
            rows += len(waiting[-1])
        if rows > GATHERED:
            yield flush()
            rows = 0
    yield flush()


def _near_hub(num: int, den: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by (hub, block), the hub's own rows first, those that may be similar to the hub,
    and the hub's where there are any."""
    unit, hubs, named = None, [], False
    for batch in batches:
        found = []
        for hub, block, i, n, bits in zip(*(batch[c] for c in ("hub", "block", "id", "n", "sketch")),
                                          strict=True):
            if (hub, block) != unit:
                unit, hubs, named = (hub, block), [], False
            own = np.frombuffer(bits, np.uint64)
            if i == hub:
                hubs.append((n, own))
                continue
            for size, other in hubs:
                words = min(len(own), len(other))
                if may_link(np.array([n]), _folded(own, words)[None], size, _folded(other, words), num,
                            den)[0]:
                    found.extend([(hub, block, i)] if named else [(hub, block, hub), (hub, block, i)])
                    named = True
                    break
        yield pd.DataFrame(found, columns=["hub", "block", "id"], dtype=np.int64)


def _against_hub(k: int, num: int, den: int,
                 batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of rows sorted by (hub, block), the hub's own rows first."""
    unit, hubs = None, []
    for batch in batches:
        found = []
        for hub, block, i, own in zip(*(batch[c].to_pylist() for c in ("hub", "block", "id")),
                                      shingle_sets(batch["text"], k), strict=True):
            if (hub, block) != unit:
                unit, hubs = (hub, block), []
            if i == hub:
                hubs.append(own)
            elif any(linked(own, h, num, den) for h in hubs):
                found.append((i, hub))
        yield _pairs(found)


def _links_of(sets: list[np.ndarray], labels: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Links that join different labels; of those between two labels one is enough."""
    if len(sets) == 2:
        return [(0, 1)] if labels[0] != labels[1] and linked(*sets, num, den) else []
    sizes = np.array([len(s) for s in sets])
    of = np.repeat(np.arange(len(sets)), sizes)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    renamed = np.cumsum(times > 1) - 1
    of, column = of[shared], renamed[column[shared]]
    both = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        low, high = np.searchsorted(column, [at, at + 4096])
        part = np.zeros((len(sets), 4096), np.float32)
        part[of[low:high], column[low:high] - at] = 1
        both += part @ part.T
    both = both.astype(np.int64)
    close = both * den >= (sizes[:, None] + sizes - both) * num
    a, b = np.nonzero(np.triu(close & (labels[:, None] != labels), 1))
    lows, highs = np.minimum(labels[a], labels[b]), np.maximum(labels[a], labels[b])
    _, one = np.unique(np.stack([lows, highs], 1), axis=0, return_index=True)
    return list(zip(a[one].tolist(), b[one].tolist(), strict=True))


def _near_in_blocks(num: int, den: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by unit (hub, i, j), those that may be similar to one of another label there."""
    unit, rows, sizes, sketches = None, [], [], []

    def near() -> list[tuple[int, ...]]:
        if len(rows) < 2:
            return []
        labels = np.array([label for *_, label in rows])
        return [rows[x] for x in np.flatnonzero(near_others(np.array(sizes), sketches, labels, num, den))]

    for batch in batches:
        out = []
        for hub, i, j, doc, label, n, bits in zip(*(batch[c] for c in ("hub", "i", "j", "id", "label",
                                                                       "n", "sketch")), strict=True):
            if (hub, i, j) != unit:
                out.extend(near())
                unit, rows, sizes, sketches = (hub, i, j), [], [], []
            rows.append((hub, i, j, doc, label))
            sizes.append(n)
            sketches.append(np.frombuffer(bits, np.uint64))
        yield pd.DataFrame(out, columns=["hub", "i", "j", "id", "label"], dtype=np.int64)
    yield pd.DataFrame(near(), columns=["hub", "i", "j", "id", "label"], dtype=np.int64)


def _in_blocks(k: int, num: int, den: int,
               batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between labels, of rows sorted by unit (hub, i, j); a unit has two blocks at most."""
    unit, ids, labels, sets = None, [], [], []

    def links() -> list[tuple[int, int]]:
        found = _links_of(sets, np.array(labels), num, den) if len(sets) > 1 else []
        return [(ids[a], ids[b]) for a, b in found]

    for batch in batches:
        out = []
        for hub, i, j, doc, label, own in zip(*(batch[c].to_pylist() for c in ("hub", "i", "j", "id",
                                                                               "label")),
                                              shingle_sets(batch["text"], k), strict=True):
            if (hub, i, j) != unit:
                out.extend(links())
                unit, ids, labels, sets = (hub, i, j), [], [], []
            ids.append(doc)
            labels.append(label)
            sets.append(own)
        yield _pairs(out)
    yield _pairs(links())


def similar(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, key: str = "doc_id",
            text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) of every row: its set's size and the smallest key reachable.

    Two documents are linked when their sets' Jaccard similarity is num / den or more; every link is
    found. Documents without words are linked with nothing. Equal sets are one class and go on as one
    document. Rows of one key are one document with several texts. A null key has component null and
    is linked with nothing; an empty table gives an empty one; other columns are not read.

    At scale: a document deals its rows over some hundred signatures, so even a signature that a third
    of all documents share is a small part of all rows; its group is streamed in order and only the
    hub is held. Clusters are cut into blocks. Members of one cluster in different components must be
    compared with each other: that work grows with the square of such a cluster, its rows do not.
    Disk holds one job's shuffle at a time; the largest are the signatures and the texts by their key.
    """
    with shuffles_freed(docs.sparkSession):
        return _similar(docs, k, num, den, key, text)


def _similar(docs: DataFrame, k: int, num: int, den: int, key: str, text: str) -> DataFrame:
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    sets = stored(
        texts.mapInArrow(partial(_sets, k), "id long, n long, k1 long, k2 long, sketch binary"),
        "sets")
    known = sets.where("id IS NOT NULL AND n > 0")
    classes = stored(
        known.groupBy("n", "k1", "k2").agg(F.min("id").alias("rep")), "classes")
    of = known.join(classes, ["n", "k1", "k2"]).select("id", "rep").distinct()
    # ids of one class, and several texts of one id, are linked from the start
    of = stored(of, "reps")
    # rows carry a key of the set, so copies are one member without a join of texts
    pairs = stored(
        texts.where("id IS NOT NULL").mapInArrow(partial(_signed, k, num, den), "sig long, key long")
        .repartition("sig").sortWithinPartitions("sig", "key")
        .mapInArrow(_hubs, "hub long, key long").distinct(), "pairs",
    )
    rep = classes.select(F.col("k1").alias("key"), "rep")
    pairs = stored(
        pairs.join(rep.select(F.col("key").alias("hub"), F.col("rep").alias("h")), "hub").join(rep, "key")
        .select(F.col("h").alias("hub"), F.col("rep").alias("id")).where("hub <> id").distinct(), "members",
    )
    n_blocks = stored(pairs.groupBy("hub").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "hubs")
    wanted = pairs.select("id").union(pairs.select("hub")).distinct()
    # texts and sketches are joined by merge joins, so that small inputs go the way of large ones
    sketches = stored(
        known.select("id", "n", "sketch").join(wanted.hint("merge"), "id", "left_semi"), "sketches")

    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    rows = pairs.join(n_blocks, "hub").select("hub", block.alias("block"), "id").unionByName(
        n_blocks.select("hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                        F.col("hub").alias("id")))
    near = stored(
        rows.hint("merge").join(sketches, "id").select("hub", "block", "id", "n", "sketch")
        .repartition("hub", "block").sortWithinPartitions("hub", "block", F.col("id") != F.col("hub"))
        .mapInPandas(partial(_near_hub, num, den), "hub long, block int, id long").distinct(), "near",
    )
    links = stored(
        near.hint("merge").join(texts, "id").select("hub", "block", "id", "text")
        .repartition("hub", "block").sortWithinPartitions("hub", "block", F.col("id") != F.col("hub"))
        .mapInArrow(partial(_against_hub, k, num, den), "a long, b long"), "links",
    ).unionByName(of.select(F.col("id").alias("a"), F.col("rep").alias("b")))
    label = components(links)
    members = pairs.join(label, "id", "left").select(
        "hub", "id", F.coalesce("component_id", "id").alias("label"))
    mixed = members.groupBy("hub").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"),
        F.min("label").alias("l0"), F.max("label").alias("l1"),
    ).where("l0 <> l1").select("hub", "blocks")
    units = stored(
        members.join(mixed, "hub").withColumn("own", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("hub", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                "id", "label"), "units",
    )
    near = stored(
        units.hint("merge").join(sketches, "id").select("hub", "i", "j", "id", "label", "n", "sketch")
        .repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j")
        .mapInPandas(partial(_near_in_blocks, num, den), "hub long, i int, j int, id long, label long")
        .distinct(), "near",
    )
    more = stored(
        near.hint("merge").join(texts, "id").select("hub", "i", "j", "id", "label", "text")
        .repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j")
        .mapInArrow(partial(_in_blocks, k, num, den), "a long, b long"), "more",
    )
    final = stored(components(links.unionByName(more)), "components")
    return sets.join(final, "id", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """The documents of which no similar one has a smaller key, with the columns they came with.

    Rows without a key are kept. Repeated rows of a kept key all stay.
    """
    found = similar(docs, key=key, text=text, **limits)
    dropped = found.where(F.col(key) != F.col("component_id")).select(F.col(key).alias("__key"))
    return docs.join(dropped.distinct(), F.col(key) == F.col("__key"), "left_anti")
