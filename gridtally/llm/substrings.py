"""Substring dedup by De Bruijn compaction over token k-mers.

Every window of ``width`` words is an edge of a De Bruijn graph; an edge is repeated when it occurs in
several documents. Consecutive windows of a document whose smallest inner gram, the minimizer, is the
same occurrence form a path, and a path is compact as long as all paths of its minimizer are equal: the
graph does not branch there, one row stands for all its edges, and its source coordinates say what they
cover. Paths meet by aggregates and joins on the minimizer and on minimizer and content. A path that a
smaller document has too is repeated as a whole. Where paths of a minimizer differ, the graph branches:
the first occurrence of each is taken apart into its edges, which are counted one by one. Equal windows
have equal minimizers at equal places, and whatever edge a later equal path has its first one has too,
so no repeated edge is missed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.common import WORDS, stored

WIDTH = 13
#: Words of the inner grams; a window has WIDTH - GRAM + 1 of them.
GRAM = 5
ROWS = 50_000
#: Words that are hashed together; texts are never cut, a longer one goes alone.
CHUNK = 100_000


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[str]) -> np.ndarray:
    seen = {w: xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in set(words)}
    return np.array([seen[w] for w in words], np.uint64)


def gram_hashes(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """A hash of every k consecutive words: of two shorter grams that overlap, doubled up from words."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out, size = _mixed(h + np.uint64(k + (seed << 32))), 1
    while size < k:
        step = min(size, k - size)
        out = _mixed(out[:-step] * np.uint64(0x9E3779B97F4A7C15) + out[step:])
        size += step
    return out


def paths(h: np.ndarray, sizes: np.ndarray, width: int = WIDTH, gram: int = GRAM):
    """(document, minimizer, content, first window, windows) of the paths of several documents.

    ``h`` has the words of all of them, ``sizes`` how many each has, ``width`` at the least. ``content``
    is a hash of all words under the path and of where the minimizer lies in it.
    """
    n = len(h) - width + 1
    grams = gram_hashes(h, gram)
    best, at = grams[:n].copy(), np.arange(n)
    for j in range(1, width - gram + 1):
        now = grams[j:j + n]
        less = np.flatnonzero(now < best)
        best[less] = now[less]
        at[less] = less + j
    # the windows that lie in one document
    begin = np.cumsum(sizes) - sizes
    windows = sizes - width + 1
    doc = np.repeat(np.arange(len(sizes)), windows)
    inside = np.repeat(begin - np.cumsum(windows) + windows, windows) + np.arange(len(doc))
    at = at[inside]
    first = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])))
    count = np.diff(np.append(first, len(doc)))
    doc, start = doc[first], inside[first]
    # the words under a path are those under its first and its last window
    edges = gram_hashes(h, width, 1)
    content = _mixed(edges[start] + np.uint64(0x9E3779B97F4A7C15) * edges[start + count - 1])
    content = _mixed(content + (at[first] - start).astype(np.uint64) * np.uint64(64)
                     + count.astype(np.uint64))
    return doc, best[start], content, start - begin[doc], count


def _chunks(batches: Iterator[pd.DataFrame], width: int, text) -> Iterator[tuple]:
    """Rows with ``width`` words or more and the hashes of all their words, some rows at a time."""
    for batch in batches:
        rows, words, sizes, n = [], [], [], 0
        for k, value in enumerate(batch[text[0]]):
            mine = WORDS.findall(text[1](value))
            if len(mine) < width:
                continue
            rows.append(k)
            words.append(word_hashes(mine))
            sizes.append(len(mine))
            n += len(mine)
            if n > CHUNK:
                yield batch.iloc[rows], np.concatenate(words), np.array(sizes)
                rows, words, sizes, n = [], [], [], 0
        if rows:
            yield batch.iloc[rows], np.concatenate(words), np.array(sizes)


def _path_rows(width: int, gram: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Paths with the hash of their content; first window and windows share one number."""
    for rows, h, sizes in _chunks(batches, width, ("text", lambda t: t or "")):
        doc, m, content, first, count = paths(h, sizes, width, gram)
        yield pd.DataFrame({
            "m": m.view(np.int64), "id": rows["id"].to_numpy(np.int64)[doc],
            "row": rows["row"].to_numpy(np.int64)[doc], "at": first * width + count - 1,
            "content": content.view(np.int64),
        })


def _edges(width: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edges of the paths that are taken apart, two hashes each, with their coordinates."""
    for rows, h, sizes in _chunks(batches, width, ("packed", _text)):
        one, two = gram_hashes(h, width, 2), gram_hashes(h, width, 3)
        ats = [np.asarray(a, np.int64) for a in rows["apart"]]
        begin = np.repeat(np.cumsum(sizes) - sizes, [len(a) for a in ats])
        doc = np.repeat(np.arange(len(ats)), [len(a) for a in ats])
        ats = np.concatenate(ats)
        first, count = ats // width, ats % width + 1
        at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        place = at + np.repeat(begin, count)
        doc = np.repeat(doc, count)
        for k in range(0, len(at), ROWS):
            part = slice(k, k + ROWS)
            yield pd.DataFrame({
                "e1": one[place[part]].view(np.int64), "e2": two[place[part]].view(np.int64),
                "id": rows["id"].to_numpy(np.int64)[doc[part]],
                "row": rows["row"].to_numpy(np.int64)[doc[part]], "at": at[part],
            })


def _later(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(row, at) of edges that also occur in a smaller document; rows sorted by edge and document."""
    edge, doc0 = None, 0
    for batch in batches:
        e1, e2, doc, row, at = (batch[c].to_numpy() for c in ("e1", "e2", "id", "row", "at"))
        n = len(e1)
        if not n:
            continue
        head = np.append(True, (e1[1:] != e1[:-1]) | (e2[1:] != e2[:-1]))
        head[0] = (e1[0], e2[0]) != edge
        start = np.maximum.accumulate(np.where(head, np.arange(n), -1))
        first = np.where(start < 0, doc0, doc[np.maximum(start, 0)])
        edge, doc0 = (e1[-1], e2[-1]), first[-1]
        hit = doc > first
        yield pd.DataFrame({"row": row[hit], "at": at[hit]})


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts compressed one by one: they are shuffled twice."""
    z = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        yield pd.DataFrame({"row": batch["row"], "id": batch["id"], "packed": [
            None if t is None else z.compress(t.encode("utf-8", "surrogatepass"))
            for t in batch["text"]]})


def _text(packed: bytes | None) -> str:
    if packed is None:
        return ""
    return zstandard.ZstdDecompressor().decompress(packed).decode("utf-8", "surrogatepass")


def _cut(width: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What is left of every document."""
    for batch in batches:
        out = []
        for packed, whole, single in zip(batch["packed"], batch["whole"], batch["single"], strict=True):
            words = WORDS.findall(_text(packed))
            gone = np.zeros(len(words) + 1, np.int64)
            if whole is not None and len(whole):
                at = np.asarray(whole, np.int64)
                np.add.at(gone, at // width, 1)
                np.add.at(gone, at // width + at % width + width, -1)
            if single is not None and len(single):
                at = np.asarray(single, np.int64)
                np.add.at(gone, at, 1)
                np.add.at(gone, at + width, -1)
            gone = np.cumsum(gone)[:len(words)] > 0
            kept = " ".join([w for w, g in zip(words, gone, strict=True) if not g]) if gone.any() \
                else " ".join(words)
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
            out.append((len(words), int(gone.sum()), kept,
                        [{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()]))
        n, removed, kept, spans = zip(*out, strict=True) if out else ((),) * 4
        yield pd.DataFrame({"id": batch["id"], "n_words": n, "n_removed": removed, "kept": kept,
                            "removed": spans})


def dedup(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """(key, n_words, n_removed, kept, removed) of every row.

    A word goes when a window of ``width`` words over it also starts in a document with a smaller key;
    ``kept`` is the other words joined by one space, ``removed`` the spans of words that went. Null
    and empty texts have no words. Rows of one key are one document, so they take nothing from each
    other, and what a smaller document has goes from each of them. A null key takes part in nothing. An
    empty table gives an empty one; other columns are not read.

    At scale: paths meet by aggregates that combine map-side and by joins with stored tables, so a
    minimizer that a third of all paths have is one row on one side and a skewed join that AQE splits
    on the other. Minimizers of one document go first, and only first occurrences are taken apart.
    Equal edges are streamed in order with one row in memory. Nothing meets on the driver.
    """
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    several = rows.where("id IS NOT NULL").groupBy("id").count().where("count > 1").limit(1).count()
    # coordinates need a name for each row: its key, or where keys repeat a hash with the text
    name = F.xxhash64("id", "text") if several else F.col("id")
    rows = rows.select(F.when(F.col("id").isNotNull(), name).alias("row"), "id", "text")
    found = stored(
        rows.where("id IS NOT NULL").mapInPandas(
            partial(_path_rows, width, gram), "m long, id long, row long, at int, content long"),
        "paths",
    )
    minimizers = stored(
        found.groupBy("m").agg(
            F.min("id").alias("low"), F.max("id").alias("high"),
            (F.min("content") != F.max("content")).alias("branches"),
        ).where("low < high").select("m", "low", "branches"), "minimizers",
    )
    meeting = stored(
        found.join(minimizers.hint("merge"), "m").where("branches OR id > low").drop("low"), "meeting",
    )
    at_branches = meeting.where("branches")
    firsts = stored(at_branches.groupBy("m", "content").agg(F.min("id").alias("low")), "firsts")
    repeated = stored(
        meeting.where("NOT branches").select("row", "at", F.lit(True).alias("whole")).unionByName(
            at_branches.join(firsts.hint("merge"), ["m", "content"])
            .select("row", "at", (F.col("id") > F.col("low")).alias("whole"))), "repeated",
    )
    packed = rows.mapInPandas(_pack, "row long, id long, packed binary")
    apart = repeated.where("NOT whole").groupBy("row").agg(
        F.sort_array(F.collect_set("at")).alias("apart"))
    single = stored(
        packed.where("id IS NOT NULL").join(apart.hint("merge"), "row")
        .select("row", "id", "packed", "apart")
        .mapInPandas(partial(_edges, width), "e1 long, e2 long, id long, row long, at int")
        .repartition("e1").sortWithinPartitions("e1", "e2", "id")
        .mapInPandas(_later, "row long, at int"), "edges",
    )
    spans = repeated.where("whole").select("row", "at", F.lit(True).alias("whole")).unionByName(
        single.select("row", "at", F.lit(False).alias("whole"))
    ).groupBy("row").agg(F.collect_set(F.when(F.col("whole"), F.col("at"))).alias("whole"),
                         F.collect_set(F.when(~F.col("whole"), F.col("at"))).alias("single"))
    return packed.join(spans.hint("merge"), "row", "left").select("id", "packed", "whole", "single") \
        .mapInPandas(partial(_cut, width),
                     "id long, n_words long, n_removed long, kept string, "
                     "removed array<struct<start: long, end: long>>") \
        .withColumnRenamed("id", key)
