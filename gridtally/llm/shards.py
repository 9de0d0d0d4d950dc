"""Token ids in binary shards, and a minimal perfect hash index over the documents' keys.

Format, all little-endian: ``shard-NNNNN.bin`` holds nothing but ids, one document after the other in
ascending key order; ``index-NNNNN.mph`` holds the keys whose hash falls to that index: the header
(keys, groups) as two uint32, a displacement per group as int32, and one entry per key (fingerprint,
shard, first id in the shard, ids). A lookup hashes the key to its index and group, reads one
displacement and one entry, and compares the fingerprint; a key that was never written is refused
but for one in 2**32. Repeated keys are told apart by a copy number, so no row is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.llm import tokens
from gridtally.llm.common import stored

#: Keys of one index file, about; an index is built and read in one task.
KEYS_PER_INDEX = 20_000
#: Keys of one displacement group, on average.
GROUP = 4
ENTRY = np.dtype([("print", "<u4"), ("shard", "<u4"), ("first", "<u8"), ("n", "<u4")])


def _open(path: str):
    return arrow_fs.FileSystem.from_uri(path)


def _write(path: str, chunks: Iterator[bytes]) -> None:
    """To a name of this attempt, then renamed: a lost task leaves no half file of that name."""
    files, at = _open(path)
    files.create_dir(at.rpartition("/")[0])
    part = f"{at}.{TaskContext.get().taskAttemptId()}.part"
    with files.open_output_stream(part) as out:
        for chunk in chunks:
            out.write(chunk)
    files.move(part, at)


def shard_path(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:05d}.bin"


def index_path(folder: str, bucket: int) -> str:
    return f"{folder}/index-{bucket:05d}.mph"


def write_shards(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text",
                 tokenizer: str | None = None) -> DataFrame:
    """Writes the shards; (key, copy, shard, first, n) of every row, from a stored table.

    Null text is an empty one and gives the end id alone; null keys come first; repeated keys follow
    each other by text with copy numbers 0, 1 and so on. An empty table writes no shard. One range
    shuffle; a partition streams its rows into one file.
    """
    path = tokenizer or tokens.default_tokenizer()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, shard = tokens.encoder(path), TaskContext.get().partitionId()
        rows: list[pd.DataFrame] = []

        def chunks() -> Iterator[bytes]:
            at, previous, copy = 0, object(), 0
            for batch in batches:
                sizes, keys, copies = [], batch["key"].tolist(), []
                for k, t in zip(keys, batch["text"], strict=True):
                    k = None if pd.isna(k) else k
                    copy = copy + 1 if k == previous else 0
                    previous = k
                    (ids,) = encoder.encode([t])
                    sizes.append(len(ids) // encoder.dtype.itemsize)
                    copies.append(copy)
                    yield ids
                n = np.array(sizes, np.int64)
                rows.append(pd.DataFrame({
                    "key": batch["key"], "copy": np.array(copies, np.int64), "shard": shard,
                    "first": at + np.cumsum(n) - n, "n": n,
                }))
                at += int(n.sum())

        stream = chunks()
        head = next(stream, None)
        if head is not None:
            _write(shard_path(folder, shard), _after(head, stream))
        yield from rows

    kind = docs.schema[key].dataType.simpleString()
    ordered = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")) \
        .repartitionByRange("key").sortWithinPartitions("key", "text")
    return stored(
        ordered.mapInPandas(write, f"key {kind}, copy long, shard int, first long, n long"), "rows"
    )


def _after(head: bytes, rest: Iterator[bytes]) -> Iterator[bytes]:
    yield head
    yield from rest


def with_starts(rows: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all documents before. The window has one row per shard."""
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy("shard").agg(F.sum("n").alias("ids")).select(
        "shard", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("base")
    )
    return rows.join(bases, "shard").withColumn("start", F.col("base") + F.col("first"))


def hashes(key: Column, copy: Column) -> list[Column]:
    """Three independent 64-bit hashes: of the index and group, of the slot, and the fingerprint."""
    return [F.xxhash64(F.lit(i), key, copy).alias(f"h{i}") for i in range(3)]


def _slots(h: np.ndarray, d: np.ndarray | int, n: int) -> np.ndarray:
    """Slot of a key under displacement ``d``: another mix of its second hash for every d."""
    x = h.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.asarray(d).astype(np.uint64)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return (x % np.uint64(n)).astype(np.int64)


def build_index(h0: np.ndarray, h1: np.ndarray, entries: np.ndarray) -> bytes:
    """A minimal perfect hash: hash, displace, and place single keys in what is left.

    Groups of keys go largest first; a group takes the first displacement that puts all its keys in
    free slots. A group of one key stores its slot itself, as a negative displacement.
    """
    n = len(h0)
    groups = max(1, -(-n // GROUP))
    of = (h0.astype(np.uint64) % np.uint64(groups)).astype(np.int64)
    sizes = np.bincount(of, minlength=groups)
    by_group = np.argsort(of, kind="stable")
    ends = np.cumsum(sizes)
    moves, free = np.zeros(groups, "<i4"), np.ones(n, bool)
    place = np.empty(n, np.int64)
    for g in np.argsort(-sizes, kind="stable"):
        if sizes[g] < 2:
            break
        keys = by_group[ends[g] - sizes[g]:ends[g]]
        if len(np.unique(h1[keys])) < len(keys):
            raise ValueError("two keys have the same hashes")
        d = 0
        while True:
            tried = _slots(np.repeat(h1[keys], 32), np.tile(np.arange(d, d + 32), len(keys)), n)
            tried = tried.reshape(len(keys), 32)
            fits = free[tried].all(axis=0)
            for k in np.flatnonzero(fits):
                if len(np.unique(tried[:, k])) == len(keys):
                    moves[g], place[keys] = d + k, tried[:, k]
                    free[tried[:, k]] = False
                    break
            else:
                d += 32
                continue
            break
    single = by_group[ends[sizes == 1] - 1]
    place[single] = np.flatnonzero(free)
    moves[of[single]] = -1 - place[single]
    table = np.empty(n, ENTRY)
    table[place] = entries
    return np.array([n, groups], "<u4").tobytes() + moves.tobytes() + table.tobytes()


def look_up(index: bytes, h0: np.ndarray, h1: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """The entries of the keys; where the fingerprint differs, ``n`` is 0: no such key."""
    n, groups = (int(x) for x in np.frombuffer(index, "<u4", 2))
    moves = np.frombuffer(index, "<i4", groups, 8)
    table = np.frombuffer(index, ENTRY, n, 8 + 4 * groups)
    if n == 0:
        return np.zeros(len(h0), ENTRY)
    d = moves[(h0.astype(np.uint64) % np.uint64(groups)).astype(np.int64)]
    found = table[np.where(d < 0, -1 - d, _slots(h1, np.maximum(d, 0), n))].copy()
    found["n"][found["print"] != prints] = 0
    return found


def _prints(h2: pd.Series) -> np.ndarray:
    return (h2.to_numpy(np.int64).astype(np.uint64) >> np.uint64(32)).astype(np.uint32)


def write_index(rows: DataFrame, folder: str) -> int:
    """Builds the index files from ``write_shards``' rows; how many there are."""
    buckets = max(1, -(-rows.count() // KEYS_PER_INDEX))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        entries = np.empty(len(group), ENTRY)
        entries["print"] = _prints(group["h2"])
        for name in ("shard", "first", "n"):
            entries[name] = group[name]
        index = build_index(group["h0"].to_numpy(np.int64) // buckets,
                            group["h1"].to_numpy(np.int64), entries)
        bucket = int(group["bucket"].iloc[0])
        _write(index_path(folder, bucket), iter([index]))
        return pd.DataFrame({"bucket": [bucket], "keys": [len(group)]})

    hashed = rows.select(
        *hashes(F.col("key"), F.col("copy")), "shard", "first", "n"
    ).withColumn("bucket", F.pmod("h0", F.lit(buckets)))
    stored(hashed.groupBy("bucket").applyInPandas(build, "bucket long, keys long"), "index")
    return buckets


def find(keys: DataFrame, folder: str, buckets: int) -> DataFrame:
    """(key, copy, shard, first, n) of the keys (key, copy) that the index knows."""
    kind = keys.schema["key"].dataType.simpleString()

    def look(group: pd.DataFrame) -> pd.DataFrame:
        files, at = _open(index_path(folder, int(group["bucket"].iloc[0])))
        with files.open_input_stream(at) as f:
            index = f.read()
        found = look_up(index, group["h0"].to_numpy(np.int64) // buckets,
                        group["h1"].to_numpy(np.int64), _prints(group["h2"]))
        out = group[["key", "copy"]].assign(
            **{c: found[c].astype(np.int64) for c in ("shard", "first", "n")})
        return out[found["n"] > 0]

    hashed = keys.select("key", "copy", *hashes(F.col("key"), F.col("copy"))).withColumn(
        "bucket", F.pmod("h0", F.lit(buckets)))
    return hashed.groupBy("bucket").applyInPandas(
        look, f"key {kind}, copy long, shard long, first long, n long")


def read_ids(located: DataFrame, folder: str, dtype: str) -> DataFrame:
    """Adds ``ids``, little-endian uint32, read from the shards at the given places."""
    size = np.dtype(dtype).itemsize

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, f = None, None
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                if r.shard != shard:
                    files, at = _open(shard_path(folder, r.shard))
                    shard, f = r.shard, files.open_input_file(at)
                raw = f.read_at(r.n * size, r.first * size)
                out.append(np.frombuffer(raw, dtype).astype("<u4").tobytes())
            yield batch.assign(ids=out)

    placed = located.repartition("shard").sortWithinPartitions("shard", "first")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in located.schema)
    return placed.mapInPandas(read, f"{fields}, ids binary")


def dtype_of(tokenizer: str | None = None) -> str:
    return tokens.encoder(tokenizer or tokens.default_tokenizer()).dtype.str
