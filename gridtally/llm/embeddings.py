"""Embedding near-dedup: sign hashing in several tables, exact cosines, connected components.

Random hyperplanes give every vector a code of signs per table; vectors of one code in one table form a
bucket and are compared exactly, in double precision. The number of bits follows the number of vectors,
so buckets stay small, and the number of tables follows the bits, so that a pair right at the threshold
shares a bucket with the probability RECALL; closer pairs are found more surely.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.common import components, stored

LEAST_COSINE = 0.95
RECALL = 0.999
#: Vectors of a bucket, on average, if signs were even.
PER_BUCKET = 16
SEED = 20240601
#: Members of a block; a larger bucket is compared block by block.
BLOCK = 1024


def tables_for(n: int, least: float = LEAST_COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(tables, bits) for so many vectors."""
    bits = min(40, max(4, math.ceil(math.log2(max(1, n) / PER_BUCKET))))
    same = (1 - math.acos(least) / math.pi) ** bits
    return math.ceil(math.log(1 - recall) / math.log(1 - same)), bits


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Vectors as bytes with a 128-bit hash; null where a vector links with nothing."""
    for batch in batches:
        raws, ones, twos = [], [], []
        for v in batch["vector"]:
            v = None if v is None else np.asarray(v, np.float64)
            if v is None or not len(v) or not np.isfinite(v).all() or not v.any():
                raws.append(None)
                ones.append(0)
                twos.append(0)
                continue
            raw = (v + 0.0).tobytes()  # one zero
            raws.append(raw)
            h = xxhash.xxh3_128_intdigest(raw)
            ones.append((h & (1 << 63) - 1))
            twos.append((h >> 64) & (1 << 63) - 1)
        yield pd.DataFrame({"id": batch["id"], "raw": raws, "k1": ones, "k2": twos})


def _coded(tables: int, bits: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    planes: dict[int, np.ndarray] = {}
    powers = 1 << np.arange(bits, dtype=np.int64)
    for batch in batches:
        codes = []
        for raw in batch["raw"]:
            v = np.frombuffer(raw)
            if len(v) not in planes:
                rng = np.random.default_rng([SEED, len(v)])
                planes[len(v)] = rng.standard_normal((tables * bits, len(v)))
            signs = (planes[len(v)] @ (v / np.abs(v).max()) > 0).reshape(tables, bits)
            codes.append(signs @ powers)
        yield batch.assign(codes=codes)


def _unit_links(raws: list, codes: np.ndarray, blocks: np.ndarray, table: int, across: bool,
                least: float) -> tuple[np.ndarray, np.ndarray]:
    """Which of a unit's vectors are linked, and which of these links no earlier table has."""
    v = np.stack([np.frombuffer(r) for r in raws])
    v = v / np.abs(v).max(axis=1, keepdims=True)  # neither squares nor norms overflow
    norm = np.sqrt((v * v).sum(axis=1))
    links = (v @ v.T) / (norm[:, None] * norm) >= least
    np.fill_diagonal(links, False)
    if across:
        links &= blocks[:, None] != blocks
    a, b = np.nonzero(np.triu(links))
    new = ~(codes[a, :table] == codes[b, :table]).any(axis=1)
    first = np.zeros_like(links)
    first[a[new], b[new]] = True
    return links, first | first.T


def _roots(links: np.ndarray) -> np.ndarray:
    """The smallest member that each member reaches."""
    root = np.arange(len(links))
    while True:
        near = np.where(links, root, len(links)).min(axis=1)
        low = np.minimum(root, near)
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _compare(least: float, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(id, n, root) of rows sorted by unit (t, code, dim, i, j): links first found here, and a
    member of the unit that the vector is connected with."""
    unit, rows = None, []

    def done() -> list[tuple[int, int, int]]:
        if len(rows) < 2:
            return []
        ids, mults, raws, codes, blocks = zip(*rows, strict=True)
        links, first = _unit_links(raws, np.stack(codes), np.array(blocks), unit[0],
                                   unit[3] != unit[4], least)
        if not links.any():
            return []
        n, root = first @ np.array(mults, np.int64), _roots(links)
        return [(ids[i], int(n[i]), ids[root[i]]) for i in np.flatnonzero(links.any(axis=1))]

    for batch in batches:
        out = []
        for r in batch.itertuples(index=False):
            if (r.t, r.code, r.dim, r.i, r.j) != unit:
                out.extend(done())
                unit, rows = (r.t, r.code, r.dim, r.i, r.j), []
            rows.append((r.id, r.mult, r.raw, r.codes, r.own))
        yield pd.DataFrame(out, columns=["id", "n", "root"], dtype=np.int64)
    yield pd.DataFrame(done(), columns=["id", "n", "root"], dtype=np.int64)


def near_duplicates(vectors: DataFrame, least: float = LEAST_COSINE, key: str = "vec_id",
                    vector: str = "embedding") -> DataFrame:
    """(key, n_links, component_id, kept) of every row.

    Two vectors are linked when their cosine is ``least`` or more; no other pair is. Equal vectors are
    one class with a count, so copies are linked without being paired. A vector that is null, empty,
    zero or holds a null or non-finite number, or whose key is null, links with nothing; vectors of
    different lengths are not linked. Repeated rows of a key count as vectors, and their key is one
    node. An empty table gives an empty one; other columns are not read.

    The number of links needs every close pair, so the work in a bucket of different, mutually close
    vectors is the square of their number; it is cut into blocks, and a row per vector leaves them.
    """
    read = stored(
        vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("vector"))
        .mapInPandas(_read, "id long, raw binary, k1 long, k2 long"), "vectors")
    valid = read.where("id IS NOT NULL AND raw IS NOT NULL")
    classes = stored(
        valid.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("mult"),
                                      F.first("raw").alias("raw")), "classes")
    tables, bits = tables_for(classes.count(), least)
    # a class is named by its hash: with repeated keys two classes may have one smallest key
    coded = stored(
        classes.select(F.col("k1").alias("id"), "mult", "raw").mapInPandas(
            partial(_coded, tables, bits), "id long, mult long, raw binary, codes array<long>"), "codes")
    placed = coded.select("id", (F.length("raw") / 8).cast("int").alias("dim"),
                          F.posexplode("codes").alias("t", "code"))
    bucket = ["t", "code", "dim"]
    sizes = placed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        *bucket, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    units = placed.join(sizes, bucket).withColumn(
        "own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    ).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *bucket, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id")
    unit = [*bucket, "i", "j"]
    found = stored(
        units.join(coded, "id").repartition(*unit).sortWithinPartitions(*unit)
        .mapInPandas(partial(_compare, least), "id long, n long, root long"), "links")
    linked = found.groupBy("id").agg(F.sum("n").alias("n"))
    name = classes.select("k1", "rep")
    edges = found.where("id <> root").select("id", "root").distinct() \
        .join(name.toDF("id", "a"), "id").join(name.toDF("root", "b"), "root").select("a", "b")
    members = valid.select("id", "k1", "k2").join(classes.select("k1", "k2", "rep", "mult"), ["k1", "k2"])
    reached = components(edges.unionByName(
        members.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))))
    counted = members.join(linked.withColumnRenamed("id", "k1"), "k1", "left").select(
        "id", (F.col("mult") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    rest = read.where("id IS NULL OR raw IS NULL").select("id", F.lit(0).cast("long").alias("n_links"))
    reached = reached.withColumnRenamed("id", "of")
    component = F.coalesce("component_id", "id")
    return counted.unionByName(rest).join(reached, F.col("id") == F.col("of"), "left").select(
        F.col("id").alias(key), "n_links", component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
