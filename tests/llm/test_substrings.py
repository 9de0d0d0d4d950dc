"""Substring dedup against brute force."""

import hashlib
import random
import re

import pytest

from gridtally.llm import substrings
from gridtally.llm.queries import REGISTRY

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width=13):
    """(n_words, kept words) per row."""
    first = {}
    for i, t in rows:
        words = WORD.findall(t or "")
        for at in range(len(words) - width + 1):
            if i is not None:
                gram = tuple(words[at:at + width])
                first[gram] = min(first.get(gram, i), i)
    out = []
    for i, t in rows:
        words = WORD.findall(t or "")
        gone = [False] * len(words)
        for at in range(len(words) - width + 1):
            if i is not None and first[tuple(words[at:at + width])] < i:
                gone[at:at + width] = [True] * width
        out.append((i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return sorted(out, key=str)


def texts(seed):
    rng = random.Random(seed)
    say = lambda n, kinds=400: [f"w{rng.randrange(kinds)}" for _ in range(n)]
    passages = [say(n) for n in (13, 14, 20, 60, 200, 35)]
    hot = say(25)
    out = [None, "", "a b c", " ".join(say(12)), "x " * 40, "x " * 60, "y z " * 30]
    for _ in range(60):
        words = say(rng.randint(0, 120))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cut = p[rng.randint(0, 4):len(p) - rng.randint(0, 4)]
            if rng.random() < 0.3:
                cut = list(cut)
                cut[rng.randrange(len(cut))] = "edit"
            words[rng.randint(0, len(words)):0] = cut
        if rng.random() < 0.4:
            words += hot
        out.append(" ".join(words))
    out += [out[10], out[10], out[20] + " tail", "head " + out[20], "x " * 45]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed, batch", [(0, 10000), (1, 5), (2, 37), (3, 1)])
def test_brute_force(spark, seed, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        ids = list(range(0, 10**6, 7))
        random.Random(seed).shuffle(ids)
        rows = list(zip(ids, texts(seed))) + [(None, texts(seed)[9]), (None, None)]
        docs = spark.createDataFrame([(*r, 1, "z") for r in rows],
                                     "doc_id long, text string, row int, kept string")
        got = substrings.dedup(docs).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == brute(rows)
        for r in got:
            assert sum(s.end - s.start for s in r.removed) == r.n_removed
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10000)


def test_repeated_keys_and_empty_table(spark):
    t = texts(5)
    rows = [(i % 9, x) for i, x in enumerate(t)] + [(3, t[0]), (3, t[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.dedup(docs).collect()]
    assert sorted(got, key=str) == brute(rows)
    assert substrings.dedup(docs.limit(0)).collect() == []


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {i: (n, k, hashlib.sha256(x.encode()).hexdigest()) for i, n, k, x in brute(rows)}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in REGISTRY["op3_debruijn_substrings"](spark, sf).collect()}
    assert got == want
