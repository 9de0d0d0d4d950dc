"""Periodic runs against brute force, and the odd cases."""

import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridtally.llm import periods
from gridtally.llm.common import WORDS


def brute(words):
    """Every run (start, length, period), by trying all periods."""
    found = {}
    numbers = {}
    w = np.array([numbers.setdefault(x, len(numbers)) for x in words], np.int64)
    n = len(w)
    for p in range(1, n // 2 + 1):
        edge = np.diff(np.concatenate([[0], (w[:-p] == w[p:]).astype(np.int8), [0]]))
        for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            if e + p - s >= max(12, 2 * p):
                found.setdefault((s, e + p - s), p)
    return sorted([(s, length, p) for (s, length), p in found.items()], key=lambda r: (r[0], r[2]))


def left(words, runs):
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def samples():
    rng = random.Random(1)
    for _ in range(600):
        n, kinds = rng.randrange(0, 90), rng.choice([1, 2, 3, 5, 50])
        words = [rng.randrange(kinds) for _ in range(n)]
        if n and rng.random() < 0.5:
            a, p = rng.randrange(n), rng.randrange(1, n + 1)
            words = [words[i] if i < a else words[min(n - 1, a + (i - a) % p)] for i in range(n)]
        yield words


@pytest.mark.parametrize("batch, pairs", [(200_000, 2_000_000), (50, 7)])
def test_runs_are_brute_force(monkeypatch, batch, pairs):
    monkeypatch.setattr(periods, "BATCH_WORDS", batch)
    monkeypatch.setattr(periods, "BATCH_PAIRS", pairs)
    texts = list(samples())
    got = periods.runs([np.array(t, np.int64) for t in texts])
    assert [[tuple(r) for r in g.tolist()] for g in got] == [brute(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=80), st.data())
def test_extensions(ids, data):
    reach = periods.Extensions(np.array(ids, np.int64))
    i = np.array(data.draw(st.lists(st.integers(0, len(ids)), min_size=1, max_size=20)), np.int64)
    j = np.array([data.draw(st.integers(0, len(ids)).filter(lambda x, y=y: x != y)) for y in i], np.int64)
    for a, b, got in zip(i.tolist(), j.tolist(), reach(i, j).tolist(), strict=True):
        want = 0
        while max(a, b) + want < len(ids) and ids[a + want] == ids[b + want]:
            want += 1
        assert got == want


def test_cover_has_every_difference():
    assert {(a - b) % periods.MODULUS for a in periods.COVER for b in periods.COVER} == set(range(periods.MODULUS))
    assert periods.SHIFTS.max() < periods.MODULUS


def test_smallest_period_and_bounds():
    got = periods.judge(pd.Series(["a b " * 6, "a b " * 5 + "a", "x " + "a " * 12 + "y", None, "", " \n"]))
    rows = [[tuple(r.values()) for r in runs] for runs in got["runs"]]
    assert rows == [[(0, 12, 2)], [], [(1, 12, 1)], [], [], []]
    assert got["kept"].tolist() == ["a b", "a b a b a b a b a b a", "x a y", "", "", ""]
    assert got["n_words"].tolist() == [12, 11, 14, 0, 0, 0]


def test_long_text():
    assert periods.runs([np.zeros(50_000, np.int64)])[0].tolist() == [[0, 50_000, 1]]


def test_table_with_odd_rows(spark):
    texts = [None, "", "a b c " * 9, "one two", "a b c " * 9]
    docs = spark.createDataFrame([(1, t, "x", 5) for t in texts], "doc_id long, text string, periods string, n_words long")
    got = periods.assess(docs)
    assert got.columns == docs.columns
    rows = sorted((r.text or "", r.periods.n_words, r.periods.kept, len(r.periods.runs)) for r in got.collect())
    assert rows == sorted((t or "", len((t or "").split()), "a b c" if t and t[0] == "a" else t or "",
                           int(bool(t) and t[0] == "a")) for t in texts)
    assert periods.assess(docs.limit(0)).collect() == []


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_is_brute_force(spark, sf):
    from gridtally.llm.queries import REGISTRY
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = REGISTRY["op12_cover_runs"](spark, sf).collect()
    assert len(got) == len(docs) and sum(r.n_runs for r in got) > 10
    for r in got:
        words = WORDS.findall(docs[r.doc_id] or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        want = (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left(words, runs).encode()).hexdigest())
        assert tuple(r)[1:8] == want


def test_query_without_ids(spark, tmp_path):
    from gridtally.llm.queries import REGISTRY
    rows = [(None, "a " * 20), (20, None), (20, ""), (None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = REGISTRY["op12_cover_runs"](spark, str(tmp_path)).collect()
    assert sorted((r.n_runs, r.length, r.exponent_milli) for r in got if r.n_runs) == [(1, 20, 20000)]
    assert all(r.runs_sha256 and r.collapsed_sha256 for r in got) and len(got) == 4
