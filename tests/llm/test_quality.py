"""Quality rules against brute force, and the odd cases."""

import random
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridtally.llm import quality, suffixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)

    def cover(k):
        seen, hit = {}, [False] * n
        for i in range(n - k + 1):
            seen.setdefault(tuple(words[i:i + k]), []).append(i)
        for at in seen.values():
            if len(at) > 1:
                for i in at:
                    hit[i:i + k] = [True] * k
        return sum(hit)

    longest = 0
    for k in range(quality.REPEAT_WORDS, n):
        grams = [tuple(words[i:i + k]) for i in range(n - k + 1)]
        if len(grams) == len(set(grams)):
            break
        longest = k
    earlier, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in earlier
            earlier.add(line)
    windows, cov = cover(5), cover(quality.REPEAT_WORDS)
    failed = n < 10 or 100 * windows > 20 * n
    kept = not failed and 100 * cov <= quality.MOST_COVERED_PERCENT * n and longest <= 100
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, windows, cov, longest,
            failed, kept)


def texts():
    rng = random.Random(5)
    out = [None, "", "   \n\t", "a", "a " * 30, "x\ny\nx\n\n\n x\nx", "# * $$ é b c", "a\x1cb " * 12]
    for size in (12, 40, 200, 900):
        for kinds in (2, 5, 40, 4000):
            words = [f"w{rng.randrange(kinds)}" for _ in range(size)]
            out.append(" ".join(words))
            out.append(" ".join(words + words[3:3 + size // 4]) + "\n" + " ".join(words[:12]))
    return out


def test_judge_is_brute_force(monkeypatch):
    want = [brute(t) for t in texts()]
    for batch in (1, 50, 10**6):
        monkeypatch.setattr(quality, "BATCH_WORDS", batch)
        assert [tuple(r) for r in quality.judge(pd.Series(texts())).itertuples(index=False)] == want


def fresh(start, n):
    return [f"w{i}" for i in range(start, start + n)]


def repeated(passage, rest):
    """A passage of so many words twice, and so many other words between and after."""
    return " ".join(fresh(0, passage) + fresh(1000, rest // 2) + fresh(0, passage)
                    + fresh(5000, rest - rest // 2))


@pytest.mark.parametrize("passage, rest, covered, longest, kept", [
    (13, 104, 0, 0, True),        # a short clean repeat of 20 %, as labelled texts have
    (20, 360, 40, 20, True),      # exactly 10 %
    (20, 359, 40, 20, False),     # by the covered part alone
    (50, 1900, 100, 50, True),
    (51, 1900, 102, 51, False),   # by the longest repeat alone
])
def test_each_limit_rejects_what_passes_the_base(passage, rest, covered, longest, kept):
    r = quality.judge(pd.Series([repeated(passage, rest)])).iloc[0]
    assert not r.base_failed and r.n_words == 2 * passage + rest
    assert (r.n_covered_words, r.longest_repeat, r.kept) == (covered, longest, kept)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_labelled_clean_texts_stay(sf):
    docs = pd.read_parquet(f"{sf}/documents.parquet").merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    judged = quality.judge(docs[docs.quality == 1].text)
    assert len(judged) and judged.kept[~judged.base_failed].all()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_longest_repeats(ids):
    best = suffixes.longest_repeats(np.array(ids, np.int64))
    for i in range(len(ids)):
        want = max((k for k in range(1, len(ids) - i + 1) for j in range(len(ids) - k + 1)
                    if j != i and ids[j:j + k] == ids[i:i + k]), default=0)
        assert best[i] == want


def test_table_with_odd_rows(spark):
    rows = [(1, t, "a", 5) for t in texts()] + [(None, None, None, None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality string, n_words long")
    got = quality.assess(docs).collect()
    assert len(got) == len(rows)
    assert sorted(tuple(r.quality) for r in got) == sorted(brute(r[1]) for r in rows)
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(brute(r[1])[-1] for r in rows)
    assert quality.assess(docs.limit(0)).collect() == []


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_is_brute_force(spark, sf):
    from gridtally.llm.queries import REGISTRY
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in REGISTRY["op9_suffix_quality"](spark, sf).collect():
        want = brute(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.n_covered_words, r.longest_repeat, r.base_failed, r.kept) == want
