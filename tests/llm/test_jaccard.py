"""The Jaccard join against brute force."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from gridtally.llm import jaccard
from gridtally.llm.queries import REGISTRY

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_set(text, k):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(rows, k, num, den):
    """Component per key by comparing all pairs."""
    sets = [(i, brute_set(t, k)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            both = len(a & b)
            if a and b and min(len(a), len(b)) * den >= max(len(a), len(b)) * num \
                    and both * den >= (len(a) + len(b) - both) * num:
                p, q = sorted((root(i), root(j)))
                parent[q] = p
    return {i: root(i) for i in parent}


def check(spark, rows, k, num, den):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, k, num, den)
    got = jaccard.similar(docs, k, num, den).collect()
    assert len(got) == len(rows)
    sizes = {}
    for i, t in rows:
        sizes.setdefault(i, []).append(len(brute_set(t, k)))
    for r in got:
        assert r.n_shingles in sizes[r.doc_id]
        assert r.component_id == want.get(r.doc_id), r


def near_copies(seed, n, words, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(3000)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy[rng.randint(0, 2):]))
    return out


@pytest.mark.parametrize("k, num, den", [(4, 85, 100), (5, 80, 100)])
def test_every_link_is_found(spark, monkeypatch, k, num, den):
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    texts = [None, "", " ", "a", "A", "a b", "a b c d", "a b c d e", "É b", "é b", "a b"]
    for seed, (n, words, edits) in enumerate([(40, 150, 9), (30, 40, 4), (20, 12, 2), (10, 700, 40),
                                              (15, 9, 1), (25, 80, 20)]):
        texts += near_copies(seed, n, words, edits)
    random.Random(1).shuffle(texts)
    rows = list(enumerate(texts)) + [(None, "a b c d"), (None, None)]
    check(spark, rows, k, num, den)


def test_several_texts_of_a_key_and_empty_table(spark):
    a, b = near_copies(3, 1, 60, 0)[0], near_copies(4, 1, 60, 0)[0]
    rows = [(5, a), (5, b), (5, b), (2, a), (9, b), (7, "other words here")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n string")
    got = {r.doc_id: r.component_id for r in jaccard.similar(docs).collect()}
    assert got == {5: 2, 2: 2, 9: 2, 7: 7}
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 7]
    assert jaccard.similar(docs.limit(0)).collect() == []


@pytest.mark.parametrize("num, den", [(85, 100), (8, 10), (1, 2)])
def test_similar_sets_share_a_signature(num, den):
    rng = np.random.default_rng(0)
    bands = jaccard.Bands(num, den)
    for _ in range(1500):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        drop = int(rng.integers(0, max(1, n // 4) + 1))
        add = int(rng.integers(0, max(1, n // 6) + 1))
        b = np.unique(np.append(rng.permutation(a)[drop:], rng.integers(0, 2**63, add).astype(np.uint64)))
        if jaccard.linked(a, b, num, den) and not np.array_equal(a, b):
            assert np.intersect1d(jaccard.signatures(a, bands), jaccard.signatures(b, bands)).size


@pytest.mark.parametrize("num, den", [(85, 100), (8, 10), (1, 2)])
def test_sketches_miss_no_link(num, den):
    rng = np.random.default_rng(1)
    draw = lambda n: np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
    links = far = passed = 0
    for _ in range(300):
        base = draw(int(rng.integers(1, 700)))
        sets = [base, *(np.unique(np.append(rng.permutation(base)[int(rng.integers(0, len(base) // 4 + 1)):],
                                            draw(int(rng.integers(0, len(base) // 6 + 1))))) for _ in range(3)),
                draw(len(base)), draw(3 * len(base))]
        sketches, sizes = [jaccard.sketch(s) for s in sets], np.array([len(s) for s in sets])
        assert all(len(s) <= max(64, 64 * len(k)) < max(65, 2 * len(s) + 64)
                   for s, k in zip(sets, sketches, strict=True))
        labels = rng.integers(0, 3, len(sets))
        near = jaccard.near_others(sizes, sketches, labels, num, den)
        for x in range(len(sets)):
            for y in range(x):
                words = min(len(sketches[x]), len(sketches[y]))
                a, b = jaccard._folded(sketches[x], words), jaccard._folded(sketches[y], words)
                may = jaccard.may_link(sizes[x:x + 1], a[None], sizes[y], b, num, den)[0]
                if jaccard.linked(sets[x], sets[y], num, den):
                    links += 1
                    assert may and (labels[x] == labels[y] or near[x] and near[y])
                elif x >= 4 and len(base) > 50:
                    far += 1
                    passed += may
                if may and labels[x] != labels[y]:
                    assert near[x] and near[y]
    assert links > 300 and far > 1000
    if num * 10 >= den * 8:  # below, so many may differ that a bit or two a shingle tell less
        assert passed * 50 <= far


def test_texts_of_unlike_documents_stay_where_they_are(spark, monkeypatch):
    """Signatures of short texts are shared by many; only texts that the sketches leave are compared."""
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randint(14, 18))) for _ in range(300)]
    made, stored = [], jaccard.stored
    monkeypatch.setattr(jaccard, "stored", lambda df, name: made.append((name, out := stored(df, name))) or out)
    docs = spark.createDataFrame(list(enumerate([*texts, texts[0] + " x"])), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.similar(docs).collect()}
    assert got == {i: 0 if i == 300 else i for i in range(301)}
    rows = [(name, df.count()) for name, df in made if name in ("members", "near")]
    assert rows[0][0] == "members" and rows[0][1] > 100
    assert [n for name, n in rows if name == "near"] == [2, 0]
    assert not any("text" in df.columns for _, df in made)


@pytest.mark.parametrize("chunk", [1, 100, 1 << 17])
def test_sets_of_texts_side_by_side(monkeypatch, chunk):
    """Texts are taken apart many at once: no word, shingle or null of one touches the next."""
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    rng = random.Random(9)
    words = ["a", "A", "é", "É", "ab", "ba", "Z\u00a0z", "\u0085", "\u2003x", "\0", "\x1c", "x" * 64, "x" * 65, "y" * 300,
             "x" * 300, "日本", "本日", "😀"]
    texts = [None, "", " \t\n\x0b\x0c\r", "a b", "b", "a b c d", "", "e", *(
        rng.choice(["", " ", "\n"]) + rng.choice([" ", "\r\n", "\t"]).join(rng.choices(words, k=rng.randrange(9)))
        for _ in range(400)), None, ""]
    for k in (1, 4, 5):
        for form in (pa.array(texts), pa.array(texts, pa.large_string()), pa.array(["z", *texts])[1:]):
            sets = list(jaccard.shingle_sets(form, k))
            want = [brute_set(t, k) for t in texts]
            assert [len(s) for s in sets] == [len(w) for w in want]
            number = {}
            for t, s, w in zip(texts, sets, want, strict=True):
                assert (s[1:] > s[:-1]).all()
                assert number.setdefault(w, s.tobytes()) == s.tobytes(), t
            assert len(set(number.values())) == len(number)
            every = {x for s in sets for x in s.tolist()}
            assert len(every) == len({x for w in want for x in w})


def test_sets_cost_little_more_than_finding_the_words():
    """Words were hashed one by one, and sets took over five times what it costs to find them."""
    rng = random.Random(11)
    texts = [" ".join(f"w{rng.randrange(500_000)}" for _ in range(400)) for _ in range(1500)]
    column = pa.array(texts)
    plain, own = [], []
    for _ in range(3):
        at = time.process_time()
        found = [WORD.findall(t.lower()) for t in texts]
        plain.append(time.process_time() - at)
        at = time.process_time()
        sets = list(jaccard.shingle_sets(column, 4))
        own.append(time.process_time() - at)
    assert len(sets) == len(found)
    assert min(own) < 1.6 * min(plain)


def test_equal_texts_of_many_tasks_are_one_member(spark, monkeypatch):
    made, stored = [], jaccard.stored
    monkeypatch.setattr(jaccard, "stored", lambda df, name: made.append((name, out := stored(df, name))) or out)
    text, other = near_copies(7, 1, 90, 0)[0], near_copies(8, 1, 90, 0)[0]
    docs = spark.createDataFrame([(i, (text, other)[i % 2]) for i in range(40)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.similar(docs.repartition(8)).collect()}
    assert got == {i: i % 2 for i in range(40)}
    assert [df.count() for name, df in made if name in ("classes", "pairs")] == [2, 0]


def test_shuffle_files_go_with_their_jobs(spark):
    files = lambda: set(re.findall(
        r"shuffle_\d+_\d+_\d+\.data",
        spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")))
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    docs = spark.createDataFrame(list(enumerate(near_copies(6, 40, 150, 9))), "doc_id long, text string")
    before, setting = files(), spark.conf.get(name)
    found = jaccard.similar(docs)
    for _ in range(50):  # they are removed in the background
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before and spark.conf.get(name) == setting
    assert found.count() == 41


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(rows, 4, 85, 100)
    got = REGISTRY["op8_partenum_jaccard"](spark, sf).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(brute_set(t, 4)) for i, t in rows}
