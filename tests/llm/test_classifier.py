"""The quality classifier: held-out accuracy, features, the sample's bound and the odd cases."""

import random
import zlib

import numpy as np
import pandas as pd
import pytest

from gridtally.llm import classifier

SCHEMA = "doc_id long, text string"


def brute_buckets(text):
    """Every n-gram of a text one by one: its bucket."""
    size = 1 << classifier.BITS
    words = text.split()
    out = []
    for w in words:
        out.append(zlib.crc32(w.encode()) % size)
        for n in (3, 4, 5):
            m = f"<{w}>"
            for i in range(len(m) - n + 1):
                h = n
                for c in m[i:i + n]:
                    h = (h ^ ord(c)) * int(classifier.PRIME) % 2**64
                out.append(h >> (64 - classifier.BITS))
    for a, b in zip(words, words[1:], strict=False):
        x, y = zlib.crc32(a.encode()), zlib.crc32(b.encode())
        mixed = (x * int(classifier.FIRST) + y * int(classifier.SECOND)) % 2**64 >> (64 - classifier.BITS)
        out.append(0 if x == y else mixed)
    return out


TEXTS = ["one two two three", "a", "añ ß " * 3, "x" * 200 + " y", "the the the the"]


def test_features_are_all_ngrams():
    words = classifier.Words()
    for text in TEXTS:
        at, share = classifier.features(text, words)
        counts = np.bincount(brute_buckets(text), minlength=1 << classifier.BITS)
        assert at.tolist() == np.flatnonzero(counts).tolist()
        assert np.allclose(share, counts[at] / counts.sum())
    assert len(classifier.features(None, words)[0]) == len(classifier.features(" \n", words)[0]) == 0


def test_score_is_the_mean_of_ngrams(monkeypatch):
    rng = np.random.default_rng(1)
    model = classifier.Model(rng.normal(size=1 << classifier.BITS), 0.25)
    for remembered in (classifier.REMEMBERED, 0):
        monkeypatch.setattr(classifier, "REMEMBERED", remembered)
        got = model.score(pd.Series([*TEXTS, None, "", " \t"]), classifier.Words(model.logits))
        odds = [0.25 + model.logits[brute_buckets(t)].mean() for t in TEXTS] + [0.25] * 3
        assert np.allclose(got, 1 / (1 + np.exp(-np.array(odds))))


@pytest.mark.parametrize("sf, least", [("/root/testdata/sf0.01", 0.97), ("/root/testdata/sf0.1", 0.995)])
def test_held_out_accuracy(spark, sf, least):
    from gridtally.llm.queries import REGISTRY
    got = REGISTRY["op11_subword_quality"](spark, sf).toPandas()
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    fold = got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    assert (got.held_out == fold).all() and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3).astype(int)).all()
    judged = got[got.held_out].merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    assert (judged.predicted == judged.quality).mean() >= least
    clean = judged[judged.quality == 1]
    assert (clean.predicted == 1).mean() >= 0.99


def made(spark, n=400):
    rng = random.Random(2)
    good = [f"w{k}" for k in range(50)]
    rows = [(i, " ".join(rng.choice(good) + ("#!" if i % 2 == 0 else "") for _ in range(30))) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int")


def test_held_out_labels_teach_nothing(spark):
    docs = made(spark)
    true = [(i, i % 2) for i in range(400)]
    lies = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in true]
    a, b = ({r.doc_id: r.quality_score for r in classifier.assess(docs, labels(spark, x)).collect()}
            for x in (true, lies))
    assert a == b
    assert all((a[i] >= 0.5) == (q == 1) for i, q in true)


def test_sample_is_bounded_and_stable(spark, monkeypatch):
    monkeypatch.setattr(classifier, "SAMPLE", 40)
    docs, known = made(spark), labels(spark, [(i, i % 2) for i in range(400)])
    rows = [sorted(tuple(r) for r in classifier.examples(d, known, "doc_id", "text", "quality").collect())
            for d in (docs, docs.repartition(7))]
    assert rows[0] == rows[1] and 20 <= len(rows[0]) <= 40
    assert all(zlib.crc32(str(k).encode()) % 5 for k, _, _ in rows[0])


def test_repeated_keys_and_conflicting_labels(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (3, "x")], SCHEMA)
    known = labels(spark, [(1, 0), (1, 0), (1, 1), (2, 0), (2, 1), (3, None), (99, 1), (None, 1)])
    got = {r.key: (r.label, r.text) for r in classifier.examples(docs, known, "doc_id", "text", "quality").collect()}
    assert got == {k: v for k, v in {1: (0, "a"), 2: (1, None)}.items() if zlib.crc32(str(k).encode()) % 5}


def test_odd_tables(spark):
    rows = [(1, None, 5, "k"), (1, "", 5, "k"), (None, "a b c", 5, "k"), (2, "z" * 100_000, 5, "k"), (2, "a\x1cb", 5, "k")]
    docs = spark.createDataFrame(rows, SCHEMA + ", quality int, key string")
    got = classifier.assess(docs, labels(spark, []))
    assert got.columns == [*docs.columns, "quality_score", "quality_predicted"]
    assert [(r.quality_score, r.quality_predicted) for r in got.collect()] == [(0.5, 1)] * 5
    assert classifier.assess(docs.limit(0), labels(spark, [(1, 1)])).collect() == []
    one = classifier.assess(docs, labels(spark, [(1, 1), (2, 1)])).collect()
    assert all(r.quality_score > 0.5 for r in one)
