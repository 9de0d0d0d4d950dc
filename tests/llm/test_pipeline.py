"""The pipeline, stage by stage, on the smallest table and on odd rows."""

import re

from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from gridtally.llm import mixing, tokens
from tests.llm import test_jaccard, test_quality, test_tokens

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def run(spark, docs, tmp_path):
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, SF)
        made.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        out.append(docs)
    return out


def check(spark, stages):
    given, ruled, single, hidden, mixed, packed = stages
    rows = lambda df: [tuple(r) for r in df.select(COLUMNS).collect()]
    by = lambda df: sorted(rows(df), key=str)
    for df in stages[1:5]:
        assert df.columns == given.columns
    kept = [r for r in rows(given) if test_quality.brute(r[1])[-1]]
    assert by(ruled) == sorted(kept, key=str)
    component = test_jaccard.brute([(r[0], r[1]) for r in kept], 5, 80, 100)
    left = [r for r in kept if r[0] is None or component[r[0]] == r[0]]
    assert by(single) == sorted(left, key=str)
    assert hidden.count() == len(left)
    before = {r[0]: r for r in left}
    for r in rows(hidden):
        assert r[2:4] == before[r[0]][2:4] and r[4] == len(r[1])
        for real in re.findall(r"[\w.]+@mail\d\.example\.com|\+1 \(\d{3}\) \d{3}-\d{4}", before[r[0]][1]):
            assert real not in r[1]
    taken = {r[0]: 0 for r in rows(hidden)}
    for r in rows(mixed):
        taken[r[0]] += 1
    want = {r.doc_id: r.mix.copies for r in mixing.mix(hidden).collect()}
    assert taken == want
    tokenizer = Tokenizer.from_file(tokens.default_tokenizer())
    texts = {r[0]: r[1] for r in rows(hidden)}
    total = 0
    for i, t in texts.items():
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
        total += n * taken[i]
    got = packed.collect()
    assert sum(r.length for r in got) == total and max(r.offset + r.length for r in got) <= 4096
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at & (at - 1) == 0


def test_stages(spark, tmp_path):
    check(spark, run(spark, spark.read.parquet(f"{SF}/documents.parquet"), tmp_path))


def test_odd_rows(spark, tmp_path):
    words = " ".join(f"w{i}" for i in range(40))
    rows = [(1, words, None, None, None), (1, words, None, None, None), (2, None, "en", "a", 0),
            (3, "", "en", "a", 0), (None, words + " more", "en", "b", 9), (4, words + " x@y.org", "en", "a", 1)]
    docs = spark.createDataFrame([(*r, 1) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, pii int")
    for df in run(spark, docs, tmp_path)[1:5]:
        assert df.columns == docs.columns
    empty = run(spark, docs.limit(0), tmp_path / "empty")
    assert all(df.count() == 0 for df in empty)


def test_registered():
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    numbers = sorted(int(re.match(r"op(\d+)_", q)[1]) for q in __spark_entry__.queries() if q.startswith("op"))
    assert numbers == list(range(1, 14))
