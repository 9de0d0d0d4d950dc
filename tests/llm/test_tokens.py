"""Shards and packing against the tokenizer itself."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from gridtally.llm import packing, shards, tokens
from gridtally.llm.common import new_path
from gridtally.llm.queries import REGISTRY, packed

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(tokens.default_tokenizer())
    return lambda t: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")


ODD = [None, "", " \t\n", "It's THE end. <|endoftext|> <|ENDOFTEXT|>a<|startoftext|>b", "a\x1cb\x85c d",
       "é ΣΑΣ İ ß ̸x ≠", "x" * 9000, "word " * 9000, "日本語 テキスト 12,345.67", "a\x00b\r\n\x0bc"]


def test_encoder_is_the_tokenizer(plain, spark):
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    encoder = tokens.Encoder(tokens.default_tokenizer())
    for ids, text in zip(encoder.encode(texts), texts, strict=True):
        assert (np.frombuffer(ids, encoder.dtype) == plain(text)).all(), text[:50]


def test_shard_query(plain, spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in REGISTRY["op5_token_shards"](spark, SF).collect()}
    start = 0
    for d in docs:
        ids = plain(d.text)
        r = got.pop(d.doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got


def test_shards_of_odd_rows(plain, spark):
    rows = [(i % 4 if i % 5 else None, t, i) for i, t in enumerate(ODD * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    folder = new_path(spark, "test")
    made = shards.write_shards(docs, folder)
    n = shards.write_index(made, folder)
    located = shards.find(made.select("key", "copy"), folder, n)
    read = shards.read_ids(shards.with_starts(located), folder, shards.dtype_of()).collect()
    assert len(read) == len(rows)
    assert sorted((r.key is not None, r.key or 0, r.ids) for r in read) == sorted(
        (k is not None, k or 0, plain(t).tobytes()) for k, t, _ in rows)
    ends = sorted((r.start, r.start + r.n) for r in read)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    unknown = spark.createDataFrame([(10**9 + i, 0) for i in range(50)], "key long, copy long")
    assert shards.find(unknown, folder, n).collect() == []
    empty = shards.write_shards(docs.limit(0), new_path(spark, "test"))
    assert empty.collect() == []
    assert shards.find(made.select("key", "copy").limit(0), folder, n).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 7, 500, 20000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    h0, h1 = rng.integers(-2**63, 2**63 - 1, (2, n))
    entries = np.zeros(n, shards.ENTRY)
    entries["print"], entries["n"], entries["first"] = np.arange(n), 1, np.arange(n) * 7
    index = shards.build_index(h0, h1, entries)
    found = shards.look_up(index, h0, h1, np.arange(n, dtype=np.uint32))
    assert (found == entries).all()
    assert (shards.look_up(index, h0, h1, np.arange(n, dtype=np.uint32) + 1)["n"] == 0).all()


def test_letters_are_merged_once(plain, monkeypatch):
    texts = ["w\u00f6rter, w\u00f6rter. (w\u00f6rter) w\u00f6rter!! plain plain, 3.5\u20ac 3.5\u20ac, \u20ac, dogs' don't don't, ",
             "W\u00f6rter a\x1cb a\x85b, a\xa0b. plain\x0bplain;\x0c w\u00f6rter? e\u0301t\u00e9, \u0130x. <|im_end|> x<|", "", None]
    encoder, merged = tokens.Encoder(tokens.default_tokenizer()), []
    merge = encoder.merge
    monkeypatch.setattr(encoder, "merge", lambda letters: merged.append(letters) or merge(letters))
    for _ in range(2):
        for ids, text in zip(encoder.encode(texts), texts, strict=True):
            assert (np.frombuffer(ids, encoder.dtype) == plain(text)).all()
    assert merged.count("plain") == merged.count("dogs") == 1
    # as written in texts that are not ASCII throughout: two spellings, whatever follows them
    assert len([m for m in merged if m.startswith("w")]) == 2


def check(rows, texts, plain, window=4096):
    """Pieces hold every id once; sequences have no gap; what is padded."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for k, parts in by_doc.items():
        ids, at = plain(texts[k]), 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert zlib.crc32(ids[at:at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    padded = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padded += 0 if at & (at - 1) == 0 else window - at
    return padded


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_pack_query(plain, spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert check(REGISTRY["op10_nnls_packing"](spark, sf).collect(), texts, plain) == 0


def test_pack_odd_rows(plain, spark, monkeypatch):
    monkeypatch.setattr(packing, "SALT_ROWS", 3)
    texts = dict(enumerate(ODD * 3))
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in texts.items()],
                                 "doc_id long, text string, row int, n int")
    assert check(packed(docs).collect(), texts, plain) == 0
    assert packed(docs.limit(0)).collect() == []
    twice = packed(spark.createDataFrame([(1, "a b")] * 2 + [(None, None)], "doc_id long, text string"))
    assert sorted((r.doc_id or 0, r.length) for r in twice.collect()) in (
        [(0, 1), (1, 3), (1, 3)], [(0, 1), (1, 1), (1, 2), (1, 3)], [(0, 1), (1, 1), (1, 2), (1, 1), (1, 2)])


def share(histogram):
    """The share of remainders that solved combinations place; every one fills the window."""
    combos, counts = packing.solved(histogram)
    assert (combos.sum(1) == 4096).all() and (counts > 0).all()
    used = np.zeros(4096, int)
    for row, n in zip(combos, counts):
        np.add.at(used, row[row > 0], n)
    assert used[0] == 0 and (used <= histogram).all()
    return used.sum() / max(1, histogram[1:].sum())


def test_combinations_are_used():
    rng = np.random.default_rng(1)
    assert share(np.bincount(rng.choice([100, 1000, 1996, 2048, 3096, 3996], 5000), minlength=4096)) > 0.8
    quarter = np.zeros(4096, int)
    quarter[3], quarter[1024] = 5, 10**9
    assert share(quarter) > 0.99
    quarter[1024], quarter[1] = 0, 10**6  # no 16 of these fill a window
    assert share(quarter) == 0 and share(quarter * 0) == 0


def test_first_combinations():
    rng = np.random.default_rng(2)
    histogram = np.bincount(rng.integers(1, 4096, 3000), minlength=4096)
    for combos in (packing.combinations(histogram), packing.deeper(histogram, rng)):
        assert len(combos) and (combos.sum(1) == 4096).all()
        assert (histogram[combos[combos > 0]] > 0).all()


@pytest.mark.parametrize("times", [1, 1000])
def test_most_supplied_remainders_are_placed_by_the_plan(spark, times):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    encoder = tokens.Encoder(tokens.default_tokenizer())
    n = np.array([len(ids) // encoder.dtype.itemsize for ids in encoder.encode(texts)])
    histogram = np.bincount(n % 4096, minlength=4096) * times
    histogram[700] += len(n) * times // 2  # a hot length
    assert share(histogram) > 0.95
