"""Byte-level BPE against the tokenizer's own library."""

import random
from collections import Counter

import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus
from purchlake.llm import byte_bpe

RANKS = byte_bpe.read_ranks(byte_bpe.ranks_path())
ODD, PLAIN, CAREFUL = map(regex.compile, byte_bpe.patterns(byte_bpe.default_pattern()))
THEIRS = tiktoken.Encoding("own", pat_str=byte_bpe.default_pattern(), mergeable_ranks=RANKS, special_tokens={})
ENCODER = byte_bpe.Encoder(RANKS)


def ours(text):
    split = CAREFUL if ODD.search(text) else PLAIN
    return [i for m in split.findall(text) for i in ENCODER.match(m.encode())]


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=200), st.text("ab", max_size=300), st.text("aeiou thn'.0 \n\t", max_size=300)))
def test_same_ids(text):
    assert ours(text) == THEIRS.encode_ordinary(text)


def test_every_character():
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for k in range(0, len(every), 1 << 16):
        part = every[k:k + (1 << 16)]
        assert ours(part) == THEIRS.encode_ordinary(part)


@given(st.binary(max_size=400), st.integers(0, 400))
@settings(max_examples=200, deadline=None)
def test_join_is_the_encoding_of_the_concatenation(data, at):
    joined = ENCODER.joined(ENCODER.merged(data[:at]), ENCODER.merged(data[at:]))
    assert joined == ENCODER.merged(data) == ENCODER._merged_by_heap(data)


@pytest.mark.parametrize("data", [b"a" * 5000, b"xyz" * 1700, b" " * 4099, ("é" * 999).encode()])
def test_long_runs(data):
    assert ENCODER.tree(data, {}) == ENCODER._merged_by_heap(data)


def test_a_merge_table_of_ties():
    """Few ranks, many ways to overlap."""
    ranks = {bytes([i]): i for i in range(256)}
    for token in (b"aa", b"ab", b"aaa", b"ba", b"aab", b"aaaa", b"abab"):
        ranks[token] = len(ranks)
    e = byte_bpe.Encoder(ranks)
    rng = random.Random(4)
    for _ in range(600):
        data = bytes(rng.choice(b"aaab") for _ in range(rng.randrange(1, 120)))
        assert e.tree(data, {}) == e.merged(data)


def test_blocks_cut_no_match(monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK", 7)
    seam = regex.compile(r"(?<=\S)\s")
    text = "it's  a\n\n test  of   　blocks,\t\tand blanks   "
    parts = list(byte_bpe._blocks(text, seam))
    assert "".join(parts) == text and len(parts) > 2
    assert [m for p in parts for m in PLAIN.findall(p)] == PLAIN.findall(text)


def test_encode_and_decode(spark):
    rows = [r for r in corpus.corpus()] + [(7001, "Q" * 30000 + " x" * 9000, "en", "s", 1), (7002, "՘ \U00011de0 a", "en", "s", 1)]
    docs = corpus.frame(spark, rows, clashing=True).withColumn("ids", F.lit("x")).repartition(4)
    got = byte_bpe.decode(byte_bpe.encode(docs)).collect()
    want = Counter((r[0], tuple(THEIRS.encode_ordinary(r[1] or "")), (r[1] or "").encode()) for r in rows)
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.body)) for r in got) == want


def test_empty_null_and_odd_names(spark):
    assert byte_bpe.decode(byte_bpe.encode(corpus.frame(spark, []))).count() == 0
    odd = spark.createDataFrame([(1, "a b")], "`id.x` long, `te.xt` string")
    assert [tuple(r.ids) for r in byte_bpe.encode(odd, "te.xt", "id.x").collect()] == [tuple(THEIRS.encode_ordinary("a b"))]
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert [bytes(r.body) for r in byte_bpe.decode(none).collect()] == [b""]
