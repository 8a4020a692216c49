"""The tree reduction against the tiktoken library, and round trips."""

import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_setup import few_partitions  # noqa: F401
from reelsight.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)
REF = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
BITS = ["a", "b", " ", "  ", "'", "'s", "'re", "'ll", "\n", "\t", "é", "ß", "漢", "字", "1", "23", "!!", "the", "tion",
        " ", "😀", "<|endoftext|>", "ll", "v", "'v", "e"]


@pytest.mark.parametrize("leaf,leaf_bytes", [(8192, 16), (3, 1), (5, 2), (16, 5)])
def test_random_texts(monkeypatch, leaf, leaf_bytes):
    monkeypatch.setattr(bpe, "LEAF", leaf)
    monkeypatch.setattr(bpe, "LEAF_BYTES", leaf_bytes)
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(leaf)
    for _ in range(1500):
        t = "".join(rng.choice(BITS) for _ in range(rng.randint(0, 50)))
        got = codec.encode(t)
        assert got == REF.encode_ordinary(t)
        assert codec.decode(got) == t.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_any_text(text):
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    assert codec.encode(text) == REF.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 30_000, "ab" * 9_000, "é" * 9_000, "漢字" * 4_000, " " * 20_000 + "x", "\n " * 9_000,
                                  "'" * 3_000, "word " * 20_000])
def test_long_runs(text):
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    got = codec.encode(text)
    assert got == REF.encode_ordinary(text) and codec.decode(got).decode() == text


def test_small_caches(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 3)
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    t = " ".join(f"x{i} yz{i % 5}" for i in range(200))
    assert codec.encode(t) == REF.encode_ordinary(t)


def test_dataframe(spark):
    rows = [(1, None, "a", 5), (2, "", "b", 6), (None, "Hello <|endoftext|> it's", None, 7), (4, "x " * 9000, "c", 8), (4, "x " * 9000, "c", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `odd name` string, n_tokens long")
    out = bpe.encode(df, PATH, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "odd name", "token_ids", "n_tokens", "round_trip"]
    got = out.collect()
    assert sorted((str(r.doc_id), r.token_ids) for r in got) == sorted((str(d), REF.encode_ordinary(t or "")) for d, t, *_ in rows)
    assert all(r.round_trip and r.n_tokens == len(r.token_ids) for r in got)
    back = {str(r.doc_id): bytes(r.decoded).decode() for r in bpe.decode(out, PATH, public_tokenizers.PATTERN).collect()}
    assert back == {str(d): t or "" for d, t, *_ in rows}
    dig = {str(r.doc_id): r for r in bpe.digests(df, PATH, public_tokenizers.PATTERN).collect()}
    assert dig["1"].n_tokens == 0 and dig["1"].ids_sha256 == dig["1"].decoded_sha256 == \
        "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert bpe.encode(df.limit(0), PATH, public_tokenizers.PATTERN).collect() == []
