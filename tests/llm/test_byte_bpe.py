"""Byte-level BPE against the tiktoken library, and its round trip."""

import base64
import hashlib
import os
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from eventloom.llm import queries as Q
from eventloom.llm.byte_bpe import Encoder, Merges, decoded, encoded, seen_otherwise

DIR, PATH = "/root/testdata/sf0.001", P.path("byte_bpe_50k.tiktoken")


def library(path):
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_ids_are_the_librarys(name):
    known, own, rng = library(P.path(name)), Encoder(P.path(name), P.PATTERN, seen_otherwise(P.PATTERN)), random.Random(4)
    odd = [chr(c) for c in seen_otherwise(P.PATTERN)]
    kinds = (
        lambda: rng.choice("abc"), lambda: chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x250, 0x3000), rng.randrange(0x3000, 0xD7FF), rng.randrange(0x10000, 0x20000)])),
        lambda: rng.choice(["the", "ing", " ", "tion", "\n", "  ", "'s", "é", "12", "!!", " ", "\x1c", "<|endoftext|>"]), lambda: known.decode([rng.randrange(50_000)]), lambda: rng.choice(odd) + rng.choice("aß1! 語"),
    )
    for i in range(8000):
        text = "".join(kinds[i % 5]() for _ in range(rng.choice([1, 3, 8, 30])))
        text = text * rng.choice([1, 1, 5])
        assert np.frombuffer(own.encode(text), "<u4").tolist() == known.encode_ordinary(text), repr(text)


@pytest.mark.parametrize("text", ["a" * 200_000, "ab" * 100_000, " " * 200_000, "x" + "abcdefghij" * 20_000, "é" * 100_000])
def test_long_pieces(text):
    """Pair by pair these would take hours."""
    assert Merges(PATH).encode(text.encode()) == library(PATH).encode_ordinary(text)


def test_tokens_that_merges_do_not_make(tmp_path):
    """Ranks need not come from merges: a token that no pair of tokens makes stands for a whole piece only."""
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"xyz": 259, b"cab": 260}
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + f" {i}\n".encode() for t, i in ranks.items()))
    own, known, rng = Merges(str(path)), library(path), random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("abcxyz") for _ in range(rng.randrange(1, 25)))
        assert own.encode(text.encode()) == known.encode_ordinary(text), text
    path.write_bytes(b"YQ== 0\n")
    with pytest.raises(ValueError):
        Merges(str(path))


@pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the driver's tables")
def test_the_query(spark):
    got = {r["doc_id"]: r for r in Q.op12_byte_bpe(spark, DIR).collect()}
    docs, known = spark.read.parquet(f"{DIR}/documents.parquet").collect(), library(PATH)
    assert len(got) == len(docs)
    for d in docs:
        ids, r = known.encode_ordinary(d["text"] or ""), got[d["doc_id"]]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()


def test_edges(spark):
    texts = [(0, None), (1, ""), (None, "ab 😀"), (3, "ab 😀"), (3, "ab 😀"), (4, "word " * 100_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("ids", "bytes")})
    got = decoded(encoded(docs, PATH, P.PATTERN), PATH).collect()
    assert sorted(((r["doc_id"], bytes(r["bytes"]).decode(), len(r["ids"]) > 0) for r in got), key=str) == sorted(((i, t or "", bool(t)) for i, t in texts), key=str)
    assert decoded(encoded(docs.limit(0), PATH, P.PATTERN), PATH).collect() == []
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r["bytes"]) for r in decoded(none, PATH).collect()] == [b"", b""]
    with pytest.raises(Exception, match="names no token|out of bounds"):
        decoded(spark.createDataFrame([(1, [10**6])], "doc_id long, ids array<int>"), PATH).collect()
