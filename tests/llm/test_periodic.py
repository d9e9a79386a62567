"""Runs of words against a search through all periods."""

import hashlib
import os
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import queries as Q
from eventloom.llm.periodic import periodic_runs, runs_of

DIR = "/root/testdata/sf0.001"


def brute(w, least=24, times=3):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            n = j + q - i
            if j > i and n >= max(least, times * q) and not any(w[i : i + n - d] == w[i + d : i + n] for d in range(1, q)):
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_all_runs_are_found():
    rng, n = random.Random(3), 0
    for _ in range(400):
        w = []
        while len(w) < 200:
            p = [rng.randrange(rng.choice([1, 2, 4, 30])) for _ in range(rng.randrange(1, 40))]
            w += (p * rng.randrange(1, 8))[: rng.randrange(1, 150)]
        for least, times in ((24, 3), (6, 3), (10, 4)):
            want = brute(w, least, times)
            n += len(want)
            assert runs_of(np.array(w), least, times) == want
    assert n > 500


def test_long_rows_take_no_longer_than_their_words():
    """Quadratic in any of these would not end."""
    fib, more = [0], [0, 1]
    while len(more) < 200_000:
        fib, more = more, more + fib
    assert runs_of(np.zeros(1_000_000, np.int64)) == [(0, 1_000_000, 1)]
    assert runs_of(np.tile(np.arange(100_000), 4)) == [(0, 400_000, 100_000)]
    assert len(runs_of(np.array(more))) > 10_000


@pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the driver's tables")
def test_the_query(spark):
    got = {r["doc_id"]: r for r in Q.op11_periodic(spark, DIR).collect()}
    docs = spark.read.parquet(f"{DIR}/documents.parquet").collect()
    assert len(got) == len(docs)
    found = 0
    for d in docs:
        w = (d["text"] or "").encode().split()
        h = zlib.crc32(str(d["doc_id"]).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        if len(w) > 3000:
            continue  # the search through all periods is cubic
        runs = brute(w)
        found += len(runs)
        r = got[d["doc_id"]]
        drop = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        assert r["n_runs"] == len(runs) and (r["start"], r["length"], r["period"], r["exponent_milli"]) == ((*best, best[1] * 1000 // best[2]) if best else (None,) * 4)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in drop)).hexdigest()
    assert found > 5


def test_edges(spark):
    texts = [(0, None), (1, ""), (2, " \n\t"), (None, "a b " * 12), (4, "a b " * 12), (4, "a b " * 12), (5, "x " * 23), (6, "x " * 24), (7, "é\x85ß  " * 30 + "z"), (8, "one two three " * 60_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("start", "runs", "collapsed", "n_words")})
    got = sorted(((r["doc_id"], r["n_words"], len(r["runs"]), r["start"], r["length"], r["period"], r["collapsed"]) for r in periodic_runs(docs).collect()), key=str)
    assert got == sorted([(0, 0, 0, None, None, None, ""), (1, 0, 0, None, None, None, ""), (2, 0, 0, None, None, None, ""), *[(i, 24, 1, 0, 24, 2, "a b") for i in (None, 4, 4)], (5, 23, 0, None, None, None, " ".join("x" * 23)), (6, 24, 1, 0, 24, 1, "x"), (7, 31, 1, 0, 30, 1, "é\x85ß  z"), (8, 180_000, 1, 0, 180_000, 3, "one two three")], key=str)
    assert periodic_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        runs_of(np.zeros(9, np.int64), times=2)
