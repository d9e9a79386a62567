"""Each registered query's rows over the smallest tables, against brute force written apart from the operators."""

import hashlib
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from eventloom.llm import queries as Q

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the driver's tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet").toPandas().sort_values("doc_id").reset_index(drop=True)


@pytest.fixture(scope="module")
def ids(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(Q._tokenizer())
    return {i: e.ids for i, e in zip(docs.doc_id, t.encode_batch(list(docs.text), add_special_tokens=False), strict=True)}


def crc(own):
    return zlib.crc32(np.array(own, "<u4").tobytes())


def _components(near):
    at = np.arange(len(near))
    while True:
        new = np.array([at[n].min() for n in near])
        if (new == at).all():
            return at
        at = new


def test_simhash(spark, docs):
    def fingerprint(text):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        h = [xxhash.xxh64_intdigest(x, 42) for x in [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)] if x]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    got = Q.op1_simhash(spark, DIR).toPandas().sort_values("doc_id")
    f = np.array([fingerprint(t) for t in docs.text], np.uint64)
    assert list(got.fingerprint) == [f"{x:016x}" for x in f]
    at = _components([np.flatnonzero(np.bitwise_count(f ^ x) <= 4) for x in f])
    assert list(got.component_id) == list(docs.doc_id.values[at]) and len(set(at)) < len(docs)


def test_chat(spark):
    turns = spark.read.parquet(f"{DIR}/conversations.parquet").toPandas().sort_values(["conv_id", "turn"])
    got = Q.op2_chat(spark, DIR).toPandas().set_index("conv_id")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    says = "</s>[INST] ok [/INST]"
    assert list(got.loc[-1][["n_turns", "turns_sha256", "loss_chars", "loss_sha256"]]) == [2, sha(f"user\n{says}\nassistant\n{says}\n"), len(says), sha(says)]
    assert len(got) == turns.conv_id.nunique() + 1
    for c, g in turns.groupby("conv_id"):
        loss = "".join(t for r, t in zip(g.role, g.text, strict=True) if r == "assistant")
        assert list(got.loc[c][["n_turns", "turns_sha256", "loss_chars", "loss_sha256"]]) == [len(g), sha("".join(f"{r}\n{t}\n" for r, t in zip(g.role, g.text, strict=True))), len(loss), sha(loss)]


def test_scoring(spark, docs):
    got = Q.op3_scoring(spark, DIR).toPandas().set_index("doc_id").sort_index()
    held = np.array([zlib.crc32(str(i).encode()) % 10 == 0 for i in docs.doc_id])
    tokens = [[*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t)), None] for t in docs.text]
    c = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    n, v = sum(c.values()), len(c)
    base = [sum(np.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t) for t in tokens]
    assert np.allclose(got.base_score, base, rtol=1e-12) and list(got.n_tokens) == [len(t) for t in tokens] and list(got.n_known) == [sum(c[w] > 0 for w in t) for t in tokens]
    assert (got.train_tokens == n).all() and list(got.held_out) == list(held)
    assert got.score[got.held_out].sum() > got.base_score[got.held_out].sum() and got.score.sum() > 0.97 * got.base_score.sum()


def test_embeddings(spark):
    e = spark.read.parquet(f"{DIR}/embeddings.parquet").toPandas().sort_values("vec_id")
    got = Q.op4_embeddings(spark, DIR).toPandas().sort_values("vec_id")
    x = np.array(e.embedding.tolist(), float)
    n = np.linalg.norm(x, axis=1)
    links = (x @ x.T / np.outer(n, n) >= 0.93) & (e.label.values[:, None] == e.label.values)
    np.fill_diagonal(links, True)
    assert list(got.n_links) == list(links.sum(1) - 1)
    assert list(got.component_id) == list(e.vec_id.values[_components([np.flatnonzero(r) for r in links])])


def test_packing(spark, ids):
    got = Q.op5_packing(spark, DIR).toPandas()
    seen = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got.itertuples()}
    want = {(d, k // 2048): (k, len(own[k : k + 2048]), crc(own[k : k + 2048])) for d, own in ((d, [*x, 0]) for d, x in ids.items()) for k in range(0, len(own), 2048)}
    assert seen == want and len(got) == len(want)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert list(g.offset) == list(g.length.cumsum() - g.length) and g.length.sum() <= 2048
    assert got.sequence_id.nunique() <= 1.02 * got.length.sum() / 2048 + 1


def test_substring(spark, docs):
    got = Q.op6_substring(spark, DIR).toPandas().set_index("doc_id")
    first, split = {}, [WORD.findall(t) for t in docs.text]
    for i, w in zip(docs.doc_id, split, strict=True):
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    for i, w in zip(docs.doc_id, split, strict=True):
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                gone.update(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert list(got.loc[i]) == [len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()]
    assert got.n_removed.sum() > 0


def test_store(spark, ids):
    got = Q.op7_store(spark, DIR).toPandas().set_index("doc_id").sort_index()
    start = 0
    for d, own in sorted(ids.items()):
        assert tuple(got.loc[d]) == (start, len(own) + 1, crc([*own, 1]))
        start += len(own) + 1


def test_toxicity(spark):
    directory = "/root/testdata/sf0.01"
    got = Q.op8_toxicity(spark, directory).toPandas().set_index("doc_id")
    assert got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all() and len(got) == 1000
    known = got.join(spark.read.parquet(f"{directory}/labels.parquet").toPandas().set_index("doc_id"), how="inner")
    out = known[known.held_out]
    clean = out.score[out.toxic == 0]
    auc = np.mean([(p > clean).mean() + (p == clean).mean() / 2 for p in out.score[out.toxic == 1]])
    assert auc > 0.85 and known.predicted[known.toxic == 0].mean() < 0.03


def test_decontamination(spark, docs):
    plain = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = spark.read.parquet(f"{DIR}/benchmark.parquet").toPandas()
    want = {(d, i) for d, t in zip(docs.doc_id, map(plain, docs.text), strict=True) for i, x in zip(items.item_id, map(plain, items.text), strict=True) if x in t}
    got = Q.op9_decontamination(spark, DIR).toPandas()
    assert {(r.doc_id, r.item_id) for r in got.itertuples()} == want and want


def test_sharding(spark, docs):
    got = Q.op10_sharding(spark, DIR).toPandas().set_index("doc_id").sort_index()
    data = [t.encode() for t in docs.text]
    assert list(got["size"]) == [len(t) + 8 for t in data] and list(got.text_crc32) == [zlib.crc32(t) for t in data]
    assert all(sorted(s) == list(range(len(s))) for _, s in got.groupby("shard").slot) and got.shard.between(0, 23).all()
    sizes = got.groupby("shard")["size"].sum()
    assert (abs(sizes - sizes.sum() / 24) <= got["size"].max()).all()
