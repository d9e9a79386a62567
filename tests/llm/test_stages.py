"""The pipeline's stages against brute force written apart from the operators."""

import os
import re

import pytest

import corpus_pipeline

DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def jaccard_groups(rows):
    """doc_id -> the smallest one reachable over pairs whose sets of five-word runs have a Jaccard similarity of 0.8 or more."""
    sets, at = {}, {}
    for i, text in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}
        at[i] = i

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            common = len(sets[i] & sets[j]) if 0.8 * len(sets[i]) <= len(sets[j]) <= 1.25 * len(sets[i]) else 0
            if common and 5 * common >= 4 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                at[b] = a
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("block", [1024, 2])
def test_near_duplicates_are_those_of_similarity_four_fifths(spark, block):
    from eventloom.llm import minhash, simhash

    base = [f"w{k}" for k in range(100)]
    rows = [(0, " ".join(base))]
    for n, cuts in enumerate([(50,), (20, 70), (10, 30, 50, 70), (5, 15, 25, 35, 45, 55)], 1):  # 5 runs go and come for each word replaced
        rows.append((n, " ".join(f"x{n}-{k}" if k in cuts else w.upper() for k, w in enumerate(base))))
    rows += [(10, "a b c"), (11, "A  B c"), (12, "a b d"), (13, None), (14, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = jaccard_groups(rows)
    assert [want[n] for n in range(5)] == [0, 0, 0, 3, 4]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, block=block).collect()}
    assert got == want
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == {i for i in want if want[i] == i}
    assert {r.doc_id for r in simhash.drop_near_duplicates(docs).collect()} != {i for i in want if want[i] == i}


@pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the driver's tables")
def test_near_duplicates_of_the_small_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = jaccard_groups([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == {i for i in want if want[i] == i}


@pytest.mark.parametrize("block", [1024, 2])
def test_fingerprints_under_covering_masks_propose_the_pairs(spark, block, monkeypatch):
    from eventloom.llm import simhash

    monkeypatch.setattr(simhash, "WHOLE_BLOCKS", 1)  # with small blocks groups are compared by buckets too
    base = [f"w{k}" for k in range(100)]
    rows = [(0, " ".join(base))]
    for n, cuts in enumerate([(50,), (20, 70), (10, 30, 50, 70), (33,), (5, 15, 25, 35, 45, 55)], 1):
        rows.append((n, " ".join(f"x{n}-{k}" if k in cuts else w.upper() for k, w in enumerate(base))))
    rows += [(10, "a b c"), (11, "A  B c"), (12, "a b d"), (13, None), (14, " "), (9, "a B C")]
    want = jaccard_groups(rows)
    docs = spark.createDataFrame([*rows, (None, "a b c"), (2, rows[2][1])], "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id) for r in simhash.similar(docs, block=block).where("doc_id IS NOT NULL").collect())
    assert got == sorted([*want.items(), (2, want[2])])
    assert simhash.similar(docs.limit(0)).count() == 0


def test_plan_covers_with_certainty_and_the_stage_uses_it(spark):
    """Any one position of a block is left out by one of its masks; the stage is the covering method."""
    from eventloom.llm import simhash

    bits, blocks, most = simhash.plan(200_000, 0.8, 1e-6, 4096)
    masks = simhash.covering_masks(simhash.IN_BLOCK, bits=bits)
    assert all(any(not m >> i & 1 for m in masks) for i in range(bits)) and all(m < 1 << bits for m in masks)
    assert blocks * len(masks) == 48 and 45 < most < 60
    assert corpus_pipeline.drop_similar is simhash.drop_similar
