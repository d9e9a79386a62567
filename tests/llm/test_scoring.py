"""The codes in which scoring's chunks and buckets write to each other, and contexts of three tokens."""

import numpy as np
import pytest

from eventloom.llm import scoring as S


@pytest.mark.parametrize("n", [0, 1, 5, 1000])
def test_codes_are_undone(n):
    r = np.random.default_rng(n)
    hashes = np.sort(r.integers(0, 1 << 64, n, np.uint64))
    assert (S.unpack(S.pack(hashes)) == hashes).all()
    keys = np.unique(r.integers(0, 50, n).astype(np.uint64) << np.uint64(S.NAME_BITS) | r.integers(0, 1000, n).astype(np.uint64))
    assert (S.unpack_keys(S.pack_keys(keys)) == keys).all()
    counts = r.zipf(1.5, n).clip(0, 10**6)
    counts[r.random(n) < 0.3] = 0
    names, often = np.zeros(n, np.int64), np.flatnonzero(counts >= 2)
    names[often[np.argsort(-counts[often], kind="stable")]] = np.arange(len(often)) * 7 + 3
    assert (S.fallen(names, S.falling(names, counts)) == counts).all()
    words = r.integers(0, 20, n)
    assert (S.of_words(words, S.by_word(words, words * words % 251)) == words * words % 251).all()
    sizes = r.multinomial(n, [0.2, 0.0, 0.5, 0.3])
    runs = np.concatenate([np.sort(r.choice(10_000, k, replace=False)) for k in sizes])
    assert (S.risen(S.rising(runs, sizes), sizes) == runs).all()
    assert (S.loose(S.tight(runs)) == runs).all()


@pytest.mark.parametrize("known", [S.KEYED_WORDS, 0])
def test_three_tokens_and_contexts_by_hash(spark, monkeypatch, known):
    monkeypatch.setattr(S, "KEYED_WORDS", known)
    rng = np.random.default_rng(8)
    docs = spark.createDataFrame([(i, " ".join(rng.choice(["a b c d", "b c e", "a b c f", "x y"], 20))) for i in range(150)], "doc_id long, text string")
    found = [sorted((r.doc_id, round(r.score, 5)) for r in S.scored(docs, depth=depth, least=4, bits=1.0, mb=mb).collect()) for depth, mb in ((3, 10.0), (3, 0.004), (2, 10.0))]
    assert found[0] == found[1]
    assert sum(s for _, s in found[0]) > sum(s for _, s in found[2])


def test_distinct_values_are_those_of_unique():
    import numpy as np

    from eventloom.llm.scoring import distinct, distinct_below

    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 64, 50, np.uint64)[rng.integers(0, 50, 400)]
    numbers = rng.integers(0, 90, 400)
    for of, a in [(distinct, hashes), (distinct, hashes[:0]), *[(lambda x, n=n: distinct_below(x, n), numbers) for n in (90, 1 << 54, 1 << 55)], (lambda x: distinct_below(x, 90), numbers[:0])]:
        for got, want in zip(of(a), np.unique(a, return_inverse=True), strict=True):
            assert (got == want).all() and len(got) == len(want) and got.dtype == want.dtype


def test_distinct_hashes_that_differ_in_their_last_bits():
    near = np.array([7, 3, 5, 3, 7 << 40, 6, 7], np.uint64)
    for a in (near, np.repeat(near, 50), near + np.uint64((1 << 64) - (7 << 40) - 1)):
        for got, want in zip(S.distinct(a), np.unique(a, return_inverse=True), strict=True):
            assert (got == want).all()


def test_a_bucket_counts_once(spark, monkeypatch, tmp_path):
    """The totals and the hot contexts' statistics come from a pass of their own: the buckets' answers aren't made again for these."""
    seen = str(tmp_path / "seen")

    def noted(name):
        of = getattr(S, name)

        def make(*args):
            run = of(*args)

            def noting(key, table):
                with open(seen, "a") as f:
                    f.write(f"{name} {args} {key[0].as_py()}\n")
                return run(key, table)

            return noting

        monkeypatch.setattr(S, name, make)

    for name in ("_count_words", "_count_pairs"):
        noted(name)
    docs = spark.createDataFrame([(i, f"a b c {'d e' if i % 3 else 'e f'} w{i % 7}") for i in range(120)], "doc_id long, text string")
    S.scored(docs, least=4, mb=0.001).collect()
    with open(seen) as f:
        lines = f.read().splitlines()
    assert {x.split()[0] for x in lines} == {"_count_words", "_count_pairs"}
    assert len(lines) == len(set(lines))


@pytest.mark.parametrize("ids", [[None, None], [1, 2]])
def test_without_frequent_contexts_a_text_is_scored_by_the_root(spark, ids):
    docs = spark.createDataFrame([(i, text) for i, text in zip(ids, ("a b c", None), strict=True)], "doc_id long, text string")
    rows = S.scored(docs).collect()
    assert len(rows) == 2
    for r in rows:
        assert abs(r.score - r.base_score) < 1e-9
        assert ids[0] or (r.score, r.n_known, r.train_tokens) == (0.0, 0, 0)
