"""Marking of covered words against all windows compared one by one, and how long it takes on texts that repeat themselves."""

import random
import time

import numpy as np

from eventloom.llm.substring import WINDOW, covered


def brute(docs, ids, passages):
    least, out = {}, []
    for owner, p in passages:
        for i in range(len(p) - WINDOW + 1):
            key = tuple(p[i : i + WINDOW].tolist())
            least[key] = min(owner, least.get(key, owner))
    for doc, me in zip(docs, ids, strict=True):
        mark = np.zeros(len(doc), bool)
        for i in range(len(doc) - WINDOW + 1):
            if least.get(tuple(doc[i : i + WINDOW].tolist()), me) < me:
                mark[i : i + WINDOW] = True
        out.append(mark if mark.any() else None)
    return out


def test_all_covered_words_are_marked():
    rng, n = random.Random(1), 0
    for _ in range(1500):
        most = rng.choice([1, 2, 3, 50, 5000])
        pool = [np.array([rng.randrange(1, most + 1) for _ in range(rng.randrange(1, 60))]) for _ in range(6)]
        passages = [(rng.randrange(9), p) for p in pool]
        docs = [np.concatenate([rng.choice(pool)[rng.randrange(5) :][: rng.randrange(1, 60)] if rng.random() < 0.7 else np.array([rng.randrange(most + 1) for _ in range(9)]) for _ in range(rng.randrange(1, 6))]) for _ in range(3)]
        ids = [rng.randrange(10) for _ in docs]
        for mine, want in zip(covered(docs, ids, passages), brute(docs, ids, passages), strict=True):
            assert (mine is None) == (want is None) and (mine is None or (mine == want).all())
            n += mine is not None
    assert n > 500


def test_words_decide_where_numbers_agree():
    """Words whose numbers agree by chance are told apart by what they say."""
    doc = np.arange(1, 41)
    words = [str(i).encode() for i in range(40)]
    theirs = list(words)
    theirs[20] = b"other"
    mark = covered([doc], [2], [(1, doc)], lambda i, s, k, o, n: (words[s : s + n], theirs[o : o + n]))[0]
    assert not mark[20] and mark[:20].all() and mark[21:].all()


def test_tables_of_figures_take_time_in_proportion():
    took = []
    for n in (20_000, 200_000):
        figures = np.ones(n, np.int64)
        figures[::14] = np.arange(2, 2 + len(figures[::14]))
        began = time.time()
        for doc in (figures, np.ones(n, np.int64), np.random.default_rng(0).integers(1, 3, n)):
            first, second = covered([doc, doc.copy()], [1, 2], [(1, doc)])
            assert first is None and second.all()
        took.append(time.time() - began)
    assert took[0] < 10 and took[1] < 30 * max(took[0], 0.3)
