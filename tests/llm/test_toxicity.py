"""op8 recomputed in plain Python and numpy over the smallest tables: voters, label model and classifier."""

import os
import re
import zlib

import numpy as np
import pytest

from eventloom.llm import queries as Q
from eventloom.llm.toxicity import INSULTS, LEAST_GAIN, RIGHT_CLEAN, RIGHT_TOXIC

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the driver's tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UNDISGUISED = dict(zip("013457@$!", "oieastasi", strict=True))


def bare(word):
    return re.sub(r"^[\W_]+|[\W_]+$", "", word).lower()


def entries_of(word):
    w = bare(word)
    return {"=" + w} | {w[:k] + "*" for k in range(4, 9) if len(w) >= k} if w else set()


def votes(text, lexicon):
    """The lexicon's entries that the text has, and the eleven patterns."""
    words = WORD.findall(text)
    told, plain, hidden, addressed, on = [], 0, 0, 0, set()
    for i, raw in enumerate(words):
        w, own = bare(raw), entries_of(raw) & lexicon.keys()
        clear = w in INSULTS
        opened = "".join(UNDISGUISED.get(x, x) for x in w)
        masked = not clear and opened != w and opened in INSULTS
        if own or clear or masked:
            told.append(i)
            on |= {lexicon[e] for e in own}
            plain, hidden = plain + clear, hidden + masked
            addressed += clear and any(x.lower() in ("you", "you're", "youre", "your", "u", "ur") for x in words[max(0, i - 3) : i])
    share = 100 * len(told) / max(len(words), 1)
    capitals = sum(map(len, re.findall("[A-Z]{3,}", text))) / max(len(text.encode()), 1)
    patterns = [
        plain, hidden, told and capitals > 0.3, told and len(re.findall("!{2,}", text)) >= 3, re.search(r"(?<![\w*])[A-Za-z]\*{2,}[A-Za-z]*(?![\w*])", text, re.ASCII), addressed,
        len(told) == 1, 0 < share < 0.5, 0.5 <= share < 1.5, share >= 1.5, not told,
    ]
    return [float(i in on) for i in range(len(lexicon))] + [float(bool(p)) for p in patterns]


def mined(rows, most=256, least=4):
    """Entries by the likelihood ratio of two rates over one."""
    sizes = [sum(y == k for _, y in rows) for k in (0, 1)]
    counts = {}
    for text, y in rows:
        for e in set().union(*map(entries_of, set(WORD.findall(text)))) if text.strip() else ():
            counts.setdefault(e, [0, 0])[y] += 1
    found = []
    for e, hits in counts.items():
        rates = [h / n for h, n in zip(hits, sizes, strict=True)]
        if hits[1] < least or rates[1] <= 3 * rates[0]:
            continue
        mean = sum(hits) / sum(sizes)
        gain = sum((h * np.log(r / mean) if h else 0) + ((n - h) * np.log((1 - r) / (1 - mean)) if h < n else 0) for h, r, n in zip(hits, rates, sizes, strict=True))
        if gain >= LEAST_GAIN:
            found.append((-gain, e))
    return {e: i for i, (_, e) in enumerate(sorted(found)[:most])}


def posterior(x, rounds=20, rows=2.0):
    """Expectation-maximisation of two classes from the annotator's votes, the last column."""
    post, share = np.clip(x[:, -1], 0.02, 0.98), np.ones(x.shape[1])
    for step in range(rounds):
        rates = []
        for own in (post, 1 - post):
            rates.append(np.clip(sum(p * v for p, v in zip(own, x, strict=True)) / (own.sum() + 2 * rows) + rows * x.mean(0) / (own.sum() + 2 * rows) + 1e-6, 1e-5, 1 - 1e-5))
        toxic, clean = rates
        toxic[-1], clean[-1] = max(toxic[-1], RIGHT_TOXIC), min(clean[-1], 1 - RIGHT_CLEAN)
        if step in (2, 6, 12):
            rest = x - np.outer(post, toxic) - np.outer(1 - post, clean)
            rest /= np.sqrt((rest**2).sum(0)) + 1e-6
            alike = np.abs(rest.T @ rest)
            share = 1 / np.maximum(np.where(alike < 0.5, 0, alike).sum(0), 1)
            share[-1] = 1
        prior = post.mean()
        logit = np.log(prior / (1 - prior)) + (np.where(x > 0, np.log(toxic / clean), np.log((1 - toxic) / (1 - clean))) * share).sum(1)
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        done, post = np.abs(new - post).max() < 1e-4, new
        if done:
            break
    return post


def classifier(x, y, steps=60):
    """Logistic regression on soft labels, ridge 1 but for the bias, by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.append(np.ones(x.shape[1] - 1), 1e-3)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        w += np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
    return w


def test_scores_are_those_of_plain_numpy(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DIR}/labels.parquet").select("doc_id", "toxic").collect() if r.toxic is not None}
    rows = [(docs[d], int(labels[d])) for d in sorted(labels) if d in docs and zlib.crc32(str(d).encode()) % 5]
    assert {y for _, y in rows} == {0, 1}
    lexicon = mined(rows)
    x = np.array([votes(t, lexicon) for t, _ in rows])
    w = classifier(x, posterior(np.hstack([x, np.array([[float(y)] for _, y in rows])])))
    want = {d: 1 / (1 + np.exp(-(np.array([*votes(t, lexicon), 1.0]) @ w))) for d, t in docs.items()}
    got = {r.doc_id: (r.score, r.predicted) for r in Q.op8_toxicity(spark, DIR).collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[d][0] - want[d]) for d in want) < 1e-3  # the label model counts in single precision
    assert all(p == (s >= 0.5) for s, p in got.values())
