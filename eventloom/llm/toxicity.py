"""Toxicity by weak supervision.

Many voters look at a text: one for each entry of a lexicon (a fixed list, and words and word beginnings mined from the training labels) and a
few patterns. A generative model takes the true class as hidden and estimates how often each voter fires in either class; voters that fire
together beyond what the class explains share their weight. Its posteriors label the training rows, and a linear classifier learns from them.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import begins, stored, texts, words

#: Insults and slurs-free abuse that any English lexicon has. Fixed values.
INSULTS = frozenset(
    "idiot idiots idiotic moron morons moronic stupid dumb fool fools loser losers trash garbage scum filth pathetic worthless disgusting clown clowns jerk jerks "
    "ugly imbecile cretin dimwit halfwit nitwit bastard crap hate hateful vile vermin parasite pig swine rat liar coward freak creep".split()
)
_LEET = str.maketrans("013457@$!", "oieastasi")
_LETTERS = re.compile(r"^[\W_]+|[\W_]+$")
PREFIXES = (4, 5, 6, 7, 8)
#: A task hands on its counts of words and beginnings when it has met so many words, which bounds its memory.
MINED_WORDS = 30_000
#: A mined entry's likelihood ratio, as a logarithm: chance reaches about ln(entries looked at), which is 11.5 for 100,000.
LEAST_GAIN = 12.0
#: The annotators' labels are taken to be right at least so often, for toxic and for clean texts: else small samples let the classes drift.
RIGHT_TOXIC, RIGHT_CLEAN = 0.7, 0.9
#: Words that a task remembers while it scores; beyond them it begins anew.
LOOKED_UP = 150_000
PATTERNS = ("insult", "disguised", "shouting", "exclaiming", "masked", "addressed", "once", "sparse", "medium", "dense", "none")


def normal(raw: bytes) -> str:
    return _LETTERS.sub("", raw.decode("utf-8", "replace")).lower()


def features_of(word: str) -> list[str]:
    """A word and its beginnings, as the lexicon names them."""
    return ["=" + word, *[word[:k] + "*" for k in PREFIXES if len(word) >= k]]


class _Look(dict):
    """For each raw word: 0, or the number of an entry of ``hits``: (lexicon entries, is an insult, is a disguised one)."""

    def __init__(self, entries: dict[str, int]):
        super().__init__()
        self.entries, self.hits = entries, [((), False, False)]

    def __missing__(self, raw: bytes) -> int:
        w = normal(raw)
        found = tuple(self.entries[x] for x in features_of(w) if x in self.entries) if w else ()
        plain = w in INSULTS
        bare = w.translate(_LEET)
        hidden = not plain and bare != w and bare in INSULTS
        v = 0
        if found or plain or hidden:
            self.hits.append((found, plain, hidden))
            v = len(self.hits) - 1
        self[raw] = v
        return v


_MASKED = re.compile(rb"(?<![\w*])[A-Za-z]\*{2,}[A-Za-z]*(?![\w*])")
_EXCLAIM = re.compile(rb"!{2,}")
_CAPITALS = re.compile(rb"[A-Z]{3,}")
_YOU = frozenset(b"you you're youre your u ur".split())


class Voters:
    """The voters that fire on a text, as numbers: the lexicon's entries, then the patterns."""

    def __init__(self, entries: list[str]):
        begins("toxicity")
        self.look = _Look({e: i for i, e in enumerate(entries)})
        self.n = len(entries)

    def __call__(self, text: bytes | None) -> list[int]:
        found = words(text)
        if len(self.look) > LOOKED_UP:
            self.look = _Look(self.look.entries)
        codes = np.fromiter(map(self.look.__getitem__, found), np.int64, len(found))
        at = np.flatnonzero(codes)
        on: set[int] = set()
        plain = hidden = addressed = 0
        for i in at.tolist():
            own, is_plain, is_hidden = self.look.hits[codes[i]]
            on.update(own)
            plain += is_plain
            hidden += is_hidden
            addressed += is_plain and any(w.lower() in _YOU for w in found[max(0, i - 3) : i])
        n = max(len(found), 1)
        density = 100 * len(at) / n
        whole = text or b""
        # Patterns of the text as a whole are looked for only where the words give a reason to; they confirm and don't accuse.
        shout = sum(map(len, _CAPITALS.findall(whole))) / max(len(whole), 1) if len(at) else 0
        values = (plain, hidden, shout > 0.3, len(_EXCLAIM.findall(whole)) >= 3 if len(at) else 0, len(_MASKED.findall(whole)), addressed, len(at) == 1, 0 < density < 0.5, 0.5 <= density < 1.5, density >= 1.5, not len(at))
        return sorted(on) + [self.n + k for k, v in enumerate(values) if v]




@dataclass
class Model:
    entries: list[str]
    weights: np.ndarray = field(repr=False)
    bias: float = 0.0
    voters: dict[str, tuple[float, float, float]] = field(default_factory=dict, repr=False)  # P(fires | toxic), P(fires | clean), share of its weight


def label_model(fires: np.ndarray, rounds: int = 20, prior_rows: float = 2.0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(posterior of the hidden class, P(fires|1), P(fires|0), shares) for rows of firing voters; the last voter is the annotator's label.

    Expectation-maximisation of a two-class model, begun at the annotator's labels. After each round the correlation that two voters keep within
    the classes is estimated, and a voter's evidence is divided by the sum of its correlations: k copies of a voter count as one.
    """
    n, m = fires.shape
    x = fires.astype(np.float32)
    post = np.clip(x[:, -1], 0.02, 0.98)
    share = np.ones(m, np.float32)
    for step in range(rounds):
        w1, w0 = post.sum() + 2 * prior_rows, (1 - post).sum() + 2 * prior_rows
        a1, a0 = (post @ x + prior_rows * x.mean(0)) / w1 + 1e-6, ((1 - post) @ x + prior_rows * x.mean(0)) / w0 + 1e-6
        a1, a0 = np.clip(a1, 1e-5, 1 - 1e-5), np.clip(a0, 1e-5, 1 - 1e-5)
        a1[-1], a0[-1] = max(a1[-1], RIGHT_TOXIC), min(a0[-1], 1 - RIGHT_CLEAN)
        if step in (2, 6, 12):
            rest = x - post[:, None] * a1 - (1 - post)[:, None] * a0
            scale = np.sqrt((rest * rest).sum(0)) + 1e-6
            corr = np.abs((rest / scale).T @ (rest / scale))
            corr[corr < 0.5] = 0  # weaker ones also come from what the posteriors don't know yet
            share = (1 / np.maximum(corr.sum(0), 1)).astype(np.float32)
            share[-1] = 1
        on, off = np.log(a1 / a0) * share, np.log((1 - a1) / (1 - a0)) * share
        prior = np.clip(post.mean(), 1e-4, 1 - 1e-4)
        logit = np.log(prior / (1 - prior)) + x @ on + (1 - x) @ off
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - post).max() < 1e-4:
            post = new
            break
        post = new
    return post, a1, a0, share


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Newton's method for logistic regression on soft labels; the last weight is the bias and isn't shrunk."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), l2)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fold(doc_id: str = "doc_id"):
    """crc32 of the id as text; rows where it is 0 modulo 5 are held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, max_entries: int = 256, least_docs: int = 4) -> Model:
    """Fits on at most about ``max_rows`` labelled documents outside the held-out fold, chosen by a hash of their id; of repeated rows of an id on
    that of the least text.

    The bound is on the fit alone; scoring takes all rows. Of the mined lexicon, the ``max_entries`` most telling entries by a likelihood ratio
    are kept. Rows with a null id, label or text don't train; without both classes, with empty ``docs`` or
    empty ``labels`` among them, the model gives every text the training rate, drawn towards a quarter, which it is if there are no labels. Other columns don't matter.
    """
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where(fold() != 0)
    n = usable.count()
    part = min(1.0, max_rows / max(n, 1))
    chosen = usable.where(F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 62)) < F.lit(int(part * (1 << 62))))
    # One row a document, however often its id is repeated: the bound holds for rows.
    rows = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic")
    sample = stored(rows, "toxicity-sample")

    def counted_in(by: tuple[Counter, Counter]) -> pa.RecordBatch:
        names = list(by[0].keys() | by[1].keys())
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([by[1][x] for x in names], pa.int64()), pa.array([by[0][x] for x in names], pa.int64())], names=["entry", "t", "c"])

    def mine(batches):
        begins("toxicity")
        known, by = {}, (Counter(), Counter())
        for b in batches:
            for t, y in zip(texts(b.column(1)), b.column(2).to_pylist(), strict=True):
                own: set[str] = set()
                for w in set(words(t)):
                    if w not in known:
                        x = normal(w)
                        known[w] = features_of(x) if x else []
                    own.update(known[w])
                by[y > 0].update(own)
                if len(known) > MINED_WORDS:
                    yield counted_in(by)
                    known, by = {}, (Counter(), Counter())
        yield counted_in(by)

    totals = sample.agg(F.sum("toxic"), F.count("*")).first()
    toxic, clean = float(totals[0] or 0), float(totals[1] - (totals[0] or 0))
    if not toxic or not clean:
        rate = (toxic + 0.5) / (toxic + clean + 2)  # nothing is rejected for want of labels
        return Model([], np.zeros(len(PATTERNS)), float(np.log(rate / (1 - rate))))
    counted = sample.mapInArrow(mine, "entry string, t long, c long").groupBy("entry").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    t, c = F.col("t") / toxic, F.col("c") / clean
    mean = (F.col("t") + F.col("c")) / (toxic + clean)

    def gain(hits, rate, size):  # of the class's own rate over the common one
        yes = F.when(hits > 0, hits * F.ln(rate / mean)).otherwise(0.0)
        return yes + F.when(hits < size, (size - hits) * F.ln((1 - rate) / (1 - mean))).otherwise(0.0)

    told = counted.where((F.col("t") >= least_docs) & (t > 3 * c)).withColumn("gain", gain(F.col("t"), t, toxic) + gain(F.col("c"), c, clean))
    told = told.where(F.col("gain") >= LEAST_GAIN)
    entries = [r[0] for r in told.orderBy(F.desc("gain"), "entry").limit(max_entries).collect()]

    def fire(batches):
        voters = Voters(entries)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([voters(x) for x in texts(b.column(1))], pa.list_(pa.int32())), b.column(2).cast(pa.int32())], names=["on", "toxic"])

    found = sample.orderBy("doc_id").mapInArrow(fire, "on array<int>, toxic int").collect()  # bounded by max_rows
    size = len(entries) + len(PATTERNS)
    x = np.zeros((len(found), size + 1), np.uint8)
    for i, r in enumerate(found):
        x[i, r[0]] = 1
        x[i, -1] = r[1] > 0
    post, a1, a0, share = label_model(x)
    weights, bias = _logistic(x[:, :-1], post)
    names = [*entries, *PATTERNS, "annotator"]
    return Model(entries, weights, bias, {k: (float(p), float(q), float(s)) for k, p, q, s in zip(names, a1, a0, share, strict=True)})


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row, from its whole text alone.

    Null and empty texts are scored as texts in which no voter finds a word. Repeated rows are repeated; for a null id held_out is false.
    """
    spec = "doc_id long, held_out boolean, score double, predicted int"

    def run(batches):
        voters = Voters(model.entries)
        for b in batches:
            score = []
            for t in texts(b.column(2)):
                score.append(1 / (1 + np.exp(-np.clip(model.bias + model.weights[voters(t)].sum(), -30, 30))))
            s = np.array(score, np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(run, spec)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those that the classifier rejects, other rows as they are, repeated ones too. Null and empty texts are judged as texts without
    words; rows with a null id are judged like others. No rows, no result."""
    model = fit(docs, labels)
    names = docs.columns

    def run(batches):
        voters = Voters(model.entries)
        for b in batches:
            keep = [model.bias + model.weights[voters(t)].sum() < 0 for t in texts(b.column(names.index("text")))]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
