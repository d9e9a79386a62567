"""Runs of words that repeat with a period: seeds that agree at a lag, extended along their diagonal.

A run of period q and length L >= max(least, times * q) agrees with itself, q words on, over L - q words. For every q up to the first gram
size k that is at least k words, so each such run holds two equal k-grams q apart; later sizes double, each for the lags between half of it and
itself. In a run a gram of at least q words comes again q words on and never sooner, as an earlier copy would give the run a smaller period. So
only pairs of an occurrence and the next one are seeds, at most one a word and size, and each extends to a run whose smallest period is its lag.
A table of how far each lag has been covered skips seeds that lie in an earlier extension.

Grams are numbered exactly by pairs of numbers of their halves, for many documents at once; a gram that occurs once takes no further part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import texts, words

#: Words that are looked at together; a longer document is taken alone.
TOGETHER = 400_000
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _repeated(keys: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The keys as small numbers by place, -1 where a place has none or a key occurs once."""
    _, number, counts = np.unique(keys, return_inverse=True, return_counts=True)
    out, more = np.full(n, -1, np.int64), counts[number] > 1
    out[at[more]] = number[more]
    return out


def _longer(grams: np.ndarray, by: int) -> np.ndarray:
    """From the grams of some size those that are ``by`` words longer, ``by`` being at most that size."""
    n = len(grams)
    at = np.flatnonzero((grams[: max(0, n - by)] >= 0) & (grams[by:] >= 0))
    return _repeated(grams[at] * n + grams[at + by], at, n)


def first_size(least: int, times: int) -> int:
    return min(max(least - q, (times - 1) * q) for q in range(1, least + 1))


def _agree(codes: np.ndarray, i: int, q: int, step: int) -> int:
    """How many words from i on (``step`` 1) or before i (-1) equal those q words after them; ever larger stretches are compared."""
    done, size = 0, 64
    while True:
        a, b = (i + done, min(i + done + size, len(codes) - q)) if step > 0 else (max(0, i - done - size), i - done)
        if a >= b:
            return done
        differ = np.flatnonzero(codes[a:b] != codes[a + q : b + q])
        if len(differ):
            return done + int(differ[0] if step > 0 else b - a - 1 - differ[-1])
        done, size = done + b - a, 2 * size


def _seeds(grams: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of each gram whose next occurrence is more than ``low`` and at most ``high`` words on, by lag and place."""
    at = np.flatnonzero(grams >= 0)
    at = at[np.argsort(grams[at], kind="stable")]
    lag = np.diff(at)
    near = np.flatnonzero((grams[at[1:]] == grams[at[:-1]]) & (lag > low) & (lag <= high)) if len(at) else at
    at, lag = at[near], lag[near]
    order = np.lexsort((at, lag))
    return at[order], lag[order]


def runs_of(codes: np.ndarray, least: int = 24, times: int = 3, longest: int | None = None) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in a row of numbers, in order. Negative numbers, each there once, are no words: no run crosses them.
    ``longest``: words of the longest document."""
    if times < 3:
        raise ValueError("a run repeats at least 3 times")
    n = len(codes)
    longest = n if longest is None else longest
    k, size, found = first_size(least, times), 1, []
    real = np.flatnonzero(codes >= 0)
    grams = _repeated(codes[real], real, n)
    while size < k:
        by = min(size, k - size)
        grams, size = _longer(grams, by), size + by
    low = 0
    while max(least, times * (low + 1)) <= longest and (grams >= 0).any():
        covered: dict[int, int] = {}  # by lag: no seed before it is new
        at, lag = _seeds(grams, low, k)
        first = np.ones(len(at), bool)
        first[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)
        for i, q in zip(at[first].tolist(), lag[first].tolist(), strict=True):
            if i < covered.get(q, 0):
                continue
            start, end = i - _agree(codes, i, q, -1), i + _agree(codes, i, q, 1)
            covered[q] = end
            if end + q - start >= max(least, times * q):
                found.append((start, end + q - start, q))
        low, k, grams = k, 2 * k, _longer(grams, k)
    return sorted(found, key=lambda r: (r[0], r[2]))


def _documents(b: pa.RecordBatch, alter) -> Iterator[tuple[int | None, list[bytes]]]:
    for doc_id, text in zip(b.column(0).to_pylist(), texts(b.column(1)), strict=True):
        own = words(text)
        yield doc_id, alter(doc_id, own) if alter else own


def _rows(held: list[tuple[int | None, list[bytes]]], least: int, times: int) -> pa.RecordBatch:
    numbers, parts, starts, n = _Numbers(), [], [], 0
    for i, (_, own) in enumerate(held):
        parts += [np.fromiter(map(numbers.__getitem__, own), np.int64, len(own)), np.array([-1 - i])]
        starts.append(n)
        n += len(own) + 1
    each: list[list[tuple[int, int, int]]] = [[] for _ in held]
    if held:
        for start, length, q in runs_of(np.concatenate(parts), least, times, max(len(own) for _, own in held)):
            i = int(np.searchsorted(starts, start, "right")) - 1
            each[i].append((start - starts[i], length, q))
    rows = []
    for (doc_id, own), runs in zip(held, each, strict=True):
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        kept = own
        if runs:
            inside = np.zeros(len(own) + 1, np.int64)
            np.add.at(inside, [s + q for s, _, q in runs], 1)
            np.add.at(inside, [s + m for s, m, _ in runs], -1)
            kept = [own[i] for i in np.flatnonzero(np.cumsum(inside[:-1]) == 0).tolist()]
        rows.append((doc_id, len(own), *best, [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], b" ".join(kept).decode("utf-8", "replace")))
    columns = list(zip(*rows, strict=True)) or [[] for _ in SCHEMA]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA, strict=True)], schema=SCHEMA)


def periodic_runs(docs: DataFrame, least: int = 24, times: int = 3, alter: Callable[[int | None, list[bytes]], list[bytes]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, start, length, period, runs, collapsed): every run of at least ``least`` words and ``times`` periods in each whole text, in
    order of start and period; start, length and period of the run with the greatest length / period (ties: least start, then period); and the text less
    the words that a run has after its first period, joined by one space.

    ``alter`` may change a document's words first. No exchange: a document is looked at where it was read. Null and empty texts have no words, no
    runs (start, length and period are null) and an empty ``collapsed``; rows with a null or a repeated id are rows of their own; no rows give none;
    other columns are left behind. A document is held whole by its task.
    """
    spec = "doc_id long, n_words long, start long, length long, period long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

    def run(batches):
        for b in batches:
            held, n = [], 0
            for doc_id, own in _documents(b, alter):
                if held and n + len(own) > TOGETHER:
                    yield _rows(held, least, times)
                    held, n = [], 0
                held.append((doc_id, own))
                n += len(own)
            yield _rows(held, least, times)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, spec)
