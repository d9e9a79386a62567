"""Exchanges of many small numbers between chunks of documents and buckets of hashes.

Documents are dealt into chunks of a few megabytes of text. A chunk sends each hash bucket one row, a cell, with all it has for it as packed
numbers; the bucket answers with one row per chunk. So statistics over all words of a corpus travel as some bytes a word, not as a row each.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import ODD, begins, dealt_by, mixed, parts, tasks, total


#: Bytes of text for each bucket of hashes: the number of buckets follows the corpus, so that a bucket's share of it doesn't grow.
BUCKET_BYTES = 16e6


def sized(docs: DataFrame, text_col: str = "text") -> int:
    """The bytes of all texts."""
    return total(docs, F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)))[0]


def buckets_for(size: int, spark: SparkSession) -> int:
    return max(parts(spark), math.ceil(size / BUCKET_BYTES))


def chunked(docs: DataFrame, size: int, mb: float = 2.0) -> DataFrame:
    """docs, of ``size`` bytes of text, dealt by rows into chunks of about ``mb`` MB, given in the first column, ``chunk``."""
    n = max(1, math.ceil(size / (mb * 1e6)))
    return docs.select(dealt_by(n).alias("chunk"), *docs.columns).repartition(tasks(docs.sparkSession, size), "chunk")


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the high 32 bits, so that sorted hashes are sorted by bucket."""
    return (((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)


def pack(a: np.ndarray) -> bytes:
    """Sorted unsigned numbers as their differences, in 4 bytes each where these suffice."""
    if not len(a):
        return b""
    d = np.diff(a, prepend=np.uint64(0))
    small = len(d) < 2 or int(d[1:].max()) < 1 << 32
    return (b"\4" if small else b"\x08") + d[:1].astype("<u8").tobytes() + d[1:].astype("<u4" if small else "<u8").tobytes()


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.empty(0, np.uint64)
    return np.cumsum(np.concatenate([np.frombuffer(data, "<u8", 1, 1), np.frombuffer(data, f"<u{data[0]}", -1, 9)]), dtype=np.uint64)


def raw(a: np.ndarray) -> bytes:
    """Whole numbers in 4 bytes each where these suffice, else 8."""
    wide = len(a) and (int(a.max()) >= 1 << 31 or int(a.min()) < -(1 << 31))
    return (b"\x08" if wide else b"\4") + np.asarray(a).astype("<i8" if wide else "<i4").tobytes()


def unraw(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", -1, 1).astype(np.int64)


def slices(keys: np.ndarray):
    """(key, start, end) of the runs of sorted keys."""
    if len(keys):
        edges = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        yield from zip(keys[edges[:-1]].tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FIRST = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)  # masks of the first k bytes
_WHOLE = (1 << 64) - 1
#: A word's bytes are hashed by eights up to here, and longer words by XXH64.
LONG = 64


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each pair; ``data`` has 8 bytes more after the last end."""
    sizes = end - start
    h = mixed(sizes.astype(np.uint64) * ODD)
    for at in range(0, len(start), 1 << 16):
        s, size, out = start[at : at + (1 << 16)], sizes[at : at + (1 << 16)], h[at : at + (1 << 16)]
        low = int(s[0])
        own = np.ascontiguousarray(data[low : int(s[-1] + size[-1]) + 8])
        eights = np.ndarray(len(own) - 7, "<u8", own, strides=(1,))
        out[:] = mixed(out ^ (eights[s - low] & _FIRST[np.minimum(size, 8)]))
        live, k = np.flatnonzero(size > 8), 8
        while len(live) and k < LONG:
            out[live] = mixed(out[live] * ODD ^ (eights[s[live] - low + k] & _FIRST[np.minimum(size[live] - k, 8)]))
            k += 8
            live = live[size[live] > k]
        for i in live.tolist():
            out[i] = xxhash.xxh64_intdigest(own[s[i] - low : s[i] - low + size[i]].tobytes(), 9)
    return h


class Split:
    """The words of texts in a row, runs of other bytes than 0x20 and 0x09-0x0D: each word's start and end in ``data``, its hash ``h`` and its text's
    number ``doc``; each text's first word and the one after its last, ``starts`` and ``ends``, and its bytes' ``bounds``. Null texts are empty."""

    def __init__(self, column: pa.Array | pa.ChunkedArray, lower: bool = False):
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        column = column.cast(pa.large_binary()).fill_null(b"")
        n = len(column)
        bounds = np.frombuffer(column.buffers()[1], np.int64, n + 1, 8 * column.offset) if n else np.zeros(1, np.int64)
        low, high = int(bounds[0]), int(bounds[-1])
        self.bounds = bounds - low
        self.data = np.zeros(high - low + 8, np.uint8)
        if high > low:
            own = np.frombuffer(column.buffers()[2], np.uint8, high - low, low)
            self.data[:-8] = _LOWER[own] if lower else own
        self.space = _SPACE[self.data[:-8]]
        solid = ~self.space
        begin, end = solid.copy(), solid.copy()
        begin[1:] &= self.space[:-1]
        end[:-1] &= self.space[1:]
        first, last = self.bounds[:-1], self.bounds[1:] - 1
        some = first <= last
        begin[first[some]], end[last[some]] = solid[first[some]], solid[last[some]]
        self.start, self.end = np.flatnonzero(begin), np.flatnonzero(end) + 1
        edges = np.searchsorted(self.start, self.bounds)
        self.starts, self.ends = edges[:-1], edges[1:]
        self.doc = np.repeat(np.arange(n, dtype=np.int32), self.ends - self.starts)
        self.h = word_hashes(self.data, self.start, self.end)

    def said(self, word: int, n: int) -> bytes:
        """The ``n`` words from ``word`` on, with the white space between them."""
        return self.data[self.start[word] : self.end[word + n - 1]].tobytes()

    def hashes(self, k: int) -> np.ndarray:
        """A hash of the k words from each place on, across ends of texts too: a polynomial in ODD, put together from runs of powers of two."""
        n = max(len(self.h) - k + 1, 0)
        out, have, power = np.zeros(n, np.uint64), 0, self.h
        run, factor = 1, ODD
        while True:
            if k & run:
                out *= factor
                out += power[have : have + n]
                have += run
            if run << 1 > k:
                return mixed(out)
            power = power[: max(len(power) - run, 0)] * factor + power[run:]
            run, factor = run << 1, np.uint64(int(factor) ** 2 & _WHOLE)


class Chunk(Split):
    """The words of a chunk's documents."""

    def __init__(self, table: pa.Table, lower: bool = False, id_col: str = "doc_id", text_col: str = "text"):
        begins("chunks")
        super().__init__(table.column(text_col), lower)
        ids = table.column(id_col)
        self.null = ids.is_null().to_numpy()
        self.ids = ids.cast(pa.int64()).fill_null(-1 << 63).to_numpy()

    def windows(self, k: int) -> np.ndarray:
        """Starts of runs of k words within a document with an id."""
        n = len(self.h) - k + 1
        if n <= 0:
            return np.empty(0, np.int64)
        whole = self.doc[:n] == self.doc[k - 1 :]
        return np.flatnonzero(whole & ~self.null[self.doc[:n]] if self.null.any() else whole)


def among(h: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which of h are in the sorted ``wanted``: most are ruled out by their high bits alone."""
    found = np.zeros(len(h), bool)
    if len(wanted):
        coarse = np.zeros(1 << 20, bool)
        coarse[(wanted >> np.uint64(44)).astype(np.int64)] = True
        maybe = np.flatnonzero(coarse[(h >> np.uint64(44)).astype(np.int64)])
        own = h[maybe]
        found[maybe] = wanted[np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)] == own
    return found
