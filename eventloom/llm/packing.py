"""Packing documents into sequences of a fixed number of tokens: bounded-space best-fit.

A fixed number of bins is open. A bitset has a bit for each amount of free space that an open bin has; the lowest bit at or above a piece's
length is its best fit. When no open bin fits and all may be open are, the fullest closes and a new one opens.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import batches_of, cut, dealt_by
from eventloom.llm.tokens import encoded


class BestFit:
    """Places lengths, one after the other, into bins of ``capacity``; ``place`` returns (bin, offset)."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.bits = 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            at = self._take(free)
        else:
            if self.open >= self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)
                self.open -= 1
            free, at = self.capacity, self.made
            self.made += 1
            self.open += 1
        left = free - length
        if left:
            self.by_free[left].append(at)
            self.bits |= 1 << left
        else:
            self.open -= 1
        return at, self.capacity - free

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        at = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        return at


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): the pieces of at most ``capacity`` tokens of each text's ids and ``end_id``.

    Null and empty texts are a piece of ``end_id`` alone. Repeated rows give repeated pieces, and rows with a null id pieces with a null id. No rows, no
    pieces; other columns are left behind.
    """
    spec = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * keep_ids)
    end, step = end_id.to_bytes(4, "little"), 4 * capacity

    def rows(b):
        for doc_id, ids in zip(b.column(0).to_pylist(), encoded(b.column(1), tokenizer), strict=True):
            ids = ids.tobytes() + end
            for k, at in enumerate(range(0, len(ids), step)):
                own = ids[at : at + step]
                yield (doc_id, k, at // 4, len(own) // 4, zlib.crc32(own)) + (own,) * keep_ids

    def run(batches):
        for b in batches:
            yield from batches_of(rows(b), schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, spec)


def pack(found: DataFrame, capacity: int = 2048, open_bins: int = 4096, group: int = 65_536) -> DataFrame:
    """``found`` with (sequence_id, offset): pieces share a sequence, gapless from offset 0, up to ``capacity`` tokens.

    Pieces of a stored table are dealt by rows into groups of about ``group``, each packed by one task, longest pieces first: what is left over is a bin or
    two a group. A group's number is the upper half of its sequence ids. Full pieces close their bin at once. No pieces, no rows.
    """
    groups = max(1, round(found.count() / group))
    names = found.columns
    dealt = found.withColumn("_group", dealt_by(groups))
    schema = None

    def run(batches):
        now, bins = None, None
        for b in batches:
            places = []
            for g, length in zip(b.column("_group").to_pylist(), b.column("length").to_pylist(), strict=True):
                if g != now:
                    now, bins = g, BestFit(capacity, open_bins)
                at, offset = bins.place(length)
                places.append(((g << 32) + at, offset))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array([p[0] for p in places], pa.int64()), pa.array([p[1] for p in places], pa.int64())], names=[*names, "sequence_id", "offset"])

    from pyspark.sql.types import LongType, StructType

    schema = StructType(list(found.schema.fields)).add("sequence_id", LongType()).add("offset", LongType())
    return dealt.repartition(groups, "_group").sortWithinPartitions("_group", F.desc("length"), "doc_id", "piece").mapInArrow(run, schema)


def packed(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """pieces() and pack() in one; the texts are tokenized once."""
    return pack(cut(pieces(docs, tokenizer, capacity, end_id, keep_ids)), capacity)


def sequences(found: DataFrame) -> DataFrame:
    """(sequence_id, length, ids) from packed pieces that keep their ids; a sequence is at most its capacity, so a row holds it. Pieces of null and
    empty texts are their end id, repeated rows are pieces of their own. No pieces, no rows."""
    whole = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate(whole, F.lit(b""), lambda done, x: F.concat(done, x["ids"]))
    return found.groupBy("sequence_id").agg(F.sum("length").alias("length"), ids.alias("ids"))
