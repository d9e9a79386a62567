"""What several operators share: words of a text, lineage cuts and running totals over partitions."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.sources.shared import new_folder, shared_folder

#: A worker's cache of words is emptied beyond so many entries, which bounds its memory; it changes no result.
CACHE_WORDS = 700_000


def cut(df: DataFrame) -> DataFrame:
    """df computed once and read back from the shared folder, so that lost executors cost no recomputation."""
    folder = shared_folder(df.sparkSession)
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """As cut(), as Parquet: smaller on disk, and later reads take only the columns they need."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of text that a task takes from an exchange, beyond which there are more tasks than the session says.
TASK_BYTES = 256e6


def tasks(spark: SparkSession, size: int) -> int:
    """Tasks for an exchange of so many bytes: as the session has it, more for a large one."""
    return max(parts(spark), math.ceil(size / TASK_BYTES))


def dealt_by(n: int):
    """A number below n for each row of a stored table, by the row's place and not by its values, so that copies of a row, or rows without an id and
    text, are spread like others. The same for a row each time that the table is read."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")


def words(text: bytes | None) -> list[bytes]:
    """Runs of other bytes than 0x20 and 0x09-0x0D. bytes.split() knows no other white space than these six."""
    return text.split() if text else []


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


_FORGET: dict[str, Callable[[], object]] = {}
_busy = ""


def remembers(operator: str, forget: Callable[[], object]) -> None:
    """Says how a Python worker gives up what it remembers for an operator."""
    _FORGET[operator] = forget


def begins(operator: str) -> None:
    """Python workers outlive stages: when one begins another operator's task, it gives up what it remembers for others."""
    global _busy
    if _busy != operator:
        _busy = operator
        for name, forget in _FORGET.items():
            if name != operator:
                forget()


class WordHashes(dict):
    """XXH64 by word; ``array`` gives those of a list of words."""

    def __init__(self, seed: int = 0, of=None):
        super().__init__()
        self.seed, self.of = seed, of

    def __missing__(self, word: bytes) -> int:
        v = self[word] = xxhash.xxh64_intdigest(self.of(word) if self.of else word, self.seed)
        return v

    def array(self, found: list[bytes]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose low and high bits depend on all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of k of the word hashes h, in order; none if there are fewer."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, k):
        out *= ODD
        out += h[j : j + n]
    return mixed(out)


def batches_of(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch_of(held, schema)
            held = []
    if held:
        yield batch_of(held, schema)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def signed(column):
    """A column of unsigned 64-bit values as Spark's long."""
    return np.asarray(column, np.uint64).view(np.int64)


def total(df: DataFrame, *aggregates) -> tuple:
    """One row of totals, the only thing that comes to the driver."""
    return tuple(df.agg(*aggregates).first())


def gapless(df: DataFrame, by: list[str], order: list[str], into: str, groups: list[str] = (), at_most: int = 50_000) -> DataFrame:
    """Numbers the rows from 0 without gaps, within each value of ``groups``, in no stated order between blocks.

    Rows are dealt into blocks by a hash of ``by`` so that no task holds more than about ``at_most``; a block's first number is the sum of
    the blocks before it, of which there are few.
    """
    from pyspark.sql import Window

    groups = list(groups)
    n = df.count()
    blocks = max(1, -(-n // at_most))
    df = df.withColumn("_block", F.pmod(F.xxhash64(*by), F.lit(blocks)).cast("int"))
    sizes = df.groupBy(*groups, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(*groups, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy(*groups, "_block").orderBy(*order)
    df = df.withColumn(into, F.row_number().over(within) - 1)
    return df.join(firsts, [*groups, "_block"]).withColumn(into, (F.col(into) + F.col("_first")).cast("long")).drop("_block", "_first")
