"""Comparing the rows that share a bucket, however large it is, without forming pairs as rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import cut, parts

#: (rows of one side, rows of the other or None for pairs within the first) -> a batch of results, or None.
Compare = Callable[[pa.Table, "pa.Table | None"], "pa.RecordBatch | None"]


def runs(batches: Iterator[pa.RecordBatch], keys: list[str], most: int) -> Iterator[tuple[pa.Table, int, bool]]:
    """Pieces of runs of equal keys, of ``most`` rows: (rows, number of the piece, whether it ends the run). Runs of one row are left out."""
    held: list[pa.RecordBatch] = []
    rows, piece = 0, 0
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for v in values:
            change[1:] |= v[1:] != v[:-1]
        change[0] = last is not None and last != tuple(v[0] for v in values)
        last = tuple(v[-1] for v in values)
        starts = np.flatnonzero(change)
        edges = np.concatenate([[0], starts, [batch.num_rows]])
        for i, (s, e) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if i or change[0]:  # a new run begins
                if rows and (rows > 1 or piece):
                    yield pa.Table.from_batches(held), piece, True
                held, rows, piece = [], 0, 0
            if i and i < len(edges) - 2 and e - s == 1:  # alone, and its run ends here
                continue
            while s < e:
                if rows == most:
                    yield pa.Table.from_batches(held), piece, False
                    held, rows, piece = [], 0, piece + 1
                take = min(e - s, most - rows)
                held.append(batch.slice(s, take))
                rows, s = rows + take, s + take
    if rows and (rows > 1 or piece):
        yield pa.Table.from_batches(held), piece, True


def compare_buckets(rows: DataFrame, key: str, order: list[str], compare: Compare, out: T.StructType, block: int = 4096) -> DataFrame:
    """Calls ``compare`` so that all rows with equal ``key`` meet, and returns what it gives.

    A bucket of at most ``block`` rows is compared where the shuffle brought it. A larger one leaves that task in numbered blocks, and each
    pair of its blocks is compared in a task of its own: memory is bounded by two blocks, and a hot bucket's work spreads over the cluster.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    names = rows.columns
    mixed_schema = T.StructType([T.StructField("_piece", T.IntegerType()), *[T.StructField(f.name, f.dataType) for f in rows.schema], T.StructField("_out", out)])
    arrow, result = to_arrow_schema(mixed_schema), to_arrow_schema(out)

    def first(batches):
        def deferred(table, piece):
            return pa.RecordBatch.from_arrays([pa.array(np.full(table.num_rows, piece, np.int32)), *[table.column(c).combine_chunks() for c in names], pa.nulls(table.num_rows, arrow.field("_out").type)], schema=arrow)

        for table, piece, ends in runs(batches, [key], block):
            if piece or not ends:
                yield deferred(table, piece)
            elif (found := compare(table, None)) is not None and found.num_rows:
                n = found.num_rows
                yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int32()), *[pa.nulls(n, arrow.field(c).type) for c in names], pa.StructArray.from_arrays(found.columns, fields=list(result))], schema=arrow)

    met = cut(rows.repartition(parts(rows.sparkSession), key).sortWithinPartitions(key, *order).mapInArrow(first, mixed_schema))
    results = met.where("_piece IS NULL").select("_out.*")
    large = met.where("_piece IS NOT NULL").select("_piece", *names)
    if large.isEmpty():
        return results
    sizes = large.groupBy(key).agg((F.max("_piece") + 1).alias("_pieces"))
    pairs = (
        large.join(sizes, key)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
        .select(F.least("_piece", "_other").alias("_i"), F.greatest("_piece", "_other").alias("_j"), "_piece", *names)
        .withColumn("_unit", F.xxhash64(key, "_i", "_j"))
    )

    def second(batches):
        for table, _, _ in runs(batches, ["_unit", key, "_i", "_j"], 2 * block):
            piece = table.column("_piece").to_numpy()
            i, j = table.column("_i")[0].as_py(), table.column("_j")[0].as_py()
            sides = (table.select(names), None) if i == j else (table.filter(pa.array(piece == i)).select(names), table.filter(pa.array(piece == j)).select(names))
            if (found := compare(*sides)) is not None and found.num_rows:
                yield found

    units = pairs.repartition(parts(rows.sparkSession), "_unit").sortWithinPartitions("_unit", key, "_i", "_j", "_piece", *order)
    return results.union(units.mapInArrow(second, out))
