"""Near-duplicate embeddings: random-hyperplane sign hashing in several tables, exact cosine verification, connected components.

Two vectors at an angle of a fall on the same side of a random hyperplane with probability 1 - a/pi, so a table keyed by the signs for b
hyperplanes joins them with that probability to the power b. The number of signs follows the number of vectors with one label, so that
buckets stay small at any size, and the number of tables follows from the chance that a pair just at the threshold may be missed.

Vectors are long against ids. So a table's rows first carry SKETCH further signs alone, and only those that have a peer in their bucket whose
signs differ in no more than a pair at the threshold may, go on to fetch their vectors for the exact cosine.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.buckets import compare_buckets, runs
from eventloom.llm.common import begins, cut, parts, stored
from eventloom.llm.graph import components


#: Signs of a sketch: two longs.
SKETCH = 128
#: Bits of a key that number its table.
TABLE_BITS = 12


def most_differing(threshold: float, miss: float) -> int:
    """The least number of a sketch's signs such that a pair at the threshold differs in more with a chance below ``miss``."""
    p = math.acos(threshold) / math.pi
    left, k = 1.0, -1
    while left >= miss and k < SKETCH:
        k += 1
        left -= math.comb(SKETCH, k) * p**k * (1 - p) ** (SKETCH - k)
    return k


def plan(largest: int, threshold: float, miss: float, bucket: int) -> tuple[int, int]:
    """(signs in a key, tables) for the largest number of vectors under one label."""
    signs = max(6, math.ceil(math.log2(max(largest, 1) / bucket)) if largest > bucket else 6)
    meet = (1 - math.acos(threshold) / math.pi) ** signs
    return signs, math.ceil(math.log(miss) / math.log(1 - meet))


def _vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, str]:
    """((vec_id, label, hi, lo, vec), kind): vec holds the components as little-endian numbers of ``kind``, hi and lo its digest; all three are null if
    the vector links with nothing. Floats stay floats, as their doubles say no more."""
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("hi", pa.int64()), ("lo", pa.int64()), ("vec", pa.binary())])
    kind = "<f4" if dict(df.dtypes)[vector_col] == "array<float>" else "<f8"

    def of(values, label, vec_id):
        if values is None or label is None or vec_id is None:
            return None
        with np.errstate(over="ignore"):
            x = np.array([np.nan if v is None else v for v in values], kind) + np.array(0, kind)  # -0 is 0
        return x.tobytes() if len(x) and np.isfinite(x).all() and x.any() else None

    def run(batches):
        for b in batches:
            ids, labels = b.column(0), b.column(1)
            vec = [of(*x) for x in zip(b.column(2).to_pylist(), labels.to_pylist(), ids.to_pylist(), strict=True)]
            names = [(None, None) if v is None else np.frombuffer(hashlib.blake2b(v, digest_size=16).digest(), "<i8").tolist() for v in vec]
            yield pa.RecordBatch.from_arrays([ids, labels, *(pa.array([n[i] for n in names], pa.int64()) for i in (0, 1)), pa.array(vec, pa.binary())], schema=schema)

    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("v"))
    return rows.mapInArrow(run, "vec_id long, label string, hi long, lo long, vec binary"), kind


def _signed(classes: DataFrame, kind: str, signs: int, tables: int, seed: int) -> DataFrame:
    """classes with ``sig``, their signs in each table, and ``s1``, ``s2``, their sketch."""
    schema = pa.schema([("label", pa.string()), ("hi", pa.int64()), ("lo", pa.int64()), ("rep", pa.int64()), ("n", pa.int64()), ("vec", pa.binary()), ("sig", pa.binary()), ("s1", pa.int64()), ("s2", pa.int64())])
    powers = (1 << np.arange(signs, dtype=np.uint64)).astype(np.uint64)

    def run(batches):
        begins("embeddings")
        planes: dict[int, np.ndarray] = {}
        for whole in batches:
            for b in (whole.slice(i, 1024) for i in range(0, whole.num_rows, 1024)):
                vec = b.column("vec").to_pylist()
                sig, sketch = np.zeros((len(vec), tables), np.uint64), np.zeros((len(vec), SKETCH // 8), np.uint8)
                dims = np.array([len(v) // int(kind[2]) for v in vec])
                for d in np.unique(dims):
                    if d not in planes:
                        planes[d] = np.random.default_rng(seed + int(d)).standard_normal((int(d), signs * tables + SKETCH))
                    at = np.flatnonzero(dims == d)
                    x = np.frombuffer(b"".join(vec[i] for i in at), kind).astype(np.float64).reshape(len(at), d)
                    side = (x / np.abs(x).max(axis=1, keepdims=True)) @ planes[d] > 0
                    sig[at] = side[:, : signs * tables].reshape(len(at), tables, signs) @ powers
                    sketch[at] = np.packbits(side[:, signs * tables :], axis=1)
                blobs = pa.array([s.astype("<u4").tobytes() for s in sig], pa.binary())
                two = sketch.view(np.int64)
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("label", "hi", "lo", "rep", "n", "vec")), blobs, pa.array(two[:, 0]), pa.array(two[:, 1])], schema=schema)

    return classes.select("label", "hi", "lo", "rep", "n", "vec").mapInArrow(run, "label string, hi long, lo long, rep long, n long, vec binary, sig binary, s1 long, s2 long")


def _dealt(signed: DataFrame, kind: str, tables: int) -> DataFrame:
    """(key, rep, s1, s2): a row for each class and table, keyed by its bucket; the key's last bits number the table."""
    schema = pa.schema([("size", pa.int32()), ("tab", pa.int32()), ("sign", pa.int64()), ("label", pa.string()), ("rep", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64())])

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), "<u4").reshape(b.num_rows, tables)
            for t in range(tables):
                yield pa.RecordBatch.from_arrays([b.column("size"), pa.array(np.full(b.num_rows, t, np.int32)), pa.array(sig[:, t].astype(np.int64)), *(b.column(c) for c in ("label", "rep", "s1", "s2"))], schema=schema)

    rows = signed.select("sig", F.length("vec").alias("size"), "label", "rep", "s1", "s2").mapInArrow(run, "size int, tab int, sign long, label string, rep long, s1 long, s2 long")
    key = F.xxhash64("label", "size", "tab", "sign").bitwiseAND(F.lit(-1 << TABLE_BITS)).bitwiseOR(F.col("tab").cast("long"))
    return rows.select(key.alias("key"), "rep", "s1", "s2")


def _with_peers(dealt: DataFrame, most: int, block: int) -> DataFrame:
    """(key, rep) of the rows whose sketch differs from another's in their bucket in ``most`` signs at most; of a bucket of more than ``block`` rows all."""
    schema = pa.schema([("key", pa.int64()), ("rep", pa.int64())])

    def run(batches):
        for table, piece, ends in runs(batches, ["key"], block):
            if not piece and ends:
                own = np.stack([table.column(c).to_numpy().view(np.uint64) for c in ("s1", "s2")])
                near = np.zeros(len(own[0]), np.int64)
                for i in range(0, len(near), 256):
                    differ = sum(np.bitwise_count(x[i : i + 256, None] ^ x[None]) for x in own)
                    near[i : i + 256] = (differ <= most).sum(axis=1)
                table = table.filter(pa.array(near > 1))  # itself is one
            yield from table.select(["key", "rep"]).combine_chunks().cast(schema).to_batches()

    return dealt.repartition(parts(dealt.sparkSession), "key").sortWithinPartitions("key", "rep").mapInArrow(run, "key long, rep long")


def _links(left: pa.Table, right: pa.Table | None, threshold: float, kind: str):
    """For each row with a linked peer: (id, root of its tree here, weight of the peers first met in this table)."""
    table = left if right is None else pa.concat_tables([left, right])
    n, split = table.num_rows, 0 if right is None else left.num_rows
    vec = table.column("vec").to_pylist()
    lengths = np.array([len(v) for v in vec])
    if (lengths != lengths[0]).any():  # keys of other lengths fell together; these vectors have no cosine
        side = np.arange(n) < split
        own = [(table.filter(pa.array((lengths == k) & side)), table.filter(pa.array((lengths == k) & ~side))) for k in np.unique(lengths)]
        found = [_links(b, None, threshold, kind) if right is None else _links(a, b, threshold, kind) for a, b in own if b.num_rows and (right is None or a.num_rows)]
        found = [f for f in found if f is not None]
        return pa.Table.from_batches(found).combine_chunks().to_batches()[0] if found else None
    x = np.frombuffer(b"".join(vec), kind).astype(np.float64).reshape(n, -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    norm = np.sqrt((x * x).sum(axis=1))
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u4").reshape(n, -1)
    tab, weight = table.column("key").to_numpy() & ((1 << TABLE_BITS) - 1), table.column("n").to_numpy()
    label = np.unique(np.array(table.column("label").to_pylist(), object), return_inverse=True)[1]
    found_i, found_j = [], []
    step = 1024
    for i in range(0, n, step):
        for j in range(i, n, step):
            if split and (i >= split or j + step <= split):
                continue
            close = (x[i : i + step] @ x[j : j + step].T) >= threshold * norm[i : i + step, None] * norm[None, j : j + step]
            p, q = np.nonzero(close)
            p, q = p + i, q + j
            ok = (p < q) & (tab[p] == tab[q]) & (label[p] == label[q])
            if split:
                ok &= (p < split) & (q >= split)
            found_i.append(p[ok])
            found_j.append(q[ok])
    if not found_i or not (total := sum(map(len, found_i))):
        return None
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    counted = np.zeros(n, np.int64)
    for at in range(0, total, 1 << 16):
        p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        first = (sig[p] == sig[q]).argmax(axis=1) == tab[p]
        np.add.at(counted, p[first], weight[q[first]])
        np.add.at(counted, q[first], weight[p[first]])
    root = np.arange(n)
    while True:  # least label over links, with halving of paths
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    touched = np.unique(np.concatenate([i, j]))
    ids = table.column("rep").to_numpy()
    return pa.RecordBatch.from_arrays([pa.array(ids[touched]), pa.array(ids[root[touched]]), pa.array(counted[touched])], names=["a", "b", "n"])


def near_duplicates(df: DataFrame, threshold: float = 0.93, miss: float = 1e-5, bucket: int = 64, block: int = 2048, seed: int = 11, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row.

    Rows are compared when their labels are equal and not null. n_links: other rows with a cosine of ``threshold`` or more, in double
    precision; component_id: the smallest vec_id reachable by links; kept: it is the row's own. Vectors that are null, empty, zero or hold a
    null or non-finite component, and rows with a null label, link with nothing (0, own id, true); vectors of other lengths don't compare. A
    null vec_id links with nothing and gives (null, 0, null, true). Repeated rows count as others of each other. No rows give none.

    Equal vectors under a label are one class with a count from the start. Pairs are verified inside their bucket and never become rows: a
    bucket gives each class its number of links not met in an earlier table, and one edge to the root of its tree. ``miss`` bounds the
    chance that a pair exactly at the threshold shares no bucket; closer pairs are missed more rarely. A class's vectors have one digest of 128 bits.
    """
    rows, kind = _vectors(df, id_col, vector_col, label_col)
    rows = stored(rows, "vectors")
    valid = rows.where("vec IS NOT NULL")
    grouped = valid.groupBy("label", "hi", "lo").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"), F.first("vec").alias("vec"))
    classes = cut(grouped.withColumn("rep", F.monotonically_increasing_id()))  # no vec_id names a class, as ids may come again with other vectors
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    signs, tables = plan(largest, threshold, miss, bucket)
    if tables >> TABLE_BITS:
        raise ValueError(f"{tables} tables are too many; give a larger bucket or miss")

    from pyspark.sql.types import LongType, StructField, StructType

    out = StructType([StructField(c, LongType()) for c in "abn"])
    signed = stored(_signed(classes, kind, signs, tables, seed), "signed-vectors")
    near = _with_peers(_dealt(signed, kind, tables), most_differing(threshold, miss / 100), block)
    met = near.join(signed.select("rep", "label", "n", "sig", "vec"), "rep").select("key", "rep", "label", "n", "sig", "vec")
    met = cut(compare_buckets(met, "key", ["rep"], lambda a, b: _links(a, b, threshold, kind), out, block))
    counts = met.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("far"))
    found = components(met.select("a", "b")).withColumnRenamed("id", "rep")
    found = found.union(found.select(F.col("component").alias("rep"), "component").distinct())
    members = classes.select("rep", "least").join(found, "rep")
    members = members.join(members.groupBy("component").agg(F.min("least").alias("first")), "component").select("rep", "first")
    results = classes.join(counts, "rep", "left").join(members, "rep", "left").select("label", "hi", "lo", (F.col("n") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"), F.coalesce("first", "least").alias("component_id"))
    linked = valid.select("vec_id", "label", "hi", "lo").join(results, ["label", "hi", "lo"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("vec IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
