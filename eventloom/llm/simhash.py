"""SimHash near-duplicates by covering locality-sensitive hashing: fingerprints that are close, or texts whose sets of word runs are.

A text's fingerprint takes for each bit the majority over its shingles' hashes. Fingerprints that differ in at most ``radius`` bits are
linked. A random map gives each bit position a vector of radius + 1 bits; for each non-zero vector v of that length, a mask keeps the
positions whose vector has an odd inner product with v. Any ``radius`` vectors span less than the whole space, so some v is orthogonal to
all of them and its mask leaves those positions out: every pair within the radius agrees under one of the 2^(radius+1) - 1 masks, with
certainty.

Sets of a Jaccard similarity s have an angle of acos(2s / (1 + s)) or less between them, and a bit of their fingerprints differs with a
probability of angle / pi. At 0.8 that is 0.15, which no few masks of 64 bits cover. So ``similar`` takes longer fingerprints, of as many
blocks as the chance of a miss asks for, and covers each block by masks of its own: pairs within blocks * (IN_BLOCK + 1) - 1 bits meet with
certainty, others if one block differs in IN_BLOCK bits at most. Fingerprints only propose; the exact similarity of the sets decides.
"""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.buckets import compare_buckets
from eventloom.llm.common import ODD, WordHashes, begins, cut, mixed, texts, words
from eventloom.llm.graph import components
from eventloom.llm.minhash import linked_sets, name_of, sets_of, shingle_set

BITS = 64
#: Bits of a block that may differ in a pair that it brings together, and bits by which pairs of a bucket are judged: three longs. By 128 bits each
#: text has a few unrelated ones that differ no more than a pair at 0.8 may, and most of a corpus becomes one group; by 192 one in thousands has.
IN_BLOCK, SKETCH = 1, 192
SIGNS = ["s1", "s2", "s3"]
#: Proposed groups of more sets than so many blocks are compared bucket by bucket.
WHOLE_BLOCKS = 16


def covering_masks(radius: int, seed: int = 7, bits: int = BITS) -> list[int]:
    """Masks of ``bits`` bits such that any ``radius`` positions are all zero in one of them."""
    rng = random.Random(seed)
    size = radius + 1
    vectors = list(range(1, 1 << size))
    # Each vector is dealt equally often, so that every mask keeps about half of the positions.
    at = (vectors * (bits // len(vectors) + 1))[: bits - bits % len(vectors)] if len(vectors) < bits else []
    at += rng.sample(vectors * 3, bits - len(at))
    rng.shuffle(at)
    return [sum(1 << i for i, m in enumerate(at) if (m & v).bit_count() % 2) for v in vectors]


def simhash(text: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    """A bit is 1 if it is set in over half of the shingles' XXH64. Shorter texts are one shingle; without words the result is 0."""
    found = words(text.lower()) if text else []
    if not found:
        return 0
    whole = b" ".join(found)
    if len(found) <= shingle:
        return xxhash.xxh64_intdigest(whole, seed)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest, n = xxhash.xxh64_intdigest, len(found) - shingle + 1
    counts = np.zeros(2048, np.int64)
    for at in range(0, n, 1 << 16):  # very long texts by parts
        to = min(n, at + (1 << 16))
        cuts = zip(starts[at:to].tolist(), ends[at + shingle - 1 : to + shingle - 1].tolist(), strict=True)
        h = np.fromiter((digest(whole[s:e], seed) for s, e in cuts), np.uint64, to - at)
        counts += np.bincount((h.view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)).ravel(), minlength=2048)
    ones = counts.reshape(8, 256) @ np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
    return int(np.packbits((2 * ones > n).ravel(), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        begins("simhash")
        for b in batches:
            fp = np.fromiter((simhash(t, shingle) for t in texts(b.column(1))), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(fp.view(np.int64))], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, fp long")


def _linked(fps: np.ndarray, ids: np.ndarray, radius: int) -> tuple[list, list]:
    """Links that join what lies within the radius, by breadth-first search: rows already reached are compared no more."""
    left = np.arange(len(fps))
    a, b = [], []
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            near = np.bitwise_count(fps[front[:256], None] ^ fps[None, left]) <= radius
            reached = near.any(axis=0)
            a.append(ids[left[reached]])
            b.append(ids[front[:256]][near[:, reached].argmax(axis=0)])
            front, left = np.concatenate([front[256:], left[reached]]), left[~reached]
    return a, b


def near_duplicates(docs: DataFrame, radius: int = 4, shingle: int = 4, block: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs.

    fingerprint: 16 lower-case hex digits. component_id: the smallest doc_id reachable over links of at most ``radius`` differing bits. Null
    and empty texts and texts without words have fingerprint zero and are linked like any other. Repeated rows come back repeated; a row
    with a null id keeps its group's component_id. An empty table gives no rows. Other columns of docs are not used.

    Equal fingerprints are one row from the start, so that copies cost nothing later; the masks then give 2^(radius+1) - 1 rows for each.
    """
    fps = cut(fingerprints(docs, shingle, id_col, text_col))
    classes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    masks = [m - (1 << 64) if m >> 63 else m for m in covering_masks(radius)]
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m).cast("long"))) for i, m in enumerate(masks)])
    rows = classes.where("rep IS NOT NULL").select(F.explode(keys).alias("key"), "fp", "rep")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(left, right):
        table = left if right is None else pa.concat_tables([left, right])
        a, b = _linked(table.column("fp").to_numpy().view(np.uint64), table.column("rep").to_numpy(), radius)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], schema=schema) if a else None

    from pyspark.sql.types import LongType, StructField, StructType

    out = StructType([StructField("a", LongType()), StructField("b", LongType())])
    found = components(compare_buckets(rows, "key", ["fp"], compare, out, block))
    named = classes.join(found, classes.rep == found.id, "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(named, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, radius: int = 4, shingle: int = 4) -> DataFrame:
    """docs, with all their columns, without those whose group has a smaller doc_id; rows without an id stay. Null texts count as empty, and texts without
    words are one group; repeated rows of an id stay or go together; no rows give none."""
    gone = near_duplicates(docs.where("doc_id IS NOT NULL"), radius, shingle).where("doc_id != component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def plan(n: int, similarity: float, miss: float, bucket: int) -> tuple[int, int, int]:
    """(bits of a block, blocks, bits of a sketch in which a pair may differ) for n texts: a mask keeps two thirds of a block, so that of unrelated texts
    about ``bucket`` share a key, and a pair just at the similarity is lost by all blocks, or by the sketch, with a chance of ``miss`` at most."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    chance = lambda bits, k: math.comb(bits, k) * p**k * (1 - p) ** (bits - k)
    bits = 3 * max(2, math.ceil(math.log2(max(n / bucket, 1)) / 2))
    lost = 1 - sum(chance(bits, k) for k in range(IN_BLOCK + 1))
    blocks = math.ceil(math.log(miss) / math.log(lost)) if lost > 1e-15 else 1
    left, most = 1 - chance(SKETCH, 0), 0
    while left >= miss and most < SKETCH:
        most += 1
        left -= chance(SKETCH, most)
    return bits, blocks, most


def long_simhash(own: np.ndarray, salts: np.ndarray) -> bytes:
    """64 bits for each salt, the majority over the distinct hashes ``own``, mixed with it anew."""
    counts = np.zeros(BITS * len(salts), np.int64)
    for at in range(0, len(own), 255):  # as many as a byte counts
        h = mixed(mixed(own[at : at + 255, None] ^ salts) * ODD)
        counts += np.unpackbits(h.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(own)).tobytes()


def _long_fingerprints(docs: DataFrame, shingle: int, size: int, seed: int) -> DataFrame:
    """(doc_id, name, fp): name is the same for equal sets; fp has ``size`` longs, and is null for an empty set."""
    schema = pa.schema([("doc_id", pa.int64()), ("name", pa.int64()), ("fp", pa.binary())])
    salts = np.random.default_rng(seed).integers(0, 1 << 64, size, np.uint64)

    def run(batches):
        begins("simhash")
        known = WordHashes(seed)
        for b in batches:
            sets = [shingle_set(t, shingle, known) for t in texts(b.column(1))]
            fps = pa.array([long_simhash(s, salts) if len(s) else None for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(np.array([name_of(s) for s in sets], np.uint64).view(np.int64)), fps], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, name long, fp binary")


def _dealt(classes: DataFrame, bits: int, blocks: int) -> DataFrame:
    """(key, name, *SIGNS): a row for each class, block and mask; the signs are the sketch, the fingerprint's first bits."""
    schema = pa.schema([(c, pa.int64()) for c in ("key", "name", *SIGNS)])
    masks = covering_masks(IN_BLOCK, bits=bits)
    powers = 1 << np.arange(bits, dtype=np.int64)

    def run(batches):
        for whole in batches:
            for b in (whole.slice(i, 2048) for i in range(0, whole.num_rows, 2048)):
                fps = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(b.num_rows, -1)
                sketch = np.ascontiguousarray(fps[:, : SKETCH // 8]).view(np.int64)
                signs = [pa.array(np.ascontiguousarray(x)) for x in sketch.T]
                side = np.unpackbits(fps, axis=1)
                for k in range(blocks):
                    value = side[:, k * bits : (k + 1) * bits] @ powers
                    for m, mask in enumerate(masks):
                        yield pa.RecordBatch.from_arrays([pa.array((k * len(masks) + m) << 32 | value & mask), b.column(0), *signs], schema=schema)

    return classes.select("name", "fp").where("fp IS NOT NULL").mapInArrow(run, "key long, name long, s1 long, s2 long, s3 long")


def _clusters(fps: np.ndarray, most: int) -> np.ndarray:
    """For each column of fps the first one reachable over pairs that differ in ``most`` bits at most."""
    root = np.arange(fps.shape[1])
    differ = lambda i, j: sum(np.bitwise_count(f[i][:, None] ^ f[j][None]) for f in fps)
    met = np.zeros(len(root), bool)
    for i in range(0, len(root), 256):
        near = differ(slice(i, i + 256), slice(i, None)) <= most
        np.fill_diagonal(near, False)
        met[i : i + 256] |= near.any(axis=1)
        met[i:] |= near.any(axis=0)
    left = np.flatnonzero(met)
    while len(left):
        front, left = left[:1], left[1:]
        first = front[0]
        while len(front) and len(left):
            reached = (differ(front[:256], left) <= most).any(axis=0)
            root[left[reached]] = first
            front, left = np.concatenate([front[256:], left[reached]]), left[~reached]
    return root


def _alike(table: pa.Table, most: int, schema: pa.Schema) -> pa.RecordBatch | None:
    """(unit, name, root) of the classes of a bucket that may be similar to others in it; a unit is named by its members."""
    name = table.column("name").to_numpy()
    root = _clusters(np.stack([table.column(c).to_numpy().view(np.uint64) for c in SIGNS]), most)
    size = np.bincount(root, minlength=len(root))[root]
    of = np.lexsort((name, root))
    of = of[size[of] > 1]
    if not len(of):
        return None
    name, edges = name[of], np.flatnonzero(np.diff(root[of], prepend=-1, append=-1))
    units = [xxhash.xxh64_intdigest(name[s:e].tobytes(), 3) for s, e in zip(edges[:-1], edges[1:], strict=True)]
    sizes = np.diff(edges)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (np.repeat(np.array(units, np.uint64).view(np.int64), sizes), name, np.repeat(name[edges[:-1]], sizes))], schema=schema)


def similar(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, miss: float = 1e-6, bucket: int = 4096, block: int = 1024, seed: int = 17) -> DataFrame:
    """(doc_id, component_id) for each row of docs(doc_id, text); rows with a null doc_id come back with their group's.

    Rows are linked if their sets of ``shingle`` words, in lower case, have a Jaccard similarity of ``similarity`` or more, counted exactly over
    64-bit hashes; component_id is the smallest doc_id reachable by links. Null and empty texts and texts without words are equal to each other
    alone. ``miss`` bounds the chance that a pair exactly at the threshold is not proposed; closer pairs are missed more rarely.

    Equal sets are one row from the start. A bucket's rows carry a sketch alone, and only classes whose sketches are close in some bucket are
    compared. They form groups over all buckets, so that a set, computed anew, is sent to one group; in a group of very many, to its buckets.
    """
    from pyspark.sql.types import LongType, StructField, StructType

    n = docs.count()
    bits, blocks, most = plan(n, similarity, miss, bucket)
    rows = cut(_long_fingerprints(docs, shingle, math.ceil(max(bits * blocks, SKETCH) / BITS), seed))
    classes = cut(rows.groupBy("name").agg(F.min("doc_id").alias("rep"), F.first("fp").alias("fp")).where("rep IS NOT NULL"))
    schema = pa.schema([(c, pa.int64()) for c in ("unit", "name", "root")])

    def propose(left, right):
        return _alike(left if right is None else pa.concat_tables([left, right]), most, schema)

    form = lambda *names: StructType([StructField(c, LongType()) for c in names])
    units = cut(compare_buckets(_dealt(classes, bits, blocks), "key", ["name"], propose, form("unit", "name", "root"), 8 * block).distinct())
    found = components(units.select(F.col("name").alias("a"), F.col("root").alias("b")))
    found = found.union(found.select("component", "component").distinct()).toDF("name", "group")
    large = found.groupBy("group").count().where(F.col("count") > WHOLE_BLOCKS * block).select("group")
    whole = found.join(large, "group", "left_anti").select(F.col("group").alias("unit"), "name")
    split = units.join(found.join(large, "group", "left_semi").select("name"), "name", "left_semi").select("unit", "name")
    met = cut(whole.union(split).join(classes.select("name", "rep"), "name").select("unit", "name", "rep"))
    wanted = met.select(F.col("rep").alias("_wanted")).distinct()
    sets = sets_of(docs.join(wanted, docs["doc_id"] == wanted["_wanted"], "left_semi"), shingle, seed).dropDuplicates(["name"])
    links = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(left, right):
        table = left if right is None else pa.concat_tables([left, right])
        a, b = linked_sets(table.column("members").to_pylist(), table.column("rep").to_numpy(), similarity)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], schema=links) if a else None

    linked = components(compare_buckets(met.join(sets, "name").select("unit", "rep", "members"), "unit", ["rep"], compare, form("a", "b"), block))
    named = classes.join(linked, classes.rep == linked.id, "left").select("name", F.coalesce("component", "rep").alias("component_id"))
    return rows.join(named, "name", "left").select("doc_id", "component_id")


def drop_similar(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs, with all their columns, without those whose group by similar() has a smaller doc_id; rows without an id stay. Null texts count as empty, and
    texts without words are one group; repeated rows of an id stay or go together; no rows give none."""
    gone = similar(docs.where("doc_id IS NOT NULL"), shingle, similarity).where("doc_id != component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti").select(docs.columns)
