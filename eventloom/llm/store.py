"""A content-addressed store of token ids.

A rolling hash over the last 16 ids cuts each document's ids into chunks, so that equal passages give equal chunks wherever they stand. A
store is a folder with three Parquet tables:

- chunks: of kind chunk (hash, ids, payload), a chunk's hash, its number of ids, and these as little-endian unsigned integers of ``width``
  bytes, each chunk once; of kind recipe (doc_id, chunks), the documents as map tasks met them, from which recipes is made.
- recipes: (part, place, first, doc_id, n_tokens, root, chunks), in files in ascending doc_id order: a document's chunk hashes in order, their
  Merkle root, and its place and the tokens before it in its part.
- manifest: (part, before, n_tokens, n_docs, root, width, whole): for each part the tokens in the parts before it and the root of the Merkle
  tree over its documents' roots; whole is the root of the tree over the parts' roots.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.cells import sized
from eventloom.llm.common import dealt_by, tasks
from eventloom.llm.tokens import encoded_together

LEAST, MOST, MEAN_BITS = 128, 4096, 9
#: Documents under one node of a part's tree that a task puts together at a time: a power of two, so that such nodes are the tree's own.
TOGETHER = 4096


@cache
def _gear(size: int = 1 << 16) -> np.ndarray:
    return np.random.default_rng(16).integers(0, 1 << 64, size, np.uint64)


def _candidates(ids: np.ndarray) -> np.ndarray:
    """Places after ids where the hash of the last 16 has MEAN_BITS leading zeros. No chunk ends in its first 16 ids, so documents may stand in a row."""
    h = _gear()[ids & 0xFFFF]
    for step in (1, 2, 4, 8):
        older = h[:-step] << np.uint64(step)
        h = h.copy()
        h[step:] += older
    return np.flatnonzero(h >> np.uint64(64 - MEAN_BITS) == 0) + 1


def _ends(candidates: list[int], start: int, end: int) -> list[int]:
    """Ends of the chunks of the document from ``start`` to ``end``, of LEAST to MOST ids but for the last."""
    ends, last = [], start
    for e in [*candidates, end]:
        if e - last < LEAST and e != end:
            continue
        while e - last > MOST:
            last += MOST
            ends.append(last)
        if e > last:
            ends.append(e)
            last = e
    return ends


def boundaries(ids: np.ndarray) -> list[int]:
    """Ends of the chunks of one document's ids."""
    return _ends(_candidates(ids).tolist(), 0, len(ids))


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def merkle(leaves: list[bytes]) -> bytes:
    """The root of a binary tree over the leaves; an odd node moves up as it is."""
    if not leaves:
        return digest(b"")
    while len(leaves) > 1:
        leaves = [digest(b"\x01" + a + b) for a, b in zip(leaves[::2], leaves[1::2])] + leaves[len(leaves) & ~1 :]
    return leaves[0]


_POLY = np.uint64(0xEDB88320)  # CRC-32's polynomial, reflected


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The products of polynomials modulo CRC-32's, pair by pair."""
    p, b, one = np.zeros(len(a), np.uint64), b.copy(), np.uint64(1)
    for bit in range(31, -1, -1):
        p ^= np.where(a >> np.uint64(bit) & one, b, np.uint64(0))
        b = (b >> one) ^ np.where(b & one, _POLY, np.uint64(0))
    return p


def _shift(n: np.ndarray) -> np.ndarray:
    """x to the power 8n for each n."""
    known, at = np.unique(n, return_inverse=True)
    result, square = np.full(len(known), 0x80000000, np.uint64), np.full(1, 0x00800000, np.uint64)
    while known.any():
        result = np.where(known & 1, _times(np.repeat(square, len(result)), result), result)
        square, known = _times(square, square), known >> 1
    return result[at]


def joined_crcs(crc: np.ndarray, length: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The CRC-32 of each run of strings from one of ``starts`` to the next, from the strings' own and their lengths in bytes."""
    after = np.cumsum(length[::-1])[::-1]
    ends = np.append(after[starts[1:]], 0)
    return np.bitwise_xor.reduceat(_times(_shift(after - length - np.repeat(ends, np.diff(np.append(starts, len(crc))))), crc.astype(np.uint64)), starts) if len(crc) else crc


#: Bytes of text for which a map task sends a payload once; copies of one chunk that a group may get.
SENT_ONCE, COPIES = 4e6, 32_768
_CHUNKS = pa.list_(pa.struct([("hash", pa.binary()), ("ids", pa.int32())]))
_CHUNKS_SPEC = "array<struct<hash: binary, ids: int>>"
_OBJECTS = pa.schema([("kind", pa.string()), ("hash", pa.binary()), ("ids", pa.int32()), ("payload", pa.binary()), ("doc_id", pa.int64()), ("row", pa.int64()), ("times", pa.int32()), ("chunks", _CHUNKS)])
_OBJECTS_SPEC = f"kind string, hash binary, ids int, payload binary, doc_id long, row long, times int, chunks {_CHUNKS_SPEC}"
_RECIPE = pa.schema([("part", pa.int32()), ("place", pa.int64()), ("first", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("root", pa.binary()), ("chunks", _CHUNKS)])
_RECIPE_SPEC = f"part int, place long, first long, doc_id long, n_tokens long, root binary, chunks {_CHUNKS_SPEC}"


def _lists(hashes: list[bytes], sizes: list[int], counts: list[int]) -> pa.Array:
    rows = pa.StructArray.from_arrays([pa.array(hashes, pa.binary()), pa.array(sizes, pa.int32())], fields=list(_CHUNKS.value_type))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), rows)


def _cut_up(tokenizer: str, end_id: int, width: int):
    """Texts to the distinct chunks and the recipes of some megabytes at a time."""
    kind = f"<u{width}"

    def objects(doc_ids, rows, ids, bounds):
        n = len(bounds) - 1
        wide = np.full(len(ids) + n, end_id, np.uint32)
        at = np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(bounds))
        wide[at] = ids
        if width == 2 and wide.max() > 0xFFFF:
            raise ValueError("an id needs more than 2 bytes; give width=4")
        payload = wide.astype(kind).tobytes()
        starts = (bounds + np.arange(n + 1)).tolist()
        found = _candidates(wide)
        slots = np.searchsorted(found, starts).tolist()
        found = found.tolist()
        chunks: dict[bytes, bytes] = {}
        recipes: dict[tuple, list] = {}
        for k, place in enumerate(zip(doc_ids, rows, strict=True)):
            if (known := recipes.get(place)) is not None:
                known[0] += 1
                continue
            s, hashes, sizes = starts[k], [], []
            for e in _ends(found[slots[k] : slots[k + 1]], s, starts[k + 1]):
                own = payload[width * s : width * e]
                key = digest(own)
                chunks[key] = own
                hashes.append(key)
                sizes.append(e - s)
                s = e
            recipes[place] = [1, hashes, sizes]
        return chunks, recipes

    def run(batches):
        for b in batches:
            doc_ids, rows, done = b.column(0).to_pylist(), b.column(1).to_pylist(), 0
            for ids, bounds in encoded_together(b.column(2), tokenizer):
                n = len(bounds) - 1
                chunks, recipes = objects(doc_ids[done : done + n], rows[done : done + n], ids, bounds)
                done += n
                size = len(chunks)
                none = pa.nulls(size, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(["chunk"] * size), pa.array(list(chunks), pa.binary()), pa.array([len(x) // width for x in chunks.values()], pa.int32()), pa.array(list(chunks.values()), pa.binary()), none, none, pa.nulls(size, pa.int32()), pa.nulls(size, _CHUNKS)], schema=_OBJECTS)
                size = len(recipes)
                keys = [xxhash.xxh3_128_digest(f"{d} {r}") for d, r in recipes]
                chunk_lists = _lists([h for x in recipes.values() for h in x[1]], [i for x in recipes.values() for i in x[2]], [len(x[1]) for x in recipes.values()])
                yield pa.RecordBatch.from_arrays([pa.array(["recipe"] * size), pa.array(keys, pa.binary()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary()), pa.array([d for d, _ in recipes], pa.int64()), pa.array([r for _, r in recipes], pa.int64()), pa.array([x[0] for x in recipes.values()], pa.int32()), chunk_lists], schema=_OBJECTS)

    return run


def _once(batches):
    """Of chunks sorted by key the first of each; recipes pass."""
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        kind, key = b.column("kind"), b.column("hash")
        before = pa.concat_arrays([pa.array([last], pa.binary()), key.slice(0, len(key) - 1)])
        last = key[-1].as_py()
        yield b.filter(pc.or_(pc.equal(kind, "recipe"), pc.fill_null(pc.not_equal(key, before), True)))


def _assemble(batches):
    """Recipes of a part, in order, with their place, tokens before and root."""
    part, place, first = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        if not b.num_rows:
            continue
        lists = b.column("chunks")
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        flat = lists.flatten()
        hashes = flat.field(0).to_numpy(zero_copy_only=False).tolist()
        sums = np.concatenate([[0], np.cumsum(flat.field(1).to_numpy().astype(np.int64))])
        tokens = np.diff(sums[offsets])
        edges = offsets.tolist()
        roots = [hashes[s] if e - s == 1 else merkle(hashes[s:e]) for s, e in zip(edges, edges[1:])]
        times = b.column("times").to_numpy()
        at = np.repeat(np.arange(b.num_rows), times)
        own = tokens[at]
        firsts = first + np.cumsum(own) - own
        rows = pa.array(at)
        columns = [np.full(len(at), part, np.int32), place + np.arange(len(at)), firsts, b.column("doc_id").take(rows), own, pa.array(roots, pa.binary()).take(rows), lists.take(rows)]
        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema=_RECIPE)
        place, first = place + len(at), first + int(own.sum())


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, width: int = 2, id_col: str = "doc_id", text_col: str = "text", copies: int = COPIES) -> None:
    """Writes every text's ids and ``end_id``. Null and empty texts are ``end_id`` alone; repeated rows stay documents of their own; null ids come
    first. An empty table gives a store without documents.

    Texts are tokenized once. One exchange brings a chunk's copies together, each map task sending a payload once for some megabytes of text
    however often it stands there, and no references, so that a frequent chunk is no large group. Where the corpus is so large that a chunk of all texts
    could come more than ``copies`` times all the same, an exchange before it brings its copies together in as many groups as keep below that. Recipes travel with them, spread by their
    document, and are put in order from what was written.
    """
    if width not in (2, 4):
        raise ValueError("width must be 2 or 4 bytes")
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    objects = rows.mapInArrow(_cut_up(tokenizer, end_id, width), _OBJECTS_SPEC)
    size = sized(docs, text_col)
    to, salts = tasks(spark, size), math.ceil(size / SENT_ONCE / copies)
    if salts > 1:
        objects = objects.repartition(to, "hash", dealt_by(salts)).sortWithinPartitions("kind", "hash").mapInArrow(_once, _OBJECTS_SPEC)
    objects = objects.repartition(to, "hash").sortWithinPartitions("kind", "hash")
    objects.mapInArrow(_once, _OBJECTS_SPEC).write.partitionBy("kind").option("compression", "zstd").parquet(f"{path}/chunks")

    met = spark.read.schema(_OBJECTS_SPEC).parquet(f"{path}/chunks").where("kind = 'recipe'").select("doc_id", "row", "times", "chunks")
    met.repartitionByRange(to, "doc_id", "row").sortWithinPartitions("doc_id", "row").mapInArrow(_assemble, _RECIPE_SPEC).write.option("compression", "zstd").parquet(f"{path}/recipes")

    trees = _part_trees(spark.read.schema(_RECIPE_SPEC).parquet(f"{path}/recipes")).orderBy("part").collect()  # a row for each part: as many as tasks wrote
    whole, before, manifest = merkle([bytes(t["root"]) for t in trees]), 0, []
    for t in trees:
        manifest.append((t["part"], before, t["n_tokens"], t["n_docs"], t["root"], width, whole))
        before += t["n_tokens"]
    spark.createDataFrame(manifest, "part int, before long, n_tokens long, n_docs long, root binary, width int, whole binary").coalesce(1).write.parquet(f"{path}/manifest")


def _part_trees(recipes: DataFrame) -> DataFrame:
    """(part, n_tokens, n_docs, root): the tree over each part's documents' roots, from nodes over TOGETHER documents each."""

    def roots(spec):
        def run(batches):
            for b in batches:
                own = [merkle([x["root"] for x in nodes]) for nodes in b.column("nodes").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("part", "at", "n_tokens", "n_docs")), pa.array(own, pa.binary())], names=["part", "at", "n_tokens", "n_docs", "root"])

        return lambda df: df.mapInArrow(run, spec)

    def over(df, at):
        nodes = F.array_sort(F.collect_list(F.struct("at", "root"))).alias("nodes")
        return df.groupBy("part", at.alias("_node")).agg(F.sum("n_tokens").alias("n_tokens"), F.sum("n_docs").alias("n_docs"), nodes).withColumnRenamed("_node", "at").transform(roots("part int, at long, n_tokens long, n_docs long, root binary"))

    leaves = recipes.select("part", F.col("place").alias("at"), "n_tokens", F.lit(1).cast("long").alias("n_docs"), "root")
    return over(over(leaves, F.floor(F.col("at") / TOGETHER)), F.lit(0).cast("long")).select("part", "n_tokens", "n_docs", "root")


def _tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    chunks = spark.read.schema(_OBJECTS_SPEC).parquet(f"{path}/chunks").where("kind = 'chunk'").select(F.col("hash").alias("hash"), "ids", "payload")
    return chunks, spark.read.schema(_RECIPE_SPEC).parquet(f"{path}/recipes"), spark.read.parquet(f"{path}/manifest")


def _verified(recipes: DataFrame, manifest: list) -> DataFrame:
    """Recipes with their start among all tokens; fails if a root is not that of its hashes, a part's not that of its documents, or the whole's not
    that of the parts. ``manifest`` has a row for each part."""
    spark = recipes.sparkSession
    if manifest and merkle([bytes(m["root"]) for m in manifest]) != bytes(manifest[0]["whole"]):
        raise ValueError("the parts don't give the store's Merkle root")

    def check(batches):
        for b in batches:
            lists = b.column("chunks")
            edges = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
            hashes = lists.flatten().field(0).to_numpy(zero_copy_only=False).tolist()
            for k, (s, e, root) in enumerate(zip(edges, edges[1:], b.column("root").to_numpy(zero_copy_only=False).tolist(), strict=False)):
                if (hashes[s] if e - s == 1 else merkle(hashes[s:e])) != root:
                    raise ValueError(f"the recipe of document {b.column('doc_id')[k].as_py()} doesn't give its Merkle root")
            yield b

    due = spark.createDataFrame([(m["part"], m["before"], m["root"]) for m in manifest], "part int, before long, due binary")
    trees = due.join(_part_trees(recipes).select("part", "root"), "part", "left")
    right = trees.select("part", "before", F.assert_true(F.coalesce(F.col("due") == F.col("root"), F.lit(False)), "a part's recipes don't give its Merkle root").alias("ok"))
    # A row for each part, of which there are as many as write tasks.
    return recipes.mapInArrow(check, _RECIPE_SPEC).join(F.broadcast(right), "part").where("ok IS NULL").withColumn("start", F.col("before") + F.col("first"))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, null ids and repeated ones included, every payload read and verified against its
    hash, every recipe against its Merkle root. A store without documents gives no rows.

    A document's checksum is joined from its chunks' ones, so that payloads stay where they are read.
    """
    chunks, recipes, manifest = _tables(spark, path)
    manifest = manifest.orderBy("part").collect()
    kind = f"<u{manifest[0]['width']}" if manifest else "<u2"
    schema = pa.schema([("hash", pa.binary()), ("crc", pa.int64())])

    def check(batches):
        for b in batches:
            out = []
            for h, p in zip(b.column(0).to_numpy(zero_copy_only=False).tolist(), b.column(1).to_numpy(zero_copy_only=False).tolist(), strict=True):
                if digest(p) != h:
                    raise ValueError(f"the payload of chunk {h.hex()} doesn't give its hash")
                out.append(zlib.crc32(np.frombuffer(p, kind).astype("<u4")))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.int64())], schema=schema)

    sums = chunks.select("hash", "payload").mapInArrow(check, "hash binary, crc long")
    used = _verified(recipes, manifest).select("doc_id", "start", "n_tokens", F.posexplode("chunks").alias("seq", "c")).select("doc_id", "start", "n_tokens", "seq", "c.hash", "c.ids")
    # start is unique to a document: each has its end id at least.
    found = used.join(sums, "hash", "left").groupBy("start").agg(F.first("doc_id").alias("doc_id"), F.first("n_tokens").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("seq", "ids", "crc"))).alias("own"))
    result = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def join(batches):
        for b in batches:
            if not b.num_rows:
                continue
            lists = b.column("own")
            starts = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
            flat = lists.flatten()
            ids = flat.field(1).to_numpy().astype(np.int64)
            if flat.field(2).null_count or (np.add.reduceat(ids, starts) != b.column("n_tokens").to_numpy()).any():
                raise ValueError("a document's chunks are missing")
            crc = joined_crcs(flat.field(2).to_numpy(), 4 * ids, starts)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), b.column("n_tokens"), pa.array(crc.astype(np.int64))], schema=result)

    return found.mapInArrow(join, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids): each document's ids put together again from its recipe, in the file's width; recipes are verified, and documents come as
    in read_digests()."""
    chunks, recipes, manifest = _tables(spark, path)
    used = _verified(recipes, manifest.orderBy("part").collect()).select("doc_id", "start", F.posexplode("chunks").alias("seq", "c")).select("doc_id", "start", "seq", "c.hash")
    whole = F.array_sort(F.collect_list(F.struct("seq", "payload")))
    return used.join(chunks.select("hash", "payload"), "hash").groupBy("start").agg(F.first("doc_id").alias("doc_id"), F.aggregate(whole, F.lit(b""), lambda done, x: F.concat(done, x["payload"])).alias("ids"))
