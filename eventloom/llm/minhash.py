"""Near-duplicates by the similarity of their shingle sets: MinHash bands propose, the exact Jaccard similarity decides.

Two sets of Jaccard similarity s have the same least hash, under one random order of all hashes, with probability s. A table is keyed by
``ROWS`` least hashes, so that it brings a pair together with probability s^ROWS; the number of tables follows from the chance that a pair
just at the threshold may be missed. The pipeline proposes pairs by fingerprints instead (``simhash.similar``, with this module's sets).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.buckets import compare_buckets
from eventloom.llm.common import WordHashes, begins, cut, shingle_hashes, texts, words
from eventloom.llm.graph import components

#: Least hashes in a table's key.
ROWS = 4
#: Words whose hashes a task remembers; beyond them it begins anew.
KNOWN_WORDS = 150_000


def tables_for(similarity: float, miss: float) -> int:
    return math.ceil(math.log(miss) / math.log(1 - similarity**ROWS)) if similarity < 1 else 1


def shingle_set(text: bytes | None, shingle: int, known: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of a text's runs of ``shingle`` words, in lower case; of all its words if it has fewer, none without words."""
    found = words(text.lower()) if text else []
    if len(known) > KNOWN_WORDS:
        known.clear()
    return np.unique(shingle_hashes(known.array(found), min(shingle, len(found)))) if found else np.empty(0, np.uint64)


def name_of(own: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(own.tobytes(), 5)


def _signed(docs: DataFrame, shingle: int, tables: int, seed: int) -> DataFrame:
    """(doc_id, name, keys): name is the same for equal sets; keys are a set's keys in the tables, none for an empty set."""
    schema = pa.schema([("doc_id", pa.int64()), ("name", pa.int64()), ("keys", pa.list_(pa.int64()))])
    rng = np.random.default_rng(seed)
    odd, add = (rng.integers(0, 1 << 64, (ROWS * tables, 1), np.uint64) for _ in range(2))
    odd |= np.uint64(1)

    def run(batches):
        begins("minhash")
        known = WordHashes(seed)
        for b in batches:
            names, keys = [], []
            for text in texts(b.column(1)):
                own = shingle_set(text, shingle, known)
                names.append(name_of(own))
                if not len(own):
                    keys.append([])
                    continue
                least = np.full(ROWS * tables, np.iinfo(np.uint64).max, np.uint64)
                for at in range(0, len(own), 1024):  # very long texts by parts
                    np.minimum(least, (own[None, at : at + 1024] * odd + add).min(axis=1), out=least)
                keys.append(shingle_hashes(least, ROWS)[::ROWS].view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(np.array(names, np.uint64).view(np.int64)), pa.array(keys, pa.list_(pa.int64()))], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, name long, keys array<long>")


def sets_of(docs: DataFrame, shingle: int, seed: int) -> DataFrame:
    """(name, members): the sets themselves, as unsigned 64-bit numbers."""
    schema = pa.schema([("name", pa.int64()), ("members", pa.binary())])

    def run(batches):
        begins("minhash")
        known = WordHashes(seed)
        for b in batches:
            sets = [shingle_set(t, shingle, known) for t in texts(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(np.array([name_of(s) for s in sets], np.uint64).view(np.int64)), pa.array([s.tobytes() for s in sets], pa.binary())], schema=schema)

    return docs.select("text").mapInArrow(run, "name long, members binary")


def linked_sets(members: list[bytes], ids: np.ndarray, similarity: float) -> tuple[list, list]:
    """Links that join the sets of this similarity, by breadth-first search: sets already reached are compared no more."""
    sizes = np.array([len(m) // 8 for m in members])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    at = np.unique(np.frombuffer(b"".join(members), np.uint64), return_inverse=True)[1]
    own = np.zeros(at.max() + 1, np.uint8)
    left = np.arange(len(members))
    a, b = [], []
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            f = front.pop()
            mine = at[starts[f] : starts[f] + sizes[f]]
            own[mine] = 1
            common = np.add.reduceat(own[at], starts, dtype=np.int64)[left]
            own[mine] = 0
            reached = common >= similarity * (sizes[f] + sizes[left] - common) - 1e-9
            a.append(ids[left[reached]])
            b.append(np.full(int(reached.sum()), ids[f]))
            front.extend(left[reached])
            left = left[~reached]
    return a, b


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, miss: float = 1e-6, block: int = 1024, seed: int = 17) -> DataFrame:
    """(doc_id, component_id) for each row of docs(doc_id, text); rows with a null doc_id come back with their group's.

    Rows are linked if their sets of ``shingle`` words, in lower case, have a Jaccard similarity of ``similarity`` or more, counted exactly over
    64-bit hashes; component_id is the smallest doc_id reachable by links. Null and empty texts and texts without words are equal to each other
    alone. ``miss`` bounds the chance that a pair exactly at the threshold shares no bucket; closer pairs are missed more rarely.

    Equal sets are one row from the start. Only buckets of two or more sets are compared, and of buckets with the same sets one; only then are
    the sets, computed anew, sent there.
    """
    rows = cut(_signed(docs, shingle, tables_for(similarity, miss), seed))
    classes = cut(rows.groupBy("name").agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys")).where("rep IS NOT NULL"))
    dealt = classes.select(F.posexplode("keys").alias("tab", "key"), "name", "rep").select(F.xxhash64("tab", "key").alias("key"), "name", "rep")
    full = dealt.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("name")).alias("x"), F.bit_xor(F.xxhash64("name", F.lit(1))).alias("y")).where("n > 1")
    met = cut(dealt.join(full.groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key"), "key", "left_semi"))
    wanted = met.select(F.col("rep").alias("_wanted")).distinct()
    sets = sets_of(docs.join(wanted, docs["doc_id"] == wanted["_wanted"], "left_semi"), shingle, seed).dropDuplicates(["name"])
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(left, right):
        table = left if right is None else pa.concat_tables([left, right])
        a, b = linked_sets(table.column("members").to_pylist(), table.column("rep").to_numpy(), similarity)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], schema=schema) if a else None

    from pyspark.sql.types import LongType, StructField, StructType

    out = StructType([StructField("a", LongType()), StructField("b", LongType())])
    found = components(compare_buckets(met.join(sets, "name").select("key", "rep", "members"), "key", ["rep"], compare, out, block))
    named = classes.join(found, classes.rep == found.id, "left").select("name", F.coalesce("component", "rep").alias("component_id"))
    return rows.join(named, "name", "left").select("doc_id", "component_id")
