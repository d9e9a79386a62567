"""Splitting a table into shards of near equal size by histogram sort.

Rows are ordered by a hash of their text and then by id, so that equal texts lie together. Rounds count exactly how many bytes lie in each
of a few thousand key ranges, over all partitions; the ranges that hold a wanted boundary are divided again until every boundary is within
the tolerance. Then one exchange brings each row to its shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import cut, gapless, total

DIGIT = 10
_WIDTH = 64


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, k1, k2): size is the text's UTF-8 bytes plus 8; k1, k2 order the rows as signed numbers."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("k1"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("k2"))


def splitters(rows: DataFrame, shards: int, weight: str = "size", tolerance: float = 0.0005) -> list[tuple[int, int]]:
    """The first key (k1, k2) of each shard but the first, such that the weight below each is within ``tolerance`` shards of its due.

    A boundary falls between two texts where that is close enough, else between two ids of one text, else (a single row, or repeated rows
    of one id and text, being larger than the tolerance) at the nearest key. A round gives the driver at most 2^DIGIT ranges per boundary.
    """
    whole, = total(rows, F.coalesce(F.sum(weight), F.lit(0)))
    due = {s: whole * s / shards for s in range(1, shards)}
    allowed = tolerance * whole / shards
    ends: dict[int, tuple[int, int]] = {}
    # An open range: the digits of a key prefix of 0 to 128 bits, known to hold the boundaries listed, and the weight below it.
    open_ranges: dict[int, tuple[float, list[int]]] = {0: (0, sorted(due))}
    known = 0  # bits of the prefix
    while open_ranges:
        column, done = ("k1", known) if known < _WIDTH else ("k2", known - _WIDTH)
        take = min(DIGIT, _WIDTH - done)
        # As unsigned numbers the signed keys keep their order once the sign bit is turned over.
        flipped = F.col(column).bitwiseXOR(F.lit(-(1 << 63)))
        digit = F.shiftrightunsigned(flipped, _WIDTH - done - take).bitwiseAND(F.lit((1 << take) - 1))
        if known < _WIDTH:
            prefix = F.shiftrightunsigned(flipped, _WIDTH - known) if known else F.lit(0)
            is_open = [(p, prefix == F.lit(p)) for p in open_ranges]
        else:
            rest = F.shiftrightunsigned(flipped, _WIDTH - done) if done else F.lit(0)
            is_open = [(p, (F.col("k1") == F.lit((p >> done) - (1 << 63))) & (rest == F.lit(p & ((1 << done) - 1)))) for p in open_ranges]
        which = F.coalesce(*[F.when(test, F.lit(i)) for i, (_, test) in enumerate(is_open)])
        found: dict[int, dict[int, int]] = {}
        for i, d, w in rows.select(which.alias("i"), digit.alias("d"), weight).where("i IS NOT NULL").groupBy("i", "d").agg(F.sum(weight)).collect():
            found.setdefault(i, {})[d] = w
        following: dict[int, tuple[float, list[int]]] = {}
        for i, (p, _) in enumerate(is_open):
            below, wanted = open_ranges[p]
            for d, w in sorted(found.get(i, {}).items()):
                child = (p << take) | d
                last = known + take == 2 * _WIDTH
                for s in [s for s in wanted if s not in ends and below <= due[s] <= below + w]:
                    near_start = due[s] - below <= below + w - due[s]
                    if last or min(due[s] - below, below + w - due[s]) <= allowed:
                        ends[s] = _key(child + (0 if near_start else 1), known + take)
                    else:
                        base, held = following.setdefault(child, (below, []))
                        if s not in held:
                            held.append(s)
                for s in following.get(child, (0, []))[1]:
                    wanted = [x for x in wanted if x != s]
                below += w
        open_ranges, known = following, known + take
    least = (-(1 << 63), -(1 << 63))
    return [ends.get(s, least) for s in range(1, shards)]


def _key(prefix: int, bits: int) -> tuple[int, int]:
    """The least (k1, k2) that begins with this prefix."""
    full = prefix << (2 * _WIDTH - bits)
    top = (1 << (2 * _WIDTH)) - 1
    full = min(full, top)
    return (full >> _WIDTH) - (1 << 63), (full & ((1 << _WIDTH) - 1)) - (1 << 63)


def with_shard(rows: DataFrame, ends: list[tuple[int, int]]) -> DataFrame:
    """rows with their shard, found by comparison with the splitters."""
    after = [F.when((F.col("k1") > F.lit(a)) | ((F.col("k1") == F.lit(a)) & (F.col("k2") >= F.lit(b))), 1).otherwise(0) for a, b in ends]
    return rows.withColumn("shard", sum(after, F.lit(0)).cast("int"))


def assign(docs: DataFrame, shards: int = 24, law: str = "bytes", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row.

    law "bytes": shards' sizes are near equal; "rows": their counts are. slot numbers a shard's rows from 0. grown_shard is null: both laws
    move boundaries when a shard is added. Null texts count as empty, a null id sorts first, repeated rows are rows of their own. A text is
    split between two shards only if the law needs it. No rows, no result.
    """
    if law not in ("bytes", "rows"):
        raise ValueError(f"law must be bytes or rows, not {law}")
    rows = cut(keyed(docs, id_col, text_col).withColumn("_one", F.lit(1).cast("long")))
    ends = splitters(rows, shards, *(("size",) if law == "bytes" else ("_one", 0.0)))
    placed = gapless(with_shard(rows, ends), ["k1", "k2"], ["k1", "k2"], "slot", ["shard"], at_most=50_000 * shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 24, files: int = 1) -> None:
    """Writes the whole rows of docs, in one exchange, below path/shard=N, in ``files`` files each; a column named shard gives way. Null texts count as
    empty but are written as null, null ids come first, repeated rows are rows of their own. No rows give an empty folder."""
    keys = keyed(docs).select("k1", "k2", "size")
    ends = splitters(cut(keys), shards)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*[c for c in docs.columns if c != "shard"]).alias("row"), F.xxhash64(text).alias("k1"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("k2"))
    dealt = with_shard(rows, ends).repartition(shards * files, "shard", F.pmod(F.xxhash64("k2"), F.lit(files)))
    dealt.sortWithinPartitions("shard", "k1", "k2").select("row.*", "shard").write.partitionBy("shard").parquet(path)
