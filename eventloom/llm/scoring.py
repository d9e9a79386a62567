"""Scoring texts by a probabilistic suffix tree over words.

A state is a context of up to ``depth`` preceding tokens. A context is a candidate if the training texts have it ``least`` times or more, and it
is retained if a divergence test says that it predicts better than its suffix: over its training occurrences, each left out in turn, the bits
saved against the suffix's distribution must exceed ``bits``. Its next-symbol distribution keeps the symbols seen twice or more, each less a
discount; all the rest of the mass goes to the suffix's distribution. The root is the smoothed distribution of single tokens, with one more
symbol for all unknown words. So every state's probabilities sum to 1, and a token is predicted from the longest suffix that is a state.

The model is never gathered. Documents are dealt into chunks; a chunk asks hash buckets for what it needs, first its words' counts, then for
each length of context the counts of its (context, word) pairs, and gets them back in the order it asked. Words are known by the whole of their
64-bit hashes, and once counted by numbers that no two share, small for frequent words. Pairs are summed in the chunk first, so that frequent ones
cost each chunk one entry. Contexts are dealt by their hash; those with more than a bucket's share of all tokens by the pair, and their
statistics, like the numbers of all tokens and words, are added up over the buckets and sent to each chunk. The number of buckets follows the
corpus's bytes, and a chunk writes to none for which it has nothing.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.cells import Split, bucket_of, buckets_for, sized, slices
from eventloom.llm.common import ODD, begins, dealt_by, mixed, tasks

DISCOUNT = 0.75
#: Of the texts' compression: they are most of what is sent.
LEVEL = 7
#: Bits saved are added up over buckets in whole parts, so that the sum doesn't depend on their order.
PARTS = 1 << 16
#: A bucket's share of all tokens, by which a context is hot, is at least and at most this: there are no more hot contexts than 1 / LEAST_SHARE.
LEAST_SHARE, MOST_SHARE = 1e-4, 5e-3
START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)

_PRESS, _PULL = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pressed(data: bytes) -> bytes:
    return _PRESS.compress(data)


def tight(a: np.ndarray) -> bytes:
    """Whole numbers from 0 on in as few bytes each as the largest needs, first bytes first, compressed: most are small or equal."""
    width = max(1, -(-int(a.max()).bit_length() // 8)) if len(a) else 1
    return bytes([width]) + pressed(np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes())


def loose(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_PULL.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view("<i8").ravel()


def rising(a: np.ndarray, sizes: np.ndarray) -> bytes:
    """Numbers that rise within runs of these sizes: each run's first, then differences."""
    d = np.diff(a, prepend=0)
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    d[first] = a[first]
    return tight(d)


def risen(data: bytes, sizes: np.ndarray) -> np.ndarray:
    """The inverse of rising()."""
    d = loose(data)
    sums = np.cumsum(d)
    first = np.cumsum(sizes) - sizes
    before = np.concatenate([[0], sums])[first]
    return sums - np.repeat(before, sizes)


def by_word(names: np.ndarray, a: np.ndarray) -> bytes:
    """Numbers of which equal names have equal ones, once for each name: words that are numbered after each other are about as frequent."""
    d = np.diff(a[np.unique(names, return_index=True)[1]], prepend=0)
    return tight((d << 1) ^ (d >> 63))


def of_words(names: np.ndarray, data: bytes) -> np.ndarray:
    """The inverse of by_word()."""
    z = loose(data)
    return np.cumsum((z >> 1) ^ -(z & 1))[np.unique(names, return_inverse=True)[1]]


def pack(a: np.ndarray) -> bytes:
    """Rising hashes as the first and their differences."""
    return a[:1].astype("<u8").tobytes() + tight(np.diff(a)) if len(a) else b""


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.empty(0, np.uint64)
    return np.cumsum(np.concatenate([np.frombuffer(data, "<u8", 1), loose(data[8:]).view(np.uint64)]), dtype=np.uint64)


def _block(data: bytes) -> bytes:
    return len(data).to_bytes(4, "little") + data


def _blocks(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 4], "little")
        out.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return out


#: Bits of a word's number in a context's key, up to so many distinct words: half of those of its numbers, which leaves room for uneven buckets.
NAME_BITS, KEYED_WORDS = 32, 1 << 31


def pack_keys(a: np.ndarray) -> bytes:
    """Rising keys, as those of two words: the distinct upper halves, and the lower ones that rise under each."""
    high, low = (a >> np.uint64(NAME_BITS)).astype(np.int64), (a & np.uint64((1 << NAME_BITS) - 1)).astype(np.int64)
    own, sizes = np.unique(high, return_counts=True)
    return _block(rising(own, np.array([len(own)]))) + _block(tight(sizes)) + _block(rising(low, sizes))


def unpack_keys(data: bytes) -> np.ndarray:
    own, sizes, low = _blocks(data)
    sizes = loose(sizes)
    high = np.repeat(np.cumsum(loose(own)), sizes)
    return high.astype(np.uint64) << np.uint64(NAME_BITS) | risen(low, sizes).astype(np.uint64)


def falling(names: np.ndarray, counts: np.ndarray) -> bytes:
    """Counts of words of one bucket, with numbers where they are 2 or more: those fall as numbers rise."""
    order = np.argsort(names[counts >= 2], kind="stable")
    often = counts[counts >= 2][order]
    fall = -np.diff(often, prepend=often[:1])
    return _block(tight(np.minimum(counts, 2))) + _block(tight(often[:1])) + _block(tight(fall))


def fallen(names: np.ndarray, data: bytes) -> np.ndarray:
    """The inverse of falling()."""
    few, first, fall = map(loose, _blocks(data))
    often = np.flatnonzero(few == 2)
    few[often[np.argsort(names[often], kind="stable")]] = np.repeat(first, len(fall)) - np.cumsum(fall)
    return few


_DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])


def _dealt(docs: DataFrame, n: int, to: int) -> DataFrame:
    """(chunk, docs): documents dealt by rows into ``n`` chunks and ``to`` tasks; those that a task has for a chunk are one compressed blob."""
    schema = pa.schema([("chunk", pa.int32()), ("docs", pa.binary())])

    def blob(rows: pa.RecordBatch) -> bytes:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _DOCS, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", LEVEL))) as out:
            out.write_batch(rows)
        return sink.getvalue().to_pybytes()

    def run(batches):
        for b in batches:
            chunk = b.column(0).to_numpy()
            order = np.argsort(chunk, kind="stable")
            rows = pa.RecordBatch.from_arrays([b.column(1), pc.ascii_lower(b.column(2).cast(pa.string()))], schema=_DOCS).take(pa.array(order))
            found = [(k, blob(rows.slice(s, e - s))) for k, s, e in slices(chunk[order])]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.binary())], schema=schema)

    rows = docs.select(dealt_by(n).alias("chunk"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "chunk int, docs binary").repartition(to, "chunk")


def _joined(table: pa.Table, column: str, of, none=np.empty(0, np.int64)) -> np.ndarray:
    found = [of(x) for x in table.column(column).to_pylist()]
    return np.concatenate(found) if found else none


def _by_bucket(replies: pa.Table) -> tuple[pa.Table, pa.Table]:
    """The answers of the buckets that were asked, in their order, and the row for all chunks."""
    own = pc.greater_equal(replies.column("bucket"), 0)
    return replies.filter(own).sort_by("bucket"), replies.filter(pc.invert(own))


def distinct(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes, rising, and the place of each among them, as np.unique() gives: each is sorted with its place instead of its last bits, and
    all of them anew where two differ in these alone."""
    shift = np.uint64(len(a).bit_length())
    both = a >> shift << shift | np.arange(len(a), dtype=np.uint64)
    both.sort()
    place = (both & ((np.uint64(1) << shift) - np.uint64(1))).view(np.int64)
    values = a[place]
    if (values[1:] < values[:-1]).any():
        return np.unique(a, return_inverse=True)
    new = np.ones(len(a), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    inverse = np.empty(len(a), np.int64)
    inverse[place] = np.cumsum(new) - 1
    return values[new], inverse


def distinct_below(a: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for numbers from 0 to ``below``, many of which differ: each is sorted with its place in its last bits, if both fit a long."""
    shift = len(a).bit_length()
    if not len(a) or below.bit_length() + shift > 63:
        return np.unique(a, return_inverse=True)
    both = a << shift | np.arange(len(a))
    both.sort()
    values = both >> shift
    new = np.concatenate([[True], values[1:] != values[:-1]])
    inverse = np.empty(len(a), np.int64)
    inverse[both & ((1 << shift) - 1)] = np.cumsum(new) - 1
    return values[new], inverse


class _Tokens:
    """A chunk's tokens in a row: ``kind`` of each among the chunk's distinct ones, sorted by hash, and its document."""

    def __init__(self, blobs: pa.Table, buckets: int, share: float = 1.0):
        begins("scoring")
        self.buckets, self.share = buckets, share
        table = pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in blobs.column("docs").to_pylist()])
        split = Split(table.column("text"))
        self.ids = table.column("doc_id").to_pylist()
        lengths = split.ends - split.starts + 1
        self.lengths, self.ends = lengths, np.cumsum(lengths) - 1
        self.doc = np.repeat(np.arange(len(lengths)), lengths)
        h = np.full(int(lengths.sum()), END)
        body = np.ones(len(h), bool)
        body[self.ends] = False
        h[body] = split.h
        self.held = np.array([i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i in self.ids])
        self.training = ~self.held & np.array([i is not None for i in self.ids])
        self.train = self.training[self.doc]
        self.first = self.ends - lengths + 1
        self.hashes, kind = distinct(h)
        self.kind = kind.astype(np.int32)

    def know(self, replies: pa.Table) -> None:
        """Takes in the counts that the word buckets sent, in the order of the hashes."""
        answers, totals = _by_bucket(replies)
        names = [loose(x) for x in answers.column("names").to_pylist()]
        self.name = np.concatenate(names)
        self.count = np.concatenate([fallen(n, x) for n, x in zip(names, answers.column("counts").to_pylist(), strict=True)])
        self.n, self.v = totals.column("n")[0].as_py(), totals.column("v")[0].as_py()
        self.root = np.log10((self.count + 0.1) / (self.n + 0.1 * (self.v + 1)))
        self.p = (10**self.root)[self.kind]
        # Words that stand twice or more, by their numbers, and the place of each among them.
        often = np.flatnonzero(self.count >= 2)
        self.by_name = often[np.argsort(self.name[often])]
        self.rank = np.full(len(self.name), -1)
        self.rank[self.by_name] = np.arange(len(often))

    def contexts(self, depth: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of its context among the chunk's frequent ones, or -1, for each token; these contexts' hashes; their training counts), by bucket and
        key.

        Of length 1: the token before, or the start. Longer ones: the pair asked for at the token before, so known to be frequent. A bucket knows a
        context of one word by the word's number, the start by 0, one of two by both numbers, and longer ones by their hash.
        """
        before = np.empty(len(self.kind), np.int32)
        if depth == 1:
            before[1:] = self.kind[:-1]
            before[self.first] = len(self.hashes)  # the start; as many as there are training documents, which is how often END stands
            counts = np.append(self.count, self.count[np.searchsorted(self.hashes, END)])
            often = np.flatnonzero(counts >= least)
            hashes = np.append(self.hashes, START)[often]
            keys = np.append(self.name + 1, 0)[often].astype(np.uint64)
        else:
            before[1:] = self.pair[:-1]
            before[self.first] = -1
            counts = self.pair_count
            often = np.flatnonzero(counts >= least)
            word = self.pair_word[often]
            hashes = mixed(self.pair_context[often] * ODD + self.hashes[word])
            keys = hashes
            if self.keyed(depth):
                names, above = self.name[word].astype(np.uint64), self.pair_key[often]
                if max(above.max(initial=0), names.max(initial=0)) >> np.uint64(NAME_BITS):
                    raise ValueError(f"with {self.v} words a word's number should have {NAME_BITS} bits")
                keys = above << np.uint64(NAME_BITS) | names
        order = np.lexsort((keys, bucket_of(hashes, self.buckets)))
        self.context_key = keys[order]
        rank = np.full(len(counts) + 1, -1, np.int32)  # the last stands for no context
        rank[often[order]] = np.arange(len(order))
        return rank[before], hashes[order], counts[often[order]]

    def keyed(self, depth: int) -> bool:
        """Whether contexts of this length are known by their words' numbers."""
        return depth == 1 or depth == 2 and self.v < KEYED_WORDS

    def ask(self, depth: int, least: int, send: bool = True) -> None:
        """The distinct pairs of a frequent context and a word seen twice or more: those dealt by context, then the hot ones, in cell order. What
        only the buckets need is left out unless it is to be sent."""
        at, hashes, counts = self.contexts(depth, least)
        self.used = np.flatnonzero(at >= 0)
        wanted = self.used[(self.rank >= 0)[self.kind[self.used]]]
        if depth > 1:  # what stands twice after a context stands twice after its suffix
            wanted = wanted[(self.pair_count >= 2)[self.pair[wanted]]]
        size = max(len(self.by_name), 1)
        # Pairs of a context stand by their words' numbers; hot ones after the others, by bucket of the pair.
        pairs, inverse = distinct_below(at[wanted].astype(np.int64) * size + self.rank[self.kind[wanted]], len(counts) * size)
        context = pairs // size
        word = self.by_name[pairs - context * size]
        often = counts > self.share * self.n
        hot = often[context]
        last = np.flatnonzero(hot)
        spread = mixed(hashes[context[last]] ^ mixed(self.hashes[word[last]]))
        by_bucket = np.argsort(bucket_of(spread, self.buckets), kind="stable")
        order = np.concatenate([np.flatnonzero(~hot), last[by_bucket]])
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        self.at, self.context_hash, self.context_count = at, hashes, counts
        self.ask_context, self.ask_word, self.hot, self.spread = context[order], word[order], hot[order], spread[by_bucket]
        # Contexts whose next words here are all rare are asked for too: they leave less mass to the suffix if they are states.
        met = np.zeros(len(hashes), bool)
        met[at[self.used]] = True
        self.cold_contexts, self.hot_contexts = np.flatnonzero(met & ~often), np.flatnonzero(met & often)
        self.pair = np.full(len(self.kind), -1, np.int32)
        own = place[inverse]
        self.pair[wanted] = own
        if send:
            self.ask_own = np.bincount(own[self.train[wanted]], minlength=len(order))
            suffix = np.zeros(len(order))
            suffix[own] = self.p[wanted]
            self.ask_bits = np.minimum(np.round(-8 * np.log2(np.maximum(suffix, 1e-300))), 255).astype(np.int64)

    def take(self, replies: pa.Table, least: int, bits: float) -> None:
        """Takes in the answers to ask() and predicts each token from the context, where that is a state."""
        answers, totals = _by_bucket(replies)
        count = np.concatenate([_joined(answers, "pairs", loose), _joined(answers, "hot_pairs", loose)])
        rest = np.zeros(len(self.context_hash))  # mass left to the suffix; 0: no state
        cold = _joined(answers, "rest", _rests, np.empty((0, 2), np.int64))
        rest[self.cold_contexts] = np.where(cold[:, 1] > 0, (cold[:, 0] + DISCOUNT * cold[:, 1]) / np.maximum(self.context_count[self.cold_contexts], 1), 0)
        of = {x["h"]: x for x in totals.column("hot")[0].as_py() or ()}
        for k in self.hot_contexts.tolist():
            if (x := of.get(int(self.context_key[k].view(np.int64)))) is not None:
                rest[k] = float(_rest(*(np.array([x[c]]) for c in "nme"), np.array([x["g"] / PARTS]), bits)[0])
        left = rest[self.at[self.used]]
        state = self.used[left > 0]
        kept = np.where(count >= 2, (count - DISCOUNT) / np.maximum(self.context_count[self.ask_context], 1), 0)
        self.p[state] = np.append(kept, 0)[self.pair[state]] + left[left > 0] * self.p[state]
        self.pair_count, self.pair_word = count, self.ask_word
        self.pair_context, self.pair_key = self.context_hash[self.ask_context], self.context_key[self.ask_context]


def _rests(data: bytes) -> np.ndarray:
    """(occurrences before other symbols, kept symbols) of each context; 0 kept symbols: no state."""
    return np.stack(list(map(loose, _blocks(data))), axis=1)


def _rest(n: np.ndarray, m: np.ndarray, e: np.ndarray, g: np.ndarray, bits: float) -> np.ndarray:
    """The mass that a context leaves to its suffix, or 0 if it is no state. n: its occurrences, m: those before one of its e kept symbols, g: the
    bits these save. What comes before other symbols costs the bits of the mass left."""
    left = (n - m + DISCOUNT * e) / np.maximum(n, 1)
    gain = g + (n - m) * np.log2(np.maximum(left, 1e-12))
    return np.where((gain > bits) & (e > 0), left, 0.0)


def _gains(count: np.ndarray, n: np.ndarray, eighths: np.ndarray) -> np.ndarray:
    """The bits saved over a kept symbol's occurrences, each predicted from the others."""
    p = np.maximum(count - 1 - DISCOUNT, 0.05) / np.maximum(n - 1, 1)
    return count * np.maximum(np.log2(p) + eighths / 8, -4)


def _cells(chunk: int, found: np.ndarray, schema: pa.Schema, of) -> pa.Table:
    """A row for each of the buckets for which there is anything."""
    rows = [(b, chunk, *of(b)) for b in np.unique(found).tolist()]
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


#: In a reply, the bucket of the row for all chunks.
ALL = -1
_WORD_CELL = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("words", pa.binary()), ("counts", pa.binary())])
_WORD_REPLY = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("counts", pa.binary()), ("names", pa.binary())])
_WORD_TOTALS = pa.schema([("n", pa.int64()), ("v", pa.int64())])
_PAIR_COLUMNS = ("contexts", "totals", "sizes", "words", "counts", "bits", "hot_contexts", "hot_totals", "hot_sizes", "hot_words", "hot_counts", "hot_bits")
_PAIR_CELL = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), *[(c, pa.binary()) for c in _PAIR_COLUMNS]])
_PAIR_REPLY = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), *[(c, pa.binary()) for c in ("pairs", "rest", "hot_pairs")]])
_HOT_STATS = pa.schema([(c, pa.int64()) for c in "hnmeg"])
_HOT = "array<struct<h: long, n: long, m: long, e: long, g: long>>"


def _spec(schema: pa.Schema) -> str:
    kinds = {pa.binary(): "binary", pa.int32(): "int", pa.float64(): "double", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {kinds.get(f.type, 'long')}" for f in schema)


def _ask_words(buckets: int):
    def run(key, table):
        t = _Tokens(table, buckets)
        own = np.bincount(t.kind[t.train], minlength=len(t.hashes))
        at = bucket_of(t.hashes, buckets)
        edges = np.searchsorted(at, np.arange(buckets + 1))
        return _cells(key[0].as_py(), at, _WORD_CELL, lambda b: (pack(t.hashes[edges[b] : edges[b + 1]]), tight(own[edges[b] : edges[b + 1]])))

    return run


def _count_words(buckets: int):
    """Counts of a bucket's words, and numbers for those that stand twice or more, by falling count."""

    def run(key, table):
        h = [unpack(x) for x in table.column("words").to_pylist()]
        c = [loose(x) for x in table.column("counts").to_pylist()]
        known, at = distinct(np.concatenate(h))
        total = np.bincount(at, np.concatenate(c), len(known)).astype(np.int64)
        often = np.flatnonzero(total >= 2)
        names = np.zeros(len(total), np.int64)
        names[often[np.argsort(-total[often], kind="stable")]] = np.arange(len(often)) * buckets + key[0].as_py()
        places = np.split(at, np.cumsum([len(x) for x in h])[:-1])
        answers = [pa.array(own, pa.binary()) for own in ([falling(names[x], total[x]) for x in places], [tight(names[x]) for x in places])]
        return pa.table([table.column("chunk"), table.column("bucket"), *answers], schema=_WORD_REPLY)

    return run


def _word_totals(key, table):
    """The training tokens and the distinct words among them of a bucket: apart from its answers, of which Spark would make all again for these."""
    c = np.concatenate([loose(x) for x in table.column("counts").to_pylist()])
    h = np.concatenate([unpack(x) for x in table.column("words").to_pylist()])
    h = np.sort(h[c > 0])
    return pa.table([pa.array([int(c.sum())]), pa.array([len(h) - int((h[1:] == h[:-1]).sum())])], schema=_WORD_TOTALS)


def _ready(table: pa.Table, replies: list[pa.Table], least: int, bits: float, buckets: int, share: float) -> _Tokens:
    t = _Tokens(table, buckets, share)
    t.know(replies[0])
    for depth, found in enumerate(replies[1:], 1):
        t.ask(depth, least, send=False)
        t.take(found, least, bits)
    return t


def _split(replies: pa.Table, depth: int) -> list[pa.Table]:
    """The replies of each round: cogroup takes one table, so rounds come as rows of it."""
    return [replies.filter(pa.compute.equal(replies.column("round"), k)) for k in range(depth)]


def _ask_pairs(buckets: int, depth: int, least: int, bits: float, share: float):
    def run(key, table, replies):
        if not table.num_rows:
            return _PAIR_CELL.empty_table()
        t = _ready(table, _split(replies, depth), least, bits, buckets, share)
        t.ask(depth, least)
        cold = int((~t.hot).sum())
        asked = bucket_of(t.context_hash[t.cold_contexts], buckets), bucket_of(t.spread, buckets)  # both rise
        edges = np.searchsorted(bucket_of(t.context_hash[t.ask_context[:cold]], buckets), np.arange(buckets + 1))
        context_edges = np.searchsorted(asked[0], np.arange(buckets + 1))
        hot_edges = cold + np.searchsorted(asked[1], np.arange(buckets + 1))
        names = t.name[t.ask_word]

        def pairs(contexts, s, e):
            size = np.bincount(np.searchsorted(contexts, t.ask_context[s:e]), minlength=len(contexts))
            own = by_word(names[s:e], t.ask_bits[s:e]) if depth == 1 else tight(t.ask_bits[s:e])
            keys = t.context_key[contexts]
            coded = b"a" + tight(keys) if len(keys) > 1 and (keys[1:] <= keys[:-1]).any() else b"k" + pack_keys(keys) if t.keyed(depth) else b"h" + pack(keys)
            return coded, tight(t.context_count[contexts]), tight(size), rising(names[s:e], size), tight(t.ask_own[s:e]), own

        def of(b):
            s, e = hot_edges[b], hot_edges[b + 1]
            return *pairs(t.cold_contexts[context_edges[b] : context_edges[b + 1]], edges[b], edges[b + 1]), *pairs(np.unique(t.ask_context[s:e]), s, e)

        return _cells(key[0].as_py(), np.concatenate(asked), _PAIR_CELL, of)

    return run


def _summed(h, size, n, w, c, q):
    """Distinct (context, word) over pairs of which each entry of h, n has as many as size says, sorted by context and word: their contexts, counts,
    totals and bits, and the place of each pair among them."""
    known, at = np.unique(h, return_inverse=True)
    most = int(w.max(initial=0)) + 1
    if len(known) * most >> 63:
        w_known, w_at = np.unique(w, return_inverse=True)
        most = len(w_known)
    else:
        w_at = w
    pairs, back = distinct_below(np.repeat(at, size) * most + w_at, len(known) * most)
    count = np.bincount(back, c, len(pairs)).astype(np.int64)
    nd, qd = np.empty(len(pairs), np.int64), np.empty(len(pairs), np.int64)
    nd[back], qd[back] = np.repeat(n, size), q  # equal for equal pairs
    return known[pairs // most], count, nd, qd, back


def _by_context(h, count, n, q):
    """(contexts, n, m, e, g) over distinct pairs sorted by context."""
    at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
    if not len(at):
        none = np.empty(0, np.int64)
        return h, none, none, none, none.astype(float)
    kept = count >= 2
    add = lambda x: np.add.reduceat(np.where(kept, x, 0), at)
    return h[at], n[at], add(count), add(np.ones(len(h), np.int64)), add(_gains(count, n, q))


def _asked(table: pa.Table, depth: int, prefix: str):
    """The pairs of all chunks in a row: (each chunk's contexts, where its pairs end, what _summed() takes)."""
    column = lambda name, of: [of(x) for x in table.column(prefix + name).to_pylist()]
    read = {b"k": unpack_keys, b"h": unpack, b"a": lambda x: loose(x).view(np.uint64)}
    contexts = column("contexts", lambda x: read[x[:1]](x[1:]))
    sizes = column("sizes", loose)
    w = [risen(x, n) for x, n in zip(table.column(prefix + "words").to_pylist(), sizes, strict=True)]
    bits = table.column(prefix + "bits").to_pylist()
    q = [of_words(n, x) for n, x in zip(w, bits, strict=True)] if depth == 1 else list(map(loose, bits))
    return contexts, np.cumsum([len(x) for x in w]), tuple(map(np.concatenate, (contexts, sizes, column("totals", loose), w, column("counts", loose), q)))


def _count_pairs(bits: float, depth: int):
    def run(key, table):
        contexts, ends, asked = _asked(table, depth, "")
        hd, count, nd, qd, back = _summed(*asked)
        known, total, m, e, g = _by_context(hd, count, nd, qd)
        e = np.where(_rest(total, m, e, g, bits) > 0, e, 0)  # 0: no state
        count = np.where(count >= 2, count, 0)
        pairs = [tight(count[x]) for x in np.split(back, ends[:-1])]
        known, total, m, e = np.append(known, np.uint64((1 << 64) - 1)), np.append(total, 0), np.append(m, 0), np.append(e, 0)

        def rest_of(x):
            at = np.searchsorted(known, x)
            met = known[at] == x
            return b"".join(_block(tight(np.where(met, y[at], 0))) for y in (total - m, e))

        rests = [rest_of(x) for x in contexts]

        _, ends, asked = _asked(table, depth, "hot_")
        _, count, _, _, back = _summed(*asked)
        count = np.where(count >= 2, count, 0)
        hot_pairs = [tight(count[x]) for x in np.split(back, ends[:-1])]
        return pa.table([table.column("chunk"), table.column("bucket"), *(pa.array(x, pa.binary()) for x in (pairs, rests, hot_pairs))], schema=_PAIR_REPLY)

    return run


def _hot_stats(depth: int):
    """A bucket's part of the statistics of hot contexts: apart from its answers, of which Spark would make all again for these."""

    def run(key, table):
        h, n, m, e, g = _by_context(*_summed(*_asked(table, depth, "hot_")[2])[:4])
        return pa.table([pa.array(h.view(np.int64)), *map(pa.array, (n, m, e, np.round(g * PARTS).astype(np.int64)))], schema=_HOT_STATS)

    return run


_RESULT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def scored(docs: DataFrame, depth: int = 2, least: int = 16, bits: float = 8.0, mb: float = 12.0) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of docs(doc_id, text).

    Texts are lower-cased (A-Z); tokens are their words and one end. held_out: crc32 of the id as text is 0 modulo 10; all other rows train. A
    null id is neither held out nor trained on. Null and empty texts are the end alone. Repeated rows train and are scored as often as they stand.
    Without training rows nothing is known, and the root gives all its mass to unknown words. No rows, no result.

    All is one plan, in which the exchange of texts by chunk is made once and used by each round.
    """
    spark = docs.sparkSession
    size = sized(docs)
    buckets, chunks = buckets_for(size, spark), max(1, math.ceil(size / (mb * 1e6)))
    share = max(LEAST_SHARE, min(MOST_SHARE, 1 / buckets))
    to = tasks(spark, size)
    by_chunk = _dealt(docs, chunks, to).groupBy("chunk")

    def to_every(row: DataFrame) -> DataFrame:
        """One row, of totals or of the hot contexts (1 / LEAST_SHARE at most, 40 bytes each), to each chunk, from as many tasks as texts are dealt to."""
        return spark.range(0, chunks, 1, to).select(F.col("id").cast("int").alias("chunk"), F.lit(0).alias("_one")).join(F.broadcast(row.withColumn("_one", F.lit(0))), "_one").drop("_one")

    def dealt(found: DataFrame, k: int, *columns) -> DataFrame:
        """Replies of a round as rows of one form, dealt as the texts are: a union of such parts needs no further exchange."""
        given = dict(columns)
        kinds = {"counts": "binary", "names": "binary", "n": "long", "v": "long", "pairs": "binary", "rest": "binary", "hot_pairs": "binary", "hot": _HOT}
        return found.repartition(to, "chunk").select("chunk", given["bucket"].alias("bucket"), F.lit(k).alias("round"), *[given.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()])

    def named(*names):
        return [(c, F.col(c)) for c in names]

    cells = by_chunk.applyInArrow(_ask_words(buckets), _spec(_WORD_CELL)).groupBy("bucket")
    totals = cells.applyInArrow(_word_totals, _spec(_WORD_TOTALS)).agg(F.sum("n").alias("n"), F.sum("v").alias("v")).transform(to_every)
    counted = cells.applyInArrow(_count_words(buckets), _spec(_WORD_REPLY))
    replies = dealt(counted, 0, *named("bucket", "counts", "names")).union(dealt(totals, 0, ("bucket", F.lit(ALL)), *named("n", "v")))
    for k in range(1, depth + 1):
        cells = by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(_ask_pairs(buckets, k, least, bits, share), _spec(_PAIR_CELL)).groupBy("bucket")
        counted = cells.applyInArrow(_count_pairs(bits, k), _spec(_PAIR_REPLY))
        sums = cells.applyInArrow(_hot_stats(k), _spec(_HOT_STATS)).groupBy("h").agg(F.max("n").alias("n"), F.sum("m").alias("m"), F.sum("e").alias("e"), F.sum("g").alias("g"))
        hot = sums.agg(F.collect_list(F.struct("h", "n", "m", "e", "g")).alias("hot")).transform(to_every)
        replies = replies.union(dealt(counted, k, *named("bucket", "pairs", "rest", "hot_pairs"))).union(dealt(hot, k, ("bucket", F.lit(ALL)), *named("hot")))

    def finish(key, table, known):
        if not table.num_rows:
            return _RESULT.empty_table()
        t = _ready(table, _split(known, depth + 1), least, bits, buckets, share)
        size = len(t.ids)
        add = lambda x: np.bincount(t.doc, x, size)
        columns = [t.ids, t.held, t.lengths, add(t.count[t.kind] > 0).astype(np.int64), np.full(size, t.n), add(t.root[t.kind]), add(np.log10(t.p))]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _RESULT, strict=True)], schema=_RESULT)

    return by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(finish, _spec(_RESULT))
