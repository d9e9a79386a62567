"""Removal of passages that an earlier document has: recurring passages, compiled into Aho-Corasick automata, located in all documents.

1. Candidates. A window is ``window`` consecutive words. Its anchor is the least hash of the runs of ``anchor`` words in it, so equal windows
   have equal anchors, and neighbours mostly share theirs: few anchors stand for all windows. Anchors found in two documents or more recur.
2. Confirmation. Only windows with a recurring anchor are hashed whole and exchanged; the smallest document of each is its owner.
3. The passages, runs of windows with one owner, are cut out of a text that has them and sent to the chunks that need them. A chunk sends a
   window to SERVED others at most, which send it on, so that a passage in a third of all chunks is no one chunk's load.
4. A shard of the automata holds the passages of one chunk of documents: every chunk compiles those sent to it and its own documents', and
   streams all its documents through. A hit is compared word for word in both directions, so no hash decides a removal.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from eventloom.llm.cells import Chunk, Split, among, bucket_of, buckets_for, chunked, pack, raw, sized, slices, unpack, unraw
from eventloom.llm.common import mixed, shingle_hashes

WINDOW, ANCHOR = 13, 6
#: Chunks to which one chunk sends a window.
SERVED = 64


def _anchors(c: Chunk, starts: np.ndarray) -> np.ndarray:
    """The 48-bit anchor of the window at each start, in the upper bits."""
    low = c.hashes(ANCHOR)
    width, have = WINDOW - ANCHOR + 1, 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    return mixed(low[starts]) & ~np.uint64(0xFFFF)


def _edges(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _send_anchors(buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("one", pa.binary()), ("many", pa.binary())])

    def run(key, table):
        c = Chunk(table)
        starts = c.windows(WINDOW)
        if not len(starts):
            return schema.empty_table()
        v, d = _anchors(c, starts), c.doc[starts]
        new = _edges(v, d)
        rank = np.unique(c.ids, return_inverse=True)[1]
        v, d = v[new], rank[d[new]].astype(np.uint64)
        if len(c.ids) <= 1 << 16:  # the document's number stands in the free bits
            v = np.sort(v | d)
            d, v = v & np.uint64(0xFFFF), v >> np.uint64(16)
        else:
            order = np.lexsort((d, v))
            d, v = d[order], v[order] >> np.uint64(16)
        first = _edges(v)
        many = d[first] != d[np.append(first[1:], len(d)) - 1]
        v = v[first]
        rows = [(b, pack(v[s:e][~many[s:e]]), pack(v[s:e][many[s:e]])) for b, s, e in slices(bucket_of(v << np.uint64(16), buckets))]
        return pa.table([pa.array([r[0] for r in rows], pa.int32()), pa.array([key[0].as_py()] * len(rows), pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], schema=schema)

    return run


def _recurring(table: pa.Table) -> pa.Table:
    """Of a bucket: the anchors of two documents or more, for each chunk that has them."""
    v, c, m = [], [], []
    for chunk, one, many in zip(*(table.column(x).to_pylist() for x in ("chunk", "one", "many")), strict=True):
        for data, flag in ((unpack(one), 0), (unpack(many), 2)):
            v.append(data)
            c.append(np.full(len(data), chunk, np.int32))
            m.append(np.full(len(data), flag, np.int8))
    v, c, m = np.concatenate(v), np.concatenate(c), np.concatenate(m)
    order = np.argsort(v, kind="stable")
    v, c, m = v[order], c[order], m[order]
    edges = _edges(v)
    sizes = np.diff(np.append(edges, len(v)))
    recur = np.repeat((sizes > 1) | (np.maximum.reduceat(m, edges) > 1), sizes) if len(v) else np.empty(0, bool)
    v, c = v[recur], c[recur]
    order = np.argsort(c, kind="stable")
    v, c = v[order], c[order]
    rows = [(k, pack(v[s:e])) for k, s, e in slices(c)]
    return pa.table({"chunk": pa.array([r[0] for r in rows], pa.int32()), "anchors": pa.array([r[1] for r in rows], pa.binary())})


def _send_windows(buckets: int):
    """Of a chunk with its recurring anchors: the windows that have them, with their smallest document."""
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("windows", pa.binary()), ("docs", pa.binary())])

    def run(key, table, answers):
        if not table.num_rows or not answers.num_rows:
            return schema.empty_table()
        c = Chunk(table)
        starts = c.windows(WINDOW)
        wanted = np.sort(np.concatenate([unpack(x) for x in answers.column("anchors").to_pylist()]))
        v = _anchors(c, starts)
        runs = _edges(v)
        starts = starts[np.repeat(among(v[runs], wanted << np.uint64(16)), np.diff(np.append(runs, len(v))))]
        h, d = c.hashes(WINDOW)[starts], c.ids[c.doc[starts]]
        order = np.argsort(h)
        h, d = h[order], d[order]
        first = _edges(h)
        h, d = h[first], np.minimum.reduceat(d, first) if len(d) else d
        rows = [(b, h[s:e].astype("<u8").tobytes(), raw(d[s:e])) for b, s, e in slices(bucket_of(h, buckets))]
        return pa.table([pa.array([r[0] for r in rows], pa.int32()), pa.array([key[0].as_py()] * len(rows), pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], schema=schema)

    return run


def _requests(table: pa.Table) -> pa.Table:
    """Of a bucket: for each chunk the windows that it has to send, to which chunks, and their owners.

    A window's chunks, ordered by their smallest document with it, are a tree: each but the first, the owner's, gets it from one before it.
    """
    h, d, c = [], [], []
    for chunk, windows, docs in zip(*(table.column(x).to_pylist() for x in ("chunk", "windows", "docs")), strict=True):
        h.append(np.frombuffer(windows, "<u8"))
        d.append(unraw(docs))
        c.append(np.full(len(h[-1]), chunk, np.int64))
    h, d, c = np.concatenate(h), np.concatenate(d), np.concatenate(c)
    order = np.lexsort((c, d, h))
    h, d, c = h[order], d[order], c[order]
    edges = _edges(h)
    sizes = np.diff(np.append(edges, len(h)))
    first = np.repeat(edges, sizes)
    place = np.arange(len(h)) - first
    need = np.flatnonzero(d != d[first])
    sender = c[first[need] + (place[need] - 1) // SERVED]
    h, c, owner = h[need], c[need], d[first[need]]
    order = np.lexsort((h, c, sender))
    h, c, owner, sender = h[order], c[order], owner[order], sender[order]
    rows = [(k, h[s:e].tobytes(), raw(c[s:e]), raw(owner[s:e])) for k, s, e in slices(sender)]
    names = ("windows", "targets", "owners")
    return pa.table({"chunk": pa.array([r[0] for r in rows], pa.int32()), **{n: pa.array([r[i] for r in rows], pa.binary()) for i, n in enumerate(names, 1)}})


def _runs(c: Chunk, starts: np.ndarray):
    """(first word, number of words) of the runs of windows at sorted starts, each within a document."""
    if not len(starts):
        return
    breaks = np.flatnonzero((np.diff(starts) != 1) | (np.diff(c.doc[starts]) != 0)) + 1
    first, last = np.concatenate([[0], breaks]), np.append(breaks, len(starts)) - 1
    yield from zip(starts[first].tolist(), (starts[last] - starts[first] + WINDOW).tolist(), strict=True)


def _places(c: Chunk, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of sorted hashes in a chunk, sorted by hash, then by document and place: (hashes, documents' ids, starts)."""
    starts = c.windows(WINDOW)
    h = c.hashes(WINDOW)[starts]
    met = among(h, wanted)
    h, starts = h[met], starts[met]
    d = c.ids[c.doc[starts]]
    order = np.lexsort((starts, d, h))
    return h[order], d[order], starts[order]


def _send_passages(key, table: pa.Table, answers: pa.Table) -> pa.Table:
    """Of a chunk: the passages that it has to send, in its own words."""
    schema = pa.schema([("chunk", pa.int32()), ("owner", pa.int64()), ("passage", pa.binary())])
    if not table.num_rows or not answers.num_rows:
        return schema.empty_table()
    c = Chunk(table)
    wanted = np.concatenate([np.frombuffer(x, "<u8") for x in answers.column("windows").to_pylist()])
    target, owner = (np.concatenate([unraw(x) for x in answers.column(n).to_pylist()]) for n in ("targets", "owners"))
    h, _, starts = _places(c, np.unique(wanted))
    first = _edges(h)
    at = starts[first][np.searchsorted(h[first], wanted)]
    order = np.lexsort((at, owner, target))
    at, target, owner = at[order], target[order], owner[order]
    edges = np.append(_edges(target, owner), len(at)).tolist()
    rows = [(int(target[s]), int(owner[s]), c.said(w, n)) for s, e in zip(edges, edges[1:]) for w, n in _runs(c, at[s:e])]
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _own_passages(c: Chunk):
    """(owner, first word, number of words) of the passages that a document of this chunk has first and a later one here has too."""
    h = np.sort(c.hashes(WINDOW)[c.windows(WINDOW)])
    h, d, starts = _places(c, np.unique(h[1:][h[1:] == h[:-1]]))
    if not len(h):
        return
    first = _edges(h)
    twice = d[first] != d[np.append(first[1:], len(d)) - 1]
    for w, n in _runs(c, np.sort(starts[first[twice]])):
        yield int(c.ids[c.doc[w]]), w, n


def _spelled(numbers: np.ndarray, digits: int) -> str:
    """Each number as ``digits`` letters out of 64. A node of an automaton looks through its edges one by one, so they must be few."""
    out = np.empty((len(numbers), digits), np.uint8)
    for k in range(digits):
        out[:, k] = (numbers >> (6 * (digits - 1 - k))) & 63
    return (out + 48).tobytes().decode("ascii")


def _patterns(flat: np.ndarray, at: np.ndarray, part: int) -> np.ndarray:
    """Where in ``flat`` a pattern begins, once each: every window at ``at`` has its rarest run of ``part`` words for one, rare among these windows."""
    grams = shingle_hashes(mixed(flat.astype(np.uint64)), part)
    width = WINDOW - part + 1
    inside = np.unique((at[:, None] + np.arange(width)).ravel())
    found, number, counts = np.unique(grams[inside], return_inverse=True, return_counts=True)
    rank = np.empty(len(found), np.int64)
    rank[np.lexsort((found, counts))] = np.arange(len(found))
    ranks = np.zeros(len(grams), np.int64)
    ranks[inside] = rank[number]
    best = np.min([ranks[at + j] for j in range(width)], axis=0)
    first = np.full(len(found), -1, np.int64)
    first[rank[number]] = inside
    return first[np.unique(best)]


def covered(docs: list[np.ndarray], ids: np.ndarray, passages: list[tuple[int, np.ndarray]], said=None) -> list[np.ndarray | None]:
    """For each document, which of its words a window of a passage with a smaller id covers; None: none. Words are numbers, equal if the words are,
    or, with ``said``, at least likely so: said(i, s, k, o, n) is then the words themselves, of document i from s and of passage k from o.

    Of equal windows that of the smallest id stands for all. The automaton holds a run of about half a window for each, its rarest. Around a hit lie
    no more windows than a window has such runs; each has one place in the passages at most, which it is compared with, neighbours along one
    passage together. So a hit costs the same however often its words come again.
    """
    part = (WINDOW + 1) // 2
    found: list[np.ndarray | None] = [None] * len(docs)
    sizes = np.array([len(p) for _, p in passages], np.int64)
    if not (sizes >= WINDOW).any():
        return found
    flat = np.concatenate([p for _, p in passages]).astype(np.int64)
    of = np.repeat(np.arange(len(passages)), sizes)
    begins = np.cumsum(sizes) - sizes
    owners = np.array([int(o) for o, _ in passages], np.int64)
    at = np.flatnonzero(np.arange(len(flat)) + WINDOW <= (begins + sizes)[of])
    h = shingle_hashes(mixed(flat.astype(np.uint64)), WINDOW)[at]
    order = np.lexsort((at, owners[of[at]], h))
    at = at[order[_edges(h[order])]]
    h = h[order[_edges(h[order])]]
    digits = max(1, -(-int(flat.max()).bit_length() // 6))
    spelled = _spelled(flat, digits)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for o in _patterns(flat, at, part).tolist():
        automaton.add_word(spelled[o * digits : (o + part) * digits])
    del spelled
    automaton.make_automaton()
    for i, doc in enumerate(docs):
        if len(doc) < WINDOW or not doc.any():
            continue
        hits = np.array([end for end, _ in automaton.iter(_spelled(doc, digits))], np.int64) + 1
        hits = hits[hits % digits == 0] // digits - part  # others end within a word
        if not len(hits):
            continue
        near = np.zeros(len(doc) - WINDOW + 1, bool)
        for j in range(WINDOW - part + 1):
            start = hits - j
            near[start[(start >= 0) & (start < len(near))]] = True
        s = np.flatnonzero(near)
        own = shingle_hashes(mixed(doc.astype(np.uint64)), WINDOW)[s]
        place = np.minimum(np.searchsorted(h, own), len(h) - 1)
        met = (h[place] == own) & (owners[of[at[place]]] < int(ids[i]))
        s, w = s[met], at[place[met]]
        for j in range(WINDOW):
            same = doc[s + j] == flat[w + j]
            s, w = s[same], w[same]
        if not len(s):
            continue
        mark = np.zeros(len(doc), bool)
        first = np.flatnonzero(np.append(True, (np.diff(s) != 1) | (np.diff(w) != 1)))
        for x, y in zip(first.tolist(), np.append(first[1:], len(s)).tolist(), strict=True):
            start, n = int(s[x]), y - x + WINDOW - 1
            breaks = [-1, n]
            if said is not None:
                k = int(of[w[x]])
                ours, theirs = said(i, start, k, int(w[x] - begins[k]), n)
                if ours != theirs:
                    breaks = [-1, *(z for z, (a, b) in enumerate(zip(ours, theirs, strict=True)) if a != b), n]
            for a, b in zip(breaks, breaks[1:]):
                if b - a > WINDOW:
                    mark[start + a + 1 : start + b] = True
        found[i] = mark if mark.any() else None
    return found


def _marks(c: Chunk, sent: pa.Table) -> list[np.ndarray | None]:
    """Which words of each document go."""
    own = list(_own_passages(c))
    others = Split(sent.column("passage"))
    places = [(c, w, n) for _, w, n in own] + [(others, int(s), int(e - s)) for s, e in zip(others.starts, others.ends, strict=True)]
    if not places:
        return [None] * len(c.ids)
    # Words of passages are numbered from 1; all other words of documents are 0.
    known = np.unique(np.concatenate([others.h, *(c.h[w : w + n] for _, w, n in own)]))
    met = np.flatnonzero(among(c.h, known))
    numbers = np.zeros(len(c.h), np.int64)
    numbers[met] = np.searchsorted(known, c.h[met]) + 1
    passages = [(owner, numbers[w : w + n]) for owner, w, n in own]
    theirs = np.searchsorted(known, others.h) + 1
    passages += [(owner, theirs[s:e]) for owner, s, e in zip(sent.column("owner").to_pylist(), others.starts, others.ends, strict=True)]
    docs = [numbers[s:s] if n else numbers[s:e] for s, e, n in zip(c.starts.tolist(), c.ends.tolist(), c.null.tolist(), strict=True)]

    def said(i, s, k, o, n):
        source, first, _ = places[k]
        return c.said(int(c.starts[i]) + s, n).split(), source.said(first + o, n).split()

    return covered(docs, c.ids, passages, said)


def _kept(c: Chunk, i: int, mark: np.ndarray | None) -> bytes:
    """The kept words of a document, joined by single spaces."""
    s, e = int(c.starts[i]), int(c.ends[i])
    if s == e or (mark is not None and mark.all()):
        return b""
    text = c.said(s, e - s)
    if mark is None:
        return text if text.count(b" ") == e - s - 1 == int(c.space[c.start[s] : c.end[e - 1]].sum()) else b" ".join(text.split())
    return b" ".join([w for w, gone in zip(text.split(), mark.tolist(), strict=True) if not gone])


def _without(c: Chunk, i: int, mark: np.ndarray) -> bytes:
    """The text of a document without the marked words and the white space after each."""
    own, stop = c.start[c.starts[i] : c.ends[i]], c.bounds[i + 1]
    keep = np.concatenate([np.ones(own[0] - c.bounds[i], bool), np.repeat(~mark, np.diff(np.append(own, stop)))])
    return c.data[c.bounds[i] : stop][keep].tobytes()


def deduplicated(docs: DataFrame, mb: float = 2.0) -> DataFrame:
    """docs with ``text`` less the removed words, and with (n_words, n_removed, kept_sha256) after its own columns.

    A word goes if a window of ``WINDOW`` words over it has the same words as one that starts in a document with a smaller doc_id, judged on
    the input. A text loses its removed words and the white space after each; others stay byte for byte. kept_sha256: of the kept words,
    joined by single spaces. Null and empty texts stay and have no words; rows with a null doc_id lose nothing and are no one's earlier
    document; repeated rows of a doc_id are one document and lose the same. No rows, no result. Columns of docs named as the added ones, or
    ``chunk``, give way.

    All is one plan, in which the exchange of texts by chunk is made once and used by each of its four readers.
    """
    docs = docs.drop("n_words", "n_removed", "kept_sha256", "chunk")
    size = sized(docs)
    buckets = buckets_for(size, docs.sparkSession)
    by_chunk = chunked(docs, size, mb).groupBy("chunk")
    anchors = by_chunk.applyInArrow(_send_anchors(buckets), "bucket int, chunk int, one binary, many binary")
    recurring = anchors.groupBy("bucket").applyInArrow(_recurring, "chunk int, anchors binary")
    windows = by_chunk.cogroup(recurring.groupBy("chunk")).applyInArrow(_send_windows(buckets), "bucket int, chunk int, windows binary, docs binary")
    requests = windows.groupBy("bucket").applyInArrow(_requests, "chunk int, windows binary, targets binary, owners binary")
    passages = by_chunk.cogroup(requests.groupBy("chunk")).applyInArrow(_send_passages, "chunk int, owner long, passage binary")

    names = docs.columns
    added = T.StructType().add("n_words", T.LongType()).add("n_removed", T.LongType()).add("kept_sha256", T.StringType())
    out = T.StructType([*docs.schema.fields, *added.fields])

    def remove(key, table, sent):
        c = Chunk(table)
        marks = [m if m is not None and m.any() else None for m in _marks(c, sent)]
        removed = [0 if m is None else int(m.sum()) for m in marks]
        digests = [hashlib.sha256(_kept(c, i, m)).hexdigest() for i, m in enumerate(marks)]
        changed = [i for i, m in enumerate(marks) if m is not None]
        text = table.column("text").combine_chunks()
        if changed:
            at = np.full(len(text), -1)
            at[changed] = np.arange(len(changed))
            new = pa.array([_without(c, i, marks[i]) for i in changed], pa.binary()).cast(text.type).take(pa.array(at, mask=at < 0))
            text = pc.if_else(pa.array(at >= 0), new, text)
        columns = [text if n == "text" else table.column(n) for n in names]
        return pa.table([*columns, pa.array(c.ends - c.starts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())], names=[*names, *added.names])

    return by_chunk.cogroup(passages.groupBy("chunk")).applyInArrow(remove, out)
