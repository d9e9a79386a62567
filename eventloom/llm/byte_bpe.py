"""Byte-level BPE from merge ranks: encoding by longest matches and backtracking, and decoding.

A row of tokens is what the merges make of its bytes exactly if each two neighbours are what the merges make of theirs, and every prefix of a
piece has one such row. So a piece is read from the left: the longest token that fits the one before is taken, shorter ones when the way on is
blocked, and a place from which no way leads on is never tried again. That is a bounded number of steps a byte, however long the piece, where
merging pair by pair is quadratic. Tokens are found by an automaton over bytes that are mapped to the 256 letters of Latin-1.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from array import array
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import begins, remembers

#: What a worker remembers at most, pieces and pairs; beyond that it forgets all, which changes no result. Longer pieces are not kept.
KNOWN_PIECES, KNOWN_PAIRS, LONG_PIECE = 400_000, 1_000_000, 64


class Merges:
    """The tokens of a file of ranks, lines of a token in base64 and its number: lower numbers merge first."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
        if missing := [b for b in range(256) if bytes([b]) not in self.ranks]:
            raise ValueError(f"no token for the bytes {missing}")
        self.bytes_of = {i: token for token, i in self.ranks.items()}
        self.length = [0] * (max(self.bytes_of) + 1)
        self.shorter: list[int | None] = [None] * len(self.length)  # of each token the longest other one that it begins with
        for i, token in self.bytes_of.items():
            self.length[i] = len(token)
        self.longest = max(self.length)
        self.fits = _Fits(self)
        #: Tokens that merges make, as Latin-1; others only stand for a whole piece.
        self.made = {token.decode("latin-1"): i for token, i in self.ranks.items() if self.merged(token) == [i]}
        self.automaton = ahocorasick.Automaton()
        for token, i in self.made.items():
            self.automaton.add_word(token, i)
            self.shorter[i] = next((self.made[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in self.made), None)
        self.automaton.make_automaton()

    def merged(self, data: bytes) -> list[int]:
        """The definition, for short strings: of all neighbours the pair that merges first becomes one, the leftmost of equals, until none is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            found = [(rank, i) for i in range(len(parts) - 1) if (rank := self.ranks.get(parts[i] + parts[i + 1])) is not None]
            if not found:
                break
            _, i = min(found)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _at(self, text: str, at: int) -> int:
        """The longest token that stands at a place."""
        ahead = text[at : at + self.longest]
        ahead = ahead[: self.automaton.longest_prefix(ahead)]
        while (token := self.made.get(ahead)) is None:
            ahead = ahead[:-1]
        return token

    def _first_choices(self, text: str) -> list[int | None]:
        """The longest token at each place of a short text, in one pass."""
        out, length = [None] * len(text), self.length
        for end, token in self.automaton.iter(text):
            out[end + 1 - length[token]] = token  # of one place, longer ones end later
        return out

    def encode(self, piece: bytes) -> list[int]:
        """A piece's token numbers."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        text, n, at = piece.decode("latin-1"), len(piece), 0
        length, shorter, fits = self.length, self.shorter, self.fits
        choices = self._first_choices(text) if n <= LONG_PIECE else None
        taken: list[int] = []
        blocked = bytearray(n + 1)
        token = choices[0] if choices else self._at(text, 0)
        while at < n:
            before = taken[-1] if taken else None
            while token is not None:
                end = at + length[token]
                if not blocked[end] and (before is None or fits[before, token]):
                    taken.append(token)
                    at = end
                    token = None if end >= n else choices[end] if choices else self._at(text, end)
                    break
                token = shorter[token]
            else:
                blocked[at] = 1
                token = taken.pop()
                at -= length[token]
                token = shorter[token]
        return taken


class _Fits(dict):
    """Whether two tokens may stand side by side."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges = merges

    def __missing__(self, pair: tuple[int, int]) -> bool:
        if len(self) > KNOWN_PAIRS:
            self.clear()
        a, b = pair
        known = self.merges.bytes_of
        ok = self[pair] = self.merges.merged(known[a] + known[b]) == [a, b]
        return ok


@cache
def seen_otherwise(pattern: str) -> dict[int, str]:
    """Characters that the regex module takes for letters or numbers, or doesn't, unlike tiktoken's own pattern, as the two follow different versions of
    Unicode; with a character of the class that tiktoken sees. Those on which regex and Python's tables agree are the same in all versions.

    tiktoken tells by ranks under which a character joins the one before only within a piece.
    """
    import tiktoken

    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    known = {c: kind for kind in "LN" for c in regex.findall(rf"\p{{{kind}}}", every)}
    doubtful = [c for c in every if known.get(c, "O") != (kind if (kind := unicodedata.category(c)[0]) in "LN" else "O")]
    out = {}
    for kind, like in (("L", "a"), ("N", "1"), ("O", "!")):
        ranks = {bytes([i]): i for i in range(256)} | {like.encode() + bytes([i]): 256 + i for i in range(128, 256)}
        found = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary_batch([like + c for c in doubtful], num_threads=1)
        out |= {ord(c): like for c, ids in zip(doubtful, found, strict=True) if ids[0] >= 256 and known.get(c, "O") != kind}
    return out


def _any_of(codes: list[int]) -> str:
    """A class of characters in as few ranges as there are; re looks these up by tables, regex one by one."""
    ends = [i for i in range(len(codes)) if i + 1 == len(codes) or codes[i + 1] != codes[i] + 1]
    starts = [0, *(i + 1 for i in ends[:-1])]
    return "[" + "".join(f"\\U{codes[a]:08x}-\\U{codes[b]:08x}" for a, b in zip(starts, ends, strict=True)) + "]"


class Encoder(dict):
    """Texts as numbers of 4 bytes each. As a dict: the numbers of the pieces met so far."""

    def __init__(self, path: str, pattern: str, as_if: dict[int, str]):
        super().__init__()
        self.merges, self.pattern, self.as_if = Merges(path), regex.compile(pattern), as_if
        self.odd = re.compile(_any_of(sorted(as_if))) if as_if else None

    def __missing__(self, piece: str) -> bytes:
        ids = array("I", self.merges.encode(piece.encode())).tobytes()
        if len(piece) <= LONG_PIECE:
            if len(self) > KNOWN_PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def pieces(self, text: str) -> list[str]:
        if self.odd and not text.isascii() and self.odd.search(text):
            return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.as_if))]
        return self.pattern.findall(text)

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, self.pieces(text))) if text else b""

    def forget(self) -> None:
        self.clear()
        self.merges.fits.clear()


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder(path: str, pattern: str, as_if: dict[int, str]) -> Encoder:
    if (path, pattern) not in _ENCODERS:
        made = _ENCODERS[path, pattern] = Encoder(path, pattern, as_if)
        remembers(f"byte_bpe {path} {pattern}", made.forget)
    return _ENCODERS[path, pattern]


@cache
def _tokens(path: str) -> pa.Array:
    """Each number's bytes, null for numbers that name no token."""
    with open(path, "rb") as lines:
        found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
    return pa.array([found.get(i) for i in range(max(found, default=-1) + 1)], pa.large_binary())


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): each whole text's token numbers under the ranks at ``path``, each match of ``pattern`` encoded on its own.

    Null and empty texts have no tokens; null and repeated ids are rows of their own; no rows give none; other columns are left behind. No exchange.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    as_if = seen_otherwise(pattern)  # takes seconds, so not in each worker

    def run(batches):
        encoder = _encoder(path, pattern, as_if)
        for b in batches:
            begins(f"byte_bpe {path} {pattern}")
            found = [encoder.encode(t.as_py()) for t in b.column(1)]
            ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, bytes): the bytes that each row's token numbers stand for. Null or no ids give no bytes; a null among them, or a number that
    names no token, raises. Repeated rows stay; no rows give none."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("bytes", pa.binary())])

    def run(batches):
        known = _tokens(path)
        for b in batches:
            lists = b.column(1)
            parts = known.take(lists.flatten().cast(pa.int64()))  # in a row, so their bytes are the texts'
            if parts.null_count:
                raise ValueError("an id names no token")
            sizes = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            _, ends, data = parts.buffers()
            ends = np.frombuffer(ends, np.int64)[parts.offset : parts.offset + len(parts) + 1] if ends is not None and len(parts) else np.zeros(1, np.int64)
            own = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(b), [None, pa.py_buffer(np.ascontiguousarray(ends[sizes])), data or pa.py_buffer(b"")])
            yield pa.RecordBatch.from_arrays([b.column(0), lists, own.cast(pa.binary())], schema=schema)

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, ids array<int>, bytes binary")
