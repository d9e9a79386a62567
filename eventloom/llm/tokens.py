"""Token ids of whole texts, with a worker's memory of the words it has met.

The tokenizer splits at white space before it merges, so a text's ids are those of its words in a row. Corpora repeat their words: each
Python worker passes a word to the tokenizers library once and looks it up afterwards. Texts are cut into words, and ids gathered, by Arrow
for some megabytes at a time.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from eventloom.llm.common import begins, remembers

#: Entries that a worker remembers; beyond them it forgets all and begins anew. About 0.1 GB at most for words of usual length.
KNOWN_STEMS = 600_000
#: Words in one text when new ones go to the library.
TOGETHER = 256
#: Latin letters and ASCII marks after them. These letters are composed already and lower-case one by one; the one left out, U+0130, becomes a
#: letter and a combining mark, which the tokenizer keeps with the marks after it.
_PLAIN = "^(?P<stem>[A-Za-zªµºÀ-ÖØ-öø-įı-ɏ]+)(?P<marks>[!-/:-@\\[-`{-~]*)$"


class WordIds:
    """Ids of texts as unsigned 32-bit integers. Only for tokenizers that compose and lower-case letters, split at white space and between letters
    and marks; a word with anything but Latin letters and marks after them goes to the library as it is."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # which ids end a word
        if suffix:
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True

    def _learn(self, new: list[str]) -> None:
        texts = [" ".join(new[i : i + TOGETHER]) for i in range(0, len(new), TOGETHER)] if new[0].isalpha() else new
        for i, found in enumerate(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            if texts is new:
                self.known[new[i]] = ids.tobytes()
                continue
            own = new[i * TOGETHER : (i + 1) * TOGETHER]
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(own):  # a word's last id doesn't say so: take the words one by one
                self.known.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(own, self.tokenizer.encode_batch_fast(own, add_special_tokens=False), strict=True))
                continue
            whole, ends = ids.tobytes(), (4 * ends).tolist()
            self.known.update((w, whole[s:e]) for w, s, e in zip(own, [0, *ends], ends))

    def _ids_of(self, keys: pa.Array, plain: bool) -> pa.Array:
        """The ids of each string, as bytes."""
        coded = keys.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, distinct))
        if None in found:
            new = [w for w, f in zip(distinct, found, strict=True) if f is None]
            if len(self.known) + len(new) > KNOWN_STEMS:
                self.known, new = {"": b""}, distinct
            if new := [w for w in new if w]:
                self._learn(new) if plain else self._learn_each(new)
            found = list(map(self.known.__getitem__, distinct))
        return pa.array(found, pa.binary()).take(coded.indices)

    def _learn_each(self, new: list[str]) -> None:
        self.known.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's begin, and the end)."""
        lists = pc.ascii_split_whitespace(texts.fill_null("").cast(pa.string()))
        coded = lists.flatten().dictionary_encode()
        cut = pc.extract_regex(coded.dictionary, _PLAIN)
        plain = pc.is_valid(cut)
        stems, marks = (pc.struct_field(cut, k).filter(plain) for k in ("stem", "marks"))
        ours = pc.binary_join_element_wise(self._ids_of(pc.utf8_lower(stems), True), self._ids_of(marks, False), b"")
        others = self._ids_of(coded.dictionary.filter(pc.invert(plain)), False)
        blobs = pc.replace_with_mask(pc.replace_with_mask(pa.array([b""] * len(plain), pa.binary()), plain, ours), pc.invert(plain), others)
        found = blobs.cast(pa.large_binary()).take(coded.indices)
        _, ends, data = found.buffers()
        ids = np.frombuffer(data, "<u4") if data is not None else np.empty(0, "<u4")
        ends = np.frombuffer(ends, np.int64)[: len(found) + 1] // 4 if len(found) else np.zeros(1, np.int64)
        return ids[: ends[-1]], ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]


@cache
def word_ids(path: str) -> WordIds:
    """This worker's tokenizer for a file."""
    return WordIds(path)


remembers("tokens", word_ids.cache_clear)


def encoded_together(column: pa.Array, path: str, at_once: int = 1 << 23) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The ids of a string column's texts in a row, and where each text's begin and the last's end, for about ``at_once`` bytes of text at a time;
    null: none."""
    begins("tokens")
    tokenizer = word_ids(path)
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        done = int(size[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(size, done + at_once)))
        yield tokenizer.encode(column.slice(at, to - at))
        at = to


def encoded(column: pa.Array, path: str, at_once: int = 1 << 23) -> Iterator[np.ndarray]:
    """The ids of each text of a string column, in order."""
    for ids, bounds in encoded_together(column, path, at_once):
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            yield ids[s:e]
