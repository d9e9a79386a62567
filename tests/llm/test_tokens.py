"""Token ids against the tokenizers library itself."""

import random
import unicodedata

import pyarrow as pa
import pytest

from eventloom.llm import queries as Q
from eventloom.llm import tokens

#: Letters that compose in one case only, marks that stay with punctuation, letters with several or no lower-case forms, and what splits words.
PARTS = [
    "T̈", "H̱", "J̌", "W̊", "Y̊", "İ", "İ", "i̇", "ALİ.", "gel", "̇", "̸", "=", "<", "!", "!!", "...", "$$$", "'s", "'RE", "'", "don't", "ß", "ẞ", "Σ", "ΣΑΣ", "ος",
    "É", "é", "Å", "Å", "ﬁ", "Ǆ", "ǅ", "½", "²", "٣", "12", "3.5", "%", "_", "-", "ab-cd", "Straße", "Müller", "niño", "L'été", "çok", "ığdır", "IŞIK", "привет", "Ё", "Ё", "日本語", "한국", "각",
    "😀", "👩‍👩", "​", " ", " ", "\x85", "\x1c", "\x00", "­", " ", "  ", "\t", "\n", "\r\n", "\x0b", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "x<|endoftext|>y", "<|", "|>", "A", "B", "the", "The", "THE", "of,", "(one)", "ª", "º", "µ", "ŉ", "ǰ", "ɐ", "Ɐ", "ȺȾ",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(Q._tokenizer())


def same(tokenizer, found):
    got = [x.tolist() for x in tokens.encoded(pa.array(found, pa.string()), Q._tokenizer(), at_once=1 << 18)]
    want = [e.ids for e in tokenizer.encode_batch([t or "" for t in found], add_special_tokens=False)]
    assert [t for t, a, b in zip(found, got, want, strict=True) if a != b] == []


def test_chosen_parts(tokenizer):
    rng = random.Random(1)
    same(tokenizer, ["".join(rng.choices(PARTS, k=rng.randint(0, 8))) for _ in range(60_000)])


def test_random_code_points(tokenizer):
    rng = random.Random(2)
    ranges = [(0, 0x7F), (0x80, 0x24F), (0x250, 0x5FF), (0x300, 0x36F), (0x1E00, 0x1FFF), (0x2000, 0x2FFF), (0xA640, 0xABFF), (0xF900, 0xFFFF), (0x10000, 0x1FFFF)]

    def one():
        low, high = rng.choice(ranges)
        return chr(rng.randint(low, high))

    found = ["".join(one() if rng.random() < 0.7 else rng.choice("abcXYZ .!") for _ in range(rng.randint(1, 12))) for _ in range(40_000)]
    same(tokenizer, found)
    same(tokenizer, [unicodedata.normalize("NFD", t) for t in found[:10_000]])


def test_edges(tokenizer):
    same(tokenizer, [])
    same(tokenizer, [None, "", " ", "\n\n", None])
    same(tokenizer, ["word " * 200_000, "ALİ. gel", "x" * 5_000, "!" * 5_000])


def test_little_memory(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_STEMS", 20)
    tokens.word_ids.cache_clear()
    rng = random.Random(3)
    same(tokenizer, [" ".join(rng.choices(PARTS, k=30)) for _ in range(500)])
    tokens.word_ids.cache_clear()
