import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from qualia.llm import word_bpe
from qualia.llm.pair_bpe import PairBpe
from qualia.llm.word_bpe import WordBpe

# Letters that normalize or lower-case oddly, marks, digits, symbols, white space of all kinds, special tokens.
ODD = [
    "a", "B", "1", "'s", "'", "'re", ".", ",", "!!", "#", " ", "  ", "\n", "\n\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0",
    "aaaa", "the", "The", "<|", "|>", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>",
    *map(chr, [0xDF, 0xE9, 0x130, 0x3A3, 0x3C2, 0x6F22, 0x1F642, 0x301, 0x958, 0x1100, 0x1161, 0x663, 0x2003, 0x3000, 0x200B, 0xAD]),
]
texts = st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=3)), max_size=30).map("".join)


def raw(ids):
    return np.asarray(ids, dtype="<u4").tobytes()


@pytest.fixture(scope="module")
def byte_level():
    path = public_tokenizers.path("byte_bpe_50k.json")
    return PairBpe(path, max_chunks=500), Tokenizer.from_file(path)


@pytest.fixture(scope="module")
def word_level():
    path = public_tokenizers.path("word_bpe_49k.json")
    return WordBpe(path, max_chunks=500), Tokenizer.from_file(path)


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, min_size=1, max_size=4))
def test_byte_level_ids_and_text(byte_level, some):
    ours, library = byte_level
    found = ours.encode(some)
    expected = library.encode_batch(some, add_special_tokens=False)
    assert found == [raw(e.ids) for e in expected]
    decoded = [ours.decode(np.frombuffer(f, dtype="<u4").tolist()) for f in found]
    assert decoded == [library.decode(e.ids, skip_special_tokens=False) for e in expected]


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, min_size=1, max_size=4))
def test_word_level_ids(word_level, some):
    ours, library = word_level
    assert ours.encode(some) == [raw(e.ids) for e in library.encode_batch(some, add_special_tokens=False)]


def test_long_runs_and_nulls(byte_level, word_level):
    rng = random.Random(3)
    some = ["a" * 3001, "ab" * 1500, "aaab" * 700, None, "", " " * 50, "".join(rng.choice("abc ") for _ in range(5000))]
    for ours, library in (byte_level, word_level):
        assert ours.encode(some) == [raw(library.encode(t or "", add_special_tokens=False).ids) for t in some]


def test_invalid_bytes_decode_as_the_library(byte_level):
    ours, library = byte_level
    rng = random.Random(4)
    for _ in range(300):
        ids = [rng.randrange(0, 50257) for _ in range(rng.randrange(8))]
        assert ours.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_a_plain_word_is_learned_once_in_all_its_forms(word_level):
    path, library = public_tokenizers.path("word_bpe_49k.json"), word_level[1]
    ours, asked = WordBpe(path), []
    text = "Naïve, naïve NAÏVE. word\nWord!? WORD;word word-word ×word wo÷rd H\u0331a A\u0301, é\u0327"
    plain = ours._plain
    ours._plain = lambda piece: asked.append(piece.decode()) or plain(piece)
    assert ours.encode([text, text]) == 2 * [raw(library.encode(text, add_special_tokens=False).ids)]
    assert sorted(asked) == sorted(["naïve", "word", ",", ".", "!?", ";", "-"])


def test_pieces_with_equal_hashes_are_told_apart(word_level, monkeypatch):
    ours, library = WordBpe(public_tokenizers.path("word_bpe_49k.json"), max_chunks=40), word_level[1]
    monkeypatch.setattr(word_bpe, "hash_words", lambda data, starts, ends: (ends - starts).astype(np.uint64) % np.uint64(2))
    rng = random.Random(5)
    for _ in range(20):
        some = ["".join(rng.choice(ODD + ["one, ", "two. ", "twelve letters "]) for _ in range(20)) for _ in range(5)]
        assert ours.encode(some) == [raw(library.encode(t, add_special_tokens=False).ids) for t in some]


def test_known_pieces_take_little_memory(word_level):
    ours, library = WordBpe(public_tokenizers.path("word_bpe_49k.json"), max_chunks=5000), word_level[1]
    rng = random.Random(6)
    some = [" ".join("".join(rng.choice("abcdeé") for _ in range(8)) for _ in range(500)) for _ in range(24)]
    for at in range(0, len(some), 4):
        assert ours.encode(some[at:at + 4]) == [raw(library.encode(t, add_special_tokens=False).ids) for t in some[at:at + 4]]
    held = sum(x.nbytes for x in vars(ours.table).values())
    assert 0 < len(ours.table) <= 5000 + 2000 and held / len(ours.table) < 80
