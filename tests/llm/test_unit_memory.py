"""The memory of units of the token encoder: a table of open addresses, exact keys of short units."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer, pre_tokenizers

from eventmart.llm import token_output

TEXTS = ["Plain words, and longer ones: incomprehensibilities incomprehensibility", "12345678 123456789 abcdefgh abcdefghi", "o\u00f9, \u00e9t\u00e9! \u00c9T\u00c9", "", "it's <b>a</b>\x00a a\x00 a", "\u4e2d\u6587 \U0001f600 word"]
PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(texts):
    return [[*e.ids, 2] for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def encoded(encoder, texts):
    ids, n = encoder.encode(pa.array(texts), 2)
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


def test_short_units_are_neither_hashed_nor_compared(monkeypatch):
    """Only units of more than 8 bytes or beyond ASCII go to the hash and to the comparison."""
    seen = []
    original = {name: getattr(token_output, name) for name in ("string_hash", "same_strings")}
    monkeypatch.setattr(token_output, "string_hash", lambda data, starts, ends, *a: seen.extend((ends - starts).tolist()) or original["string_hash"](data, starts, ends, *a))
    monkeypatch.setattr(token_output, "same_strings", lambda data, starts, other, places, sizes: seen.extend(sizes.tolist()) or original["same_strings"](data, starts, other, places, sizes))
    assert encoded(token_output.Encoder(PATH), ["short words, twice: short words incomprehensible"]) == expected(["short words, twice: short words incomprehensible"])
    assert seen == [16, 16]


@pytest.mark.parametrize("slots", [1, 1 << 16])
def test_a_full_table_grows_and_keeps_its_units(monkeypatch, slots):
    monkeypatch.setattr(token_output, "LEAST_SLOTS", slots)
    encoder, texts = token_output.Encoder(PATH), TEXTS + [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}x" * (1 + i % 4) for i in range(900)]
    for some in (texts[:3], texts, texts[::-1]):
        assert encoded(encoder, some) == expected(some)
    entries = np.arange(1, len(encoder.keys))
    assert (encoder.find(encoder.keys[1:]) == entries).all() and 2 * len(encoder.keys) <= len(encoder.slots)


def test_a_hash_that_is_a_short_unit_is_no_match(monkeypatch):
    """The hash of a long unit is made to be the key of a short one, whichever comes first."""
    data = np.frombuffer(b"cat", np.uint8)
    key, short = token_output.unit_keys(data, data, np.array([0]), np.array([3]), np.zeros(1, bool))
    assert short.all()
    monkeypatch.setattr(token_output, "string_hash", lambda data, starts, ends, *a: np.full(len(starts), key[0]))
    for texts in (["cat", "incomprehensible cat"], ["incomprehensible", "cat"], ["cat incomprehensible considerable"]):
        encoder = token_output.Encoder(PATH)
        assert [encoded(encoder, [t]) for t in texts] == [expected([t]) for t in texts]
        assert encoded(token_output.Encoder(PATH), texts) == expected(texts)


def test_the_byte_alphabet_is_the_tokenizers():
    spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
    for text in ("".join(map(chr, range(1, 0x800))), "\u0800\u20ac\uffff\U00010000\U0001f600\U0010ffff"):
        assert token_output.charmap_decode(text.encode(), "strict", token_output._ALPHABET)[0] == spell(text)[0][0]
