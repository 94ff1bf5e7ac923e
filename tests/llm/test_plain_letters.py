"""Units with the letters U+00C0 to U+00FF, the growing memory of units, and the coding of ranks."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from eventmart.llm import token_output

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(texts):
    return [[*e.ids, 2] for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def encoded(encoder, texts):
    ids, n = encoder.encode(pa.array(texts), 2)
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


def test_forms_of_a_word_are_one_unit():
    """Capitals and the punctuation that follows make no other unit of a word with such letters."""
    encoder, texts = token_output.Encoder(PATH), ["Été, été. ÉTÉ", "(über,été) ÜBER.", "été,"]
    assert encoded(encoder, texts) == expected(texts)
    units = {bytes(x) for x in token_output._spellings(*token_output.units(np.frombuffer(" ".join(texts).encode(), np.uint8), np.array([0]))[:3])}
    assert units == {x.encode() for x in ("été", "über", ",", ".", "(", ").", ")")} - {b")."}
    assert len(encoder.keys) == 1 + len(units)


def test_every_letter_in_every_neighbourhood():
    letters = [chr(c) for c in range(0xA0, 0x180)]
    near = ["", "a", "Z", "7", ".", " ", "'", "<", "́", "̧", "̈", "Å", "中", "×", "÷", "ẞ"]
    texts = [f"{x}{c}{y}" for c in letters for x in near for y in near] + [c * n for c in letters for n in (2, 5, 9)]
    random.Random(3).shuffle(texts)
    encoder = token_output.Encoder(PATH)
    for some in (texts[: len(texts) // 2], texts[len(texts) // 2 :], [" ".join(texts)], [",".join(texts)]):
        assert encoded(encoder, some) == expected(some)


def test_texts_do_not_run_together():
    texts = ["café", "é", "", "É", "á", "́", "é ", " Ã", "¿", "×", "÷é"]
    assert encoded(token_output.Encoder(PATH), texts) == expected(texts)


def test_memory_is_not_copied_for_a_few_more_units():
    encoder = token_output.Encoder(PATH)
    encoded(encoder, [" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600))])
    places = {name: getattr(encoder, name).__array_interface__["data"][0] for name in ("keys", "entries", "ids", "spelled")}
    texts = ["some words more, incomprehensibilities"]
    assert encoded(encoder, texts) == expected(texts)
    assert {name: getattr(encoder, name).__array_interface__["data"][0] for name in places} == places


def test_coding_of_ranks_of_every_length():
    rng = np.random.default_rng(5)
    n = rng.integers(0, 7, 3000)
    ranks = (rng.integers(0, 1 << 32, int(n.sum()), np.uint64) >> rng.integers(0, 33, int(n.sum()), np.uint64)).astype(np.uint32)
    control, data, sizes = token_output.encode_ranks(ranks, n)
    assert len(control) == (-(-n // 4)).sum() and data.tobytes() == b"".join(r.to_bytes(max(1, -(-r.bit_length() // 8)), "little") for r in ranks.tolist())
    assert (np.cumsum(sizes)[-1], len(sizes)) == (len(data), len(n)) and (token_output.decode_ranks(control, data, n) == ranks).all()
    assert [len(x) for x in token_output.encode_ranks(ranks[:0], n[:0])] == [0, 0, 0]
