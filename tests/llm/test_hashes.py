"""Texts that agree under sums of powers modulo 2 ** 64 are told apart."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from eventmart.llm import decontaminate, jaccard_join, line_dedup, substring_dedup, token_output, words
from test_llm import documents


def thue_morse(n: int) -> tuple[str, str]:
    """The first n letters of the sequence and of its complement."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_products_and_stretches():
    rng, prime = np.random.default_rng(1), int(words.PRIME)
    a, b = (np.append(rng.integers(0, prime, 500, np.uint64), [0, prime - 1, prime - 1]).astype(np.uint64) for _ in range(2))
    assert all(int(x) == int(y) * int(z) % prime for x, y, z in zip(words._product(a, b), a, b, strict=True))
    values = np.array([ord(c) for c in "".join(thue_morse(1024)) + thue_morse(1024)[0]], np.uint64)
    one, two, again = words.Sequences(values, 3).hash(np.array([0, 1024, 2048]), np.array([1024, 2048, 3072]))
    assert one == again != two
    assert words.Sequences(values[5:1024], 3).hash(np.array([2]), np.array([900])) == words.Sequences(values, 3).hash(np.array([7]), np.array([905]))
    data = np.frombuffer(b"abcdefghij" * 3, np.uint8)
    starts, ends = np.array([0, 10, 20, 0, 3]), np.array([10, 20, 30, 0, 9])
    h = words.string_hash(data, starts, ends)
    assert h[0] == h[1] == h[2] and len(set(h.tolist())) == 3
    assert words.same_strings(data, starts[:3], data, np.array([10, 20, 1]), np.array([10, 10, 10])).tolist() == [True, True, False]


@pytest.mark.parametrize("n", [1024, 4096])
def test_operators_tell_them_apart(spark, n):
    one, two = thue_morse(n)
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = token_output.Encoder(path)
    ids, sizes = encoder.encode(pa.array([one, two, one]), 2)
    parts = np.split(ids, np.cumsum(sizes)[:-1])
    want = [[*e.ids, 2] for e in encoder.tokenizer.encode_batch([one, two, one], add_special_tokens=False)]
    assert [p.tolist() for p in parts] == want
    groups = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(documents(spark, [one, two, one])).collect()}
    assert groups == {0: 0, 1: 1, 2: 0}
    lines = [" ".join(one), " ".join(two), "x\n" + " ".join(one)]
    assert [r.n_removed for r in line_dedup.without_repeated_passages(documents(spark, lines)).orderBy("doc_id").collect()] == [0, 0, 1]
    items = spark.createDataFrame([(1, one)], "item_id long, text string")
    assert [r.n_hit for r in decontaminate.contamination(documents(spark, [one, two]), items).orderBy("doc_id").collect()] == [1, 0]
    gone = substring_dedup.without_repeats(documents(spark, [one, two]), length=200).orderBy("doc_id").collect()
    where = [{s[i : i + 200] for i in range(n - 199)} for s in (one, two)]
    assert [r.n_removed > 0 for r in gone] == [bool(where[0] & where[1]) or len(where[0]) < n - 199] * 2


def test_equal_hashes_are_encoded_by_their_bytes(monkeypatch):
    """With a hash that has two values, ids are still those of the library."""
    monkeypatch.setattr(token_output, "string_hash", lambda data, starts, ends, seed=0: ((ends - starts) % 2).astype(np.uint64))
    encoder = token_output.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["Some words, and more words: don't stop", "", "naïve café", "and more. 42"]
    for _ in range(2):
        ids, sizes = encoder.encode(pa.array(texts), 2)
        got = [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])]
        assert got == [[*e.ids, 2] for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
