"""Ranked search against scores by the definition."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from eventmart.llm import lexical_search
from test_llm import documents


def plain_ranks(docs, items, best=10):
    """(item, rank, doc_id, score), all by the definition."""
    words = [re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or "")) for _, t in docs]
    n, total, df = sum(map(bool, words)), sum(map(len, words)), Counter(w for x in words for w in set(x))
    out = []
    for item, text in items:
        terms = set(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or "")))
        scores = []
        for (key, _), x in zip(docs, words, strict=True):
            tf, m = Counter(x), 10 + (90 * len(x) * n) // max(1, total)
            s = sum(lexical_search.weight(n, df[w]) * ((1_000_000_000 * tf[w]) // (1_000 * tf[w] + 8 * m)) for w in terms if w in tf)
            if s > 0:
                scores.append((-s, key is not None, key or 0))
        out += [(item, r + 1, key if some else None, -s) for r, (s, some, key) in enumerate(sorted(scores)[:best])]
    return sorted(out, key=repr)


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id long, text string, score string, rank int").repartition(3)
    q = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, key int")
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in lexical_search.search(lexical_search.build_index(d), q, **options).collect()], key=repr)


def corpus(rng, n):
    word = lambda: f"w{int(rng.paretovariate(0.6)) % 400}"
    return [" ".join(word() for _ in range(rng.choice([1, 3, 30, 300]))) for _ in range(n)]


def test_equals_the_definition(spark, monkeypatch):
    rng = random.Random(5)
    docs = list(enumerate(corpus(rng, 400)))
    docs += [(k, docs[3][1]) for k in range(1000, 1040)] + [(7, docs[7][1]), (None, docs[7][1]), (None, None), (2000, ""), (2001, "!?"), (2002, "Über ÜBER über ABC abc"), (2003, "w1 " * 5000), (2003, "x_y-z 1,2")]
    items = [(k, t) for k, t in enumerate(corpus(rng, 60))] + [(3, docs[3][1]), (None, "w1 w2"), (100, None), (101, "..."), (102, "über Über abc W1"), (103, "nowhere"), (104, docs[9][1] + " w1" * 50)]
    want = plain_ranks(docs, items)
    assert run(spark, docs, items) == want
    # small segments, short steps and several blocks of queries give the same
    for name, value in (("SEGMENT_BYTES", 5_000), ("STEP", 7), ("BLOCK_TERMS", 300), ("SHORT", 2)):
        monkeypatch.setattr(lexical_search, name, value)
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, best=3) == plain_ranks(docs, items, 3)
    assert run(spark, [], items) == [] and run(spark, docs, []) == [] and run(spark, [(1, None)], items) == []


def test_walk_equals_all_scores():
    """One segment, lists of all lengths, any least score."""
    rng = np.random.default_rng(7)
    for size in (1, 5, 300):
        part = lexical_search.Segment.__new__(lexical_search.Segment)
        part.size, part.rank, part.lists = size, rng.permutation(size), {}
        whole = np.zeros(size, np.int64)
        for k in range(9):
            where = np.sort(rng.choice(size, max(1, size >> rng.integers(0, 6)), replace=False)).astype(np.int32)
            adds = rng.integers(1, 6, len(where))
            part.lists[k] = where, adds, int(adds.max())
            whole[where] += adds
        order = [d for d in np.lexsort((part.rank, -whole)) if whole[d] > 0]
        for least in (1, 5, int(whole.max()), int(whole.max()) + 1):
            docs, scores = part.best(np.arange(9), least, 10)
            assert docs.tolist() == [d for d in order if whole[d] >= least][:10] and scores.tolist() == whole[docs].tolist()


def test_large_numbers():
    n = np.array([1, 10**7])
    assert lexical_search.lengths(n, 10**12, 3 * 10**14).tolist() == [10 + 90 * v * 10**12 // (3 * 10**14) for v in n.tolist()]


def test_documents_of_other_columns(spark):
    assert lexical_search.build_index(documents(spark, [])).count() == 0
