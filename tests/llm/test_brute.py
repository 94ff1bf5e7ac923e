"""Operators without SQL against plain versions of their methods, and the cases that every operator has to stand."""

from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_llm import documents, fold, labelled, plain_words, prose
from tokenizers import Tokenizer

from eventmart.llm import decontaminate, exact_dedup, jaccard_join, license_scan, line_dedup, mixing, quality, substring_dedup, token_output, toxicity
from eventmart.llm.words import Words


def test_kneser_ney_equals_counting_by_hand(spark, monkeypatch):
    """Both interpolated models by dictionaries of words, from documents and continuations to the shared counts."""
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(25)]
    texts = [(" ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2, 30]))), int(rng.random() < 0.4)) for _ in range(150)]
    unlabelled = [" ".join(rng.choice([*vocabulary, "other", "words"]) for _ in range(20)) for _ in range(40)]
    rows = spark.createDataFrame(texts, "text string, y int").repartition(3)
    docs = spark.createDataFrame([(t,) for t in [*(t for t, _ in texts), *unlabelled, None]], "text string").repartition(4)
    for held in (1 << 21, 50):
        monkeypatch.setattr(toxicity, "HELD_PAIRS", held)
        m = toxicity.fit_models(docs, rows)
    d = m.discount
    pairs, single = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for t, y in texts:
        w = t.split()
        for p in set(zip(w, w[1:], strict=False)):
            pairs[p][y] += 1
        for x in set(w):
            single[x][y] += 1
    shared = Counter(b for _, b in {p for t in [*(t for t, _ in texts), *unlabelled] for p in zip(t.split(), t.split()[1:], strict=False)})
    every = sum(shared.values()) + (1 << toxicity.SHARED_BITS)
    cont = [Counter(b for (_, b), n in pairs.items() if n[c]) for c in (0, 1)]
    kept = {x for x, n in single.items() if sum(n) >= 2}

    def probability(word, before, c):
        total = sum(cont[c].values())
        freed = total - sum(max(cont[c][x] - d, 0) for x in kept)
        p = (max(cont[c][word] - d, 0) if word in kept else 0) / total + freed / total * (shared[word] + 1) / every
        if before not in kept:
            return p
        followed = {b: n for (a, b), n in pairs.items() if a == before}
        total = sum(n[c] for n in followed.values())
        if not total:
            return p
        own = {b: max(n[c] - d, 0) for b, n in followed.items() if max(n) > d}
        return own.get(word, 0) / total + (total - sum(own.values())) / total * p

    for t in ["v1 v2 v3 v4 v5 v6 v7", "v9", "other v3 unheard v3 v8 v8", *(t for t, _ in texts[:20])]:
        w = t.split()
        want = [np.log(probability(x, b, 1)) - np.log(probability(x, b, 0)) for b, x in zip([None, *w], w, strict=False)]
        assert np.allclose(m.ratios(Words(pa.array([t]))), want)


def test_interactions_equal_all_pairs():
    rng = np.random.default_rng(2)
    column = pa.array(["Some words! some WORDS 12", "", "x " * 40, "naïve | é"])
    bounds, number, values = quality.features(column, np.array([3, 0, 80, 9]))
    size = int(number.max()) + 1
    m = quality.FactorisationMachine(0.3, rng.normal(size=size), rng.normal(size=(size, quality.FACTORS)))
    for i, (a, b) in enumerate(itertools.pairwise(bounds)):
        f, x = number[a:b], values[a:b].astype(float)
        want = 0.3 + m.linear[f] @ x + sum(m.factors[f[p]] @ m.factors[f[q]] * x[p] * x[q] for p, q in itertools.combinations(range(b - a), 2))
        assert np.isclose(m.terms(bounds, number, values)[0][i], want)


def slow_schedule(share, slots):
    """Earliest deadline first by looking at every source in every slot."""
    done, out = dict.fromkeys(share, 0), []
    for slot in range(slots):
        ready = [(-(-(done[s] + 1) // w), s) for s, w in share.items() if done[s] // w <= slot]
        s = min(ready)[1]
        out.append((s, done[s]))
        done[s] += 1
    return out


@pytest.mark.parametrize("weights", [{"a": 1 / 3, "b": 1 / 3, "c": 1 / 3}, {"a": 0.9995, "b": 0.0005}, {"a": Fraction(3, 7), "b": Fraction(4, 7)}, {f"s{i:03}": i + 1 for i in range(450)}])
def test_schedule_stays_within_a_block(weights):
    share = mixing.shares(weights)
    slots = 50_000 if len(weights) < 10 else 3_000
    got = mixing.earliest_deadline_first(share, {s: max(1, int(w * slots)) for s, w in share.items()})
    few = min(len(got), 20_000 if len(weights) < 10 else 1_500)
    assert [p[:2] for p in got[:few]] == slow_schedule(share, few)
    done = dict.fromkeys(share, 0)
    for s, _, _, _, slot in got:
        done[s] += 1
        assert all(abs(done[x] - float(share[x]) * (slot + 1)) < 1 for x in ([s] if len(share) > 10 else share))


def test_mixing_of_many_sources_and_clashing_columns(spark):
    docs = documents(spark, [str(i) for i in range(900)]).withColumn("source", F.when(F.col("doc_id") >= 449, "big").otherwise(F.concat(F.lit("s"), F.col("doc_id"))))
    docs = docs.withColumns({c: F.lit(c) for c in ("mix_source", "mix_slot", "mix_row", "mix_bucket", "row", "mix_key")})
    got = mixing.schedule(docs)
    assert got.columns == [*docs.columns, "mix_source_", "mix_epoch", "mix_block", "mix_release", "mix_deadline", "mix_slot_"]
    rows = got.collect()
    assert {r.doc_id for r in rows} == set(range(900)) and {(r.mix_source, r.mix_slot, r.mix_row, r.row) for r in rows} == {("mix_source", "mix_slot", "mix_row", "row")}
    assert len({(r.doc_id, r.mix_epoch) for r in rows}) == len(rows)
    assert mixing.mixed_stream(docs).columns == docs.columns
    hot = mixing.numbered(spark.range(1, numPartitions=2).select(F.lit("one").alias("mix_source"), F.lit(None).cast("long").alias("mix_key"), F.explode(F.sequence(F.lit(1), F.lit(9_999))).alias("n")))
    assert sorted(r.mix_row for r in hot.collect()) == list(range(9_999))
    with pytest.raises(ValueError):
        mixing.schedule(docs, weights={"big": 1.0})
    with pytest.raises(ValueError):
        mixing.shares({"a": 0.0})


def test_blocks_follow_the_corpus():
    places, blocks, size = mixing.plan({"a": 5 * 10**10, "b": 1, "c": 10**9})
    assert len(places) < 1.1 * mixing.MAX_BLOCKS and blocks["a"] == -(-5 * 10**10 // size) and blocks["b"] == 1


def longest_passages(words, templates):
    """After each word, the longest passage of any template that ends there."""
    out = []
    for i in range(len(words)):
        best = 0
        for t in templates:
            for end in range(1, len(t) + 1):
                n = 0
                while n < min(end, i + 1) and words[i - n] == t[end - 1 - n]:
                    n += 1
                best = max(best, n)
        out.append(best)
    return out


def test_automaton_equals_longest_match():
    rng = random.Random(5)
    for _ in range(30):
        templates = [[rng.randrange(4) for _ in range(rng.randrange(1, 12))] for _ in range(4)]
        words = [rng.randrange(5) for _ in range(60)]
        a = license_scan.SuffixAutomaton(templates)
        got = list(a.stream(words))
        assert [n for _, n in got] == longest_passages(words, templates)
        for i, (state, n) in enumerate(got):
            if n:
                assert {(k, e) for k, e in a.ends[state] if e >= n} >= {(k, e) for k, t in enumerate(templates) for e in range(n, len(t) + 1) if t[e - n : e] == words[i + 1 - n : i + 1]}


def test_phrase_places_equal_search(spark):
    rng = random.Random(3)
    pool = ["cc", "BY", "by", "general", "public", "License", "all", "rights", "reserved", "x", "-", "é"]
    texts = [rng.choice([" ", ".", "\n"]).join(rng.choice(pool) for _ in range(rng.choice([0, 3, 40]))) for _ in range(150)] + [None, "cc by " * 20_000]
    got = {r.doc_id: r for r in license_scan.license_labels(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        w = plain_words(t)
        places = [(k, label) for phrase, label in license_scan.PHRASES.items() for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()]
        at = [k for k, _ in places]
        assert (got[i].n_words, got[i].n_base, got[i].first_word, got[i].last_word) == (len(w), len(places), min(at, default=None), max(at, default=None))
        assert got[i].base_labels == ",".join(sorted({x for _, x in places})) and set(got[i].base_labels.split(",")) <= set(got[i].labels.split(","))


def test_tokens_from_the_folder_alone_and_other_rules(spark, tmp_path):
    texts = ["Ab ab, AB! 12 it's", None, "", "é <|endoftext|> Σας x\ty", "word " * 5000]
    others = [p for p in (public_tokenizers.path("word_bpe_49k.json"), *_other_tokenizers())]
    for n, path in enumerate(others):
        token_output.token_output(documents(spark, texts), path, shards=2, folder=f"{tmp_path}/{n}")
        got = {r.doc_id: r for r in token_output.read_blocks(spark, f"{tmp_path}/{n}", with_ids=True).collect()}
        library = Tokenizer.from_file(path)
        for i, t in enumerate(texts):
            ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
            assert got[i].ids == ids and got[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())


def _other_tokenizers():
    import glob
    import os

    folder = os.path.dirname(public_tokenizers.path("word_bpe_49k.json"))
    found = []
    for p in sorted(glob.glob(f"{folder}/*.json")):
        try:
            Tokenizer.from_file(p)
        except Exception:  # files of other kinds
            continue
        if "word_bpe_49k" not in p:
            found.append(p)
    return found[:1]


def test_units_equal_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, library, rng = token_output.Encoder(path), Tokenizer.from_file(path), random.Random(1)
    pool = ["a", "B", "é", "é", "Σ", "ς", " ", "\n", "\t", "\x0b", "\x1c", "\x00", "'", "'s", "'LL", "<", "<|endoftext|>", "|", ">", ".", ",", "_", "0", "7", "½", "ǅ", "İ", "ß", "中", "😀", "Å", "word", "Hello"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(14))) for _ in range(3000)]
    for begin in (0, 1500):
        some = texts[begin : begin + 1500]
        ids, n = encoder.encode(pa.array(some), 2)
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [[*e.ids, 2] for e in library.encode_batch(some, add_special_tokens=False)]
    encoder.forget()
    assert encoder.encode(pa.array([""]), 2)[0].tolist() == [2]


def test_items_longer_than_a_document(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(5000)]
    item = " ".join(rng.choice(words) for _ in range(20_000))
    part = " ".join(item.split()[1000:2000])
    docs = documents(spark, [item, f"x {part}", item[:40], "w1 w2"])
    got = {r.doc_id: r for r in decontaminate.contamination(docs, spark.createDataFrame([("a", item), ("b", item[:500])], "item_id string, text string"), slop=2).collect()}
    assert [(got[i].n_hit, got[i].n_items, got[i].contaminated) for i in range(4)] == [(20_000, 2, True), (1000, 1, True), (0, 0, False), (0, 0, False)]
    assert [got[i].n_near for i in range(4)] == [2, 1, 0, 0]


def test_every_operator_stands_repeated_rows_null_keys_and_clashes(spark):
    """Rows that repeat a key or have none are answered one by one, whatever other columns there are."""
    passage = prose(random.Random(2), 80)
    rows = [(1, passage), (1, passage), (None, passage), (None, None), (2, ""), (2, "Cc By " * 3), (3, "word " * 20_000)]
    docs = spark.createDataFrame([(i, t, "en", None if i == 2 else "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit(1) for c in ("key", "row_id", "digest", "n", "score", "spans", "recipe", "y", "held_out", "words", "pos", "a", "b", "count", "line", "mix_slot", "ids", "shard", "pipeline_row", "component_id", "contaminated")})
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (3, 0, 1), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(None, passage), ("a", None)], "item_id string, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    made = {
        "toxicity": toxicity.toxicity_scores(docs, labels), "quality": quality.quality_scores(docs, labels), "contamination": decontaminate.contamination(docs, bench, slop=1), "tokens": token_output.token_output(docs, path),
        "exact": exact_dedup.exact_duplicates(docs), "lines": line_dedup.without_repeated_runs(docs), "passages": line_dedup.without_repeated_passages(docs), "substrings": substring_dedup.without_repeats(docs),
        "near": jaccard_join.near_duplicates(docs), "licences": license_scan.license_labels(docs),
    }
    keys = sorted((i or 0) for i, _ in rows)
    got = {name: df.collect() for name, df in made.items()}
    for name, out in got.items():
        assert sorted((r.doc_id or 0) for r in out) == keys, name
    assert sorted(r.contaminated for r in got["contamination"]) == [False] * 4 + [True] * 3 and {r.n_items for r in got["contamination"] if r.contaminated} == {1}
    assert sum(r.kept for r in got["exact"]) == 4 and {r.group_size for r in got["exact"]} == {3, 2, 1}
    assert all(r.n_removed == r.n_bytes for r in got["substrings"] if r.n_bytes == len(passage)) and sum(r.n_removed > 0 for r in got["substrings"]) == 4
    assert [r.component_id for r in got["near"] if r.n_shingles > 2] == [1] * 3
    assert {r.doc_id for r in mixing.schedule(docs).collect()} == {None, 1, 2, 3}
    assert quality.quality_scores(docs.drop("n_chars"), labels).count() == len(rows)


def test_held_out_scores_of_both_classifiers_ignore_rows_that_repeat(spark):
    docs, labels = labelled(spark, 200)
    twice = docs.union(docs.filter("doc_id = 7"))
    got = [r.score for r in toxicity.toxicity_scores(twice, labels).filter("doc_id = 7").collect()]
    assert len(got) == 2 and np.isclose(got[0], got[1])


def test_pipeline_equals_its_stages_by_hand(spark, tmp_path):
    """run() against a plain pass over the documents: scores, pairs of sets, windows of words, blocks and the library's ids."""
    rng = random.Random(12)
    docs, labels = labelled(spark, 160)
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.filter("doc_id < 160").collect()]
    near = [(500 + i, f"{t} tail{i}", "en", "src9", 9) for i, t in ((r[0], r[1]) for r in rows[:12])]
    item = prose(rng, 20)
    dirty = [(600 + i, f"{prose(rng, 30)} {item} {prose(rng, 30)}", "en", "src9", 9) for i in range(3)]
    every = [*rows, *near, *dirty, (700, None, "en", None, 0), (701, "", None, "src1", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(every, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    score = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, labels).collect()}
    kept = sorted(((i, t) for i, t, *_ in every if score[i] < 0.3), key=lambda x: x[0])

    def shingles(t):
        w = fold(t).split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()

    sets, root = [shingles(t) for _, t in kept], list(range(len(kept)))
    for a, b in itertools.combinations(range(len(kept)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            old, new = max(root[a], root[b]), min(root[a], root[b])
            root = [new if r == old else r for r in root]
    kept = [x for k, x in enumerate(kept) if root[k] == k]
    words = plain_words(item)
    windows = {tuple(words[k : k + 13]) for k in range(len(words) - 12)}

    def hit(t):
        w = plain_words(t)
        found = {q for k in range(len(w) - 12) if tuple(w[k : k + 13]) in windows for q in range(k, k + 13)}
        return bool(found) and 20 * len(found) >= len(w)

    kept = [x for x in kept if not hit(x[1])]
    sizes = Counter({i: s or "" for i, _, _, s, _ in every}[i] for i, _ in kept)
    places, blocks, size = mixing.plan(dict(sizes))
    times = Counter()
    for s, j, *_ in places:
        times[s] += min(size, sizes[s] - j % blocks[s] * size)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in kept}
    out = corpus_pipeline.run(spark, str(tmp_path)).orderBy("start").collect()
    assert {r.doc_id for r in out} == set(ids) and len(out) == sum(times.values())
    assert [r.doc_id for r in out] == sorted(r.doc_id for r in out)
    assert all(b.start == a.start + a.n_tokens for a, b in itertools.pairwise(out)) and out[0].start == 0
    assert all((r.n_tokens, r.ids_crc32) == (len(ids[r.doc_id]), zlib.crc32(np.array(ids[r.doc_id], "<u4").tobytes())) for r in out)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_output"]
