"""Training-data operators against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from math import ceil

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventmart.llm import pipeline as corpus_pipeline
from eventmart.llm import common, decontaminate, exact_dedup, jaccard_join, license_scan, line_dedup, mixing, quality, substring_dedup, token_output, toxicity
from eventmart.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = [f"word{i}" for i in range(60)] + ["é" * 3, "Ñandú", "naïve", "x"]


def fold(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(text))


def documents(spark, texts, parts=3, **extra):
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return df.withColumns({c: F.lit(v) for c, v in extra.items()})


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Random texts with copies, near copies, shared passages, nulls, empty, one-word and long texts."""
    rng = random.Random(3)
    texts = [None, "", " \n ", "Word", "x", "x", prose(rng, 6000), "a\n\n\nb", "Ha " * 300]
    passage = prose(rng, 60)
    for _ in range(40):
        t = prose(rng, rng.choice([3, 5, 8, 30, 120]))
        texts.append(t)
        for _ in range(rng.choice([0, 0, 1, 2])):
            words = t.split()
            words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
            texts.append(rng.choice([t, t.upper(), " ".join(words), f"{t} {passage}", f"{passage}\n{t}"]))
    return texts


CLASH = {"key": "k", "row_id": 1, "digest": 2, "n": 3, "score": 0.5, "spans": "s", "recipe": "r", "mix_slots": 1}


def test_exact(spark, corpus):
    got = {r.doc_id: r for r in exact_dedup.exact_duplicates(documents(spark, corpus, **CLASH)).collect()}
    groups = defaultdict(list)
    for i, t in enumerate(corpus):
        groups[fold(t)].append(i)
    for i, t in enumerate(corpus):
        g = groups[fold(t)]
        assert (got[i].keep_id, got[i].group_size, got[i].kept, got[i].text_sha256) == (max(g), len(g), i == max(g), hashlib.sha256(fold(t).encode()).hexdigest())
    repeated = spark.createDataFrame([(1, "a"), (1, "A"), (None, "a")], "doc_id long, text string")
    assert sorted((r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(repeated).collect()) == [(1, 3, False), (1, 3, False), (1, 3, True)]


def test_chunks_cover_the_text(spark, corpus):
    docs = documents(spark, corpus)
    cut = F.lit(exact_dedup.CHUNK.format(least=20, most=40))
    joined = docs.select("text", F.array_join(F.regexp_extract_all(F.coalesce("text", F.lit("")), cut, F.lit(0)), "").alias("j"))
    assert all(r.j == (r.text or "") for r in joined.collect())


def test_contamination(spark, corpus):
    rng = random.Random(5)
    items = [" ".join(rng.choice(corpus[6].split()) for _ in range(20)), corpus[6][300:600], "word1", "", None, corpus[-1], corpus[-1]]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(documents(spark, corpus, **CLASH), bench).collect()}
    for i, t in enumerate(corpus):
        w, hit, found = plain_words(t), set(), set()
        for item, text in enumerate(items):
            b = plain_words(text)
            m = min(13, len(b))
            grams = {tuple(b[k : k + m]) for k in range(len(b) - m + 1)} if b else set()
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in grams:
                    hit |= set(range(k, k + m))
                    found.add(str(item))
        want = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
        assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].items_sha256, got[i].contaminated) == want


def test_proximity(spark):
    docs = documents(spark, ["zeta one two three alpha tail", "zeta " + "filler " * 30 + "alpha", "alpha one zeta"])
    items = decontaminate.item_table(spark.createDataFrame([(0, "zeta one two alpha")], "item_id long, text string"))
    index = decontaminate.build_index(docs, items, min_run=1)
    assert [r.key for r in decontaminate.proximity_matches(index, items, slop=2).collect()] == [0]


def test_tokens(spark, corpus):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [*corpus, "It's 4.0 -- don't! ΣΑΣ é İx <|endoftext|> ½ a_b", "tab\tand space x"]
    docs = documents(spark, texts, **CLASH)
    got = {r.doc_id: r for r in token_output.token_output(docs, path, shards=3).collect()}
    tokenizer, start = Tokenizer.from_file(path), 0
    for i, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_rank_coding():
    ranks = np.array([0, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1, 7, 9], np.uint32)
    for n in ([9], [0, 4, 0, 5], [1] * 9):
        n = np.array(n)
        control, data, sizes = token_output.encode_ranks(ranks, n)
        assert sizes.sum() == len(data) and (token_output.decode_ranks(control, data, n) == ranks).all()


def test_mixing(spark):
    texts = [str(i) for i in range(500)]
    docs = documents(spark, texts).withColumn("source", F.when(F.col("doc_id") < 350, "big").when(F.col("doc_id") < 480, "mid"))
    got = mixing.schedule(docs, weights={"big": 0.5, "mid": 0.3, "": 0.2}, block_rows=4).select("doc_id", "mix_source", "mix_slot", "mix_release", "mix_deadline").collect()
    assert {r.doc_id for r in got} == set(range(500))
    assert all(r.mix_release <= r.mix_slot < r.mix_deadline for r in got)
    slots = {r.mix_slot: r.mix_source for r in got}
    assert sorted(slots) == list(range(len(slots)))
    for s, w in {"big": 0.5, "mid": 0.3, "": 0.2}.items():
        done = 0
        for slot in range(len(slots)):
            done += slots[slot] == s
            assert abs(done - w * (slot + 1)) < 1
    stream = mixing.mixed_stream(docs.withColumn("mix_rows", F.lit(1)))
    assert stream.columns == [*docs.columns, "mix_rows"] and stream.select("doc_id").distinct().count() == 500


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1, "c": 1}, {"a": 97, "b": 2, "c": 0.5, "d": 0.5}])
def test_every_block_meets_its_window(weights):
    share = mixing.shares(weights)
    for s, j, release, deadline, slot in mixing.earliest_deadline_first(share, dict.fromkeys(weights, 40)):
        assert (release, deadline) == (int(j / share[s]), ceil((j + 1) / share[s])) and release <= slot < deadline


def test_lines(spark):
    rng = random.Random(9)
    texts = ["\n".join(rng.choice("abcd") for _ in range(rng.choice([0, 1, 2, 3, 5, 12]))) for _ in range(60)] + [None, "\n\n\n\n"]
    got = {r.doc_id: r for r in line_dedup.without_repeated_runs(documents(spark, texts, **CLASH)).collect()}
    seen, gone = set(), defaultdict(set)
    for i, t in enumerate(texts):
        lines = (t or "").split("\n")
        for k in range(len(lines) - 2):
            run = tuple(lines[k : k + 3])
            if run in seen:
                gone[i] |= {k, k + 1, k + 2}
            seen.add(run)
    for i, t in enumerate(texts):
        kept = [x for k, x in enumerate((t or "").split("\n")) if k not in gone[i]]
        assert (got[i].n_removed, got[i].n_runs, got[i].kept_text) == (len(gone[i]), sum(k - 1 not in gone[i] for k in gone[i]), "\n".join(kept))


def removed(texts, length):
    seen = Counter(b[k : k + length] for b in texts for k in range(len(b) - length + 1))
    out = []
    for b in texts:
        covered = set().union(*[range(k, k + length) for k in range(len(b) - length + 1) if seen[b[k : k + length]] > 1])
        kept = bytes(x for k, x in enumerate(b) if k not in covered)
        out.append((len(b), len(covered), sum(k - 1 not in covered for k in covered), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("part", [4 << 20, 700])
def test_substrings(spark, corpus, part, monkeypatch):
    monkeypatch.setattr(substring_dedup, "PART", part)
    got = {r[0]: tuple(r[1:5]) for r in substring_dedup.without_repeats(documents(spark, corpus, **CLASH), with_text=True).collect()}
    assert [got[i] for i in range(len(corpus))] == removed([(t or "").encode() for t in corpus], 200)


def test_near_duplicates(spark, corpus):
    got = {r.doc_id: r for r in jaccard_join.near_duplicates(documents(spark, corpus, **CLASH)).collect()}
    sets = []
    for t in corpus:
        w = re.findall(r"[^\x20\x09-\x0D]+", fold(t))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    root = list(range(len(corpus)))
    for a, b in itertools.combinations(range(len(corpus)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            old, new = max(root[a], root[b]), min(root[a], root[b])
            root = [new if r == old else r for r in root]
    assert [(got[i].n_shingles, got[i].component_id) for i in range(len(corpus))] == [(len(s), r) for s, r in zip(sets, root, strict=True)]


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 102), (102, 101), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}


def test_licenses(spark):
    mit = next(t for label, t in license_scan.TEMPLATES if label == "mit")
    texts = [None, "", "All Rights  reserved. all rights reserved", f"intro {mit[:200]} changed words here {mit[200:]}", "cc-by CC BY general public license", "the license of the software is general"]
    got = {r.doc_id: r for r in license_scan.license_labels(documents(spark, texts, **CLASH)).collect()}
    assert [(got[i].n_base, got[i].first_word, got[i].last_word, got[i].base_labels) for i in range(6)] == [(0, None, None, ""), (0, None, None, ""), (2, 0, 3, "reserved"), (0, None, None, ""), (3, 0, 4, "cc-by,gpl"), (0, None, None, "")]
    assert (got[3].labels, got[5].labels, got[4].score) == ("mit", "", 1.0) and got[3].score > 0.9 and got[0].score == 0.0


def labelled(spark, n=400):
    rng = random.Random(11)
    texts, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = prose(rng, 40).split()
        if bad:
            words[rng.randrange(40)] = rng.choice(["scoundrel", "nitwit"])
        junk = i % 4 == 0
        texts.append(" ".join(f"{w.upper()}!!" if junk else w for w in words))
        labels.append((i, int(not junk), int(bad)))
    return documents(spark, [*texts, None, "", "..."], **CLASH), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", ["toxic", "quality"])
def test_classifiers_on_held_out_rows(spark, name):
    docs, labels = labelled(spark)
    score = toxicity.toxicity_scores if name == "toxic" else quality.quality_scores
    got = score(docs, labels).join(labels, "doc_id", "left").toPandas()
    assert len(got) == 403 and got["score"].between(0, 1).all()
    folds, remainder = (4, 2) if name == "toxic" else (5, 0)
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % folds == remainder for i in got["doc_id"]]).all()
    test = got[got["held_out"] & got[name].notna()]
    assert (test["predicted"] == test[name]).mean() > 0.9
    # held-out labels and other columns change nothing
    other = labels.withColumn(name, F.when(toxicity.held_out("doc_id", folds, remainder), 1 - F.col(name)).otherwise(F.col(name)))
    again = score(docs.withColumns({"lang": F.lit("zz"), "source": F.lit("s")}), other).toPandas()
    assert np.allclose(got.sort_values("doc_id")["score"], again.sort_values("doc_id")["score"])
    # without labels of both classes
    assert score(docs, labels.limit(0)).agg(F.max("score")).first()[0] == 0.0


def test_empty_tables(spark):
    docs, labels = documents(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    for df in (
        toxicity.toxicity_scores(docs, labels), quality.quality_scores(docs, labels), decontaminate.contamination(docs, bench), token_output.token_output(docs, path), mixing.schedule(docs), exact_dedup.exact_duplicates(docs),
        line_dedup.without_repeated_runs(docs), substring_dedup.without_repeats(docs), jaccard_join.near_duplicates(docs), license_scan.license_labels(docs),
    ):
        assert df.count() == 0
    assert decontaminate.contamination(documents(spark, ["a b"]), bench).first().contaminated is False


def test_pipeline(spark, tmp_path):
    docs, labels = labelled(spark, 200)
    docs = docs.drop(*CLASH).union(docs.drop(*CLASH).filter("doc_id < 5").withColumn("doc_id", F.col("doc_id") + 1000))
    item = docs.filter("doc_id = 1").first().text
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, common.stored(stage(spark, now, str(tmp_path)), name)
        if name != "token_output":
            assert now.columns == before.columns
        kept.append({r.doc_id for r in now.select("doc_id").collect()})
    toxic, near, clean, mixed, tokens = kept
    assert not any(i in near for i in range(1000, 1005)) and 1 in near and 1 not in clean
    assert mixed == clean == tokens and len(clean) > 130
    assert now.agg(F.sum("n_tokens")).first()[0] == now.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0]
