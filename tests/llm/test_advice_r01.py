"""Cases that reviewers found to be done only in part."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa

from eventmart.llm import pipeline as corpus_pipeline
from eventmart.llm import license_scan, line_dedup, toxicity
from eventmart.llm.words import Words
from test_llm import SCHEMA, documents


def passages_gone(texts, least):
    """Lines of every stretch of at least `least` words that occurred before, by trying all stretches."""
    seen, gone = set(), defaultdict(set)
    for i, t in enumerate(texts):
        lines = (t or "").split("\n")
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                run = tuple(lines[a : b + 1])
                if sum(len(x.split()) for x in run) >= least:
                    if run in seen:
                        gone[i] |= set(range(a, b + 1))
                    seen.add(run)
    return gone


def test_passages_of_any_number_of_lines(spark):
    rng = random.Random(4)
    pool = ["", "a", "b c", "d e f g", "h i j k l m n", " ", "é o p q r s t u v w x y"]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.choice([1, 1, 2, 2, 4, 9]))) for _ in range(120)]
    texts += [None, "", "\n\n", "lone " * 60, "head\n" + "lone " * 60, "\n".join(["x " * 30, "y " * 30]), "\n".join(["z", "x " * 30, "y " * 30, ""])]
    for least in (1, 6, 50):
        got = {r.doc_id: r for r in line_dedup.without_repeated_passages(documents(spark, texts), least=least).collect()}
        gone = passages_gone(texts, least)
        for i, t in enumerate(texts):
            lines = (t or "").split("\n")
            want = (len(lines), len(gone[i]), sum(k - 1 not in gone[i] for k in gone[i]), "\n".join(x for k, x in enumerate(lines) if k not in gone[i]))
            assert tuple(got[i])[1:] == want, (least, i)
    assert line_dedup.without_repeated_passages(documents(spark, [])).count() == 0


def test_ordinary_pairs_speak_against_toxic(spark):
    """A pair of ordinary documents alone counts for their class, and no mass of a class is lost."""
    rng = random.Random(6)
    filler = lambda: " ".join(rng.choice(["one", "two", "three", "four", "five"]) for _ in range(6))
    texts = [(f"{filler()} good morning {filler()}", 0) for _ in range(300)]
    texts += [(f"{filler()} good {rng.choice(['heavens', 'grief', 'lord'])} {filler()} morning {filler()}", 1) for _ in range(60)]
    rows = spark.createDataFrame(texts, "text string, y int")
    m = toxicity.fit_models(rows, rows)
    w = Words(pa.array(["good morning"]))
    assert m.ratios(w)[1] < -1
    at, known = toxicity.find(m.words, w.hash[:1])
    vocabulary = Words(pa.array(["good " + x for x in "one two three four five good morning heavens grief lord".split()]))
    pairs = toxicity.grams(vocabulary.hash, 2)[::2]
    place, kept = toxicity.find(m.pairs, pairs)
    for c in (0, 1):
        seen = np.maximum(m.pair_counts[c][place[kept]] - m.discount, 0).sum()
        assert known[0] and np.isclose(seen + m.freed[c][at[0]], m.followed[c][at[0]])


def test_pipeline_decides_by_row(spark, tmp_path):
    """Rows that share a doc_id, or have none, are judged one by one."""
    copy, other, third, bad = ("".join(f"{w}{i} " for i in range(40)) for w in ("copy", "other", "third", "bad"))
    texts = [(7, copy), (7, copy), (None, copy), (3, other), (7, other), (None, third), (None, bad), (3, bad + "end")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts], SCHEMA).repartition(3)
    spark.createDataFrame([(0, bad)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    near = corpus_pipeline.near_duplicate(spark, docs, str(tmp_path))
    assert near.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in near.collect()) == sorted([(7, copy), (3, other), (0, third), (3, bad + "end")])
    clean = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in clean.collect()) == sorted((i or 0, t) for i, t in texts[:6])


def test_common_openings_tell_no_licence(spark):
    work = "This work is licensed under"
    cases = {
        f"{work} the MIT License": "mit", f"{work} the Apache License, Version 2.0": "apache-2.0", f"{work} the Foo License": "", f"{work} a Foo 4.0 International License": "",
        f"{work} the GNU General Public License, version 3": "gpl", "Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    }
    for label, name in (("", ""), ("-nc", "-NonCommercial"), ("-sa", "-ShareAlike"), ("-nc-sa", "-NonCommercial-ShareAlike")):
        cases[f"{work} a Creative Commons Attribution{name} 4.0 International License"] = f"cc-by{label}"
    whole = {label: text for label, text in license_scan.TEMPLATES if len(text) > 400}
    cases |= {text[len(text) // 5 :]: label for label, text in whole.items()} | {text: label for label, text in license_scan.TEMPLATES}
    got = {r.doc_id: r.labels for r in license_scan.license_labels(documents(spark, list(cases))).collect()}
    base = {t: {v for k, v in license_scan.PHRASES.items() if k in t.lower()} for t in cases}
    assert {t: got[i] for i, t in enumerate(cases)} == {t: ",".join(sorted(base[t] | ({label} if label else set()))) for t, label in cases.items()}
