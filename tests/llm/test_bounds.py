"""Work and memory that repeats in texts, rows, keys and weights must not blow up."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from eventmart.llm import decontaminate, license_scan, mixing, quality, substring_dedup, toxicity
from test_llm import SCHEMA, documents

LINE = "licensed under the apache license version 2 0"


def test_stretches_equal_a_set_of_places():
    rng = random.Random(3)
    for _ in range(50):
        s, places = license_scan.Stretches(), set()
        for _ in range(30):
            a = rng.randrange(60)
            b = a + rng.randrange(1, 9)
            assert s.meets(a, b) == any(x in places for x in range(a, b))
            if rng.random() < 0.5:
                s.add(a, b)
                places |= set(range(a, b))
        assert all(x < y for x, y in zip(s.stops, s.firsts[1:], strict=False)) and sum(b - a for a, b in zip(s.firsts, s.stops, strict=True)) == len(places)


def test_many_licence_lines_take_linear_time(spark):
    text = "\n".join("This work is licensed under CC BY 4.0. Released under the MIT License. Licensed under the Apache License, Version 2.0." for _ in range(14_000))
    began = time.time()
    got = license_scan.license_labels(documents(spark, [text])).first()
    assert time.time() - began < 25 and {"apache", "mit"} <= {x.split("-")[0] for x in got.labels.split(",")}


def test_one_word_repeated_meets_on_every_diagonal(spark):
    items = spark.createDataFrame([(1, "word " * 20), (2, "word other " * 10)], "item_id long, text string")
    began = time.time()
    got = decontaminate.contamination(documents(spark, ["word " * 100_000, "word " * 12, "x " + "word " * 13]), items).orderBy("doc_id").collect()
    assert time.time() - began < 60
    assert [(r.n_hit, r.n_items) for r in got] == [(100_000, 1), (0, 0), (13, 1)]


def test_repeated_rows_share_their_stretches(spark):
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefgh ") for _ in range(2_000))
    df = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(text).alias("text")).repartition(4)
    began = time.time()
    got = substring_dedup.without_repeats(df).groupBy("n_bytes", "n_removed", "n_spans").count().collect()
    assert [tuple(r) for r in got] == [(2_000, 2_000, 1, 20_000)] and time.time() - began < 60


def test_a_labelled_key_of_many_rows_counts_once(spark, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["good", "bad", "fine", "awful"]) for _ in range(8)) for _ in range(200)]
    rows = [(i % 40 if i < 100 else 7, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    taken = toxicity.labelled_texts(docs, labels, "toxic", F.lit(True), "doc_id", "text", 1_000).count()
    assert taken == 40
    assert quality.quality_scores(docs, labels).count() == 200 and toxicity.toxicity_scores(docs, labels).count() == 200


def test_weights_that_ask_for_too_much_are_refused(spark):
    with pytest.raises(ValueError, match="too small weights"):
        mixing.plan({"a": 100, "b": 100}, {"a": 1.0, "b": 1e-6})
    places, _, _ = mixing.plan({"a": 100, "b": 100}, {"a": 1.0, "b": 1e-4})
    assert len(places) <= mixing.MOST_SLOTS
    shuffled = documents(spark, ["t"] * 50).repartition(7).withColumn("source", F.lit("one"))
    assert sorted(r.doc_id for r in mixing.schedule(shuffled).collect()) == list(range(50))
