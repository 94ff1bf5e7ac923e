"""What judging a batch of the queue costs, and codes of objects that are told without printing them."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from eventmart.operators import quality
from eventmart.streaming import ingest

RECORD = {"occurred_at": "2026-06-01T10:00:00+00:00", "event_type": "order_placed", "product": {"product_id": "p"}, "customer": {"customer_id": "c"}}


def codes(spark, *changes):
    rows = [(i, json.dumps(RECORD | change)) for i, change in enumerate(changes)]
    return [r.c for r in spark.createDataFrame(rows, "i int, body string").select("i", quality.json_errors().alias("c")).orderBy("i").collect()]


def test_a_batch_parses_each_body_once_for_its_codes(spark):
    judged = ingest.judged(spark.createDataFrame([(json.dumps(RECORD),), ("[1]",), ("garbage",)], "value string"))
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
    assert [(r.lost, r.reasons) for r in judged.orderBy("_order").collect()] == [(False, []), (True, ["undecodable"]), (True, ["undecodable"])]


def test_objects_are_not_printed_for_their_kind(spark):
    """A schema is printed only of what is no object."""
    plan = spark.createDataFrame([("{}",)], "body string").select(quality.json_errors().alias("c"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("schemaOfVariant") and "schemaOfVariant(lambda" not in plan


def test_codes_of_odd_objects(spark):
    empty, text, listed, nested, null, filled = codes(spark, {"product": {}}, {"product": "{}", "customer": "{}"}, {"product": [], "order": [1]}, {"product": {"product_id": {}}, "customer": {"customer_id": None}}, {"product": None, "order": None}, {"product": {"price": "abc"}, "customer": {"name": "x"}})
    assert empty == ["missing:product", "missing:product.product_id"]
    assert text == ["missing:product", "missing:customer", "not_an_object:product", "not_an_object:customer"]
    assert listed == ["missing:product", "not_an_object:product", "not_an_object:order"]
    assert nested == [] and null == ["missing:product"]
    assert filled == ["missing:product.product_id", "invalid_type:product.price"]


def test_nested_names_count_and_plain_ones_are_not_read_as_json(spark):
    rows = [(('{"name": "Shoes"}', "plain"),), (("a {b} c", ' {"slug": "s"}'),), (("[1]", None),)]
    texts = ingest.decode(ingest.messages(spark.createDataFrame([(json.dumps(RECORD | {"product": dict(zip(("category", "brand"), r[0], strict=True))}),) for r in rows], "value string"))).select("record.*")
    got = ingest.normalize(texts).select("product.category", "product.brand")
    assert {tuple(r) for r in got.collect()} == {("Shoes", "plain"), ("a {b} c", "s"), ("[1]", None)}


def test_text_of_accepted_records_is_not_shuffled(spark, tmp_path, monkeypatch):
    seen, original = [], ingest.first_of_each
    monkeypatch.setattr(ingest, "first_of_each", lambda rows: seen.append(rows) or original(rows))
    ingest.staged(spark.createDataFrame([(json.dumps(RECORD),), ("garbage",)], "value string"), 0, str(tmp_path / "stage"))
    assert sorted((r.body or "", len(r.reasons)) for r in seen[0].select("body", "reasons").collect()) == [("", 0), ("garbage", 1)]
    kept = spark.read.text(f"{tmp_path}/stage/messages/zone=quarantine").select(F.get_json_object("value", "$.record").alias("r")).collect()
    assert [r.r for r in kept] == ["garbage"]
