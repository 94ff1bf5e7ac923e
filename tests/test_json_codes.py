"""Codes of JSON text."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventmart.operators import quality


def test_json_text_is_parsed_once(spark):
    codes = spark.createDataFrame([('{"product": {"product_id": "p", "price": "abc"}}',), ("[1]",)], "body string").select(F.filter(quality.json_errors(), lambda c: c != "").alias("c"))
    assert codes._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1
    assert [list(r.c) for r in codes.collect()] == [["missing:occurred_at", "missing:event_type", "missing:customer", "invalid_type:product.price"], ["not_a_dict"]]
