"""Totals of groups whose rows are dealt over parts."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from eventmart.llm.common import stored, with_totals


def test_totals_of_large_and_single_groups(spark):
    rows = [(i, 0 if i % 3 else i) for i in range(3000)]
    table = stored(spark.createDataFrame(rows, "row_id long, g long"), "grouped")
    totals = {"n": (F.count("*"), F.sum), "top": (F.max("row_id"), F.max), "one": (F.min("row_id"), F.min)}
    size = Counter(g for _, g in rows)
    top, one = {g: i for i, g in rows}, {g: i for i, g in reversed(rows)}
    expected = sorted((i, g, size[g], top[g], one[g]) for i, g in rows)
    found = with_totals(table, ["g"], ["row_id"], totals)
    assert sorted(map(tuple, found.select("row_id", "g", "n", "top", "one").collect())) == expected
    some = with_totals(table, ["g"], ["row_id"], totals, "n > 1")
    assert sorted(map(tuple, some.select("row_id", "g", "n", "top", "one").collect())) == [x for x in expected if x[2] > 1]
    assert with_totals(table.limit(0), ["g"], ["row_id"], totals).count() == 0
