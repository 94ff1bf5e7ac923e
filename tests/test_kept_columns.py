"""Silver that is stored for a query holds what the query reads."""

from __future__ import annotations

import pytest

from eventmart import queries
from eventmart.operators import gold


@pytest.mark.parametrize(("name", "more"), [("gold_customer_rfm", []), ("view_customer_360", ["utm_source", "signed_net_amount"])])
def test_only_the_columns_that_are_read_are_stored(spark, monkeypatch, name, more):
    stored = {}
    monkeypatch.setattr(queries, "materialized", lambda df, kept: stored.setdefault(kept, df))
    queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert stored["silver"].columns == [*gold.CUSTOMER_COLUMNS, *more]
