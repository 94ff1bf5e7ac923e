"""Every registered query over the shop tables against its oracle on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from eventmart.oracles import ORACLES
from eventmart.queries import QUERIES, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def rows(frame):
    import pandas as pd

    frame = frame[sorted(frame.columns)]
    return sorted(tuple("~" if pd.isna(v) else f"{float(v):.6f}" if isinstance(v, float) else str(v) for v in r) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, name):
    db = duckdb.connect()
    for t in ("events", "part", "customer", "nation"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert rows(queries()[name](spark, SF).toPandas()) == rows(db.sql(ORACLES[name]).df())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
