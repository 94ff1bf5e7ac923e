"""Loads by configuration, loads into files, statistics of catalogs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventmart.operators import load
from eventmart.plans import loads
from eventmart.plans.paths import Lake
from eventmart.sources import catalog

LAKE = Lake("/lake", {"gold/orders": "s3://other/orders"})


def shape(config):
    return [(t.dataset, t.table, t.mode, t.optional, t.columns, t.path) for t in loads.targets(config, LAKE)]


def test_no_table_named_loads_the_whole_layout():
    got = shape({})
    assert [t[1] for t in got] == [t.table for t in load.TARGETS] and got[0][2:4] == ("merge", False) and {t[3] for t in got[1:]} == {True}
    assert {t[2] for t in shape({"RDS_WRITE_MODE": "append"})} == {"append"}
    assert got[3][5] == "s3://other/orders" and got[1][5] == "/lake/gold/sessions"


def test_one_table_takes_some_columns_of_the_events():
    assert shape({"RDS_TABLE": "t"}) == [("silver/events", "t", "append", False, loads.ONE_TABLE_COLUMNS, "/lake/silver/events")]


def test_a_list_goes_before_one_table():
    entries = [
        {"table": "a"}, {"dataset": "processed", "table": "b", "optional": True}, {"dataset": "curated/orders", "table": "c", "mode": "overwrite"}, {"dataset": "gold/sessions", "table": "d", "path": "/elsewhere"},
        {"dataset": "s3://x/y/", "table": "e", "required_columns": ["k"]}, {"dataset": "other/z", "table": "f"},
    ]
    got = shape({"RDS_TABLES": entries, "RDS_TABLE": "ignored", "RDS_WRITE_MODE": "merge"})
    assert [g[5] for g in got] == ["/lake/silver/events", "/lake/silver/events", "s3://other/orders", "/elsewhere", "s3://x/y", "/lake/other/z"]
    assert [g[2] for g in got] == ["merge", "merge", "overwrite", "merge", "merge", "merge"] and [g[3] for g in got] == [False, True, True, True, True, True] and got[4][4] == ["k"]


@pytest.mark.parametrize("entries", [[{"dataset": "gold/orders"}], [{"table": "a", "mode": "upsert"}], [{"table": "a"}, {"dataset": "gold/orders", "table": "a"}]])
def test_wrong_configurations_are_errors_before_anything_is_read(entries):
    with pytest.raises(ValueError):
        loads.targets({"RDS_TABLES": entries}, LAKE)


def test_load_into_files_and_into_a_database(spark, tmp_path):
    lake = Lake(f"{tmp_path}/lake")
    made = spark.createDataFrame([("a", "2026-01-01", "old"), ("a", "2026-01-02", "new"), ("b", None, "b"), (None, "x", "lost")], "idempotency_key string, ingested_at string, note string")
    made.write.parquet(lake.path("silver", "events"))
    config = {"RDS_TABLES": [{"table": "facts", "mode": "merge", "required_columns": ["idempotency_key", "ingested_at", "note"]}, {"dataset": "gold/gone", "table": "gone"}]}
    url, loader = f"jdbc:derby:{tmp_path}/db;create=true", loads.FolderLoader(f"{tmp_path}/warehouse")
    jdbc = load.jdbc_loader(url)
    for inserted in (2, 0):
        for write in (loader, jdbc):
            outcome = loads.load_warehouse(spark, lake, write, config)
            assert outcome["facts"] == {"status": "loaded", "rows": 4, "mode": "merge"} and outcome["gone"]["status"] == "skipped"
            assert write.inserted["facts"] == inserted
    for table in (spark.read.parquet(f"{tmp_path}/warehouse/facts"), spark.read.format("jdbc").options(url=url, dbtable="facts").load()):
        assert sorted((r[0], r[1]) for r in table.select("idempotency_key", F.col("note").cast("string")).collect()) == [("a", "new"), ("b", "b")]
    seen = {r["name"]: r["value"] for r in spark.read.parquet(lake.path("quality", "metrics")).filter("stage = 'load'").collect()}
    assert seen["tables"] == 1 and seen["skipped"] == 1 and seen["facts"] == 4


def test_chosen_columns_without_a_key_and_a_missing_one(spark, tmp_path):
    lake, loader = Lake(f"{tmp_path}/lake"), loads.FolderLoader(f"{tmp_path}/warehouse")
    spark.createDataFrame([("o1", 1), ("o1", 2)], "order_id string, units int").write.parquet(lake.path("gold", "orders"))
    target = lambda *columns, **more: {"RDS_TABLES": [{"dataset": "gold/orders", "table": "fact_orders", "required_columns": list(columns), **more}]}
    assert loads.load_warehouse(spark, lake, loader, target("units"))["fact_orders"]["rows"] == 2
    assert "lacks ['gone']" in loads.load_warehouse(spark, lake, loader, target("gone"))["fact_orders"]["reason"]
    assert loads.load_warehouse(spark, lake, loader, target("order_id"))["fact_orders"]["status"] == "refused"
    with pytest.raises(load.RepeatedKeys):
        loads.load_warehouse(spark, lake, loader, target("order_id", optional=False))


def test_an_overwrite_may_make_the_table_anew(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    read = lambda: spark.read.format("jdbc").options(url=url, dbtable="t").load()
    load.write_jdbc(spark.range(3), url, "t")
    load.write_jdbc(spark.range(2).select(F.col("id").alias("other")), url, "t", "overwrite", truncate=False)
    assert [c.lower() for c in read().columns] == ["other"] and read().count() == 2


def test_catalog_statistics(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,title,price\np1,One,\"1,5\"\np1,Again,2\np2,,3\n")
    given = {"PRODUCTS": spark.createDataFrame([("p1", "First", 9.0), (None, "none", 1.0)], "product_id string, name string, price double")}
    got, outcome = catalog.load_counted(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/gone.json"], given=given)
    assert [(r.product_id, r.name) for r in got.collect()] == [("p1", "First")]
    assert catalog.statistics(outcome) == {"sources_used": ["PRODUCTS", f"{tmp_path}/a.csv"], "rows_read": 5, "rows_dropped": 2, "duplicates_removed": 2, "resolved": 1}
    empty = catalog.load_counted(spark, [f"{tmp_path}/gone.json"])
    assert empty[0] is None and catalog.statistics(empty[1]) == {"sources_used": [], "rows_read": 0, "rows_dropped": 0, "duplicates_removed": 0, "resolved": 0}
