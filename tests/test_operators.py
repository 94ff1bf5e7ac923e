"""Operators on small rows of our own."""

from __future__ import annotations

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from eventmart.operators import gold, load, quality, ranking, silver
from eventmart.plans.paths import Lake, gold_tables
from eventmart.sources import catalog, partner, warehouse
from eventmart.sources.schema import SILVER

FLAT = ["occurred_at", "event_type", "session_id", "product_id", "product_name", "price", "customer_id", "order_id", "quantity", "discount_pct", "ingested_at"]


def flat(spark, *rows):
    full = [{**dict.fromkeys(FLAT), "occurred_at": "2026-06-24T10:00:00Z", "event_type": "product_viewed", "session_id": "s1", "product_id": "sku-1", "product_name": "Lamp", "price": "100", "customer_id": "c1"} | r for r in rows]
    return spark.createDataFrame([[r[c] for c in FLAT] for r in full], ", ".join(f"{c} string" for c in FLAT))


def records(spark, *rows):
    return partner.add_identity(partner.lift_flat(flat(spark, *rows)), "t")


def table(spark, *rows):
    return silver.to_silver(records(spark, *rows))


def test_price_categories(spark):
    got = table(spark, *[{"price": p, "product_id": f"p{i}"} for i, p in enumerate(("19.99", "99", "599", None))])
    assert [r[0] for r in got.orderBy("product_id").select("price_category").collect()] == ["budget", "mid", "premium", "unknown"]


def test_signed_amounts(spark):
    got = table(spark, *[{"event_type": k} for k in ("order_placed", "refund_issued", "order_cancelled", "product_viewed")])
    assert dict(got.select("event_type", "signed_net_amount").collect()) == {"order_placed": 100.0, "refund_issued": -100.0, "order_cancelled": -100.0, "product_viewed": 0.0}


def test_latest_arrival_wins(spark):
    got = table(spark, {"product_name": "old", "ingested_at": "2026-06-24T10:00:05+00:00"}, {"product_name": "new", "ingested_at": "2026-06-24T11:00:05+00:00"}, {"product_name": "none"}).collect()
    assert len(got) == 1 and got[0].product_name in ("new", "none")


def test_identity_has_one_form_of_utc(spark):
    a, b = (records(spark, {"occurred_at": t}).first() for t in ("2026-06-24T10:00:00Z", "2026-06-24T10:00:00+00:00"))
    assert a.idempotency_key == b.idempotency_key and a.occurred_at == "2026-06-24T10:00:00+00:00"
    assert records(spark, {"occurred_at": "2026-06-24T12:00:00.5+02:00"}).first().occurred_at == "2026-06-24T10:00:00.500000+00:00"


def test_checks_name_every_failure(spark):
    good, bad = partner.split_on_checks(records(spark, {}, {"occurred_at": "2026-13-45T12:00:00", "product_id": ""}, {"price": "abc"}))
    assert good.count() == 1 and sorted(r.failed_checks for r in bad.collect()) == [["numbers_parsed"], ["occurred_at_parsed", "product_id_present"]]
    assert partner.split_on_checks(records(spark, {}), {"unknown": "CAST(NULL AS BOOLEAN)"})[0].isEmpty()


def test_clean_resets_out_of_range(spark):
    got = table(spark, {"quantity": "9999", "discount_pct": "500"}).first()
    assert (got.quantity, got.discount_pct) == (1, 0.0)


def test_session_measures(spark):
    at = lambda m: f"2026-06-24T10:{m:02d}:00Z"
    got = gold.sessions(table(spark, *[{"event_type": k, "occurred_at": at(m), "order_id": "o" if k == "order_placed" else None} for m, k in ((0, "product_viewed"), (2, "add_to_cart"), (3, "checkout_started"), (5, "order_placed"))])).first()
    assert (got.events, got.duration_seconds, got.converted, got.bounced, got.revenue) == (4, 300, True, False, 100.0)


def test_funnel_rates(spark):
    reached = [("product_viewed", 4), ("add_to_cart", 2), ("checkout_started", 1), ("order_placed", 1)]
    got = gold.funnel_daily(table(spark, *[{"event_type": k, "session_id": f"s{i}"} for k, n in reached for i in range(n)])).first()
    assert (got.view_to_cart_pct, got.cart_to_checkout_pct, got.checkout_to_order_pct, got.overall_conversion_pct) == (50.0, 50.0, 100.0, 25.0)
    assert gold.funnel_daily(table(spark, {"event_type": "product_searched"})).first().view_to_cart_pct == 0.0


def test_orders_and_reversals(spark):
    placed = [{"event_type": "order_placed", "order_id": "o1", "quantity": "2"}, {"event_type": "order_placed", "order_id": "o1", "product_id": "sku-2", "price": "50"}]
    got = gold.orders(table(spark, *placed)).first()
    assert (got.line_items, got.units, got.net_amount, got.status, got.avg_item_value) == (2, 3, 250.0, "completed", 83.33)
    got = gold.orders(table(spark, {"event_type": "order_placed", "order_id": "o2"}, {"event_type": "refund_issued", "order_id": "o2"})).first()
    assert (got.refunded, got.realized_revenue, got.status) == (True, 0.0, "refunded")


def test_rfm(spark):
    got = gold.customer_rfm(table(spark, {"event_type": "order_placed", "order_id": "a", "customer_id": "x", "occurred_at": "2026-06-01T00:00:00Z"}, {"event_type": "order_placed", "order_id": "b", "customer_id": "y"}, {"customer_id": "z"}))
    r = {x.customer_id: x for x in got.collect()}
    assert (r["x"].recency_days, r["y"].recency_days, r["z"].is_buyer, r["z"].rfm_segment) == (23, 0, False, None)
    assert r["y"].r_score > r["x"].r_score


def test_top_products(spark):
    got = gold.product_daily(table(spark, *[{"event_type": "order_placed", "product_id": f"sku-{i}", "price": str(i)} for i in range(1, 5)]), 2)
    assert [r.product_id for r in got.orderBy("revenue_rank").collect()] == ["sku-4", "sku-3"]


def test_anomalies(spark):
    got = gold.anomalies(table(spark, {"quantity": "50", "discount_pct": "90"}, {"session_id": None, "event_type": "order_placed"}, {"session_id": None, "event_type": "order_placed", "product_id": "p2"}))
    assert [(r.reasons, r.severity) for r in got.collect()] == [(["bulk_quantity", "extreme_discount"], "high")]


@pytest.mark.parametrize("rows", [0, 1, 4, 5, 7, 103])
def test_ntile_equals_the_window_function(spark, rows):
    df = spark.range(rows).withColumn("v", F.col("id") * 37 % 11)
    from pyspark.sql import Window

    want = {r.id: r.b for r in df.withColumn("b", F.ntile(5).over(Window.orderBy("v", "id"))).collect()}
    assert all({r.id: r.b for r in ranking.ntile(df, 5, [F.asc("v"), F.asc("id")], "b", small=s).collect()} == want for s in (0, 1_000))


def test_summary_and_verdict(spark):
    raw = records(spark, {}, {"product_id": None})
    row = quality.summary(raw, silver.clean(silver.flatten(raw)), silver.to_silver(raw)).first().asDict()
    assert (row["retention_pct"], row["dropped_records"], row["duplicate_records"]) == (50.0, 1, 0)
    assert quality.verdict(row) == ("fail", ["min_pass_pct"])
    with pytest.raises(quality.QualityBreach):
        quality.enforce(row)
    assert quality.verdict(row, {"min_pass_pct": 0, "max_null_pct:order_id": 50})[1] == ["max_null_pct:order_id"]
    empty = raw.limit(0)
    row = quality.summary(empty, silver.clean(silver.flatten(empty)), silver.to_silver(empty)).first().asDict()
    assert (row["retention_pct"], row["days"]) == (0.0, 0)


def test_json_codes(spark):
    bodies = ["[1]", "{}", '{"occurred_at": "soon", "event_type": "x", "product": 5, "customer": {"customer_id": "c"}}', '{"occurred_at": 7, "event_type": "x", "product": {"product_id": "p", "price": "abc"}, "customer": {"a": 1}, "order": {"quantity": 500, "net_amount": -1}}']
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    got = [r.e for r in df.select("i", quality.json_errors().alias("e")).orderBy("i").collect()]
    assert got[0] == ["not_a_dict"]
    assert got[1] == [f"missing:{f}" for f in ("occurred_at", "event_type", "product", "customer")]
    assert got[2] == ["not_an_object:product", "invalid_format:occurred_at"]
    assert got[3] == ["invalid_type:occurred_at", "invalid_type:product.price", "out_of_range:order.quantity", "out_of_range:order.net_amount"]


def test_report(spark):
    now = F.to_timestamp(F.lit("2026-06-24 12:00:00"))
    got = quality.report(records(spark, {}, {"customer_id": None}, {"product_id": None}), now).first()
    assert (got.records, got.failed, got.warned, got.verdict, got.breaches) == (3, 1, 1, "fail", ["min_pass_pct"])
    empty = quality.report(records(spark, {}).limit(0), now).first()
    assert (empty.pass_pct, empty.verdict) == (100.0, "pass")


def test_catalogs(spark, tmp_path):
    (tmp_path / "a.csv").write_text('sku,title,price\np1,Lamp,"9,5"\np2,,1\n')
    (tmp_path / "b.json").write_text('{"items": [{"id": "p1", "name": "Other", "price": 1}, {"id": "p3", "name": "Chair", "price": 2.5}]}')
    got, outcome = catalog.load(spark, [str(tmp_path / x) for x in ("a.csv", "gone.csv", "b.json")])
    assert sorted((r.product_id, r.name, r.price) for r in got.collect()) == [("p1", "Lamp", 9.5), ("p3", "Chair", 2.5)]
    assert list(outcome.values()) == ["read", "skipped", "read"]


def test_merge_takes_new_keys_once(spark):
    staging = spark.createDataFrame([Row(idempotency_key=k, ingested_at=t, v=v) for k, t, v in (("a", "1", 1), ("b", "1", 2), ("b", "2", 3), (None, "1", 4), ("c", None, 5))])
    got = load.new_rows(staging, staging.filter("idempotency_key = 'a'"))
    assert sorted(r.v for r in got.collect()) == [3, 5]
    assert load.repeated_keys(staging.filter("v < 4"), "idempotency_key").first()["count"] == 2


def test_jdbc_append_and_truncate(spark, tmp_path):
    url, df = f"jdbc:derby:{tmp_path}/db;create=true", spark.range(3)
    load.write_jdbc(df, url, "t")
    load.write_jdbc(df, url, "t")
    read = lambda: spark.read.format("jdbc").options(url=url, dbtable="t").load().count()
    assert read() == 6
    load.write_jdbc(df, url, "t", "overwrite")
    assert read() == 3


def test_funnel_leaves_out_events_without_a_session(spark):
    got = gold.funnel_daily(table(spark, {"event_type": "order_placed"}, {"event_type": "order_placed", "session_id": None, "customer_id": "c2", "product_id": "p2"})).first()
    assert (got.sessions, got.customers, got.revenue, got.revenue_per_session) == (1, 1, 100.0, 100.0)


def test_defaults_and_rounding(spark):
    got = table(spark, {"price": None}, {"price": "9.999", "discount_pct": "12.345", "product_id": "p2"}).orderBy("product_id").collect()
    assert (got[1].discount_amount, got[1].net_amount, got[1].product_price) == (0.0, None, None)
    assert (got[0].unit_price, got[0].discount_pct) == (10.0, 12.35)


def test_a_bare_date_is_no_event_time(spark):
    assert records(spark, {"occurred_at": "2026-06-24"}).first().occurred_at is None
    assert quality.schema_errors(records(spark, {}).withColumn("occurred_at", F.lit("2026-06-24"))).first().errors == []


def test_nested_categories(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": "p1", "name": "Lamp", "price": 1, "category": {"name": "Lamps", "slug": "l"}}, {"id": "p2", "name": "Rug", "price": 2, "category": {"slug": "rugs"}}]')
    got = catalog.products(catalog.read_catalog(spark, f"{tmp_path}/a.json")).orderBy("product_id").collect()
    assert [(r.category, r.sku) for r in got] == [("Lamps", "p1"), ("rugs", "p2")]


def test_warehouse_shapes(spark):
    got = warehouse.shaped(table(spark, {"price": "9.999"}), "fact_events")
    assert got.columns == warehouse.schema("fact_events").names == SILVER and str(got.first().unit_price) == "10.00"
    assert all(set(k) <= set(warehouse.schema(t).names) for t, k in warehouse.KEYS.items())
    for name, build in (("fact_sessions", gold.sessions), ("fact_orders", gold.orders), ("dim_customer_rfm", gold.customer_rfm), ("agg_funnel_daily", gold.funnel_daily), ("agg_product_daily", gold.product_daily), ("fact_anomalies", gold.anomalies)):
        made = build(table(spark, {"event_type": "order_placed", "order_id": "o"}))
        assert set(made.columns) == set(warehouse.schema(name).names) and warehouse.shaped(made, name).count() <= 1
    with pytest.raises(ValueError):
        warehouse.shaped(spark.range(1), "fact_orders")


def test_paths_by_configuration():
    lake = Lake.from_config({"OUTPUT_BUCKET": "b", "CURATED_PREFIX": "/curated/", "RAW_S3_PATH": "s3://x/raw/", "PROCESSED_PREFIX": "done", "GOLD_ORDERS_S3_PATH": "s3://y/o", "BRONZE_PREFIX": "b0"})
    assert [lake.path(*p) for p in (("gold", "sessions"), ("bronze", "events"), ("silver", "events"), ("gold", "orders"), ("bronze", "x"), ("quality",))] == ["s3://b/curated/sessions", "s3://x/raw", "s3://b/done", "s3://y/o", "s3://b/b0/x", "s3://b/quality"]


def test_paths():
    lake = Lake("/lake/", {"gold/orders": "/else/orders"})
    assert lake.path("gold", "orders", "x") == "/else/orders/x" and lake.path("bronze") == "/lake/bronze"
    assert gold_tables([]) == [] and len(gold_tables()) == 6
    with pytest.raises(ValueError):
        gold_tables(["nope"])
