"""Jobs and the stream on a lake in a temporary folder."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from eventmart.operators import load
from eventmart.plans import jobs
from eventmart.plans.paths import Lake
from eventmart.sources import partner
from eventmart.streaming import ingest

HEAD = "occurred_at,event_type,session_id,product_id,price,customer_id,order_id,quantity\n"


def event(i: int, day: int = 24, **more) -> dict:
    return {"occurred_at": f"2026-06-{day:02d}T10:00:{i:02d}+00:00", "event_type": "product_viewed", "channel": "web", "session": {"session_id": "s"}, "product": {"product_id": f"sku-{i}", "price": 5.0}, "customer": {"customer_id": "c"}, **more}


def test_chain_is_repeatable(spark, tmp_path):
    lake = Lake(str(tmp_path))
    (tmp_path / "landing").mkdir()
    lines = [f"2026-06-{d}T10:00:0{i}Z,{k},s{d},sku-{i},10,c{i},{'o' + str(d) if k == 'order_placed' else ''},1" for d in (23, 24) for i, k in enumerate(("product_viewed", "order_placed"))]
    (tmp_path / "landing/a.csv").write_text(HEAD + "\n".join([*lines, "never,product_viewed,s,sku-9,1,c,,1"]) + "\n")
    (tmp_path / "landing/b.ndjson").write_text(json.dumps(event(7)) + "\nnot json\n")
    (tmp_path / "landing/c.txt").write_text("other")
    assert jobs.land(spark, lake, archive=False) == {"accepted": 5, "rejected": 2, "files": 2, "archived": 0}
    first = jobs.refine(spark, lake)
    assert first["processed_records"] == 5
    assert jobs.build_gold(spark, lake)["orders"] == 2
    # one day again replaces only that day
    jobs.refine(spark, lake, "2026-06-24")
    assert spark.read.parquet(lake.path("silver", "events")).count() == 5
    assert jobs.build_gold(spark, lake, "2026-06-24", tables=["sessions"]) == {"sessions": 2}
    assert spark.read.parquet(lake.path("gold", "sessions")).count() == 3
    # the landing read again is removed by the deduplication
    assert jobs.land(spark, lake)["archived"] == 2
    assert jobs.refine(spark, lake)["duplicate_records"] == 5
    assert spark.read.parquet(lake.path("silver", "events")).count() == 5
    assert spark.read.parquet(lake.path("quality", "metrics")).filter("stage = 'gold'").count() == 7
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    for _ in range(2):  # a second load adds nothing
        outcome = load.load_tables(spark, str(tmp_path), load.jdbc_loader(url), [*load.TARGETS[:2], load.Target("gold/gone", "gone")])
        assert outcome["fact_events"] == {"status": "loaded", "rows": 5, "mode": "merge"} and outcome["fact_sessions"]["rows"] == 3 and outcome["gone"]["status"] == "skipped"
        assert [spark.read.format("jdbc").options(url=url, dbtable=t).load().count() for t in ("fact_events", "fact_sessions")] == [5, 3]
    # what was archived is not read again, and one day reads only its folders
    assert jobs.land(spark, lake) == {"accepted": 0, "rejected": 0, "files": 0, "archived": 0}
    day = partner.read_bronze(spark, lake.path("bronze"), "2026-06-24", "2026-06-24")
    assert "PartitionFilters: [isnotnull(dt" in day._jdf.queryExecution().executedPlan().toString() or "dt#" in day._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_drop_folders_of_one_format_or_none(spark, tmp_path):
    lake = Lake(str(tmp_path))
    assert jobs.land(spark, lake)["files"] == 0
    (tmp_path / "landing").mkdir()
    assert jobs.land(spark, lake)["files"] == 0
    (tmp_path / "landing/b.ndjson").write_text(json.dumps(event(7)) + "\n" + json.dumps(event(8, product={"product_id": "p", "price": "abc"}, order={"quantity": "many"})) + "\n")
    (tmp_path / "landing/empty.csv").write_text("")
    assert jobs.land(spark, lake) == {"accepted": 1, "rejected": 1, "files": 1, "archived": 1}
    lost = spark.read.json(lake.path("quarantine", "landing")).first()
    assert list(lost.failed_checks) == ["numbers_parsed"] and list(lost.unparsed) == ["price", "quantity"]


def test_stream(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    queue = tmp_path / "lake/landing/queue"
    queue.mkdir(parents=True)
    good, late, bad = event(1, idempotency_key="k1"), event(2, day=1), event(3, product={"price": 1.0})
    typed = event(5, product={"product_id": "p", "price": "abc"}, order={"quantity": "many"})
    bare = {k: v for k, v in event(6).items() if k not in ("occurred_at", "event_type")}
    nested = event(7, product={"product_id": "sku-7", "category": {"name": "Lamps"}})
    records = {"Records": [{"messageId": f"m{i}", "body": json.dumps(r)} for i, r in enumerate((good, good, late, bad, typed, bare, nested, nested))]}
    (queue / "a.json").write_text(json.dumps(records) + "\n" + json.dumps({"messages": [{"id": "x", "body": "garbage"}]}) + "\n" + json.dumps(event(4)) + "\n")
    ingest.start(spark, lake, str(tmp_path / "checkpoint")).awaitTermination(120)
    bronze = partner.read_events(spark, lake.path("bronze"))
    assert sorted(r[0] for r in bronze.select("product.product_id").collect()) == ["sku-1", "sku-2", "sku-4", "sku-7", "sku-7"]
    assert {r.idempotency_key == "k1" for r in bronze.filter("product.product_id = 'sku-1'").collect()} == {True}
    assert {r.c for r in bronze.filter("product.product_id = 'sku-7'").select(F.col("product.category").alias("c")).collect()} == {"Lamps"}
    assert (tmp_path / "lake/bronze/dt=2026-06-01/hour=10").is_dir()
    lost = spark.read.json(lake.path("quarantine", "stream"))
    assert sorted(tuple(r.reasons) for r in lost.collect()) == [("schema_valid",), ("schema_valid", "product_id_present"), ("schema_valid", "timestamp_parseable"), ("undecodable",)]
    assert {"invalid_type:product.price", "invalid_type:order.quantity"} <= {c for r in lost.collect() for c in r.codes}
    counts = {r.name: r.value for r in spark.read.parquet(lake.path("quality", "metrics")).filter("stage = 'stream'").collect()}
    assert (counts["received"], counts["written"], counts["rejected"], counts["duplicates"]) == (10, 5, 4, 1)
    # a second run reads nothing again
    ingest.start(spark, lake, str(tmp_path / "checkpoint")).awaitTermination(120)
    assert partner.read_events(spark, lake.path("bronze")).count() == 5


def test_both_paths_give_one_key(spark, tmp_path):
    e = event(5)
    flat = spark.createDataFrame([(e["occurred_at"], e["event_type"], "s", "sku-5", "5", "c")], "occurred_at string, event_type string, session_id string, product_id string, price string, customer_id string")
    one = partner.add_identity(partner.lift_flat(flat)).first().idempotency_key
    lines = spark.createDataFrame([(json.dumps(e | {"event_type": " product_viewed "}),)], "value string")
    two = partner.add_identity(ingest.normalize(ingest.decode(ingest.messages(lines)).select("record.*"))).first().idempotency_key
    assert one == two


def test_continuous_silver(spark, tmp_path):
    source = tmp_path / "bronze"
    partner.add_identity(partner.lift_flat(spark.createDataFrame([("2026-06-24T10:00:00Z", "order_placed", "sku-1", "5")] * 2 + [("2026-06-24T11:00:00Z", "order_placed", "sku-2", "5")], "occurred_at string, event_type string, product_id string, price string"))).write.json(str(source))
    stream = ingest.continuous_silver(spark.readStream.schema(partner.EVENT).json(str(source)))
    q = stream.writeStream.format("memory").queryName("silver_now").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("silver_now").count() == 2
    keyless = ingest.continuous_silver(spark.readStream.schema(partner.EVENT).json(str(source)).withColumn("idempotency_key", F.lit(None).cast("string")))
    keyless.writeStream.format("memory").queryName("keyless_now").option("checkpointLocation", str(tmp_path / "d")).trigger(availableNow=True).start().awaitTermination(120)
    assert spark.table("keyless_now").count() == 2
