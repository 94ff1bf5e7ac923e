"""Drops of differing headers, merges in the target, retries of the stream, layout of silver, late rows, other time zones."""

from __future__ import annotations

import json
import random
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import pytest
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from eventmart.operators import gold, load, ranking
from eventmart.plans import jobs
from eventmart.plans.paths import Lake
from eventmart.sources import catalog, partner
from eventmart.streaming import ingest
from test_jobs import HEAD, event


@contextmanager
def zone(spark, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", name)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def tables(lake, spark):
    return {z: sorted(r.value for r in spark.read.option("recursiveFileLookup", True).text(lake.path(*z.split("/"))).select("value").collect()) for z in ("bronze", "quarantine/landing")}


def test_drops_of_differing_headers(spark, tmp_path):
    lake = Lake(str(tmp_path))
    (tmp_path / "landing/partner [x]").mkdir(parents=True)
    (tmp_path / "landing/a.csv").write_text("occurred_at,event_type,product_id,price\n2026-06-24T10:00:00Z,product_viewed,sku-1,10\n")
    (tmp_path / "landing/b.csv").write_text('event_type,occurred_at,sku,"price"\nproduct_viewed,2026-06-24T10:00:01Z,sku-2,20\n')
    (tmp_path / "landing/partner [x]/C.CSV").write_text("﻿Event_Type,occurred_at,product_id,note\nproduct_viewed,2026-06-24T10:00:02Z,sku-3,more\n")
    (tmp_path / "landing/only_header.csv").write_text("occurred_at,event_type\n")
    assert jobs.land(spark, lake) == {"accepted": 3, "rejected": 0, "files": 4, "archived": 4}
    got = {(r.id, r.price) for r in partner.read_events(spark, lake.path("bronze")).select("product.product_id", "product.price").toDF("id", "price").collect()}
    assert got == {("sku-1", 10.0), ("sku-2", 20.0), ("sku-3", None)}


def test_what_was_archived_is_not_listed(spark, tmp_path):
    for name in ("a.csv", "sub/b.ndjson", "archive/dt=1/c.csv", "queue/d.json", "sub/archive/e.csv", "_tmp/f.csv"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x\n")
    got = partner.list_drops(spark, str(tmp_path))
    assert [f.rpartition(f"{tmp_path}/")[2] for f in got["csv"] + got["json"]] == ["a.csv", "sub/b.ndjson"]
    assert partner.list_drops(spark, str(tmp_path / "gone")) == {"csv": [], "json": []}


def test_other_time_zones_change_nothing(spark, tmp_path):
    def run(name):
        lake = Lake(str(tmp_path / name))
        (tmp_path / name / "landing/queue").mkdir(parents=True)
        (tmp_path / name / "landing/a.csv").write_text(HEAD + "2026-06-24T02:00:00Z,product_viewed,s,sku-1,10,c,,1\n2026-06-24 01:30,order_placed,s,sku-1,10,c,o,1\nnever,x,s,,10,c,,1\n")
        now = F.lit("2026-06-25T00:00:00+00:00")
        assert jobs.land(spark, lake, now)["accepted"] == 2
        landed = tables(lake, spark)
        jobs.refine(spark, lake)
        jobs.build_gold(spark, lake)
        (tmp_path / name / "landing/queue/a.json").write_text(json.dumps(event(4)) + "\n")
        ingest.start(spark, lake, str(tmp_path / name / "checkpoint")).awaitTermination(120)
        days = sorted(p.relative_to(tmp_path / name).as_posix() for z in ("bronze", "silver", "gold") for p in (tmp_path / name / z).rglob("*=*") if p.is_dir())
        plain = [sorted(map(str, spark.read.parquet(lake.path("gold", t)).select(*[F.col(c).cast("double") if k == "timestamp" else F.col(c) for c, k in spark.read.parquet(lake.path("gold", t)).dtypes]).collect())) for t in ("sessions", "orders")]
        return landed, days, plain

    utc = run("utc")
    with zone(spark, "America/New_York"):
        assert run("york") == utc
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"  # a job leaves the session as it was
    assert "bronze/dt=2026-06-24/hour=02" in utc[1] and "T02:00:00+00:00" in "".join(utc[0]["bronze"])


def rows(spark, *events, price=1.0):
    return spark.createDataFrame([Row(idempotency_key=k, ingested_at=t, price=price, note=n) for k, t, n in events], "idempotency_key string, ingested_at string, price double, note string")


def test_merge_in_the_target(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    read = lambda: {(r.idempotency_key, r.note) for r in spark.read.format("jdbc").options(url=url, dbtable="facts").load().select("idempotency_key", F.col("note").cast("string").alias("note")).collect()}
    assert load.merge_jdbc(rows(spark, ("a", "1", "old"), ("a", "2", "new"), (None, "3", "lost"), ("b", None, "b")), url, "facts", ["idempotency_key"]) == 2
    assert read() == {("a", "new"), ("b", "b")}
    assert load.merge_jdbc(rows(spark, ("a", "9", "later"), ("c", "1", "c")), url, "facts", ["idempotency_key"]) == 1
    assert read() == {("a", "new"), ("b", "b"), ("c", "c")}
    # loads at once leave one row for each key
    with ThreadPoolExecutor(4) as pool:
        counts = list(pool.map(lambda n: load.merge_jdbc(rows(spark, *[(f"k{i}", str(n), str(n)) for i in range(50)]), url, "facts", ["idempotency_key"]), range(4)))
    assert sum(counts) == 50 and spark.read.format("jdbc").options(url=url, dbtable="facts").load().groupBy("idempotency_key").count().filter("count > 1").isEmpty()
    with load.Jdbc(spark, url) as db:  # no staging table is left
        with pytest.raises(Exception, match="STG"):
            db.run("DROP TABLE stg_facts_gone")
    loader = load.jdbc_loader(url)
    assert [(loader(rows(spark, ("x", "1", "x"), ("a", "1", "a")), load.Target("", "facts", "merge")), loader.inserted["facts"]) for _ in range(2)] == [(2, 1), (2, 0)]


def test_merge_statements():
    one = load.insert_absent("jdbc:postgresql://h/d", "s.t", "s.stg", ['"k"', '"v"'], ['"k"'])
    assert one == 'INSERT INTO s.t ("k", "v") SELECT "k", "v" FROM s.stg WHERE true ON CONFLICT ("k") DO NOTHING'
    assert load.insert_absent("jdbc:mysql://h/d", "t", "stg", ["k"], ["k"]).startswith("INSERT IGNORE INTO t")
    assert load.insert_absent("jdbc:derby:x", "t", "stg", ["k"], ["k"]).startswith("MERGE INTO t t USING stg s ON t.k = s.k")


def test_repeated_keys_are_named(spark, tmp_path):
    made = spark.createDataFrame([("o7", "c1"), ("o7", "c2"), ("o8", "c"), (None, "c")], "order_id string, customer_id string")
    made.write.parquet(f"{tmp_path}/gold/orders")
    spark.createDataFrame([("o8", "c")], made.schema).write.parquet(f"{tmp_path}/gold/more")
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    target = lambda d, **more: load.Target(d, "fact_orders", "append", columns=["order_id", "customer_id"], **more)
    outcome = load.load_tables(spark, str(tmp_path), load.jdbc_loader(url), [target("gold/orders")])
    assert outcome["fact_orders"]["status"] == "refused" and "null; o7" in outcome["fact_orders"]["reason"]
    assert load.load_tables(spark, str(tmp_path), load.jdbc_loader(url), [target("gold/more")])["fact_orders"] == {"status": "loaded", "rows": 1, "mode": "append"}
    with pytest.raises(load.RepeatedKeys):
        load.load_tables(spark, str(tmp_path), load.jdbc_loader(url), [target("gold/orders", optional=False)])
    lacking = load.load_tables(spark, str(tmp_path), load.jdbc_loader(url), [load.Target("gold/more", "t", columns=["gone"])])
    assert "lacks ['gone']" in lacking["t"]["reason"]


def queue(*records):
    return json.dumps({"Records": [{"messageId": f"m{i}", "body": r if isinstance(r, str) else json.dumps(r)} for i, r in enumerate(records)]})


@pytest.mark.parametrize("parts", [1, 7])
def test_first_of_a_batch_wins(spark, tmp_path, parts):
    lake = Lake(str(tmp_path))
    named = lambda i, k, n: event(i, idempotency_key=k, product={"product_id": f"p{i}", "price": 1.0, "name": n})
    lines = [(3, queue(named(1, "k", "third"))), (1, queue(named(1, "k", "first"), named(1, " k ", "second"), named(2, "", "a"), named(2, "  ", "b"))), (2, queue(named(3, "j", "one"), "garbage", named(3, "j", "two"), "garbage"))]
    random.Random(parts).shuffle(lines)
    df = spark.createDataFrame([(v, (n,)) for n, v in lines], "value string, arrival struct<n: int>").repartition(parts)
    got = ingest.write_batch(df, 0, lake)
    names = sorted(r.n for r in partner.read_events(spark, lake.path("bronze")).select(F.col("product.name").alias("n")).collect())
    assert names == ["a", "b", "first", "one"]
    assert (got["received"], got["written"], got["duplicates"], got["rejected"], got["rejected_archived"]) == (9, 4, 3, 2, 2)


def counts(spark, lake):
    return (
        partner.read_events(spark, lake.path("bronze")).count(),
        spark.read.json(lake.path("quarantine", "stream")).count(),
        sorted((r.name, r.value) for r in spark.read.parquet(lake.path("quality", "metrics")).collect()),
    )


@pytest.mark.parametrize("broken", ["jobs.metric_rows", "moved", "publish"])
def test_a_batch_that_fails_is_replayed_without_doubles(spark, tmp_path, monkeypatch, broken):
    batch = spark.createDataFrame([(queue(*[event(i, day=d) for i in range(3) for d in (1, 2)], "garbage", event(9, event_type="")),)], "value string").repartition(3)
    whole, lake = Lake(str(tmp_path / "whole")), Lake(str(tmp_path / "torn"))
    ingest.write_batch(batch, 5, whole)
    calls, original = [], ingest.moved

    def torn(*args, **options):  # after half of the folders
        calls.append(args)
        if len(calls) == 2:
            raise OSError("lost")
        return original(*args, **options)

    def lost(*args, **options):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(f"eventmart.streaming.ingest.{broken}", torn if broken == "moved" else lost)
        with pytest.raises(OSError, match="lost"):
            ingest.write_batch(batch, 5, lake)
    ingest.write_batch(batch, 5, lake)
    assert counts(spark, lake) == counts(spark, whole) and counts(spark, lake)[:2] == (6, 2)
    assert ingest.write_batch(batch, 5, lake) is None  # one that was finished is passed over
    assert counts(spark, lake) == counts(spark, whole)
    ingest.write_batch(batch, 6, lake)
    assert counts(spark, lake)[0] == 12


def test_a_batch_takes_two_writes(spark, tmp_path):
    batch = spark.createDataFrame([(queue(event(1), event(2), "garbage"),)], "value string")
    writes = []
    original = ingest.staged

    def counted(*args):
        before = spark._jsparkSession.sharedState().statusStore().executionsCount()
        out = original(*args)
        spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        writes.append(spark._jsparkSession.sharedState().statusStore().executionsCount() - before)
        return out

    ingest.staged = counted
    try:
        ingest.write_batch(batch, 0, Lake(str(tmp_path)))
    finally:
        ingest.staged = original
    assert writes == [2]


def test_late_rows_wait_for_the_batch_job(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))

    def bronze(*events):
        ingest.write_batch(spark.createDataFrame([(queue(*events),)], "value string"), bronze.n, lake)
        bronze.n += 1
        ingest.start_silver(spark, lake, str(tmp_path / "c")).awaitTermination(120)

    bronze.n = 0
    bronze(event(1, day=20), event(2, day=21))
    bronze(event(1, day=20), event(3, day=20), event(4, day=2), event(4, day=2))  # a copy, a new one, one beyond the horizon, twice
    live = spark.read.parquet(f"{lake.path('silver', 'stream')}/zone=live")
    late = spark.read.parquet(f"{lake.path('silver', 'stream')}/zone=late")
    assert sorted(r.product_id for r in live.collect()) == ["sku-1", "sku-2", "sku-3"]
    assert [(r.product_id, r.partition_date) for r in late.collect()] == [("sku-4", "2026-06-02")]
    assert jobs.late_days(spark, lake) == ["2026-06-02"]
    assert jobs.refine_late(spark, lake)["2026-06-02"]["processed_records"] == 1
    assert jobs.late_days(spark, lake) == [] and [r.product_id for r in jobs.read_silver(spark, lake).collect()] == ["sku-4"]
    # a batch that is replayed replaces what it wrote
    again = partner.read_events(spark, lake.path("bronze")).limit(2)
    for _ in range(2):
        ingest.silver_batch(again, 77, lake, "again")
    assert spark.read.parquet(f"{lake.path('silver', 'stream')}").filter("batch = 'again-00000077'").count() <= 2


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_sessions_and_anomalies_need_no_exchange(spark, tmp_path):
    lake = Lake(str(tmp_path))
    (tmp_path / "landing").mkdir()
    lines = [f"2026-06-{20 + i % 3}T10:{i:02d}:00Z,{'order_placed' if i % 4 == 0 else 'product_viewed'},{'s' + str(i % 7) if i % 5 else ''},sku-{i},10,c{i % 9},o{i},1" for i in range(60)]
    (tmp_path / "landing/a.csv").write_text(HEAD + "\n".join(lines) + "\n")
    jobs.land(spark, lake)
    jobs.refine(spark, lake)
    plain = spark.read.parquet(lake.path("silver", "events"))
    laid = jobs.read_silver(spark, lake)
    assert laid.count() == plain.count() == 60
    assert exchanges(gold.sessions(plain)) >= 1 and exchanges(gold.anomalies(plain)) >= 1
    for build, by in ((gold.sessions, {}), (gold.anomalies, {"by_session": True})):
        made = build(laid, **by)
        assert exchanges(made.drop("distinct_products")) == 0 and exchanges(made) == 0
        assert sorted(map(str, made.collect())) == sorted(map(str, build(plain).select(*made.columns).collect()))
    # one day again replaces that day alone, in its buckets
    before = sorted(map(str, laid.collect()))
    jobs.refine(spark, lake, "2026-06-21")
    assert sorted(map(str, jobs.read_silver(spark, lake).collect())) == before


@pytest.mark.parametrize("n", [0, 1, 4, 5, 7, 103])
def test_ntiles_of_one_sort(spark, n):
    df = spark.range(n).select(F.concat(F.lit("c"), F.col("id")).alias("c"), (F.col("id") * 37 % 3).cast("int").alias("r"), (F.col("id") % 2).alias("f"), (F.col("id") * 7 % 11 / 4).alias("m"))
    scores = {"rs": -F.col("r"), "fs": F.col("f"), "ms": F.col("m")}
    want = sorted(map(tuple, df.withColumns({k: F.ntile(5).over(Window.orderBy(v, "c")) for k, v in scores.items()}).collect()))
    for small in (0, 1_000):
        assert sorted(map(tuple, ranking.ntiles(df, 5, scores, "c", small=small).select("c", "r", "f", "m", *scores).collect())) == want


def test_catalog_counts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,segment,country\nc1,vip,DE\n,x,FR\nc2,,FR\n")
    (tmp_path / "b.ndjson").write_text('{"customer_id": "c1", "city": "Ulm"}\n{"customer_id": "c3", "customer_segment": "new"}\n')
    paths = [str(tmp_path / x) for x in ("a.csv", "b.ndjson", "gone.csv")]
    got, outcome = catalog.load_counted(spark, paths, "customers")
    assert sorted((r.customer_id, r.segment, r.country) for r in got.collect()) == [("c1", "vip", "DE"), ("c2", "unknown", "FR"), ("c3", "new", None)]
    assert [outcome[p] for p in paths] == [{"status": "read", "rows": 3, "usable": 2, "taken": 2}, {"status": "read", "rows": 2, "usable": 2, "taken": 1}, {"status": "skipped", "rows": 0, "usable": 0, "taken": 0}]
