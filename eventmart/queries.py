"""Registered queries over the shop tables, each in plain columns (text for times and lists)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.operators import gold, load, quality, silver
from eventmart.plans import jobs, loads, serve
from eventmart.plans.paths import Lake
from eventmart.plans.scratch import discard, materialized, new_path
from eventmart.session import configured, settings
from eventmart.sources import catalog, partner
from eventmart.sources.adapter import flat_export, table
from eventmart.sources.schema import EVENT
from eventmart.streaming import ingest
from eventmart.streaming.ingest import normalize

#: The time at which the test data is judged.
NOW = "2024-01-30 00:00:00"


def plain(df: DataFrame) -> DataFrame:
    """Timestamps and dates as text, arrays joined by commas, decimals as doubles."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind == "array<string>":
            c = F.concat_ws(",", c)
        elif kind.startswith("decimal"):
            c = c.cast("double")
        elif kind in ("int", "smallint"):
            c = c.cast("long")
        out.append(c.alias(name))
    return df.select(*out)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partner.add_identity(partner.lift_flat(flat_export(configured(spark), sf_dir)), "export")


def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partner.split_on_checks(bronze(spark, sf_dir))[0]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver; what is made of it in one pass reads only the columns that it needs, down to the export."""
    return silver.to_silver(accepted(spark, sf_dir))


def kept_events(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """The columns of silver that are read more than once, stored; the others are neither shuffled nor written."""
    return materialized(events(spark, sf_dir).select(*columns), "silver")


def _lifted(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id", "occurred_at", "event_type", "channel", "session.session_id", F.col("device.type").alias("device_type"), "geo.country", "product.product_id", "product.sku", "product.name", "product.price", "customer.customer_id", "customer.segment",
        "order.order_id", "order.quantity", "order.unit_price", "order.discount_pct", "order.gross_amount", "order.discount_amount", "order.net_amount", "order.currency", "order.payment_method", "marketing.campaign",
    )


def _flags(df: DataFrame) -> DataFrame:
    return quality.flag(df, F.to_timestamp(F.lit(NOW)))


def _merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging: all accepted rows; the table already holds those of the first ten days."""
    staging = materialized(silver.derive(silver.clean(silver.flatten(accepted(spark, sf_dir)))), "staging")
    return load.new_rows(staging, staging.filter("partition_date <= '2024-01-10'")).select("idempotency_key", "event_type", "partition_date", "ingested_at", "product_name", "net_amount")


def _part_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Two sources of the part table: the second one, with comma decimals and other names, adds what the first lacks."""
    part = table(configured(spark), sf_dir, "part")
    first = part.filter("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), F.col("p_type").alias("category"), F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("price"))
    second = part.select(F.col("p_partkey").alias("sku"), F.when(F.col("p_partkey") % 7 != 0, F.upper("p_name")).alias("title"), F.col("p_brand").alias("brand"), F.replace(F.col("p_retailprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(",")).alias("product_price"))
    return {"first": first, "second": second}


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.resolved(_part_sources(spark, sf_dir)).drop("_source")


def _kept(df: DataFrame) -> DataFrame:
    """A gold table that an analysis reads twice, stored as the jobs keep it."""
    return materialized(df, "gold")


def _products(s: SparkSession, d: str) -> DataFrame:
    return serve.product_performance(gold.product_daily(events(s, d)))


def _rfm(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = kept_events(s, d, [*gold.CUSTOMER_COLUMNS, "utm_source", "signed_net_amount"])
    return gold.customer_rfm(e), gold.sessions(e)


def _summary(s: SparkSession, d: str) -> DataFrame:
    raw = materialized(bronze(s, d), "bronze")
    cleaned = silver.clean(silver.flatten(raw))
    out = quality.summary(raw, cleaned, silver.to_silver(raw))
    return out.withColumn("events_by_type", F.array_join(F.transform(F.map_entries("events_by_type"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ","))


def _rejected(s: SparkSession, d: str) -> DataFrame:
    _, bad = quality.partition(bronze(s, d), F.lit(NOW), F.to_timestamp(F.lit(NOW)))
    return bad.select("rejected_at", "reasons", "warnings", F.col("record.idempotency_key").alias("idempotency_key"), F.col("record.ingested_at").alias("ingested_at"))


def _normalized(s: SparkSession, d: str) -> DataFrame:
    """The stream's normalisation of padded records gives the identity that the file path gives."""
    padded = bronze(s, d).filter("occurred_at IS NOT NULL").withColumns({"event_type": F.concat(F.lit("  "), "event_type", F.lit(" ")), "channel": F.concat("channel", F.lit("  "))})
    out = normalize(padded, F.to_timestamp(F.lit(NOW)))
    return out.select(partner.identity().alias("idempotency_key"), "event_id", "event_type", "channel", "occurred_at", F.col("product.name").alias("product_name"), F.col("order.amount").alias("amount"), "ingested_at")


def _dropped(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake whose landing zone holds the export as partner drops: CSV files under two headers of other names and order, and NDJSON."""
    lake, kept = Lake(new_path(configured(spark), "lake")), new_path(spark, "export")
    export = materialized(flat_export(spark, sf_dir), "export", kept)
    part = F.pmod(F.xxhash64("occurred_at", "customer_id", "product_id"), F.lit(3))
    export.filter(part == 0).write.option("header", True).option("escape", '"').csv(lake.path("landing", "one"), compression=partner.PACKING)
    renamed = export.filter(part == 1).withColumnsRenamed({"product_id": "sku", "product_name": "title", "segment": "customer_segment"})
    renamed.select(*sorted(renamed.columns)).write.option("header", True).option("escape", '"').csv(lake.path("landing", "two"), compression=partner.PACKING)
    partner.lift_flat(export.filter(part == 2)).drop("unparsed").write.json(lake.path("landing", "three"), compression=partner.PACKING)
    discard(spark, kept)
    return lake


def _landed(spark: SparkSession, sf_dir: str) -> Lake:
    """That lake after the landing job; arrival times are those of the export. The drops that it archived are read no more, and go."""
    lake = _dropped(spark, sf_dir)
    jobs.land(spark, lake, F.col("ingested_at"))
    discard(spark, lake.path("landing"))
    return lake


def _refined(spark: SparkSession, sf_dir: str, *tables: str) -> Lake:
    """After the jobs that follow, up to the chosen gold tables; bronze goes when silver is made of it."""
    lake = _landed(spark, sf_dir)
    jobs.refine(spark, lake)
    discard(spark, lake.path("bronze"))
    jobs.build_gold(spark, lake, tables=list(tables))
    return lake


#: Parts that the queue's envelopes are dealt over, and messages of a batch (more, if there are more than so many for each part).
PARTS, BATCH_ROWS = 8, 2_000_000


def _streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze of the queue path: the export's records as messages, in envelopes in the order of their arrival.

    The queue is stored and taken in batches; messages of equal keys are of one part and so of one batch, which drops all copies.
    """
    lake, records = Lake(new_path(configured(spark), "lake")), bronze(spark, sf_dir).drop("unparsed")
    body = records.select("ingested_at", "idempotency_key", F.struct(F.col("idempotency_key").alias("messageId"), F.to_json(F.struct(*records.columns)).alias("body")).alias("m"))
    packed = body.groupBy(F.substring("ingested_at", 1, 15).alias("at"), F.pmod(F.xxhash64("idempotency_key"), F.lit(PARTS)).alias("part")).agg(F.transform(F.array_sort(F.collect_list(F.struct("ingested_at", "idempotency_key", "m"))), lambda x: x["m"]).alias("Records"))
    queue = new_path(spark, "queue")
    with settings(spark):
        packed.select(F.to_json(F.struct("Records")).alias("value"), F.struct("at").alias(ingest.ARRIVAL), F.size("Records").alias("n"), "part").write.partitionBy("part").parquet(queue)
    lines = spark.read.parquet(queue)
    batches = min(PARTS, -(-(lines.agg(F.sum("n")).first()[0] or 1) // BATCH_ROWS))
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "16m"}):  # envelopes are ten times as large as their files
        for k in range(batches):
            ingest.write_batch(lines.filter(F.col("part").isin([str(p) for p in range(k, PARTS, batches)])).select("value", ingest.ARRIVAL), k, lake)
    discard(spark, queue)
    schema = T.StructType([*EVENT, T.StructField("dt", T.StringType()), T.StructField("hour", T.StringType())])
    out = spark.read.schema(schema).json(lake.path("bronze"))
    return out.select("idempotency_key", "event_id", "occurred_at", F.col("product.name").alias("product_name"), F.col("order.net_amount").alias("net_amount"), "dt", "hour")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources of the customer table: the second one, with other names and blank segments, adds what the first lacks."""
    people = table(configured(spark), sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    first = people.filter("c_custkey % 4 = 1").select(F.col("c_custkey").alias("customer_id"), F.lower("c_mktsegment").alias("segment"), F.col("n_name").alias("country"))
    second = people.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 5 != 0, F.lower("c_mktsegment")).otherwise(" ").alias("customer_segment"), F.col("c_name").alias("city"))
    return catalog.first_wins([catalog.customers(first), catalog.customers(second)], "customer_id")


#: A load's configuration in the names of older lakes too: merged events, tables by their own mode, chosen columns.
LOAD = {
    "RDS_WRITE_MODE": "overwrite",
    "RDS_TABLES": [
        {"dataset": "processed", "table": "fact_events", "mode": "merge"}, {"dataset": "curated/sessions", "table": "fact_sessions"}, {"dataset": "gold/orders", "table": "fact_orders", "mode": "append"},
        {"dataset": "gold/customer_rfm", "table": "customer_segments", "required_columns": ["customer_id", "rfm_segment", "monetary"]}, {"dataset": "gold/anomalies", "table": "fact_anomalies"}, {"dataset": "gold/gone", "table": "gone"},
    ],
}


def _loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of a load after the jobs, and what a merge repeated by the same load inserts."""
    lake = _refined(spark, sf_dir, "sessions", "orders", "customer_rfm", "anomalies")
    loader = loads.FolderLoader(new_path(spark, "warehouse"))
    outcome = loads.load_warehouse(spark, lake, loader, LOAD)
    got = dict(loader.inserted)
    loads.load_warehouse(spark, lake, loader, {"RDS_TABLES": LOAD["RDS_TABLES"][:1]})
    again = loader.inserted["fact_events"]
    rows = [(t, o["status"], o.get("mode"), o["rows"], got.get(t, 0), again if t == "fact_events" else 0) for t, o in outcome.items()]
    return spark.createDataFrame(rows, "table_name string, status string, mode string, n_rows long, inserted long, inserted_again long")


def _loaded(spark: SparkSession, sf_dir: str, config: dict, table: str) -> DataFrame:
    """A table as a load has left it."""
    lake, folder = _refined(spark, sf_dir, "customer_rfm"), new_path(spark, "warehouse")
    loads.load_warehouse(spark, lake, loads.FolderLoader(folder), config)
    return spark.read.parquet(f"{folder}/{table}")


def _gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(_refined(spark, sf_dir, name).path("gold", name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "lift_flat": lambda s, d: _lifted(bronze(s, d)),
    "event_identity": lambda s, d: bronze(s, d).select("idempotency_key", "event_id", "ingested_at"),
    "event_partitions": lambda s, d: partner.with_partitions(bronze(s, d)).groupBy("dt", "hour").count().withColumnRenamed("count", "events"),
    "bronze_rejects": lambda s, d: partner.split_on_checks(bronze(s, d))[1].select("idempotency_key", "ingested_at", "failed_checks"),
    "normalize_events": _normalized,
    "silver_flatten": lambda s, d: silver.flatten(bronze(s, d)),
    "silver_clean": lambda s, d: silver.clean(silver.flatten(bronze(s, d))).select("idempotency_key", "ingested_at", "product_id", "quantity", "discount_pct", "product_name", "occurred_ts"),
    "silver_derive": lambda s, d: silver.derive(silver.clean(silver.flatten(bronze(s, d)))).select("idempotency_key", "ingested_at", "price_category", "is_revenue_event", "is_conversion", "signed_net_amount", "day_of_week", "is_weekend", "partition_date", "partition_hour"),
    "silver_dedupe": lambda s, d: silver.deduplicate(silver.clean(silver.flatten(accepted(s, d)))).select("idempotency_key", "ingested_at", "product_name"),
    "silver_events": lambda s, d: silver.to_silver(accepted(s, d)),
    "silver_window": lambda s, d: silver.to_silver(accepted(s, d), "2024-01-15", 3).select("idempotency_key", "event_type", "partition_date"),
    "schema_errors": lambda s, d: quality.schema_errors(bronze(s, d), strict=True).select("idempotency_key", "ingested_at", "errors"),
    "quality_flags": lambda s, d: _flags(bronze(s, d)).select("idempotency_key", "ingested_at", "errors", "warnings"),
    "quality_rejects": _rejected,
    "quality_report": lambda s, d: quality.rule_failures(bronze(s, d), F.to_timestamp(F.lit(NOW))),
    "silver_quality_summary": _summary,
    "gold_sessions": lambda s, d: gold.sessions(events(s, d)),
    "gold_funnel_daily": lambda s, d: gold.funnel_daily(events(s, d)),
    "gold_orders": lambda s, d: gold.orders(events(s, d)),
    "gold_customer_rfm": lambda s, d: gold.customer_rfm(kept_events(s, d, gold.CUSTOMER_COLUMNS)),
    "gold_product_daily": lambda s, d: gold.product_daily(events(s, d)),
    "gold_product_top3": lambda s, d: gold.product_daily(events(s, d), 3),
    "gold_anomalies": lambda s, d: gold.anomalies(events(s, d)),
    "merge_new_events": _merge,
    "catalog_products": _catalog,
    "view_revenue_daily": lambda s, d: serve.revenue_daily(events(s, d)),
    "view_funnel": lambda s, d: serve.funnel(gold.funnel_daily(events(s, d))),
    "view_customer_360": lambda s, d: serve.customer_360(*_rfm(s, d)),
    "view_product_performance": _products,
    "view_anomalies_recent": lambda s, d: serve.anomalies_recent(_kept(gold.anomalies(events(s, d)))),
    "q_revenue_month": lambda s, d: serve.revenue_month(_kept(serve.revenue_daily(events(s, d)))),
    "q_funnel_leaks": lambda s, d: serve.funnel_leaks(_kept(gold.funnel_daily(events(s, d)))),
    "q_segment_value": lambda s, d: serve.segment_value(gold.customer_rfm(kept_events(s, d, gold.CUSTOMER_COLUMNS))),
    "q_viewed_not_bought": lambda s, d: serve.viewed_not_bought(_products(s, d), min_views=10),
    "q_reconcile_orders": lambda s, d: serve.reconcile_orders(_kept(gold.orders(e := kept_events(s, d, gold.ORDER_COLUMNS))), e),
    "q_session_quality": lambda s, d: serve.session_quality(_kept(gold.sessions(events(s, d)))),
    "q_anomaly_triage": lambda s, d: serve.anomaly_triage(_kept(gold.anomalies(events(s, d)))),
    "drops_lifted": lambda s, d: _lifted(partner.read_drops(s, _dropped(s, d).path("landing"))),
    "job_quarantine": lambda s, d: s.read.schema("idempotency_key string, ingested_at string, failed_checks array<string>, dt string").json(_landed(s, d).path("quarantine", "landing")).drop("dt"),
    "job_silver_events": lambda s, d: jobs.read_silver(s, _refined(s, d)),
    "job_gold_sessions": lambda s, d: _gold(s, d, "sessions"),
    "job_gold_anomalies": lambda s, d: _gold(s, d, "anomalies"),
    "stream_bronze": _streamed,
    "catalog_customers": _customers,
    "catalog_counts": lambda s, d: catalog.source_counts(_part_sources(s, d)),
    "load_outcome": _loads,
    "load_one_table": lambda s, d: _loaded(s, d, {"RDS_TABLE": "events"}, "events"),
    "load_customer_rfm": lambda s, d: _loaded(s, d, {"RDS_TABLES": [{"dataset": "gold/customer_rfm", "table": "dim_customer_rfm", "mode": "overwrite"}]}, "dim_customer_rfm"),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda s, d, f=f: plain(f(s, d))) for name, f in QUERIES.items()}
