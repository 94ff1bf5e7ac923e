"""The queue path as a stream: decode, judge, deduplicate within the batch, write by event time."""

from __future__ import annotations

import logging
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventmart.functions.columns import blank_to_null, event_time, iso
from eventmart.functions.observed import totals
from eventmart.operators import quality, silver
from eventmart.plans import jobs
from eventmart.plans.paths import Lake
from eventmart.session import configured, settings
from eventmart.sources import partner
from eventmart.sources.partner import moved
from eventmart.sources.schema import EVENT, MAX_TEXT, SILVER

#: An envelope holds messages in one of two lists, is a message, or is the bare record.
MESSAGE = "messageId: string, id: string, body: string"
ENVELOPE = f"struct<Records: array<struct<{MESSAGE}>>, messages: array<struct<{MESSAGE}>>, {MESSAGE}>"


#: Column of the order in which lines arrived; where a source has none, it is the order in which they are read.
ARRIVAL = "arrival"


def messages(lines: DataFrame, column: str = "value") -> DataFrame:
    """message_id, body and _order (arrival of its line, the line, place in its envelope) of each message in each envelope."""
    lines = lines if ARRIVAL in lines.columns else lines.withColumn(ARRIVAL, F.lit(0))
    e = lines.withColumn("line", F.monotonically_increasing_id()).withColumn("e", F.from_json(column, ENVELOPE))
    bare = F.array(F.struct(F.coalesce("e.messageId", "e.id").alias("message_id"), F.coalesce("e.body", column).alias("body")))
    listed = F.transform(F.coalesce("e.Records", "e.messages"), lambda m: F.struct(F.coalesce(m["messageId"], m["id"]).alias("message_id"), m["body"].alias("body")))
    return e.select(ARRIVAL, "line", F.posexplode(F.coalesce(listed, bare)).alias("place", "m")).select("m.message_id", "m.body", F.struct(ARRIVAL, "line", "place").alias("_order"))


def decode(df: DataFrame) -> DataFrame:
    """message_id, body, the codes of the record and itself; record is null where the body is no JSON object, as the codes say."""
    coded = df.withColumn("codes", quality.json_errors("body"))
    return coded.withColumn("record", F.when(~F.array_contains("codes", "not_a_dict"), F.from_json("body", EVENT)))


def normalize(df: DataFrame, now=None) -> DataFrame:
    """Event records with trimmed, bounded texts, blanks as null, a default time and the stream's identity."""
    now = F.current_timestamp() if now is None else now
    text = lambda c: blank_to_null(F.substring(F.trim(c), 1, MAX_TEXT))
    fixed = {f.name: (text(f.name) if f.dataType.simpleString() == "string" else F.col(f.name)) for f in EVENT if f.name not in ("_meta",)}
    for f in EVENT:
        if f.name != "_meta" and f.dataType.simpleString() != "string":
            fixed[f.name] = F.struct(*[(text(f"{f.name}.{g.name}") if g.dataType.simpleString() == "string" else F.col(f"{f.name}.{g.name}")).alias(g.name) for g in f.dataType])
    # a nested category or brand counts by its name, else its slug
    within = lambda c, path: F.when(F.contains(c, F.lit("{")), F.get_json_object(c, path))  # noqa: E731  # plain text costs an exception each time that it is read as JSON
    named = lambda c: F.coalesce(within(F.col(c), "$.name"), within(F.col(c), "$.slug"), F.when(~F.startswith(F.ltrim(c), F.lit("{")), F.col(c)))
    clipped = lambda c: blank_to_null(F.substring(F.trim(c), 1, MAX_TEXT))
    fixed["product"] = fixed["product"].withField("category", clipped(named("product.category"))).withField("brand", clipped(named("product.brand")))
    fixed["occurred_at"] = iso(F.coalesce(event_time(F.col("occurred_at"), whole=False), F.when(text("occurred_at").isNull(), now)))
    fixed["event_type"] = F.coalesce(text("event_type"), F.lit("unknown"))
    out = df.withColumns(fixed)
    order = F.col("order")
    amounts = order.withField("net_amount", F.coalesce(order["amount"], order["net_amount"])).withField("amount", F.coalesce(order["amount"], order["net_amount"]))
    out = out.withColumn("order", F.when(order.isNotNull(), amounts))
    return out.withColumn("event_id", F.coalesce("event_id", F.concat_ws("-", "event_type", "product.product_id", "occurred_at")))


def judged(batch: DataFrame) -> DataFrame:
    """The messages of a batch with `_order`, `codes` and `reasons`; messages without reasons are accepted. Records are judged
    as they came, types included, before anything is filled in."""
    decoded = decode(messages(batch))
    flagged = quality.flag(decoded.select("message_id", "body", "codes", "_order", F.col("record").isNull().alias("lost"), "record.*"))
    typed = F.when((F.size("codes") > 0) & ~F.array_contains("errors", "schema_valid"), F.concat(F.array(F.lit("schema_valid")), "errors")).otherwise(F.col("errors"))
    none = F.array().cast("array<string>")
    return flagged.withColumns({"reasons": F.when(F.col("lost"), F.array(F.lit("undecodable"))).otherwise(typed), **{c: F.when(F.col("lost"), none).otherwise(F.col(c)) for c in ("codes", "warnings")}}).drop("errors")


def first_of_each(rows: DataFrame) -> DataFrame:
    """Of accepted messages with equal keys (trimmed) the first that arrived; all messages without a key, and all rejected ones."""
    key = F.when(F.size("reasons") == 0, blank_to_null(F.col("idempotency_key")))
    once = F.coalesce(F.concat(F.lit("k"), key), F.concat(F.lit("o"), F.to_json("_order")))
    # equal keys are reduced before they are shuffled
    return rows.groupBy(once.alias("_once")).agg(F.min_by(F.struct(*rows.columns), "_order").alias("r")).select("r.*")


def staged(batch: DataFrame, batch_id: int, stage: str) -> dict:
    """Writes a batch's messages to its stage in one pass, and beside them its counters in a second write; the summary.

    What is counted is observed while it is written: messages, failures and warnings as they are judged, rows after the first of
    each key is chosen.
    """
    now = F.current_timestamp()
    before, after = Observation(), Observation()
    failed = F.size("reasons") > 0
    rows = judged(batch).observe(before, F.count(F.lit(1)).alias("received"), F.count_if(failed).alias("rejected"), F.count_if(~F.col("lost")).alias("records"), F.count_if(~F.col("lost") & failed).alias("failed"), F.count_if(~failed & (F.size("warnings") > 0)).alias("warned"))
    rows = rows.withColumn("body", F.when(failed, F.col("body")))  # of accepted records the text is neither sorted nor shuffled
    kept = first_of_each(rows).withColumn("_out", F.struct("message_id", F.when(F.col("lost"), F.substring("body", 1, 2000)).otherwise(F.col("body")).alias("record"), "reasons", "codes", "warnings", iso(now).alias("rejected_at"), F.lit(batch_id).alias("batch_id")))
    rejected = F.size("_out.reasons") > 0
    fixed = normalize(kept.drop("codes", "reasons", "warnings", "lost", "_order", "body"), now)
    stamped = partner.add_identity(fixed.withColumn("_key", F.col("idempotency_key")), "stream", source="queue")
    record = stamped.withColumn("idempotency_key", F.coalesce(blank_to_null(F.col("_key")), "idempotency_key")).withColumn("_meta", F.col("_meta").withField("message_id", F.col("message_id"))).drop("_key", "message_id")
    dated, parts = partner.with_partitions(record), ["zone", "dt", "hour"]
    fields = [c for c in dated.columns if c not in ("dt", "hour", "_out")]
    placed = dated.select(
        F.when(rejected, "quarantine").otherwise("bronze").alias("zone"), F.when(rejected, F.date_format(now, "yyyy-MM-dd")).otherwise(F.col("dt")).alias("dt"), F.when(rejected, "all").otherwise(F.col("hour")).alias("hour"),
        F.when(rejected, F.col("_out")).alias("_out"), *fields,
    )
    # records become text after they are dealt
    out = placed.hint("rebalance", *parts).select(*parts, F.when(F.col("zone") == "quarantine", F.to_json("_out")).otherwise(F.to_json(F.struct(*fields))).alias("value"))
    out.observe(after, F.count_if(F.col("zone") == "bronze").alias("written"), F.count_if(F.col("zone") == "quarantine").alias("archived")).write.mode("overwrite").partitionBy(*parts).text(f"{stage}/messages", compression=partner.PACKING)
    seen = totals(before, "received", "rejected", "records", "failed", "warned") | totals(after, "written", "archived")
    summary = {"batch_id": batch_id, "received": seen["received"], "written": seen["written"], "rejected_archived": seen["archived"], "rejected": seen["rejected"], "duplicates": seen["received"] - seen["rejected"] - seen["written"]}
    summary |= quality.batch_verdict(seen["records"], seen["failed"], seen["warned"], summary["duplicates"])
    counted = {n: v for n, v in summary.items() if isinstance(v, (int, float)) and n != "batch_id"}
    jobs.metric_rows(batch.sparkSession, "stream", counted, {"batch_id": str(batch_id), "verdict": summary["verdict"]}).write.mode("overwrite").parquet(f"{stage}/metrics")
    return summary


def publish(spark: SparkSession, lake: Lake, stage: str, name: str, quarantine: bool = True) -> None:
    """Moves a complete stage to the zones. What a try before this one has moved is in the stage no more, so that no row comes twice."""
    for zone in ("bronze", "quarantine"):
        if zone == "quarantine" and not quarantine:
            continue
        for day in partner.children(spark, f"{stage}/messages/zone={zone}"):
            for hour in partner.children(spark, day):
                dt, hh = (x.rpartition("/")[2] for x in (day, hour))
                moved(spark, hour, lake.path("bronze", dt, hh) if zone == "bronze" else lake.path("quarantine", "stream", dt), name, ".json")
    moved(spark, f"{stage}/metrics", lake.path("quality", "metrics"), name)


def write_batch(batch: DataFrame, batch_id: int, lake: Lake, quarantine: bool = True, stream: str = "queue") -> dict | None:
    """One micro-batch: accepted records to bronze by event time, the others to quarantine with their reasons; its summary.

    Of equal keys in a batch the first that arrived is kept, records without a key all pass, and a key that was
    supplied stays; late records go to their own hour and none are dropped. Counters, pass rate and verdict of the batch
    are recorded. A batch is first written to a stage of its own, which is marked when it is complete, and then moved to
    the zones: one that fails on the way is begun anew if its stage was not complete, else the rest is moved, and
    one that was finished is passed over (None). So a replay doubles nothing, in bronze, quarantine or metrics.
    """
    spark = configured(batch.sparkSession)
    name = f"{stream}-{batch_id:08d}"
    stage, done = lake.path("quality", "stages", name), lake.path("quality", "batches", name)
    files = spark._jvm.org.apache.hadoop.fs
    system = files.Path(stage).getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(files.Path(done)):
        system.delete(files.Path(stage), True)
        return None
    summary, ready = None, files.Path(f"{stage}/_READY")
    if not system.exists(ready):
        system.delete(files.Path(stage), True)
        with settings(spark):
            summary = staged(batch, batch_id, stage)
        system.create(ready, True).close()
    publish(spark, lake, stage, name, quarantine)
    system.create(files.Path(done), True).close()
    system.delete(files.Path(stage), True)
    logging.getLogger(__name__).info("batch %s: %s", batch_id, summary or "moved")
    return summary


def start(spark: SparkSession, lake: Lake, checkpoint: str, source: DataFrame | None = None, available_now: bool = True, archive: str | None = None) -> StreamingQuery:
    """Starts the stream from text files in landing/queue, or from any stream with a `value` column (e.g. Kafka) and, for the
    order of its messages, `arrival` (e.g. a struct of timestamp, partition and offset)."""
    with settings(spark):
        if source is None:
            reader = spark.readStream.option("maxFilesPerTrigger", "100")
            if archive:
                reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
            found = F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start")
            source = reader.text(lake.path("landing", "queue")).withColumn(ARRIVAL, found)
        stream = f"queue-{uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex[:12]}"  # batches are numbered by checkpoint
        rows = source.select(F.col("value").cast("string").alias("value"), *[c for c in source.columns if c == ARRIVAL])
        writer = rows.writeStream.foreachBatch(lambda df, n: write_batch(df, n, lake, stream=stream) and None).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()


def continuous_silver(bronze: DataFrame, horizon: str = "2 days") -> DataFrame:
    """Silver columns of a bronze stream, each key (or natural fields, without one) once within the horizon.

    Rows that come later than the horizon do not appear here; start_silver keeps them aside.
    """
    flat = silver.clean(silver.flatten(bronze)).withColumn("_key", silver.event_key()).withWatermark("occurred_ts", horizon)
    return silver.derive(flat.dropDuplicatesWithinWatermark(["_key"]).drop("_key"))


def high_water(spark: SparkSession, lake: Lake, stream: str, batch_id: int) -> datetime | None:
    """The latest event time of the batches before this one, None where there are none."""
    path = lake.path("quality", "silver_batches", stream)
    if not partner.children(spark, path):
        return None
    return spark.read.schema("latest timestamp, batch_id long").parquet(path).filter(F.col("batch_id") < batch_id).agg(F.max("latest")).first()[0]


def silver_batch(batch: DataFrame, batch_id: int, lake: Lake, stream: str = "silver", horizon: str = "2 days") -> dict:
    """One micro-batch of bronze to silver/stream: events within the horizon to zone=live, each once; those beyond it to zone=late.

    The horizon reaches back from the latest event of the batches before. Copies in a batch are reduced to the latest
    arrival; those of earlier batches can stand only in the days that the horizon reaches back to, and only these are
    looked up. Rows are laid out by batch, so that a batch that is replayed replaces what it wrote. Late rows wait for
    `jobs.refine_late`.
    """
    spark, mine = configured(batch.sparkSession), f"{stream}-{batch_id:08d}"
    rows = silver.derive(silver.deduplicate(silver.clean(silver.flatten(batch)))).select(*SILVER).withColumns({"batch": F.lit(mine), "_key": silver.event_key()})
    before = high_water(spark, lake, stream, batch_id)
    edge = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {horizon}")
    live = f"{lake.path('silver', 'stream')}/zone=live"
    if before is not None and partner.children(spark, live):
        first = spark.range(1).select(F.date_format(edge, "yyyy-MM-dd")).first()[0]
        known = spark.read.schema(rows.drop("_key").schema).parquet(live).filter((F.col("partition_date") >= first) & (F.col("batch") != mine))
        rows = rows.join(known.select(silver.event_key().alias("_key")), "_key", "left_anti")
    rows = rows.withColumn("zone", F.when(F.col("occurred_ts") < edge, "late").otherwise("live")).drop("_key")
    seen = Observation()
    counted = rows.observe(seen, F.count_if(F.col("zone") == "live").alias("live"), F.count_if(F.col("zone") == "late").alias("late"), F.max("occurred_ts").alias("latest"))
    parts = ["zone", "partition_date", "batch"]
    counted.hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(lake.path("silver", "stream"))
    found = totals(seen, "live", "late")
    reached = spark.range(1).select(F.lit(found.get("latest")).cast("timestamp").alias("latest"))
    reached.coalesce(1).write.mode("overwrite").parquet(f"{lake.path('quality', 'silver_batches', stream)}/batch_id={batch_id}")
    return found


def start_silver(spark: SparkSession, lake: Lake, checkpoint: str, horizon: str = "2 days", available_now: bool = True) -> StreamingQuery:
    """Starts the stream from bronze to silver/stream; each batch as in silver_batch."""
    with settings(spark):
        stream = f"silver-{uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex[:12]}"
        schema = T.StructType([*EVENT, T.StructField("dt", T.StringType()), T.StructField("hour", T.StringType())])
        bronze = spark.readStream.schema(schema).json(lake.path("bronze")).drop("dt", "hour")
        writer = bronze.writeStream.foreachBatch(lambda df, n: silver_batch(df, n, lake, stream, horizon) and None).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()
