"""Batch jobs: landing to bronze, bronze to silver with a quality report, silver to gold."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.columns import iso
from eventmart.functions.observed import totals
from eventmart.operators import gold, quality, silver
from eventmart.plans.paths import GOLD, Lake, gold_tables
from eventmart.plans.scratch import discard
from eventmart.session import job
from eventmart.sources import partner

#: Columns that silver is laid out by, and the one of its buckets. Folders begun before have the second one too, and keep it.
LAYOUT, BY_SESSION = ["partition_date", "partition_hour"], "session_id"
#: Rows of a bucket of silver when its folder is begun, where there are more than one for each core.
BUCKET_ROWS = 500_000
#: Threads that move files of a landing to the zones.
MOVERS = 16
METRICS = "stage string, name string, value double, unit string, dims map<string,string>"


def write_table(df: DataFrame, path: str, *partitions: str, mode: str = "overwrite") -> int:
    """Parquet, replacing only the partitions that df has; the rows written, counted while they are."""
    seen = Observation()
    writer = (df.hint("rebalance", *partitions) if partitions else df).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    (writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partitions) if partitions else writer).parquet(path)
    return totals(seen, "rows")["rows"]


def silver_buckets(spark: SparkSession, lake: Lake) -> int:
    """How many buckets silver's folder has, which is kept beside it; 0 without that note."""
    note = f"{lake.path('silver')}/_layout"
    return int(spark.read.text(note).first()[0]) if partner.children(spark, note) else 0


def silver_table(spark: SparkSession, lake: Lake, schema: T.StructType | None = None, buckets: int | None = None) -> str:
    """Name of a table over silver's folder that knows its layout: days and buckets by session.

    The table holds no data of its own and is made anew for each session from what the folder says. schema: of a folder
    that has no files yet, which gets `buckets` (by default as many as the session has shuffle partitions). Without the note of
    their number a folder is read without buckets.
    """
    path, kept = lake.path("silver", "events"), silver_buckets(spark, lake)
    days = partner.children(spark, path)
    if schema is not None and not kept and not days:
        kept = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.range(1).select(F.lit(str(kept)).alias("value")).coalesce(1).write.mode("overwrite").text(f"{lake.path('silver')}/_layout")
    columns = schema if schema is not None else spark.read.parquet(path).schema
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    name = f"silver_events_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    by_hour = any(f"/{LAYOUT[1]}=" in c for day in days[:1] for c in partner.children(spark, day))
    layout = LAYOUT if by_hour else LAYOUT[:1]
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*[f for f in columns if f.name not in layout], *[f for f in columns if f.name in layout]])
    cluster = f"CLUSTERED BY ({BY_SESSION}) SORTED BY ({BY_SESSION}) INTO {kept} BUCKETS" if kept else ""
    spark.sql(f"CREATE TABLE {name} ({shape}) USING parquet PARTITIONED BY ({', '.join(layout)}) {cluster} LOCATION '{path}'")
    spark.catalog.recoverPartitions(name)
    return name


def silver_tasks(spark: SparkSession, lake: Lake, rows: Callable[[], int], buckets: int | None = None) -> tuple[int, int | None]:
    """Tasks that write silver, and the buckets (those given, else by `rows()`) of a folder that is begun with them; None for other folders."""
    most, kept = int(spark.conf.get("spark.sql.shuffle.partitions")), silver_buckets(spark, lake)
    if kept or partner.children(spark, lake.path("silver", "events")):
        return kept or buckets or most, None
    begun = buckets or min(most, max(spark.sparkContext.defaultParallelism, -(-rows() // BUCKET_ROWS)))
    return begun, begun


def write_silver(df: DataFrame, lake: Lake, buckets: int | None = None, dealt: bool = False) -> int:
    """Replaces the days that df has; the rows written. Rows of a session go to one task, those without one to all.

    A folder that is begun gets `buckets`, by default one for each core or for each BUCKET_ROWS rows, if those are more, and no more
    than shuffle partitions. dealt: df is in such tasks already. There is a task for each bucket, so that a day has few files more than buckets: the work goes by rows, not by files.
    """
    spark, seen = df.sparkSession, Observation()
    tasks, begun = silver_tasks(spark, lake, df.count, buckets)
    name = silver_table(spark, lake, df.schema, begun)
    columns = spark.table(name).columns
    (df if dealt else df.repartition(tasks, silver.deal_key())).observe(seen, F.count(F.lit(1)).alias("rows")).select(*columns).write.mode("overwrite").insertInto(name)
    return totals(seen, "rows")["rows"]


def read_silver(spark: SparkSession, lake: Lake) -> DataFrame:
    """Silver with its layout: what is grouped or ordered by session needs no exchange."""
    return spark.table(silver_table(spark, lake))


def metric_rows(spark: SparkSession, stage: str, values: dict[str, float], dims: dict[str, str] | None = None) -> DataFrame:
    return spark.createDataFrame([(stage, n, float(v), "count", dims or {}) for n, v in values.items()], METRICS).coalesce(1)


def record_metrics(spark: SparkSession, lake: Lake, stage: str, values: dict[str, float], dims: dict[str, str] | None = None) -> None:
    """Run counters as rows of quality/metrics."""
    metric_rows(spark, stage, values, dims).write.mode("append").parquet(lake.path("quality", "metrics"))


@job
def land(spark: SparkSession, lake: Lake, ingested_at: Column | None = None, channel: str = "web", archive: bool = True) -> dict[str, int]:
    """Partner drops to bronze, rejected records to quarantine with the names of the checks they fail.

    Drops are read once: both kinds of records are written to a stage of this run's own and moved to the zones when it is complete.
    The files that were read are then moved to landing/archive, whether their records were accepted or not, so that no run
    reads them again. Where no file waits there is nothing to do.
    """
    drops = partner.list_drops(spark, lake.path("landing"))
    files = sum(map(len, drops.values()))
    if not files:
        record_metrics(spark, lake, "landing", {"files": 0})
        return {"accepted": 0, "rejected": 0, "files": 0, "archived": 0}
    now = ingested_at if ingested_at is not None else iso(F.current_timestamp())
    records = partner.with_partitions(partner.add_identity(partner.read_drops(spark, lake.path("landing"), channel, drops), "landing", now))
    name = f"landing-{uuid.uuid4().hex}"
    stage = lake.path("quality", "stages", name)
    try:
        counts = partner.write_judged(records, stage) | {"files": files}
        places = {}
        for zone, place in (("bronze", lake.path("bronze")), ("quarantine", lake.path("quarantine", "landing"))):
            for day in partner.children(spark, f"{stage}/zone={zone}"):
                for hour in partner.children(spark, day):
                    dt, hh = (x.rpartition("/")[2] for x in (day, hour))
                    places[hour] = f"{place}/{dt}/{hh}" if zone == "bronze" else f"{place}/{dt}"
        with ThreadPool(MOVERS) as pool:
            pool.starmap(lambda source, target: partner.moved(spark, source, target, name, ".json"), places.items())
    finally:
        discard(spark, stage)
    day = datetime.now(timezone.utc).strftime("%Y-%m-%d")
    counts["archived"] = partner.archive(spark, drops, lake.path("landing", "archive", f"dt={day}")) if archive else 0
    record_metrics(spark, lake, "landing", counts)
    return counts


@job
def refine(spark: SparkSession, lake: Lake, process_date: str | None = None, lookback_days: int = 0, thresholds: dict | None = None, stop_on_breach: bool = False) -> dict:
    """Bronze to silver (only the days of the window are replaced), with the summary row and its verdict.

    What is summed up is read from silver itself, where the days that were replaced hold the rows that were written and no others.
    """
    first = process_date and str(date.fromisoformat(process_date) - timedelta(days=lookback_days))
    bronze = silver.window(partner.read_bronze(spark, lake.path("bronze"), first, process_date), process_date, lookback_days)
    found = silver.copies(silver.flatten(bronze)).first()
    tasks, begun = silver_tasks(spark, lake, lambda: found["clean"])
    table = silver.to_silver(bronze) if found["torn"] else silver.dealt_silver(bronze, tasks)
    written = write_silver(table, lake, begun, dealt=not found["torn"])
    # copies of torn keys may lie in several days, of which one may have nothing left, and so is not replaced
    days = [r[0] for r in table.select("partition_date").distinct().collect()] if found["torn"] else found["days"]
    total = spark.range(1).select(F.lit(found["raw"]).alias("raw_records"), F.lit(found["clean"]).alias("clean_records"))
    facts = quality.summary_of(total, read_silver(spark, lake).filter(F.col("partition_date").isin(days)) if written else table.limit(0))
    row = facts.first().asDict()
    outcome, breaches = quality.verdict(row, thresholds)
    done = spark.createDataFrame([row], facts.schema).withColumns({"verdict": F.lit(outcome), "breaches": F.array(*[F.lit(b) for b in breaches]).cast("array<string>"), "dt": F.coalesce(F.lit(process_date), F.date_format(F.current_date(), "yyyy-MM-dd"))})
    try:
        done.coalesce(1).write.mode("append").partitionBy("dt").json(lake.path("quality", "silver"))
    except Exception:  # the table is written; its report is not worth failing for
        logging.getLogger(__name__).exception("quality report")
    record_metrics(spark, lake, "silver", {"processed": row["processed_records"], "dropped": row["dropped_records"]})
    if stop_on_breach:
        quality.enforce(row, thresholds)
    return row | {"verdict": outcome, "breaches": breaches}


def late_days(spark: SparkSession, lake: Lake) -> list[str]:
    """Days of the events that came too late for the stream."""
    found = partner.children(spark, f"{lake.path('silver', 'stream')}/zone=late")
    return [p.rpartition("=")[2] for p in found]


@job
def refine_late(spark: SparkSession, lake: Lake) -> dict[str, dict]:
    """Refines from bronze the days of events that came too late for the stream, and clears them; what `refine` returns, by day.

    A day that is ended on the way is refined again the next time, with the same result.
    """
    out = {}
    for day in late_days(spark, lake):
        out[day] = refine(spark, lake, day)
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{lake.path('silver', 'stream')}/zone=late/partition_date={day}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return out


@job
def build_gold(spark: SparkSession, lake: Lake, process_date: str | None = None, lookback_days: int = 0, tables: list[str] | None = None, top_n: int | None = None, threshold: float = 5000.0) -> dict[str, int]:
    """The chosen gold tables over the window of silver partitions; rows written of each.

    Each table reads the columns that it needs from silver; by its layout, sessions and anomalies are made without an exchange of events.
    """
    events = silver.window(read_silver(spark, lake), process_date, lookback_days, F.to_date("partition_date"))
    built = {
        "sessions": lambda: gold.sessions(events),
        "funnel_daily": lambda: gold.funnel_daily(events),
        "orders": lambda: gold.orders(events),
        "customer_rfm": lambda: gold.customer_rfm(events),
        "product_daily": lambda: gold.product_daily(events, top_n),
        "anomalies": lambda: gold.anomalies(events, threshold, by_session=True),
    }
    rows = {n: write_table(built[n](), lake.path("gold", n), *([GOLD[n]] if GOLD[n] else [])) for n in gold_tables(tables)}
    if rows:
        record_metrics(spark, lake, "gold", rows)
    return rows
