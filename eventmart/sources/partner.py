"""Partner drops: reading, lifting flat rows to event records, identity and named checks."""

from __future__ import annotations

import csv
import logging
import re
import uuid
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.columns import event_time, iso, named
from eventmart.functions.observed import totals
from eventmart.operators.quality import json_errors
from eventmart.sources.schema import ALIASES, EVENT, SCHEMA_VERSION

# Fields of an event's identity, in order, and the checks that reject a record.
IDENTITY = ["event_type", "occurred_at", "session.session_id", "session.sequence", "product.product_id", "customer.customer_id", "order.order_id"]
CHECKS = {
    "occurred_at_parsed": "occurred_at IS NOT NULL",
    "event_type_present": "event_type IS NOT NULL AND length(event_type) > 0",
    "product_id_present": "product.product_id IS NOT NULL AND length(product.product_id) > 0",
    "price_in_range": "product.price IS NULL OR product.price BETWEEN 0 AND 100000",
    "quantity_in_range": "order.quantity IS NULL OR order.quantity BETWEEN 1 AND 100",
    "numbers_parsed": "unparsed IS NULL OR size(unparsed) = 0",
}
#: Fields of a drop that hold numbers; those that cannot be read are named in the column `unparsed`.
NUMBERS = {"price": "decimal(18,6)", "unit_price": "decimal(18,6)", "quantity": "int", "discount_pct": "decimal(9,4)"}


#: Formats of drops by the ends of their names, which may be followed by one of a compression; NDJSON that is written here is compressed.
FORMATS = {"csv": (".csv",), "json": (".json", ".ndjson", ".jsonl")}
PACKED, PACKING = (".gz", ".bz2"), "gzip"
#: Folders of the landing zone that hold no drops: what was ingested, and the queue's files.
NO_DROPS = ("archive", "queue")
#: Threads that read the header lines of drops.
HEADER_READERS = 16


def children(spark: SparkSession, path: str) -> list[str]:
    """What stands right in a folder, hidden names left out; nothing where there is no such folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    found = [s.getPath() for s in system.listStatus(place)]
    return sorted(p.toString() for p in found if not p.getName().startswith((".", "_")))


def literal(path: str) -> str:
    """A path as a pattern that matches it alone."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def list_drops(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files that wait in a drop folder, by format; empty and other files are passed over.

    The archive and the queue are not looked into, so what was ingested before costs nothing; Spark lists the rest. The
    driver holds the names of the files, not what is in them. A folder that does not exist has none.
    """
    waiting = [c for c in children(spark, path) if c.rpartition("/")[2] not in NO_DROPS]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    found = sorted(r.path for r in files.load([literal(c) for c in waiting]).filter("length > 0").select("path").collect()) if waiting else []
    found = [f for f in found if not set(f.rpartition(path.rstrip("/") + "/")[2].split("/")[:-1]) & set(NO_DROPS)]
    return {kind: [f for f in found if f.lower().endswith(tuple(e + p for e in ends for p in ("", *PACKED)))] for kind, ends in FORMATS.items()}


def header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The column names in the first line of a CSV file, compressed or not; nothing more of it is read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(conf).open(place)
    if codec := jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place):
        stream = codec.createInputStream(stream)
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return tuple(next(csv.reader([line.lstrip("\ufeff")]), ())) if line else ()


def by_header(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """CSV files by their column names and the order of these."""
    with ThreadPool(HEADER_READERS) as pool:
        headers = pool.map(lambda p: header(spark, p), paths)
    out: dict[tuple[str, ...], list[str]] = {}
    for names, path in zip(headers, paths, strict=True):
        out.setdefault(names, []).append(path)
    return out


def read_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """Text cells of CSV files, columns by name: files of one header go to one reader, and what a file lacks is null."""
    groups = by_header(spark, list(paths))
    # names that differ in case are one column
    parts = [spark.read.option("header", True).option("escape", '"').csv([literal(f) for f in files]) for _, files in sorted(groups.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_events(spark: SparkSession, *paths: str, glob: str = "*") -> DataFrame:
    """Event records of NDJSON files under the declared schema; a bad line becomes a row of nulls."""
    return spark.read.schema(EVENT).option("mode", "PERMISSIVE").option("recursiveFileLookup", True).option("pathGlobFilter", glob).json(list(paths))


def read_bronze(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Event records of bronze; with first and last, only the dt folders of those days are read."""
    df = spark.read.schema(T.StructType([*EVENT, T.StructField("dt", T.StringType()), T.StructField("hour", T.StringType())])).json(path)
    return (df if first is None else df.filter(F.col("dt").between(first, last))).drop("dt", "hour")


def read_json_drops(spark: SparkSession, *paths: str) -> DataFrame:
    """Event records of NDJSON drops with `unparsed`: numbers that a declared schema would turn into nulls without a word."""
    types = F.filter(json_errors("value"), lambda c: c.startswith("invalid_type:") & ~c.endswith("occurred_at"))
    return spark.read.text([literal(p) for p in paths]).select(F.from_json("value", EVENT).alias("r"), F.transform(types, lambda c: F.substring_index(c, ".", -1)).alias("unparsed")).select("r.*", "unparsed")


def read_drops(spark: SparkSession, path: str, channel: str = "web", drops: dict[str, list[str]] | None = None) -> DataFrame:
    """Both formats of a drop folder as event records; no rows where no file waits."""
    drops = list_drops(spark, path) if drops is None else drops
    parts = [lift_flat(read_csv(spark, *drops["csv"]), channel)] if drops["csv"] else []
    parts += [read_json_drops(spark, *drops["json"])] if drops["json"] else []
    if not parts:
        return spark.createDataFrame([], T.StructType([*EVENT, T.StructField("unparsed", T.ArrayType(T.StringType()))]))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def archive(spark: SparkSession, drops: dict[str, list[str]], folder: str) -> int:
    """Moves ingested files out of the drop folder; the number moved. A file that cannot be moved is logged and stays:
    what is read twice is removed by the deduplication."""
    moved, files = 0, spark._jvm.org.apache.hadoop.fs
    for name in [f for found in drops.values() for f in found]:
        try:
            source, target = files.Path(name), files.Path(f"{folder}/{uuid.uuid4().hex[:8]}-{name.rpartition('/')[2]}")
            system = source.getFileSystem(spark._jsc.hadoopConfiguration())
            system.mkdirs(target.getParent())
            moved += bool(system.rename(source, target))
        except Exception:
            logging.getLogger(__name__).exception("cannot archive %s", name)
    return moved


def moved(spark: SparkSession, source: str, target: str, prefix: str, suffix: str = "") -> int:
    """Moves the files of a folder to another under names that tell their batch; those there already were moved by an earlier try.
    The end that tells a file's compression stays the last one."""
    files, n = spark._jvm.org.apache.hadoop.fs, 0
    for path in children(spark, source):
        name = path.rpartition("/")[2]
        packed = next((p for p in PACKED if suffix and name.endswith(p)), "")
        place = files.Path(f"{target}/{prefix}-{name.removesuffix(packed)}{suffix}{packed}")
        system = place.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(place.getParent())
        if not system.rename(files.Path(path), place):
            raise OSError(f"cannot move {path} to {place}")
        n += 1
    return n


def lift_flat(df: DataFrame, channel: str = "web") -> DataFrame:
    """Event records from flat text rows: the first alias with a value, basket arithmetic, UTC ISO time."""
    have = set(df.columns)  # names, order and defaults of the record below are fixed values

    def field(name: str, default: str | None = None) -> Column:
        found = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in ALIASES[name] if c in have]
        return F.coalesce(*found, F.lit(default).cast("string"))

    number = lambda c: c.try_cast("decimal(18,6)")
    stamp = F.col("ingested_at").cast("string") if "ingested_at" in have else F.lit(None).cast("string")
    base = df.select(stamp.alias("_ingested_at"), *[field(n).alias(f"_{n}") for n in ALIASES])
    price, quantity = number(F.col("_price")), F.coalesce(F.col("_quantity").try_cast("int"), F.lit(1))
    unit, pct = F.coalesce(number(F.col("_unit_price")), price), F.coalesce(F.col("_discount_pct").try_cast("decimal(9,4)"), F.lit(0).cast("decimal(9,4)"))
    base = base.withColumn("_gross", F.round(unit * quantity, 2).cast("decimal(18,2)"))
    base = base.withColumn("_off", F.round(F.col("_gross") * pct * F.lit("0.01").cast("decimal(3,2)"), 2).cast("decimal(18,2)"))
    base = base.withColumn("_net", F.col("_gross") - F.coalesce("_off", F.lit(0)))
    base = base.withColumn("_at", iso(event_time(F.col("_occurred_at")))).withColumn("_type", F.coalesce("_event_type", F.lit("unknown")))
    text, double = (lambda n, d=None: F.coalesce(F.col(f"_{n}"), F.lit(d).cast("string"))), (lambda c: c.cast("double"))
    return base.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.concat_ws("-", "_type", "_product_id", "_at").alias("event_id"),
        F.lit(None).cast("string").alias("idempotency_key"),
        F.col("_ingested_at").alias("ingested_at"),
        F.col("_at").alias("occurred_at"),
        text("channel", channel).alias("channel"),
        F.col("_type").alias("event_type"),
        F.struct(text("session_id").alias("session_id"), F.col("_sequence").try_cast("int").alias("sequence")).alias("session"),
        F.struct(text("device_type", "unknown").alias("type"), text("device_os").alias("os"), F.lit(None).cast("string").alias("user_agent")).alias("device"),
        F.struct(text("country").alias("country"), text("city").alias("city")).alias("geo"),
        F.struct(text("product_id").alias("product_id"), text("sku").alias("sku"), text("name").alias("name"), text("category").alias("category"), text("brand").alias("brand"), double(price).alias("price")).alias("product"),
        F.struct(text("customer_id").alias("customer_id"), text("segment").alias("segment"), text("country").alias("country"), F.lit(False).alias("is_returning")).alias("customer"),
        F.struct(
            text("order_id").alias("order_id"), quantity.alias("quantity"), double(F.round(unit, 2)).alias("unit_price"), double(F.round(pct, 2)).alias("discount_pct"), double(F.col("_gross")).alias("gross_amount"),
            double(F.col("_off")).alias("discount_amount"), double(F.col("_net")).alias("net_amount"), double(F.col("_net")).alias("amount"), text("currency", "EUR").alias("currency"), text("payment_method", "unknown").alias("payment_method"),
        ).alias("order"),
        F.struct(text("campaign").alias("campaign"), text("utm_source").alias("source"), text("utm_medium").alias("medium")).alias("marketing"),
        named(**{n: F.col(f"_{n}").isNotNull() & F.col(f"_{n}").try_cast(kind).isNull() for n, kind in NUMBERS.items()}).alias("unparsed"),
    )


def identity() -> Column:
    return F.sha1(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in IDENTITY]))


def add_identity(df: DataFrame, source_object: str = "", ingested_at: Column | None = None, source: str = "file") -> DataFrame:
    """idempotency_key, ingested_at (the given one; else the record's, else now) and _meta."""
    stamp = ingested_at if ingested_at is not None else F.coalesce("ingested_at", iso(F.current_timestamp()))
    meta = F.struct(stamp.alias("processed_at"), F.lit(source).alias("source"), F.lit(None).cast("string").alias("message_id"), F.lit(source_object).alias("source_object"))
    return df.withColumns({"idempotency_key": identity(), "ingested_at": stamp, "_meta": meta})


def failed_checks(checks: dict[str, str] = CHECKS) -> Column:
    """Names of the checks that a record fails; a check without an answer fails."""
    return named(**{n: ~F.coalesce(F.expr(e), F.lit(False)) for n, e in checks.items()})


def split_on_checks(df: DataFrame, checks: dict[str, str] = CHECKS) -> tuple[DataFrame, DataFrame]:
    """(accepted records, rejected ones with failed_checks)."""
    df = df if "unparsed" in df.columns else df.withColumn("unparsed", F.lit(None).cast("array<string>"))
    # each check is a filter of its own: what Spark infers from one large condition over many aliases takes it longer than the job
    accepted = df
    for check in checks.values():
        accepted = accepted.filter(F.coalesce(F.expr(check), F.lit(False)))
    marked = df.withColumn("failed_checks", failed_checks(checks))
    return accepted.drop("unparsed"), marked.filter(F.size("failed_checks") > 0)


def with_partitions(df: DataFrame) -> DataFrame:
    """dt and hour of the event time, 'unknown' where it has none."""
    ts = event_time(F.col("occurred_at"))
    return df.withColumns({"dt": F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit("unknown")), "hour": F.coalesce(F.date_format(ts, "HH"), F.lit("unknown"))})


def write_judged(df: DataFrame, path: str, checks: dict[str, str] = CHECKS) -> dict[str, int]:
    """Dated records as NDJSON in one pass, by zone (bronze, or quarantine with failed_checks and unparsed), dt and hour; how many of each.

    Records of a folder meet in few files, and those of a large one are split between tasks. They become text after they are dealt.
    """
    seen, parts = Observation(), ["zone", "dt", "hour"]
    failed = F.size("failed_checks") > 0
    marked = df.withColumn("failed_checks", failed_checks(checks)).withColumns({"zone": F.when(failed, "quarantine").otherwise("bronze"), "hour": F.when(failed, "all").otherwise(F.col("hour"))})
    fields = [c for c in df.columns if c not in parts]
    text = F.when(F.col("zone") == "bronze", F.to_json(F.struct(*[c for c in fields if c != "unparsed"]))).otherwise(F.to_json(F.struct(*fields, "failed_checks")))
    counted = marked.hint("rebalance", *parts).select(*parts, text.alias("value")).observe(seen, F.count_if(F.col("zone") == "bronze").alias("accepted"), F.count_if(F.col("zone") == "quarantine").alias("rejected"))
    counted.write.partitionBy(*parts).text(path, compression=PACKING)
    return totals(seen, "accepted", "rejected")
