"""Loads into tables: required columns, JDBC, several tables with outcomes, replay-safe merge."""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.sources import warehouse


def read_dataset(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The named columns of a Parquet dataset; a missing one is an error."""
    df = spark.read.parquet(path)
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"{path} lacks {missing}")
    return df.select(*columns)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", schema: str | None = None, truncate: bool = True, **options: str) -> None:
    """Batched JDBC write; an overwrite truncates the table and keeps its definition, unless it is told to make the table anew."""
    writer = df.write.format("jdbc").mode(mode).options(url=url, dbtable=f"{schema}.{table}" if schema else table, batchsize="10000", numPartitions="8", **options)
    (writer.option("truncate", "true") if mode == "overwrite" and truncate else writer).save()


@dataclass
class Target:
    dataset: str
    table: str
    mode: str = "overwrite"  # or append, or merge: the rows whose key the table lacks
    optional: bool = True
    columns: list[str] | None = None  # that the dataset must have, where they are not those of a warehouse table
    path: str | None = None  # of the dataset, where it is not below the lake's root


# Datasets of the lake and the warehouse tables they load.
TARGETS = [
    Target("silver/events", "fact_events", "merge", optional=False),
    *[Target(f"gold/{d}", t) for d, t in (("sessions", "fact_sessions"), ("funnel_daily", "agg_funnel_daily"), ("orders", "fact_orders"), ("customer_rfm", "dim_customer_rfm"), ("product_daily", "agg_product_daily"), ("anomalies", "fact_anomalies"))],
]


class Jdbc:
    """Statements over one connection of the driver process, made by Spark's own dialect for the url."""

    def __init__(self, spark: SparkSession, url: str, **options: str):
        jvm = spark._jvm
        given = jvm.java.util.HashMap()
        for name, value in {**options, "url": url, "dbtable": "t"}.items():
            given.put(name, str(value))
        wanted = jvm.org.apache.spark.sql.execution.datasources.jdbc.JDBCOptions(jvm.PythonUtils.toScalaMap(given))
        self.connection = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).createConnectionFactory(wanted).apply(-1)

    def __enter__(self) -> Jdbc:
        return self

    def __exit__(self, *_) -> None:
        self.connection.close()

    def run(self, sql: str) -> int:
        """Executes one statement; the rows that it changed."""
        statement = self.connection.createStatement()
        try:
            return statement.executeUpdate(sql)
        finally:
            statement.close()


#: Times that a merge is tried again when another one holds the table or has just inserted a key.
MERGE_TRIES = 10
#: Text that marks such a failure, and one of a table that exists already (or not yet).
RETRY = r"deadlock|lock could not be obtained|could not serialize|lock wait|duplicate key|unique constraint|SQLIntegrityConstraintViolation"
EXISTS, ABSENT = r"already exists|there is already|duplicate key name", r"does not exist|TABLE_OR_VIEW_NOT_FOUND|no such table|doesn't exist"
#: Column type of keys in tables that a merge creates.
KEY_TYPE = "VARCHAR(255)"


def insert_absent(url: str, target: str, staging: str, columns: list[str], key: list[str]) -> str:
    """The statement that inserts the rows of staging whose key the target lacks."""
    names, on = ", ".join(columns), ", ".join(key)
    kind = url.split(":")[1]
    if kind in ("postgresql", "sqlite", "duckdb"):
        return f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging} WHERE true ON CONFLICT ({on}) DO NOTHING"
    if kind in ("mysql", "mariadb"):
        return f"INSERT IGNORE INTO {target} ({names}) SELECT {names} FROM {staging}"
    same = " AND ".join(f"t.{k} = s.{k}" for k in key)
    return f"MERGE INTO {target} t USING {staging} s ON {same} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({', '.join('s.' + c for c in columns)})"


def merge_jdbc(df: DataFrame, url: str, table: str, key: list[str], schema: str | None = None, **options: str) -> int:
    """Inserts the rows whose key the table lacks; the number of rows inserted.

    Of each key the newest row of df is offered; rows without a whole key are left out. They go, over several connections,
    to a staging table of this load's own, and one statement brings them into the target; no row of the target is read
    here. The unique index on the key, which is made with a target that does not exist yet, decides between loads
    that run at once: the one that comes second is tried again and finds the keys present.
    """
    spark, place = df.sparkSession, lambda t: f"{schema}.{t}" if schema else t
    staging = f"stg_{table}_{uuid.uuid4().hex[:12]}"
    kinds = dict(df.dtypes)
    typed = {"createTableColumnTypes": ", ".join(f"{k} {KEY_TYPE}" for k in key if kinds[k] == "string")} if any(kinds[k] == "string" for k in key) else {}
    name = lambda c: spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(c)
    with Jdbc(spark, url, **options) as db:
        _attempt(lambda: write_jdbc(spark.createDataFrame([], df.schema), url, table, "append", schema, **typed, **options), EXISTS)
        index = f"CREATE UNIQUE INDEX uq_{table} ON {place(table)} ({', '.join(map(name, key))})"
        _attempt(lambda: db.run(index), EXISTS)
        try:
            write_jdbc(newest(df, key), url, staging, "overwrite", schema, **typed, **options)
            statement = insert_absent(url, place(table), place(staging), [name(c) for c in df.columns], [name(k) for k in key])
            for tried in range(MERGE_TRIES):
                try:
                    return db.run(statement)
                except Exception as e:
                    if tried == MERGE_TRIES - 1 or not re.search(RETRY, str(e), re.IGNORECASE):
                        raise
                    time.sleep(0.2 * (tried + 1))
        finally:
            _attempt(lambda: db.run(f"DROP TABLE {place(staging)}"), ABSENT)
    raise AssertionError("unreachable")


def _attempt(action, passing: str) -> None:
    """Runs an action whose failure for a reason that `passing` names does no harm."""
    try:
        action()
    except Exception as e:
        if not re.search(passing, str(e), re.IGNORECASE):
            raise


class JdbcLoader:
    """A write(df, target) for load_tables: overwrites, appends, or merges by key into a JDBC table; returns the rows it was given.

    inserted: of each table the rows that it got, which of a merge are those whose key it lacked.
    """

    def __init__(self, url: str, schema: str | None = None, key: str = "idempotency_key", **options: str):
        self.url, self.schema, self.key, self.options = url, schema, key, options
        self.inserted: dict[str, int] = {}

    def __call__(self, df: DataFrame, target: Target) -> int:
        rows = df.count()  # of files: from their footers, no column is read
        if target.mode == "merge":
            self.inserted[target.table] = merge_jdbc(df, self.url, target.table, warehouse.KEYS.get(target.table) or [self.key], self.schema, **self.options)
        else:
            write_jdbc(df, self.url, target.table, target.mode, self.schema, **self.options)
            self.inserted[target.table] = rows
        return rows


jdbc_loader = JdbcLoader


#: Keys that the outcome of a load names.
NAMED_KEYS = 5


def key_faults(df: DataFrame, table: str) -> str | None:
    """What is wrong with the keys of a warehouse table: the first few that occur more than once or are not whole; None if nothing is."""
    key = warehouse.KEYS.get(table)
    if not key or not set(key) <= set(df.columns):  # a target may choose columns without it
        return None
    none = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in key))
    bad = df.groupBy(*key).count().filter((F.col("count") > 1) | none).orderBy(*key).limit(NAMED_KEYS).collect()
    if not bad:
        return None
    return f"keys of {table} ({', '.join(key)}) repeated or null: " + "; ".join(", ".join("null" if r[k] is None else str(r[k]) for k in key) for r in bad)


def load_tables(spark: SparkSession, lake: str, write, targets: list[Target] = TARGETS) -> dict[str, dict]:
    """status, rows and, where skipped or refused, the reason of each table; write(df, target) does the write and returns its rows.

    Rows are brought to the columns and types of the warehouse table, where it has declared ones (a target's `columns`
    names others), and their keys are checked before anything is written: a table with a key that is repeated or
    not whole is refused, and the outcome names such keys. A merge takes the newest row of each key instead and leaves rows
    without one out; its rows are those offered. A failing optional table is skipped with its reason.
    """
    outcome: dict[str, dict] = {}
    for target in targets:
        try:
            path = target.path or f"{lake}/{target.dataset}"
            df = read_dataset(spark, path, target.columns) if target.columns else spark.read.parquet(path)
            df = warehouse.shaped(df, target.table) if target.table in warehouse.TABLES and not target.columns else df
            if df.isEmpty():
                outcome[target.table] = {"status": "skipped", "rows": 0, "reason": "empty"}
                continue
            if target.mode != "merge" and (fault := key_faults(df, target.table)):
                raise RepeatedKeys(fault)
            outcome[target.table] = {"status": "loaded", "rows": write(df, target), "mode": target.mode}
        except Exception as e:  # any source or sink failure of an optional table
            if not target.optional:
                raise
            outcome[target.table] = {"status": "refused" if isinstance(e, RepeatedKeys) else "skipped", "rows": 0, "reason": str(e).splitlines()[0][:200]}
    return outcome


class RepeatedKeys(ValueError):
    """A table whose key does not tell its rows apart."""


def newest(df: DataFrame, key: list[str], by: str = "ingested_at") -> DataFrame:
    """The newest row of each whole key (of equal ones, by the row's hash)."""
    order = [F.desc_nulls_last(by)] if by in df.columns else []
    latest = Window.partitionBy(*key).orderBy(*order, F.xxhash64(*df.columns))
    return df.dropna(subset=key).withColumn("_n", F.row_number().over(latest)).filter("_n = 1").drop("_n")


def new_rows(staging: DataFrame, target: DataFrame, key: str = "idempotency_key", by: str = "ingested_at") -> DataFrame:
    """Rows of staging to append: the newest of each key that the target lacks; null keys are left out."""
    return absent_rows(staging, target, [key], by)


def absent_rows(staging: DataFrame, target: DataFrame, key: list[str], by: str = "ingested_at") -> DataFrame:
    """The same for a key of several columns."""
    return newest(staging, key, by).join(target.select(*key), key, "left_anti").select(*staging.columns)


def repeated_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, for tables whose key must be unique."""
    return df.groupBy(*key).count().filter("count > 1")
