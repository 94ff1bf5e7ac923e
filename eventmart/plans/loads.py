"""Loads by configuration: which datasets go to which tables, how, and the job that takes them there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventmart.operators import load
from eventmart.operators.load import Target
from eventmart.plans.jobs import record_metrics, write_table
from eventmart.plans.paths import ZONES, Lake
from eventmart.session import job
from eventmart.sources import warehouse

# Configuration keys of a load, older names of datasets, the columns of a load of one table, and the dataset that no load may leave out.
TABLES_KEY, TABLE_KEY, MODE_KEY = "RDS_TABLES", "RDS_TABLE", "RDS_WRITE_MODE"
OLDER = {"processed": "silver/events", "silver": "silver/events", "curated": "gold"}
ONE_TABLE_COLUMNS = ["event_type", "product_id", "product_name", "product_price", "customer_id", "occurred_at", "partition_date", "partition_hour", "price_category"]
NEEDED = "silver/events"
MODES = ("append", "overwrite", "merge")


def dataset_name(dataset: str) -> str:
    """The lake's name of a dataset that may have an older one."""
    if dataset in OLDER:
        return OLDER[dataset]
    zone, _, rest = dataset.partition("/")
    return f"{OLDER[zone]}/{rest}" if zone == "curated" and rest else dataset


def place(lake: Lake, dataset: str) -> str:
    """Where a dataset is: a whole path as it is, a lake dataset by the lake's own overrides, anything else below its root."""
    if "://" in dataset:
        return dataset.rstrip("/")
    name = dataset_name(dataset)
    zone, _, rest = name.partition("/")
    return lake.path(zone, *rest.split("/")) if zone in ZONES and rest else f"{lake.root.rstrip('/')}/{name}"


def targets(config: dict, lake: Lake) -> list[Target]:
    """What a load takes where: its list of tables, else its one table (of some columns of the events), else the whole layout.

    Each entry of the list has a table, and may have a dataset (events by default), a path, a mode (that of the load by default, which is to
    append), required_columns (the only ones that are then loaded) and optional (by default all but the events are).
    An entry without a table, an unknown mode and a table named twice are errors before anything is read. The whole layout
    keeps the modes of `load.TARGETS`, a merge for the events among them, unless the load names one.
    """
    mode = config.get(MODE_KEY)
    if config.get(TABLES_KEY):
        entries = config[TABLES_KEY]
    elif config.get(TABLE_KEY):
        entries = [{"table": config[TABLE_KEY], "required_columns": ONE_TABLE_COLUMNS}]
    else:
        entries = [{"dataset": t.dataset, "table": t.table, "mode": mode or t.mode} for t in load.TARGETS]
    out = []
    for entry in entries:
        dataset = entry.get("dataset") or NEEDED
        if not entry.get("table"):
            raise ValueError(f"no table is named for {dataset}")
        name = dataset_name(dataset)
        chosen = entry.get("mode") or mode or "append"
        if chosen not in MODES:
            raise ValueError(f"{entry['table']}: no mode {chosen}")
        out.append(Target(name, entry["table"], chosen, bool(entry.get("optional", name != NEEDED)), list(entry["required_columns"]) if entry.get("required_columns") else None, entry.get("path") or place(lake, dataset)))
    if len({t.table for t in out}) < len(out):
        raise ValueError(f"tables named twice: {sorted(t.table for t in out)}")
    return out


@job
def load_warehouse(spark: SparkSession, lake: Lake, write, config: dict | None = None) -> dict[str, dict]:
    """Loads what the configuration names; the outcome of each table, and its rows among the run's counters."""
    outcome = load.load_tables(spark, lake.root, write, targets(config or {}, lake))
    values = {"tables": sum(o["status"] == "loaded" for o in outcome.values()), "skipped": sum(o["status"] != "loaded" for o in outcome.values())}
    record_metrics(spark, lake, "load", values | {table: o["rows"] for table, o in outcome.items()})
    return outcome


class FolderLoader:
    """A write(df, target) for loads into Parquet tables of one folder, for a warehouse that reads files; returns the rows it was given.

    A merge appends the newest row of each key that the table lacks. Files have no index: unlike loads over JDBC, only one
    load may run at a time. inserted: of each table the rows that it got.
    """

    def __init__(self, folder: str, key: str = "idempotency_key"):
        self.folder, self.key = folder.rstrip("/"), key
        self.inserted: dict[str, int] = {}

    def __call__(self, df: DataFrame, target: Target) -> int:
        path, rows = f"{self.folder}/{target.table}", df.count()  # of files: from their footers
        if target.mode != "merge":
            self.inserted[target.table] = write_table(df, path, mode=target.mode)
            return rows
        key = warehouse.KEYS.get(target.table) or [self.key]
        present = self.table(df.sparkSession, target.table, df)
        self.inserted[target.table] = write_table(load.absent_rows(df, present, key), path, mode="append")
        return rows

    def table(self, spark: SparkSession, table: str, like: DataFrame) -> DataFrame:
        """The table as it is, empty and of the given shape before its first load."""
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{table}")
        there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
        return spark.read.schema(like.schema).parquet(str(place)) if there else like.limit(0)
