"""Quantile buckets over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.plans.scratch import materialized

#: Rows that one task may number.
SMALL_ROWS = 1_000_000


def ntile(df: DataFrame, n: int, order: list[Column], name: str, tasks: int | None = None, small: int = SMALL_ROWS) -> DataFrame:
    """df with bucket 1..n of its rows in this order, as SQL's ntile gives; the order must be total.

    Up to `small` rows, counted here, one task numbers them. More are range-partitioned by the order, stored, and
    numbered within their range; the counts of the ranges, one row each, give the offsets.
    """
    if df.limit(small + 1).count() <= small:
        return df.withColumn(name, F.ntile(n).over(Window.orderBy(*order)))
    ranged = materialized(df.repartitionByRange(_tasks(df, tasks), *order).withColumn("_range", F.spark_partition_id()), "ranges")
    return _numbered(ranged, order, []).withColumn(name, _bucket(n)).drop("_range", "_before", "_total", "_row")


def ntiles(df: DataFrame, n: int, scores: dict[str, Column], key: str, tasks: int | None = None, small: int = SMALL_ROWS) -> DataFrame:
    """df with a bucket 1..n by each score (name -> a number, the smallest first; ties by key), as SQL's ntile gives.

    key tells the rows apart. Up to `small` rows one task numbers them. More are ranked by all scores in one sort: a
    row for each score of each key goes to ranges of (score, value, key), is numbered there, and the buckets meet at
    the key again. Many rows of one value are so dealt over ranges like any others.
    """
    if df.limit(small + 1).count() <= small:
        return df.withColumns({name: F.ntile(n).over(Window.orderBy(value.asc(), F.asc(key))) for name, value in scores.items()})
    long = df.select(F.col(key), F.explode(F.create_map(*[x for name, value in scores.items() for x in (F.lit(name), value.cast("double"))])).alias("_score", "_value"))
    order = [F.asc("_score"), F.asc("_value"), F.asc(key)]
    ranged = materialized(long.repartitionByRange(_tasks(df, tasks), *order).withColumn("_range", F.spark_partition_id()), "ranges")
    placed = _numbered(ranged, order, ["_score"]).withColumn("_bucket", _bucket(n))
    return df.join(placed.groupBy(key).agg(*[F.max(F.when(F.col("_score") == name, F.col("_bucket"))).alias(name) for name in scores]), key)


def _tasks(df: DataFrame, tasks: int | None) -> int:
    return tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _numbered(ranged: DataFrame, order: list[Column], by: list[str]) -> DataFrame:
    """_row (from 1) and _total of each row within its group `by`. ranged: stored, rows of a range in one task, ranges in order."""
    counts = ranged.groupBy(*by, "_range").count()  # a row for each range, and where groups meet in one, for each of them
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"), F.sum("count").over(Window.partitionBy(*by)).alias("_total"))
    row = F.row_number().over(Window.partitionBy(*by, "_range").orderBy(*order)) + F.col("_before")
    return ranged.join(F.broadcast(offsets), [*by, "_range"]).withColumn("_row", row)


def _bucket(n: int) -> Column:
    q, m = F.expr(f"_total div {n}"), F.expr(f"_total % {n}")
    long = F.expr(f"(_row - 1) div (_total div {n} + 1) + 1")
    short = F.when(q > 0, F.expr(f"_total % {n} + (_row - 1 - (_total % {n}) * (_total div {n} + 1)) div nullif(_total div {n}, 0) + 1"))
    return F.when(F.col("_row") <= m * (q + 1), long).otherwise(short).cast("int")
