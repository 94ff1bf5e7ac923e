"""The session settings that results depend on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import SparkSession

#: UTC for every date and hour; partition values stay text; partition overwrites touch only what they write.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

#: Of jobs alone: what a statement has shuffled is deleted when it ends, not when the driver next collects its garbage, and tables are packed more closely.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
JOB_SETTINGS = SETTINGS | FREED | {"spark.sql.parquet.compression.codec": "zstd"}


def configured(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def settings(spark: SparkSession, chosen: dict[str, str] = JOB_SETTINGS) -> Iterator[SparkSession]:
    """The chosen settings for a while; afterwards the session has what it had before."""
    before = {name: spark.conf.get(name, None) for name in chosen}
    try:
        for name, value in chosen.items():
            spark.conf.set(name, value)
        yield spark
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def job(function):
    """A function (spark, ...) that does its work before it returns, under JOB_SETTINGS whatever the session has: its results
    do not depend on the caller's time zone."""

    @wraps(function)
    def run(spark: SparkSession, *args, **options):
        with settings(spark):
            return function(spark, *args, **options)

    return run
