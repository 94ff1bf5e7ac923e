"""Time and money as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


# Each of these names its input once: what Spark folds into later expressions is then not multiplied.


def event_time(text: Column, whole: bool = True) -> Column:
    """Timestamp of ISO text (no zone: UTC); null when it is not a date with hour and minute (not whole: a date)."""
    return F.try_to_timestamp(F.regexp_extract(text, r"(?s)^\d{4}-\d{2}-\d{2}" + (r"[T ]\d{2}:\d{2}" if whole else "") + ".*", 0))


def iso(ts: Column) -> Column:
    """ISO text in UTC with an offset, microseconds only where there are any."""
    return F.replace(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"), F.lit(".000000"), F.lit(""))


def money(value: Column) -> Column:
    """Two exact decimals, so that sums do not depend on the order of rows."""
    return value.cast("decimal(18,2)")


def total(value: Column) -> Column:
    """Sum of money as a double, 0 for no rows."""
    return F.coalesce(F.sum(money(value)), F.lit(0)).cast("double")


def share(part: Column, whole: Column) -> Column:
    """Percentage with two decimals, 0 where the whole is 0."""
    return F.when(whole > 0, F.round(part.cast("decimal(18,0)") * 100 / whole.cast("decimal(18,0)"), 2).cast("double")).otherwise(0.0)


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def earliest(column: str, of: str = "true") -> Column:
    """First non-null value of a group, or of its rows of some kind, by event time, then key."""
    return F.expr(f"min_by({column}, struct(occurred_ts, idempotency_key)) FILTER (WHERE {column} IS NOT NULL AND {of})")


def named(**checks: Column) -> Column:
    """Names of the conditions that hold, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), for which value is computed once however often use names it, wherever the expression comes to stand."""
    return F.transform(F.array(value), use)[0]
