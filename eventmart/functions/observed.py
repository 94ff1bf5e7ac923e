"""What was counted while rows were written."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation


def totals(seen: Observation, *names: str) -> dict:
    """The observed values; 0 for each name where Spark found on the way that there are no rows, and so ran nothing that counts."""
    try:
        return seen.get
    except Py4JJavaError as e:
        if "assertion failed" not in str(e):
            raise
        return dict.fromkeys(names, 0)
