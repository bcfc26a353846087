"""Reading counts that were taken while a table was written (``DataFrame.observe``)."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation


def observed(seen: Observation) -> dict:
    """The observed values, or {} where Spark has none: a plan that it finds to be empty while running is
    replaced by one that observes nothing. The caller then counts what was written."""
    try:
        return seen.get or {}
    except Py4JJavaError:  # the row of no values has no schema
        return {}
