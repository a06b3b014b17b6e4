"""Where queries and the SQL they equal are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tracelake.plans.inputs import TABLES, prefix, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, *inputs: str, sql: str | None = None):
    """Register a function of the named inputs; ``sql`` may use the inputs by name."""

    def wrap(f: Callable[..., DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(*[read(spark, sf_dir, i) for i in inputs])
        if sql:
            made = [i for i in inputs if i not in TABLES]
            ORACLES[name] = (prefix(*made) + (", " + sql.strip()[5:] if sql.strip().startswith("WITH ") else " " + sql)) if made else sql
        return f

    return wrap
