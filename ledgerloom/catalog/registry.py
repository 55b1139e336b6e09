"""The registry of queries and their oracle SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.catalog import oracle_parts
from ledgerloom.catalog.lake import Lake, zoneless
from ledgerloom.session import fine_splits

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, *needs: str, name: str | None = None):
    """Registers `fn(lake)`; `needs` are the common tables its oracle SQL uses."""
    def register(fn):
        title = name or fn.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            fine_splits(spark)
            return zoneless(fn(Lake(spark, folder)))

        run.__name__ = title
        QUERIES[title] = run
        if oracle is not None:
            ORACLES[title] = oracle_parts.statement(oracle, *needs)
        return fn
    return register
