"""Named queries over the driver's tables with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from strataframe.session import cut_lineage, scratch_removed

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None, folders: bool = False):
    """Register a query; without ``check`` only its rows are counted.

    A query that writes ``folders`` of its own has them removed: its result, small by then, is checkpointed first.
    """

    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with scratch_removed(spark):
                return cut_lineage(fn(spark, sf_dir))

        QUERIES[name] = run if folders else fn
        if check is not None:
            CHECKS[name] = check
        return fn

    return keep
