"""The registered queries, their SQL, and the parts of the inventory that each covers."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siftspark.session import ensure_checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}


def query(sql: str | None = None, covers: str = "") -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        COVERS[f.__name__] = covers
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared folder for what a query writes and reads again."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/query-{uuid.uuid4().hex}"
