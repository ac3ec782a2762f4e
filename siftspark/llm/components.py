"""Connected components, and joins with hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.operators.graph import components

__all__ = ["components", "join_hot"]


def join_hot(rows: DataFrame, table: DataFrame, counts: DataFrame, key: str, share: float = 0.001) -> DataFrame:
    """Rows joined with the one row of ``table`` for their key. Keys with more than ``share`` of the rows in
    ``counts`` (key, n), at most 1 / share of them, are broadcast; the others meet by shuffle."""
    total = F.broadcast(counts.agg(F.sum("n").alias("_total")))
    hot = counts.crossJoin(total).filter(F.col("n") > share * F.col("_total")).select(key)
    common = rows.join(F.broadcast(table.join(F.broadcast(hot), key)), key)
    return common.unionByName(rows.join(F.broadcast(hot), key, "left_anti").join(table, key))
