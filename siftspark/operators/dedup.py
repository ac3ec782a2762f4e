"""One row per key, and disjoint splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _edge(df: DataFrame, keys: Sequence[str], order: Column, pick) -> DataFrame:  # noqa: ANN001
    """The row with the extreme order of each key, by an aggregate that combines before the shuffle."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    picked = df.groupBy(*keys).agg(pick(row, order).alias("_row"))
    return picked.select("_row.*")


def first_wins(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    return _edge(df, keys, order, F.min_by)


def last_wins(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    return _edge(df, keys, order, F.max_by)


POLICIES = ("error", "keep_first", "keep_all", "mean", "remove_positive", "remove_negative", "remove_all")


def resolve_labels(df: DataFrame, key: str, label: str, order: str, policy: str) -> DataFrame:
    """(key, label, n_rows): rows of one key with their 0/1 labels settled; a missing label counts as -1.

    keep_first: the first row's label. mean: the average. remove_positive and
    remove_negative: a conflict keeps the other class. remove_all: conflicts go.
    keep_all: a row per distinct label. error: a conflict raises when it is read.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy}")
    value = F.coalesce(F.col(label).cast("double"), F.lit(-1.0))
    rows = df.select(key, value.alias("_label"), order)
    if policy == "keep_all":
        return rows.groupBy(key, F.col("_label").alias(label)).agg(F.count("*").alias("n_rows"))
    grouped = rows.groupBy(key).agg(
        F.min_by("_label", order).alias("_first"),
        (F.sum("_label") / F.count("*")).alias("_mean"),
        F.max("_label").alias("_max"),
        F.min("_label").alias("_min"),
        F.count("*").alias("n_rows"),
    )
    clash = F.col("_min") != F.col("_max")
    settled = {
        "error": F.when(clash, F.raise_error(F.concat(F.lit("conflicting labels for "), F.col(key).cast("string"))).cast("double")).otherwise(F.col("_first")),
        "keep_first": F.col("_first"),
        "mean": F.col("_mean"),
        "remove_positive": F.col("_min"),
        "remove_negative": F.col("_max"),
        "remove_all": F.when(~clash, F.col("_first")),
    }[policy]
    return grouped.select(key, settled.alias(label), "n_rows").filter(F.col(label).isNotNull())


def resolve_label_rows(df: DataFrame, key: str, labels: Sequence[str], order: str, policy: str) -> DataFrame:
    """The same for rows with several labels: keep_first, keep_all (a row per distinct set of labels), or
    remove_both, where a key goes if any label differs between its rows."""
    row = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(-1.0)) for c in labels])
    rows = df.select(key, row.alias("_labels"), order)
    if policy == "keep_all":
        out = rows.groupBy(key, "_labels").agg(F.count("*").alias("n_rows"))
    elif policy in ("keep_first", "remove_both"):
        out = rows.groupBy(key).agg(F.min_by("_labels", order).alias("_labels"), F.count("*").alias("n_rows"), F.min("_labels").alias("_lo"), F.max("_labels").alias("_hi"))
        out = out.filter("_lo = _hi") if policy == "remove_both" else out
    else:
        raise ValueError(f"unknown policy {policy}")
    return out.select(key, *[F.get("_labels", F.lit(i)).alias(c) for i, c in enumerate(labels)], "n_rows")


def split_hygiene(splits: DataFrame, order: Sequence[str] = ("train", "valid", "test"), history: DataFrame | None = None) -> DataFrame:
    """Each id stays in the first split that has it; ids of earlier iterations go."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("split"))
    kept = splits.groupBy("id").agg(F.min_by("split", rank).alias("split"))
    return kept if history is None else kept.join(history.select("id").distinct(), "id", "left_anti")


def without_repeats(lines: DataFrame, partition: Sequence[str], order: str, value: str) -> DataFrame:
    """Drop rows that repeat the value of the row before."""
    before = F.lag(value).over(Window.partitionBy(*partition).orderBy(order))
    return lines.withColumn("_before", before).filter(~F.col("_before").eqNullSafe(F.col(value))).drop("_before")
