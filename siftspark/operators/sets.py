"""Set operations between collections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def concatenate(*collections: DataFrame) -> DataFrame:
    """All rows of collections with the same columns."""
    names = {tuple(sorted(c.columns)) for c in collections}
    if len(names) > 1:
        raise ValueError(f"columns differ: {sorted(names)}")
    return reduce(DataFrame.unionByName, collections)


def common_keys(a: DataFrame, b: DataFrame, key: Column) -> DataFrame:
    return a.select(key.alias("key")).intersect(b.select(key.alias("key")))


def missing_keys(a: DataFrame, b: DataFrame, key: Column) -> DataFrame:
    """Distinct keys of a that b lacks."""
    return a.select(key.alias("key")).subtract(b.select(key.alias("key")))


def inchikey_layer(key: Column, layers: int) -> Column:
    """The first layer of an InChIKey, or the first two without the protonation flag."""
    if layers == 1:
        return F.substring_index(key, "-", 1)
    return F.left(key, F.length(key) - 2) if layers == 2 else key


def cumulative_training(splits: DataFrame, iteration: int) -> DataFrame:
    """Training ids: all splits of this iteration and all earlier ones; valid and test are those of iteration 1."""
    train = splits.filter(F.col("iteration") <= iteration).filter((F.col("split") == "train") | (F.col("iteration") > 1)).select("id", F.lit("train").alias("split"))
    fixed = splits.filter((F.col("iteration") == 1) & F.col("split").isin("valid", "test")).select("id", "split")
    return train.unionByName(fixed).distinct()


def top_groups(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values; ties go by value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(k)


def label_shares(df: DataFrame, label: str) -> DataFrame:
    """Count and share of each label; the total is one row."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    return counts.crossJoin(F.broadcast(total)).select(label, "n", F.round(F.col("n") / F.col("_total"), 3).alias("share"))
