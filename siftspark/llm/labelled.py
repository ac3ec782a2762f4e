"""What the classifiers share: the held-out rows and their labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def labels_by_document(labels: DataFrame, name: str) -> DataFrame:
    """(doc_id, _label): one row per labelled document; of several labels the largest counts."""
    known = labels.select("doc_id", F.col(name).cast("int").alias("_label")).dropna()
    return known.groupBy("doc_id").agg(F.max("_label").alias("_label"))
