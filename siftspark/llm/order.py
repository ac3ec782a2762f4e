"""Document ids of any type as whole numbers in the same order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.operators.ordering import numbered

WHOLE = ("tinyint", "smallint", "int", "bigint")
#: Stands for a null id: before all others.
NO_ID = -(2**63)


def order_table(docs: DataFrame) -> DataFrame | None:
    """(doc_id, _o): the distinct ids, numbered in their order; None where the ids are whole numbers already.

    Whole numbers are numbered, too, where the least one of all is among them, as it stands for null.
    """
    kind = dict(docs.dtypes)["doc_id"]
    if kind in WHOLE and (kind != "bigint" or not docs.select("doc_id").filter(F.col("doc_id") == NO_ID).limit(1).count()):
        return None
    return numbered(docs.select("doc_id").filter("doc_id IS NOT NULL").distinct(), ["doc_id"], "_o")


def with_order(docs: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Add ``_o``, a long that orders rows as doc_id does; null comes first."""
    if ids is None:
        return docs.withColumn("_o", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)))
    return docs.join(ids, "doc_id", "left").withColumn("_o", F.coalesce("_o", F.lit(NO_ID)))
