"""Row numbers, running sums and top-k over a total order, without a task that sees all rows.

Rows are dealt to ranges of the order and sorted there. What a range needs of the earlier ones is
one row (its count, its sums, its extremes), so only as many rows as there are ranges meet in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftspark.session import checkpointed

Order = str | Column
#: Bits of monotonically_increasing_id below the number of the partition.
ROW_BITS = 33


def dealt(df: DataFrame, order: Sequence[Order], partition: str = "_part", place: str = "_at") -> DataFrame:
    """The rows, written in ranges of the order: ``partition`` counts the ranges, ``place`` the rows in each from 0."""
    rows = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id()))
    return rows.withColumn(partition, F.shiftright(place, ROW_BITS)).withColumn(place, F.col(place).bitwiseAND(F.lit((1 << ROW_BITS) - 1)))


def numbered(df: DataFrame, order: Sequence[Order], name: str = "row_id", first: int = 0) -> DataFrame:
    """Add the place of each row in the order, from ``first``. Rows that tie in it are numbered in any order."""
    rows = dealt(df, order)
    return _with_earlier(rows, {"_before": F.count(F.lit(1))}).withColumn(name, F.coalesce("_before", F.lit(0)) + F.col("_at") + first).drop("_before", "_part", "_at")


def _with_earlier(rows: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Add what earlier ranges have in sum: the window is over one row for each range."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per = rows.groupBy("_part").agg(*[c.alias(k) for k, c in sums.items()])
    return rows.join(F.broadcast(per.select("_part", *[F.sum(k).over(earlier).alias(k) for k in sums])), "_part")


def running_sums(df: DataFrame, order: Sequence[Order], columns: Sequence[str], suffix: str = "_sum") -> DataFrame:
    """Add c + ``suffix`` for each column: its sum over this row and all before. The order must be total."""
    rows = dealt(df, order)
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    rows = _with_earlier(rows, {f"_b_{c}": F.sum(c) for c in columns})
    total = lambda c: F.coalesce(f"_b_{c}", F.lit(0)) + F.coalesce(F.sum(c).over(inside), F.lit(0))
    return rows.withColumns({f"{c}{suffix}": total(c) for c in columns}).drop("_part", "_at", *[f"_b_{c}" for c in columns])


def running_extreme(df: DataFrame, order: Sequence[Order], column: str, name: str, larger: bool = True) -> DataFrame:
    """Add the largest (or least) value of a column so far."""
    pick = F.max if larger else F.min
    rows = dealt(df, order)
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per = rows.groupBy("_part").agg(pick(column).alias("_x")).select("_part", pick("_x").over(earlier).alias("_before"))
    best = F.greatest if larger else F.least
    return rows.join(F.broadcast(per), "_part").withColumn(name, best("_before", pick(column).over(inside))).drop("_part", "_at", "_before")


def with_previous(df: DataFrame, order: Sequence[Order], column: str, name: str) -> DataFrame:
    """Add the value of the row before; the last rows of the ranges, one each, are handed on to the next."""
    rows = dealt(df, order)
    before = F.lag(F.struct(column)).over(Window.partitionBy("_part").orderBy("_at"))
    last = rows.groupBy("_part").agg(F.max_by(F.struct(column), "_at").alias("_last"))
    handed = last.select("_part", F.lag("_last").over(Window.orderBy("_part")).alias("_handed"))
    value = F.coalesce(before, F.col("_handed"))
    return rows.join(F.broadcast(handed), "_part").withColumn(name, value[column]).drop("_part", "_at", "_handed")


def ranked(df: DataFrame, column: str, name: str = "rank", descending: bool = True) -> DataFrame:
    """Add one plus the number of rows that come before by ``column``; equal values have equal ranks, nulls are last.

    Rows of one value may fall into several ranges. A value that is a range's first or last is looked up among the first
    and last values of all ranges, one row for each, where its earliest place is.
    """
    order = F.desc_nulls_last(column) if descending else F.asc_nulls_last(column)
    rows = dealt(df.withColumn("_v", F.col(f"`{column}`")).withColumn("_tie", F.xxhash64(F.monotonically_increasing_id())), [order, F.col("_tie")]).drop("_tie")
    rows = rows.withColumn("_key", F.struct("_v"))  # equal to itself where null, too
    ends = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min_by("_key", "_at").alias("_first"), F.max_by("_key", "_at").alias("_last"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = checkpointed(ends.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))))
    inside = F.rank().over(Window.partitionBy("_part").orderBy(order))
    placed = rows.join(F.broadcast(ends.select("_part", "_first", "_last", "_before")), "_part").withColumn("_rank", F.col("_before") + inside)
    at_edge = F.col("_key").eqNullSafe(F.col("_first")) | F.col("_key").eqNullSafe(F.col("_last"))
    start = placed.filter(at_edge).groupBy("_key").agg(F.min("_rank").alias("_start")).select(F.col("_key").alias("_k"), "_start")
    least = F.least("_rank", F.coalesce("_start", "_rank")).cast("int")
    return placed.join(F.broadcast(start), F.col("_key").eqNullSafe(F.col("_k")), "left").withColumn(name, least).select(*df.columns, name)


def numbered_within(df: DataFrame, group: Sequence[str], order: Sequence[Order], name: str = "place", first: int = 1) -> DataFrame:
    """Add the place of each row among those of its group, from ``first``, however large a group is: a group may take several
    ranges, and each range gets one row for its first group about the earlier ranges."""
    rows = dealt(df.withColumn("_group", F.struct(*group)), [*(F.col(f"_group.{g}").asc_nulls_first() for g in group), *order])
    per = rows.groupBy("_part", "_group").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_begin"))
    # Only a range's first group can have begun before it, and only its last one can go on after it.
    ends = per.groupBy("_part").agg(F.min_by(F.struct("_group", "_n"), "_begin").alias("_a"), F.max_by(F.struct("_group", "_n"), "_begin").alias("_z"))
    edges = ends.select("_part", F.inline(F.array_distinct(F.array("_a", "_z"))))
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = checkpointed(edges.select("_part", "_group", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_carried"))).filter("_carried > 0")
    inside = F.row_number().over(Window.partitionBy("_part", "_group").orderBy("_at"))
    before = F.broadcast(carried.select(F.col("_part").alias("_p"), F.col("_group").alias("_g"), "_carried"))
    placed = rows.withColumn("_inside", inside).join(before, (F.col("_part") == F.col("_p")) & F.col("_group").eqNullSafe(F.col("_g")), "left")
    return placed.withColumn(name, (F.coalesce("_carried", F.lit(0)) + F.col("_inside") + first - 1).cast("int")).select(*df.columns, name)


def first_rows(df: DataFrame, order: Sequence[Order], n: int) -> DataFrame:
    """The first n rows of the order: what :func:`numbered` puts below n, so that n may be large."""
    return numbered(df, order, "_place").filter(F.col("_place") < n).drop("_place")
