"""Joins on names and ids. Spark broadcasts a side only where it knows it to be small."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.operators.dedup import first_wins, last_wins


def keep_selected(library: DataFrame, selected: DataFrame, key: str = "name") -> DataFrame:
    """Library rows whose key is selected; duplicates stay."""
    return library.join(selected.select(key), key, "left_semi")


def drop_known(library: DataFrame, known: DataFrame, key: str = "name") -> DataFrame:
    return library.join(known.select(key), key, "left_anti")


def lookup_last(rows: DataFrame, library: DataFrame, key: str, order: str) -> DataFrame:
    """Inner join with the last library row of each key."""
    return rows.join(last_wins(library, [key], F.col(order)).drop(order), key)


def must_match(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Inner join that raises, when read, for a row without a partner."""
    found = table.withColumn("_found", F.lit(True))
    joined = rows.join(found, key, "left")
    missing = F.raise_error(F.concat(F.lit(f"no {key} "), F.col(key).cast("string"))).cast("boolean")
    return joined.filter(F.coalesce("_found", missing)).drop("_found")


def zip_rows(a: DataFrame, b: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Join by row number; raises where the tables differ in length."""
    counts = [x.agg(F.count("*"), F.max(row_id)).first() for x in (a, b)]
    if counts[0][0] != counts[1][0]:
        raise ValueError(f"tables of {counts[0][0]} and {counts[1][0]} rows")
    return a.join(b, row_id)


def misaligned(a: DataFrame, b: DataFrame, row_id: str, key: str) -> DataFrame:
    """Rows whose key differs between two tables of the same order; none if they are aligned."""
    left, right = a.select(row_id, F.col(key).alias("_a")), b.select(row_id, F.col(key).alias("_b"))
    return left.join(right, row_id, "full").filter(~F.col("_a").eqNullSafe(F.col("_b")))


def left_join_all(base: DataFrame, others: Sequence[DataFrame | None], key: str) -> DataFrame:
    """Left joins on one key; absent inputs are left out. All joins share the partitioning of the first."""
    return reduce(lambda df, other: df.join(other, key, "left"), [o for o in others if o is not None], base)


def merge_votes(tables: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """Full outer merge of one value per model; a key that a table has twice gives a row for each. All joins share the partitioning of the key."""
    return reduce(lambda a, b: a.join(b, key, "full"), [t.select(key, F.col(value).alias(m)) for m, t in tables.items()])


def route(library: DataFrame, splits: DataFrame, order: Sequence[str] = ("train", "valid", "test"), row_id: str = "row_id") -> DataFrame:
    """The first library row of each id that a split asks for, with the first split that does."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("split"))
    wanted = splits.groupBy("id").agg(F.min_by("split", rank).alias("split"))
    return first_wins(library.join(wanted, "id"), ["id"], F.col(row_id))


#: Targets that are sent to all tasks at once.
MOST_TARGETS = 10_000
SEED = 42


def off_target_jobs(targets: DataFrame, ligands: DataFrame, available: DataFrame, ligand: str = "ligand", most: int = MOST_TARGETS) -> DataFrame:
    """Each target with each ligand that has a prepared file. Every such pair is a docking run to make, so the result is the
    product by definition. The targets, a list made by hand, are counted; a longer list is dealt to blocks that are broadcast in turn."""
    n = targets.count()
    blocks = 1 if n <= most else -(-4 * n // (3 * most))  # a quarter to spare, as blocks by hash differ
    ready = ligands.join(available.select(ligand).distinct(), ligand, "left_semi")
    mine = lambda k: targets if blocks == 1 else targets.filter(F.pmod(F.xxhash64(F.lit(SEED), *targets.columns), F.lit(blocks)) == k)
    return reduce(DataFrame.unionByName, [ready.crossJoin(F.broadcast(mine(k))) for k in range(blocks)])


def with_features(labels: DataFrame, library: DataFrame, key: str = "id") -> DataFrame:
    """Labelled rows with the features of their id; ids without features go, of repeated library rows all count."""
    return labels.join(library, key)


def rows_in_order(ids: DataFrame, database: DataFrame, key: str = "id", row_id: str = "row_id") -> DataFrame:
    """A database row for each listed id, repeats included, with the list's row number; raises, when read, for an id that is missing."""
    return must_match(ids.select(row_id, key), database.drop(row_id), key)


def first_threshold(models: DataFrame, thresholds: DataFrame, key: str = "model_no", order: str = "row_id") -> DataFrame:
    """Models with the first threshold row of their number."""
    return models.join(first_wins(thresholds, [key], F.col(order)).drop(order), key)


def look_up(rows: DataFrame, column: str, value: object, order: str = "row_id") -> DataFrame:
    """The first row with a value: a name, a structure or a key."""
    return rows.filter(F.col(column) == F.lit(value)).orderBy(order).limit(1)


def pick(rows: DataFrame, start: int | None = None, stop: int | None = None, step: int = 1, row_id: str = "row_id") -> DataFrame:
    """A slice by row number, as start:stop:step of rows from 0; negative ends count from the last row."""
    if step < 1:
        raise ValueError("step must be positive")
    n = rows.agg(F.max(row_id)).first()[0]
    n = 0 if n is None else n + 1
    start, stop, step = slice(start, stop, step).indices(n)
    return rows.filter((F.col(row_id) >= start) & (F.col(row_id) < stop) & (F.pmod(F.col(row_id) - start, F.lit(step)) == 0))


def at_rows(rows: DataFrame, numbers: DataFrame, row_id: str = "row_id") -> DataFrame:
    """The rows with listed numbers, in any order and as often as listed."""
    return numbers.select(row_id).join(rows, row_id)
