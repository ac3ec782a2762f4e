"""Exact quantiles of whole columns, without a task or a buffer that sees all distinct values.

A double's bits, with the sign turned, order as the doubles do. Each pass counts the values by the next bits, among
those that share the bits found so far; combined in each task, that is a bounded table of counts, and it tells
which bucket holds the wanted place and which place it is in there. As soon as a bucket has few values, these are
fetched and sorted; four passes settle any column, and one with many different values takes two.

Nulls do not count; NaN is above all other values, and both zeros are equal. A column without values has the
quantile null. Other numbers count as the double nearest to them.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.session import find_package

#: Bits that a pass looks at: at most 65,536 counts come back for each wanted place.
STEP = 16
WIDTH = 64
SIGN = np.uint64(1 << 63)


def keys_of(x: np.ndarray) -> np.ndarray:
    """Unsigned numbers that order as the doubles do."""
    x = np.where(np.isnan(x), np.nan, x + 0.0)  # one NaN, one zero
    bits = x.view(np.uint64)
    return np.where(bits & SIGN, ~bits, bits | SIGN)


def values_of(keys: np.ndarray) -> np.ndarray:
    """The doubles that :func:`keys_of` took."""
    return np.where(keys & SIGN, keys & ~SIGN, ~keys).astype(np.uint64).view(np.float64)


def _counted(df: DataFrame, columns: Sequence[str], open_: set[tuple[str, int, int]]) -> list:
    """(c, seen, prefix, bucket, n): of each column, the values that begin with ``seen`` bits of prefix, by their next bits."""
    wanted = sorted(open_)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {w: np.zeros(1 << STEP, np.int64) for w in wanted}
        for batch in batches:
            for c in {c for c, _, _ in wanted}:
                keys = keys_of(batch.column(c).drop_null().to_numpy(zero_copy_only=False))
                for w in (w for w in wanted if w[0] == c):
                    mine = keys if not w[1] else keys[keys >> np.uint64(WIDTH - w[1]) == np.uint64(w[2])]
                    bucket = (mine >> np.uint64(WIDTH - w[1] - STEP)) & np.uint64((1 << STEP) - 1)
                    totals[w] += np.bincount(bucket.astype(np.int64), minlength=1 << STEP)
        for k, w in enumerate(wanted):
            at = np.flatnonzero(totals[w])
            yield pa.record_batch([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(totals[w][at])], names=["w", "bucket", "n"])

    rows = df.mapInArrow(count, "w int, bucket int, n bigint").groupBy("w", "bucket").agg(F.sum("n").alias("n")).collect()
    return [(wanted[r["w"]], r["bucket"], r["n"]) for r in rows]


def _fetched(df: DataFrame, wanted: Sequence[tuple[str, int, int]]) -> dict[tuple[str, int, int], np.ndarray]:
    """The sorted keys of the values that begin with the bits; the caller knows that they are few."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (c, seen, prefix) in enumerate(wanted):
                keys = keys_of(batch.column(c).drop_null().to_numpy(zero_copy_only=False))
                keys, n = np.unique(keys[keys >> np.uint64(WIDTH - seen) == np.uint64(prefix)], return_counts=True)
                yield pa.record_batch([pa.array(np.full(len(keys), k, np.int32)), pa.array(keys.view(np.int64)), pa.array(n)], names=["w", "key", "n"])

    rows = df.mapInArrow(fetch, "w int, key bigint, n bigint").groupBy("w", "key").agg(F.sum("n").alias("n")).collect()
    out = {}
    for k, w in enumerate(wanted):
        own = [(r["key"], r["n"]) for r in rows if r["w"] == k]
        keys = np.array([x for x, _ in own], np.int64).view(np.uint64)
        order = np.argsort(keys)
        out[w] = np.repeat(keys[order], np.array([n for _, n in own], np.int64)[order])
    return out


def order_statistics(df: DataFrame, places: Mapping[str, Sequence[int]], few: int = 50_000) -> dict[tuple[str, int], float]:
    """By column and place, counted from 0, the value there in the column's order; places beyond the last are left out.

    ``few``: values of a bucket that may be fetched, copies of one value included.
    """
    find_package(df.sparkSession)
    df = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in places])
    where = {(c, p): (0, 0, p) for c in places for p in places[c]}  # bits seen, prefix, place among what begins with it
    small: dict[tuple[str, int, int], int] = {}
    out = {}
    while todo := {k: v for k, v in where.items() if (k[0], *v[:2]) not in small}:
        counts: dict[tuple[str, int, int], list[tuple[int, int]]] = {}
        for w, bucket, n in _counted(df, list(places), {(c, *v[:2]) for (c, _), v in todo.items()}):
            counts.setdefault(w, []).append((bucket, n))
        for (c, p), (seen, prefix, place) in todo.items():
            for bucket, n in sorted(counts.get((c, seen, prefix), ())):
                if place < n:
                    break
                place -= n
            else:
                del where[c, p]
                continue
            seen, prefix = seen + STEP, prefix << STEP | bucket
            if seen == WIDTH:
                out[c, p] = float(values_of(np.array([prefix], np.uint64))[0])
                del where[c, p]
                continue
            where[c, p] = seen, prefix, place
            if n <= few:
                small[c, seen, prefix] = n
    if where:
        found = _fetched(df, sorted({(c, *v[:2]) for (c, _), v in where.items()}))
        for (c, p), (seen, prefix, place) in where.items():
            out[c, p] = float(values_of(found[c, seen, prefix][place : place + 1])[0])
    return out


def quantiles(df: DataFrame, shares: Mapping[str, Sequence[float]]) -> dict[tuple[str, float], float | None]:
    """By column and share, the exact quantile; between two values in proportion, as a median of an even count is."""
    row = df.agg(*[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(shares)]).first()
    n = {c: row[i] for i, c in enumerate(shares)}
    at = {(c, q): q * (n[c] - 1) for c in shares for q in shares[c] if n[c]}
    places = {c: sorted({p for q in shares[c] for p in (floor(at[c, q]), min(floor(at[c, q]) + 1, n[c] - 1))}) for c in shares if n[c]}
    found = order_statistics(df, places) if places else {}

    def between(c: str, q: float) -> float:
        low = floor(at[c, q])
        a, b = found[c, low], found[c, min(low + 1, n[c] - 1)]
        return a if a == b or at[c, q] == low else a + (b - a) * (at[c, q] - low)

    return {(c, q): between(c, q) if n[c] else None for c in shares for q in shares[c]}


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """The exact median of each column."""
    return {c: v for (c, _), v in quantiles(df, {c: [0.5] for c in columns}).items()}
